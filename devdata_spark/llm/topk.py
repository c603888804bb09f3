"""Exact top-k inner products: vectors by descending length, bounds on rotated parts.

Components become integers, so scores are exact. A rotation by the singular vectors of a
bounded sample moves most of a vector's weight to the front; a pair is scored in full only
if its partial sum over the front plus the product of the remaining lengths (an upper
bound by Cauchy and Schwarz) reaches the query's k-th best score so far. The rotation
only steers the pruning: results do not depend on the sample.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devdata_spark.llm.common import checkpointed, ship

# Vectors of similar length form a class; classes by length are at most a few hundred.
CLASSES_PER_OCTAVE = 4
CHUNK = 256


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; NULL if one is NULL or not finite."""
    usable = vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
    vector: str = "embedding", scale: int = 256, sample_rows: int = 20_000, front: int = 16,
    query_block: int = 1024, block: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query row.

    `is_query` is a condition on the id column. Ties go to the smaller id. Vectors that
    are NULL or hold a NULL or non-finite component, and rows of NULL id, take no part;
    missing components of shorter vectors count as 0; of rows with one id, the smallest
    vector counts. Fewer than k other rows give fewer results. Other columns are ignored.
    Scores must fit in 63 bits, as must components times `scale` in 31.

    Queries and candidates meet block by block. `sample_rows` bounds the rows (and 4
    million the numbers) that the rotation is fitted on, on the driver.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = checkpointed(
        vectors.select(
            F.col(id_column).cast("long").alias("id"), integers(F.col(vector), scale).alias("v")
        )
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .groupBy("id")
        .agg(F.min("v").alias("v"))
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        .withColumn(
            "length_class",
            F.when(
                F.col("norm2") > 0, F.floor(F.log2("norm2") / 2 * CLASSES_PER_OCTAVE)
            ).otherwise(-1),
        )
    )
    queries = rows.filter(is_query)
    classes = {
        r["length_class"]: r
        for r in rows.groupBy("length_class")
        .agg(F.count("*").alias("n"), F.max("norm2").alias("norm2"), F.max(F.size("v")).alias("d"))
        .collect()
    }
    empty = "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT"
    if not classes:
        return spark.createDataFrame([], empty)
    width = max(max(r["d"] for r in classes.values()), 1)
    rotation = _rotation(rows, width, min(sample_rows, 4_000_000 // width))
    query_blocks = -(-max(queries.count(), 1) // query_block)
    salts = {c: -(-r["n"] // block) for c, r in classes.items()}
    # the longest vectors give every query its first threshold
    first, covered = set(), 0
    for c in sorted(classes, reverse=True):
        if covered >= max(block, 4 * k):
            break
        first.add(c)
        covered += classes[c]["n"]

    blocks = spark.createDataFrame(
        [(c, salts[c], c in first) for c in classes], "length_class LONG, salts LONG, first BOOLEAN"
    )
    candidates = (
        rows.select(F.col("id").alias("x_id"), F.col("v").alias("x_v"), "length_class")
        .join(F.broadcast(blocks), "length_class")  # one row per length class
        .withColumn("salt", F.pmod(F.xxhash64("x_id"), F.col("salts")))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    asked = queries.select(
        "id", "v", "norm2", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("q_block")
    )

    def meet(asking: DataFrame, opening: bool) -> DataFrame:
        which = F.col("first") == opening
        own = F.array(
            *[
                F.struct(
                    F.lit(c).cast("long").alias("length_class"),
                    F.lit(salts[c]).cast("long").alias("salts"),
                    F.lit(float(np.sqrt(classes[c]["norm2"]))).alias("longest"),
                )
                for c in sorted(classes) if (c in first) == opening
            ]
        ).cast("array<struct<length_class:bigint,salts:bigint,longest:double>>")
        sent = (
            asking.select("*", F.inline(own))
            # a class whose longest vector cannot reach the threshold is not asked
            .filter(F.sqrt("norm2") * F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("least"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        )
        key = ["q_block", "length_class", "salt"]
        return (
            sent.select(*key, "id", "v", "least")
            .groupBy(*key)
            .cogroup(candidates.filter(which).select(*key, "x_id", "x_v").groupBy(*key))
            .applyInPandas(
                _scorer(rotation, width, min(front, width), k),
                "query_id BIGINT, vec_id BIGINT, score BIGINT",
            )
        )

    none = F.lit(float("-inf"))
    begun = checkpointed(meet(asked.withColumn("least", none), True))
    reached = (
        begun.groupBy("query_id", "score").count()
        .withColumn("above", F.sum("count").over(
            Window.partitionBy("query_id").orderBy(F.desc("score"))))
        .filter(F.col("above") >= k)
        .groupBy(F.col("query_id").alias("id"))
        .agg(F.max("score").cast("double").alias("least"))
    )
    thresholds = asked.join(reached, "id", "left").withColumn("least", F.coalesce("least", none))
    found = begun.union(meet(thresholds, False))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _rotation(rows: DataFrame, width: int, n: int) -> np.ndarray:
    """Right singular vectors of a sample: the n rows of the smallest hash."""
    sample = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(n).toPandas()["v"]
    matrix = _matrix(sample, width).astype(np.float64)
    _, vectors = np.linalg.eigh(matrix.T @ matrix)
    return np.ascontiguousarray(vectors[:, ::-1])


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _scorer(rotation: np.ndarray, width: int, front: int, k: int):
    """The k best of one block of candidates for each query of one block."""

    def score(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(asked) or not len(block):
            return pd.DataFrame(columns=columns).astype("int64")
        q, x = _matrix(asked["v"], width), _matrix(block["x_v"], width)
        q_ids, x_ids = asked["id"].to_numpy(), block["x_id"].to_numpy()
        least = asked["least"].to_numpy(dtype=np.float64).copy()
        by_length = np.argsort(-np.linalg.norm(x.astype(np.float64), axis=1), kind="stable")
        x, x_ids = x[by_length], x_ids[by_length]
        qr, xr = q @ rotation, x @ rotation
        q_rest = np.linalg.norm(qr[:, front:], axis=1)
        x_rest = np.linalg.norm(xr[:, front:], axis=1)
        q_length, x_length = np.linalg.norm(qr, axis=1), np.linalg.norm(xr, axis=1)
        best = (np.empty(0, np.int64),) * 3  # query row, id, score
        for at in range(0, len(x), CHUNK):
            slack = 1e-9 * q_length * x_length[at] + 1e-6  # rounding of the rotation
            alive = np.flatnonzero(q_length * x_length[at] + slack >= least)
            if not len(alive):
                break  # lengths only fall from here
            part = slice(at, at + CHUNK)
            bound = qr[alive, :front] @ xr[part, :front].T
            bound += q_rest[alive, None] * x_rest[None, part] + slack[alive, None]
            i, j = np.nonzero(bound >= least[alive, None])
            i, j = alive[i], j + at
            other = q_ids[i] != x_ids[j]
            i, j = i[other], j[other]
            scores = np.empty(len(i), np.int64)
            for s in range(0, len(i), 65_536):
                e = s + 65_536
                scores[s:e] = np.einsum("nd,nd->n", q[i[s:e]], x[j[s:e]])
            best = _best(
                np.concatenate([best[0], i]), np.concatenate([best[1], x_ids[j]]),
                np.concatenate([best[2], scores]), k,
            )
            rows, counts = np.unique(best[0], return_counts=True)
            ends = np.cumsum(counts) - 1
            full = counts >= k
            least[rows[full]] = np.maximum(least[rows[full]], best[2][ends[full]])
        return pd.DataFrame({"query_id": q_ids[best[0]], "vec_id": best[1], "score": best[2]})

    return score


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The first k of each row by falling score, then id; sorted so."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    keep = place < k
    return rows[keep], ids[keep], scores[keep]
