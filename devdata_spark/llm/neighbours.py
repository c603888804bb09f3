"""Approximate nearest neighbours by cosine: cross-polytope hashing with many probes.

A unit vector is turned by three rounds of random signs and a fast Hadamard transform and
falls to the nearest signed axis; a bucket is the axes of as many such turns as the size of
the table asks for. A query looks into the buckets of the axes nearest to it, in each of
several tables, and everything found is scored exactly.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devdata_spark.llm.blocks import candidates, finite, first_of_rows, matrix
from devdata_spark.llm.common import join_small, ship, written

CHUNK = 512


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; no square can overflow."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0))
    x = np.ldexp(x, -exponent[:, None])
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of rows, whose width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(rows, width) / np.sqrt(width)


class CrossPolytope:
    """`tables` hash functions, each of `levels` pseudo-rotations."""

    def __init__(self, width: int, tables: int, levels: int, seed: int = 0):
        self.width = 1 << max(width - 1, 1).bit_length()
        self.tables, self.levels = tables, levels
        draw = np.random.default_rng(seed)
        self.signs = draw.choice([-1.0, 1.0], size=(tables, levels, 3, self.width))

    def sides(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        """The closeness of each row to each of the 2 * width signed axes."""
        padded = np.zeros((len(x), self.width))
        padded[:, : x.shape[1]] = x
        for signs in self.signs[table, level]:
            padded = hadamard(padded * signs)
        return np.concatenate([padded, -padded], axis=1)

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each row."""
        place = np.zeros(len(x), np.int64)
        for level in range(self.levels):
            place = place * 2 * self.width + self.sides(x, table, level).argmax(axis=1)
        return place

    def probes(self, x: np.ndarray, table: int, n: int) -> np.ndarray:
        """The n buckets nearest to each row, nearest first: rows by probes.

        Buckets are ranked by the sum of the row's closeness to their axes.
        """
        places, values = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for level in range(self.levels):
            sides = self.sides(x, table, level)
            axes = np.argsort(-sides, axis=1, kind="stable")[:, : min(n, 2 * self.width)]
            near = np.take_along_axis(sides, axes, 1)
            # the i-th place with the j-th axis has (i + 1) (j + 1) - 1 better ones at least
            i, j = np.arange(places.shape[1])[:, None], np.arange(axes.shape[1])[None, :]
            i, j = np.nonzero((i + 1) * (j + 1) <= n)
            places = places[:, i] * 2 * self.width + axes[:, j]
            values = values[:, i] + near[:, j]
            first = np.argsort(-values, axis=1, kind="stable")[:, :n]
            places = np.take_along_axis(places, first, 1)
            values = np.take_along_axis(values, first, 1)
        return places


def probes_needed(sample: np.ndarray, hashing: CrossPolytope, k: int, recall: float) -> int:
    """The least number of probes in each table that finds a share of a sample's neighbours.

    Neighbours within a sample are further apart than those in the whole table, so that
    more of the latter are found.
    """
    most = (2 * hashing.width) ** hashing.levels
    asked = sample[: min(len(sample), 256)]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -2
    near = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    if not near.size:
        return 1
    least = np.full(near.shape, most)
    for table in range(hashing.tables):
        own = hashing.buckets(sample, table)[near]
        probes = hashing.probes(asked, table, min(most, 4096))
        hit = own[:, :, None] == probes[:, None, :]
        rank = np.where(hit.any(axis=2), hit.argmax(axis=2) + 1, most)
        least = np.minimum(least, rank)
    return int(np.sort(least.ravel())[int(np.ceil(recall * least.size)) - 1])


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
    vector: str = "embedding", tables: int = 6, recall: float = 0.96, sample_rows: int = 4096,
    block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for every query row.

    `is_query` is a condition on the column `id`. Score is the cosine of the original
    vectors in double precision; ties go to the smaller id. A query with fewer than k
    other rows in its buckets gets fewer results. Rows of NULL id or vector, of zero
    vectors, or with a NULL or non-finite component, take no part; missing components of
    shorter vectors count as 0; of rows with one id the smallest vector counts. Other
    columns are ignored.

    Equal vectors are hashed and compared once, for their k + 1 smallest ids; so are equal
    queries. Every distinct vector is indexed in every table. The number of turns in a hash
    grows with the table, so that an even bucket has no more than `block` vectors (up to
    that size there is one bucket, and the search is exact); the
    number of probes is fitted to `recall` on the `sample_rows` vectors of the smallest hash
    (4 million numbers at most, on the driver). Fuller buckets are split into blocks, and
    each of their queries is sent to all of them: nothing is left out.
    """
    spark = vectors.sparkSession
    ship(spark)
    given = vectors.select(vector).schema[0].dataType.simpleString()
    kind = given if given == "array<float>" else "array<double>"  # as small as they come
    rows = (
        vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"))
        .filter(F.col("id").isNotNull() & finite(F.col("v")) & F.exists("v", lambda x: x != 0))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
        .withColumn("query", F.coalesce(is_query, F.lit(False)))
    )
    rows = written(rows, "vectors")
    # the k + 1 smallest ids of a vector answer every query; k + 1 of its queries mark it
    by_id = Window.partitionBy("v", "query").orderBy("id")
    points = (
        rows.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(
            F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"),
            F.max("query").alias("query"),
        )
        .withColumn("point", F.array_min("ids"))
    )
    points = written(points, "points")
    n, width = points.agg(F.count("*"), F.max(F.size("v"))).first()
    schema = "query_id LONG, rank INT, vec_id LONG, score DOUBLE"
    if not n:
        return spark.createDataFrame([], schema)
    hashing, probes = _fitted(points, n, width, k, tables, recall, sample_rows, block)

    # hashing twice costs less than keeping the index
    hashed = f"table INT, bucket LONG, point LONG, v {kind}"
    index = points.select("point", "v").mapInArrow(_hashed(hashing, width, None), hashed)
    sizes = (
        points.select("v").mapInArrow(_counted(hashing, width), "table INT, bucket LONG, n LONG")
        .groupBy("table", "bucket").agg(F.sum("n").alias("n"))
    )
    full = sizes.filter(F.col("n") > block).select(
        "table", "bucket", F.ceil(F.col("n") / block).cast("long").alias("blocks")
    )
    asked = points.filter("query").select("point", "v").mapInArrow(
        _hashed(hashing, width, probes), hashed
    )
    key = ["table", "bucket", "block"]
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    stored = join_small(index, full, ["table", "bucket"], "left").withColumn(
        "block", F.pmod(F.xxhash64("point"), blocks)
    )
    asked = join_small(asked, full, ["table", "bucket"], "left").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    )
    pairs = (
        asked.select(*key, "point", "v")
        .groupBy(*key)
        .cogroup(stored.select(*key, F.col("point").alias("x"), "v").groupBy(*key))
        .applyInArrow(_scorer(width, k), "point LONG, x LONG, score DOUBLE")
        .dropDuplicates(["point", "x"])
    )
    best = Window.partitionBy("point").orderBy(F.desc("score"), "x")
    pairs = pairs.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    ids = points.select(F.col("point").alias("x"), "ids")
    lists = (
        pairs.join(ids, "x")
        .select("point", F.transform("ids", lambda i: F.struct(
            (-F.col("score")).alias("minus"), i.alias("id"))).alias("found"))
        .groupBy("point")
        .agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    )
    queries = rows.filter("query").join(points.select("v", "point"), "v").select("id", "point")
    others = F.filter("found", lambda f: f["id"] != F.col("id"))
    return (
        queries.join(lists, "point")
        .select("id", F.posexplode(F.slice(others, 1, k)).alias("place", "hit"))
        .select(
            F.col("id").alias("query_id"),
            (F.col("place") + 1).alias("rank"),
            F.col("hit.id").alias("vec_id"),
            (-F.col("hit.minus")).alias("score"),
        )
    )


def _fitted(points, n, width, k, tables, recall, sample_rows, block):
    """The hash functions, and the number of probes in each table."""
    levels, axes = 0, 2 * CrossPolytope(width, 1, 1).width
    while n > block * axes**levels:
        levels += 1
    if not levels:  # one bucket holds all
        return CrossPolytope(width, 1, 0), 1
    hashing = CrossPolytope(width, tables, levels)
    size = min(sample_rows, 4_000_000 // width)
    sample = points.select("v").orderBy(F.xxhash64("point"), "point").limit(size).toArrow()
    return hashing, probes_needed(unit(matrix(sample["v"], width, np.float64)), hashing, k, recall)


def _hashed(hashing: CrossPolytope, width: int, probes: int | None):
    """Each vector once for each table; with `probes`, for each bucket to look into."""

    def run(batches):
        for batch, start in ((b, s) for b in batches for s in range(0, b.num_rows, CHUNK)):
            part = batch.slice(start, CHUNK)
            x = unit(matrix(part.column("v"), width, np.float64))
            for table in range(hashing.tables):
                if probes is None:
                    buckets = hashing.buckets(x, table)[:, None]
                else:
                    buckets = hashing.probes(x, table, probes)
                row = np.repeat(np.arange(len(x)), buckets.shape[1])
                for at in range(0, len(row), 8 * CHUNK):
                    some = row[at : at + 8 * CHUNK]
                    yield pa.record_batch(
                        {
                            "table": pa.array(np.full(len(some), table), pa.int32()),
                            "bucket": pa.array(buckets.ravel()[at : at + len(some)], pa.int64()),
                            "point": part.column("point").take(pa.array(some)),
                            "v": part.column("v").take(pa.array(some)),
                        }
                    )

    return run


def _counted(hashing: CrossPolytope, width: int):
    """How many vectors of each batch fall into each bucket of each table."""

    def run(batches):
        for batch in batches:
            x = unit(matrix(batch.column("v"), width, np.float64))
            for table in range(hashing.tables):
                buckets, n = np.unique(hashing.buckets(x, table), return_counts=True)
                columns = {
                    "table": pa.array(np.full(len(n), table), pa.int32()),
                    "bucket": pa.array(buckets, pa.int64()),
                    "n": pa.array(n, pa.int64()),
                }
                yield pa.record_batch(columns)

    return run


def _scorer(width: int, k: int):
    """The k + 1 nearest vectors of one block for each query of it, the query included."""

    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(asked) and len(block):
            x, x_ids = unit(matrix(block["v"], width, np.float64)), block["x"].to_numpy()
            for at in range(0, len(asked), CHUNK):
                part = asked.slice(at, CHUNK)
                q, q_ids = unit(matrix(part["v"], width, np.float64)), part["point"].to_numpy()
                rough = q @ x.T
                i, j = candidates(rough, np.ones(rough.shape, bool), k + 1, -2.0, 1e-12 * width)
                # sums of one row do not depend on the block, so a pair has one score
                scores = np.empty(len(i))
                for s in range(0, len(i), 65_536):
                    e = s + 65_536
                    scores[s:e] = np.einsum("nd,nd->n", q[i[s:e]], x[j[s:e]])
                kept = first_of_rows(i, x_ids[j], scores, k + 1)
                found.append((q_ids[i[kept]], x_ids[j[kept]], scores[kept]))
        point, x_id, score = (np.concatenate(f) for f in zip(*found))
        return pa.table(
            [pa.array(point, pa.int64()), pa.array(x_id, pa.int64()), pa.array(score, pa.float64())],
            names=["point", "x", "score"],
        )

    return run
