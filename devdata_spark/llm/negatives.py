"""Hard negatives of anchors: exact scores from a residue number system, then windows.

Components are integers. A block of scores is one float32 matrix product for each of a few
primes below 512: residues between -254 and 254 keep sums of 260 products below 2^24, which
float32 holds exactly. Chinese remaindering gives the signed score back; as many primes are
used as the largest length of a vector asks for.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devdata_spark.llm.blocks import candidates, finite, first_of_rows, matrix
from devdata_spark.llm.common import ship, written

LARGEST_PRIME = 511
# Products of residues whose sum float32 holds exactly.
SLAB = 2**24 // (LARGEST_PRIME // 2) ** 2
# Scores are made for so many anchors at once: 16 MB with a block of 4,096 rows.
CHUNK = 512
LOWEST = np.iinfo(np.int64).min


def primes_for(largest: float) -> list[int]:
    """The largest primes below 512 whose product exceeds twice `largest`, in falling order.

    Their product must stay below 2^63, so `largest` may not pass about 2^61.
    """
    found, product, n = [], 1, LARGEST_PRIME
    while product <= 2 * largest + 1:
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            found.append(n)
            product *= n
        n -= 1
    if product >= 2**63:
        raise ValueError(f"scores up to {largest:.3g} do not fit in 63 bits")
    return found


def residues(x: np.ndarray, prime: int) -> np.ndarray:
    """Signed residues, between -(prime - 1) / 2 and (prime - 1) / 2, as float32."""
    rest = x % prime
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def products(q: list[np.ndarray], x: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows, as int64, from the residues of both sides."""
    value, radix = None, 1
    for a, b, prime in zip(q, x, primes):
        rest = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], SLAB):
            part = a[:, at : at + SLAB] @ b[:, at : at + SLAB].T
            rest += part.astype(np.int64)
        rest %= prime
        if value is None:
            value = rest
        else:  # the digit of this prime in mixed radix
            digit = (rest - value % prime) * pow(radix, -1, prime) % prime
            value += digit * radix
        radix *= prime
    value[value > radix // 2] -= radix
    return value


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
    id_column: str = "vec_id", vector: str = "embedding", label: Column | None = None,
    scale: int = 256, anchor_block: int = 8192, block: int = 4096, spread: int = 24,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x). The positives of an anchor (`is_anchor` is a
    condition on the column `id`) are its best other rows of the same label; for each, its
    negatives are the best rows of another label whose score is between four fifths of the
    positive's score and that score. Ties go to the smaller id. A positive of negative
    score has no negatives. `label` is an expression, the column `label` by default.

    Rows of NULL id, label or vector, or with a NULL or non-finite component, take no part;
    missing components of shorter vectors count as 0; of rows with one id the smallest
    (vector, label) counts. Other columns are ignored. Too long vectors are an error.

    Anchors meet all rows block by block, twice: for positives, then for negatives. A block
    pair is one group of bounded size. Every row is sent once for each `anchor_block`
    anchors. Small tables are cut into `spread` blocks of 64 rows at least.
    """
    spark = vectors.sparkSession
    ship(spark)
    own = F.col("label") if label is None else label
    rows = (
        vectors.select(
            F.col(id_column).cast("long").alias("id"),
            F.when(
                finite(F.col(vector)),
                F.transform(vector, lambda x: F.floor(x.cast("double") * scale)),
            ).alias("v"),
            own.cast("long").alias("label"),
        )
        .filter("id IS NOT NULL AND v IS NOT NULL AND label IS NOT NULL")
        .groupBy("id")
        .agg(F.min(F.struct("v", "label")).alias("row"))
        .select("id", "row.v", "row.label")
    )
    rows = written(rows, "negatives")
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, longest, width, n_anchors = rows.agg(
        F.count("*"), F.max(norm2), F.max(F.size("v")), F.count_if(is_anchor)
    ).first()
    primes = primes_for((longest or 0) * (1 + 1e-9) + 1)
    width = max(width or 0, 1)
    blocks = max(-(-n // block), min(spread, -(-n // 64)), 1)
    anchor_blocks = max(-(-n_anchors // anchor_block), 1)
    key = ["a_block", "block"]
    against = rows.select(
        F.col("id").alias("x"),
        F.col("v").alias("x_v"),
        F.col("label").alias("x_label"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("a_block"),
    )
    anchors = rows.filter(is_anchor).withColumn(
        "a_block", F.pmod(F.xxhash64("id"), F.lit(anchor_blocks)).cast("int")
    )

    def meet(asking: DataFrame, select, schema: str) -> DataFrame:
        sent = asking.withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        )
        pairs = sent.groupBy(*key).cogroup(against.groupBy(*key))
        return pairs.applyInArrow(_scorer(primes, width, select), schema)

    near = meet(anchors, _positives(positives), "anchor_id LONG, positive_id LONG, score LONG")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    chosen = written(
        near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives),
        "positives",
    )
    lists = chosen.groupBy(F.col("anchor_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("p")
    )
    asking = anchors.join(lists, "id").select(
        *anchors.columns,
        F.col("p.positive_id").alias("p_ids"),
        F.col("p.score").alias("p_scores"),
    )
    found = meet(
        asking, _negatives(negatives),
        "anchor_id LONG, positive_id LONG, positive_score LONG, negative_id LONG, negative_score LONG",
    )
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id"
    )
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= negatives)
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )


def _scorer(primes: list[int], width: int, select):
    """A function of a block of anchors and one of rows; `select` picks from their scores."""

    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if len(asked) and len(block):
            x = matrix(block["x_v"], width, np.int64)
            x_parts = [residues(x, p) for p in primes]
            x_ids, x_labels = block["x"].to_numpy(), block["x_label"].to_numpy()
            for at in range(0, len(asked), CHUNK):
                part = asked.slice(at, CHUNK)
                q = matrix(part["v"], width, np.int64)
                scores = products([residues(q, p) for p in primes], x_parts, primes)
                found.append(select(part, scores, x_ids, x_labels))
        return pa.concat_tables(found) if found else select(None, None, None, None)

    return run


def _positives(k: int):
    names = ["anchor_id", "positive_id", "score"]

    def select(asked, scores, ids, labels) -> pa.Table:
        if asked is None:
            return _longs(names, [[]] * 3)
        own = asked["id"].to_numpy()
        valid = labels[None, :] == asked["label"].to_numpy()[:, None]
        valid &= ids[None, :] != own[:, None]
        i, j = candidates(scores, valid, k, LOWEST)
        kept = first_of_rows(i, ids[j], scores[i, j], k)
        i, j = i[kept], j[kept]
        return _longs(names, [own[i], ids[j], scores[i, j]])

    return select


def _negatives(k: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def select(asked, scores, ids, labels) -> pa.Table:
        found = [[] for _ in names]
        if asked is not None:
            own = asked["id"].to_numpy()
            other = labels[None, :] != asked["label"].to_numpy()[:, None]
            p_ids, p_scores = asked["p_ids"].to_pylist(), asked["p_scores"].to_pylist()
            for place in range(max(map(len, p_ids), default=0)):
                row = np.flatnonzero([len(p) > place and p[place] >= 0 for p in p_scores])
                if not len(row):
                    continue
                high = np.array([p_scores[r][place] for r in row], np.int64)
                part = scores[row]
                low = high - high // 5  # four fifths, rounded up
                valid = other[row] & (part >= low[:, None]) & (part <= high[:, None])
                i, j = candidates(part, valid, k, LOWEST)
                kept = first_of_rows(i, ids[j], part[i, j], k)
                i, j = i[kept], j[kept]
                positive = np.array([p_ids[r][place] for r in row], np.int64)
                for out, new in zip(found, (own[row[i]], positive[i], high[i], ids[j], part[i, j])):
                    out.append(new)
        return _longs(names, [np.concatenate(f) if f else [] for f in found])

    return select


def _longs(names: list[str], columns: list) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)
