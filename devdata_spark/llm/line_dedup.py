"""Near-duplicate lines: MinHash of character shingles, banding, exact Jaccard, union-find.

Equal lines are one node. A line's signature has one minimum for each of `BINS` bins of
three hashes of its shingles; bands of `ROWS` minima are index keys. Lines that share a key
are compared on their shingle sets, links make components, and the first line of each
component, by document and place, stays.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import claim, join_kept, kept, release, ship, trim
from devdata_spark.llm.linking import SKETCH, SKETCH_SCHEMA, linked, may_link, sketch
from devdata_spark.llm.packed import mix, pack, shared

SHINGLE = 8
PERCENT = 80
# At a similarity of 0.8 a pair shares one of the bands with a chance of 0.998.
BANDS, ROWS = 12, 4
BINS = BANDS * ROWS
# Odd numbers; each shingle goes into a bin by each of them, so that short lines fill most bins.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
EMPTY = np.uint32(0xFFFFFFFF)
# Pairs that a task compares at a time, to bound its memory.
PAIRS = 128
# Characters that make no line: Unicode's white space.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# Up to so many places of removed lines (24 MB) are sent to every task.
SENT_PLACES = 1_500_000


def shingle_set(line: str) -> set[str]:
    """The distinct character shingles of a line; a shorter line is one shingle."""
    if len(line) <= SHINGLE:
        return {line}
    return {line[i : i + SHINGLE] for i in range(len(line) - SHINGLE + 1)}


def _hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of the lines, and the line of each."""
    # a short line is filled up with a sign of its own, so that it is one shingle
    padded = [t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\uffff") for t in lines]
    sizes = np.array([len(t) for t in padded], np.int64)
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    hashes = codes.astype(np.uint64)
    width = 1
    while width < SHINGLE:
        hashes = hashes[:-width] * np.uint64(pow(FACTORS[0], width, 2**64)) + hashes[width:]
        width *= 2
    ends = np.cumsum(sizes)
    line = np.repeat(np.arange(len(lines)), sizes)[: len(hashes)]
    inside = np.arange(len(hashes)) + SHINGLE <= ends[line]
    return mix(hashes[inside]), line[inside]


def band_keys(lines: list[str]) -> np.ndarray:
    """Index keys of lines: an array of lines by bands of 64-bit integers."""
    hashes, line = _hashes(lines)
    line = line * BINS
    least = np.full(len(lines) * BINS, EMPTY)
    for factor in FACTORS:
        own = hashes * np.uint64(factor)
        place = ((own >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        np.minimum.at(least, line + place.astype(np.int64), own.astype(np.uint32))
    signature = _filled(least.reshape(len(lines), BINS)).astype(np.uint64)
    signature = signature.reshape(len(lines), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(lines), BANDS))
    for row in range(ROWS):
        keys = mix(keys * np.uint64(FACTORS[1]) + signature[:, :, row])
    return keys


def _filled(least: np.ndarray) -> np.ndarray:
    """Empty bins take the next filled bin's minimum, changed by how far it is."""
    todo = np.flatnonzero((least == EMPTY).any(axis=1))
    source = least[todo]
    result, distance = source.copy(), 0
    while len(todo) and (result == EMPTY).any():
        distance += 1
        if distance == BINS:
            break
        moved = np.roll(source, -distance, axis=1)
        use = (result == EMPTY) & (moved != EMPTY)
        result[use] = moved[use] + np.uint32(distance * 0x9E3779B1 & 0xFFFFFFFF)
    least[todo] = result
    return least


def dedup(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] = ()
) -> DataFrame:
    """doc_id, n_lines, n_removed, text: every document without its repeated lines.

    Lines end at a line feed. Lines of white space only are no lines to remove. Of each
    component of equal or similar lines the smallest (doc_id, place) stays. A document of
    which nothing stays has the empty text. NULL text stays NULL; a row of NULL doc_id
    keeps its text; rows of one doc_id are one document. Other columns are ignored, but
    for those that `keep` names, which go with their rows.
    """
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.struct(F.lit(True).alias("row"), *[F.col(c) for c in keep if c != doc_id]).alias("others"),
    )
    lines = (
        docs.filter("doc_id IS NOT NULL")
        .select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
        .filter(F.btrim("line", F.lit(WHITE_SPACE)) != "")
        .withColumn("node", F.xxhash64("line"))
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = pack(lines.select("node", "line"), _entries, buckets, short=True)
    entries = kept(shared(packed, short=True), "entries")
    items = kept(_items(lines, entries), "items")
    roots = linked(entries, items, PERCENT, lambda pairs: _verified(items, pairs))
    release(entries, items)
    placed = join_kept(lines.drop("line"), roots, "node", "left").select(
        "doc_id", "place", "node", F.coalesce("root", "node").alias("root")
    )
    first = kept(
        placed.groupBy("root")
        .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("root", "first"),
        "first",
    )
    gone = (
        join_kept(placed, first, "root")
        .filter(F.struct("doc_id", "place") != F.col("first"))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("place", "node")).alias("gone"))
    )
    gone = kept(gone, "gone")
    release(first)
    if (gone.agg(F.sum(F.size("gone") + 2)).first()[0] or 0) <= SENT_PLACES:
        gone = F.broadcast(gone)
    marked = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct(i.alias("place"), F.xxhash64(line).alias("node")),
    )
    staying = F.transform(
        F.array_except("marked", "gone"), lambda m: F.get("lines", m["place"])
    )
    return (
        docs.join(gone, "doc_id", "left")
        .withColumn("lines", F.split("text", "\n", -1))
        .withColumn("marked", marked)
        .withColumn("kept", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(staying))
        .select(
            "doc_id",
            F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
            F.when(F.col("gone").isNull(), F.col("text"))
            .otherwise(F.array_join("kept", "\n"))
            .alias("text"),
            *[F.col("others")[c].alias(c) for c in keep if c != doc_id],
        )
    )


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    claim("line_dedup")
    nodes = batch.column("node").to_numpy()
    nodes, first = np.unique(nodes, return_index=True)
    if not len(nodes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys = band_keys(batch.column("line").take(pa.array(first)).to_pylist())
    return keys.ravel(), np.repeat(nodes, BANDS)


def _items(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """The lines that share a key, with the size and sketch of their shingle sets."""

    def run(batches):
        for batch in batches:
            texts = batch.column("line").to_pylist()
            sets = []
            for at in range(0, len(texts), PAIRS):
                some = texts[at : at + PAIRS]
                sets += map(_sets(some).__getitem__, some)
            sketches = np.array([sketch(s) for s in sets], np.int64).reshape(len(sets), -1)
            columns = {
                "node": batch.column("node"),
                "line": batch.column("line"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
            }
            columns |= {name: sketches[:, i] for i, name in enumerate(SKETCH)}
            yield pa.record_batch(columns)
        trim()

    needed = kept(entries.select("node").distinct(), "needed")
    texts = (
        join_kept(lines.select("node", "line"), needed, "node")
        .groupBy("node").agg(F.min("line").alias("line"))
    )
    return texts.mapInArrow(run, f"node BIGINT, line STRING, n BIGINT, {SKETCH_SCHEMA}")


def similar_lines(a: list[str], b: list[str]) -> list[bool]:
    """Whether the shingle sets of each two lines reach the similarity.

    Shingles are compared by 64-bit hashes: in a pair of lines of 1,000 characters a wrong
    match has a chance of 10^-13.
    """
    found = []
    for at in range(0, len(a), PAIRS):
        x, y = a[at : at + PAIRS], b[at : at + PAIRS]
        sets = _sets(list({*x, *y}))
        for s, t in zip(map(sets.__getitem__, x), map(sets.__getitem__, y)):
            together = np.sort(np.concatenate([s, t]))
            common = np.count_nonzero(together[1:] == together[:-1])
            found.append(100 * common >= PERCENT * (len(together) - common))
    return found


def _sets(lines: list[str]) -> dict[str, np.ndarray]:
    """The distinct hashes of each line's shingles."""
    hashes, line = _hashes(lines)
    ends = np.searchsorted(line, np.arange(len(lines)), "right")
    found, at = {}, 0
    for text, end in zip(lines, ends.tolist()):
        own = np.sort(hashes[at:end])
        fresh = np.ones(len(own), bool)
        np.not_equal(own[1:], own[:-1], out=fresh[1:])
        found[text], at = own[fresh], end
    return found


def _verified(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are similar enough."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(similar_lines(a.tolist(), b.tolist()), dtype=bool)

    own = items.select("node", "line", "n", *SKETCH)
    x, y = own.withColumnRenamed("node", "a"), own.withColumnRenamed("node", "b")
    both = pairs.join(x.alias("x"), "a").join(y.alias("y"), "b").filter(may_link(PERCENT, "x", "y"))
    texts = both.select("a", "b", F.col("x.line").alias("x"), F.col("y.line").alias("y"))
    return texts.filter(similar("x", "y")).select("a", "b")
