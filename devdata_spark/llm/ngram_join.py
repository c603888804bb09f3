"""Documents whose word-shingle sets have a Jaccard similarity of some percent, exactly.

Sets of similar size fall into size bands. Two linked sets of r and s shingles differ in
at most (r + s) (100 - percent) / (100 + percent) of them, so when the shingle universe is split into more segments by
hash than that, some segment holds the same subset in both. Each subset's hash is indexed;
where it pays, a segment also indexes its subsets with one shingle left out, counts for
two and makes the other segments larger. Pairs that meet are verified on the sets.
"""

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import (
    SENT_ROWS,
    claim,
    free_shuffles,
    join_kept,
    join_small,
    kept,
    memo,
    release,
    ship,
    trim,
)
from devdata_spark.llm.linking import (
    SKETCH,
    SKETCH_SCHEMA,
    linked,
    may_link,
    may_link_wide,
    sketch,
    wide_sketch,
)
from devdata_spark.llm.packed import mix, pack, shared

# What op9 asks for; other callers name their own.
N = 3
PERCENT = 90
# Words whose hash a worker remembers before it starts anew.
MEMO_WORDS = 150_000
# Entries are dealt into buckets of so many bytes, which a task unpacks one at a time.
ENTRY_BYTES, BUCKET_BYTES = 12, 8 << 20
# What verifying a pair that met by chance costs, in index entries.
PAIR_COST = 50
# Pairs whose sets are moved at a time: their nodes are few enough to be sent to every task.
WAVE_PAIRS = SENT_ROWS // 2


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


_words = _Words()


def _forget() -> bool:
    known = len(_words) > 0
    _words.clear()
    return known


memo("ngram_join", _forget)
# Texts whose sets a task holds at a time.
ROWS = 256


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct n-word shingles; fewer words are one.

    Words are runs without ASCII white space after A-Z are lowered. Shingles are compared
    by these hashes: among 10^14 shingles a wrong match inside a compared pair has a
    chance of about 10^-13.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for i in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashed[i : i + count])
    return np.unique(total)


def node_of(sets: np.ndarray) -> int:
    """A 64-bit hash of a whole set: equal sets are one node."""
    return int.from_bytes(hashlib.blake2b(sets.tobytes(), digest_size=8).digest(), "little", signed=True)


def _edges(most: int, percent: int = PERCENT) -> list[int]:
    """Lower ends of the size bands up to `most`; partners are in the next band at most."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    return [*edges, *(edges[-1] * 2**i for i in (1, 2))]


def budget(edges: list[int], band: int, percent: int = PERCENT) -> int:
    """The most shingles in which a linked pair with its smaller set in `band` differs."""
    largest = edges[band + 1] - 1
    partner = min(largest * 100 // percent, edges[band + 2] - 1)
    return (largest + partner) * (100 - percent) // (100 + percent)


def allocate(size: float, differences: int, sets: int) -> tuple[int, int]:
    """Segments in all, and how many of them index one-deletion neighbourhoods, by cost.

    Every plan's segments count for more than the allowed differences. Costs are index
    entries, and pairs that meet only because a segment holds nothing (or one shingle,
    where deletions are indexed) in both.
    """
    best = None
    for deleting in range((differences + 1) // 2 + 1):
        segments = differences + 1 - deleting
        each = size / segments
        empty, few = math.exp(-each), math.exp(-each) * (1 + each)
        entries = segments + deleting * each
        chance = (segments - deleting) * empty**2 + deleting * few**2
        cost = entries * sets + PAIR_COST * chance * sets * sets / 2
        if best is None or cost < best[0]:
            best = (cost, segments, deleting)
    return best[1], best[2]


def signatures(sets: np.ndarray, scheme: int, segments: int, deleting: int) -> np.ndarray:
    """Index keys of one set under one scheme."""
    of = (sets >> np.uint64(20)) % np.uint64(segments)
    spread = mix(sets)
    sums = np.zeros(segments, np.uint64)
    np.add.at(sums, of.astype(np.int64), spread)
    place = mix(np.arange(segments, dtype=np.uint64) + np.uint64(scheme * 1_000_003 + 1))
    keys = mix(sums ^ place)
    if deleting:
        inner = of < deleting
        at = of[inner].astype(np.int64)
        keys = np.concatenate([keys, mix((sums[at] - spread[inner]) ^ place[at])])
    return keys


def classes(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles, component_id for every document.

    Documents are linked whose sets of `n`-word shingles are similar by `percent` or more;
    component_id is the smallest doc_id that links reach, the own one included. NULL or
    empty texts, and texts without words, have no shingles and no links; a NULL doc_id
    keeps NULL as component and links nothing; repeated rows each get a result, and two
    rows of one doc_id are one document's. Other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sized = kept(_sized(docs, n), "sized")
    usable = sized.filter("doc_id IS NOT NULL AND n_shingles > 0")
    groups = kept(
        usable.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n")
        ),
        "nodes",
    )
    most = usable.agg(F.max("n_shingles")).first()[0] or 1
    edges = _edges(most, percent)
    counted = groups.groupBy(F.floor(F.log("n") * 64).alias("size")).agg(
        F.count("*").alias("sets"), F.sum("n").alias("shingles")
    )
    counted = [(r["sets"], r["shingles"]) for r in counted.collect()]
    plans = _plans(edges, counted, percent)
    buckets = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        int(_expected(edges, plans, counted) * ENTRY_BYTES) // BUCKET_BYTES,
    )
    packed = pack(docs, _indexer(edges, plans, n, percent), buckets, short=True)
    entries = kept(shared(packed, short=True), "entries")
    del packed
    free_shuffles(spark)
    items = kept(_items(docs, groups, entries, n), "items")
    free_shuffles(spark)
    roots = linked(entries, items, percent, lambda pairs: _verified(items, pairs, percent))
    release(groups, entries, items)
    rooted = join_kept(sized, roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # only components of several documents need a look-up
    least = kept(
        rooted.filter("doc_id IS NOT NULL AND root IS NOT NULL")
        .groupBy("root")
        .agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("root", "component_id"),
        "least",
    )
    return join_kept(rooted, least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
            "component_id"
        ),
    )


def _slices(batches):
    claim("ngram_join")
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
    trim()


def _sized(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in _slices(batches):
            sets = [shingles(t, n) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                }
            )

    return docs.mapInArrow(run, "doc_id BIGINT, n_shingles BIGINT, node BIGINT")


def _plans(
    edges: list[int], counted: list[tuple[int, int]], percent: int
) -> list[tuple[int, int]]:
    """(segments, deleting) of each scheme, which holds the sets of two bands."""
    bands = [0] * len(edges)
    for sets, total in counted:
        bands[int(np.searchsorted(edges, total / sets, side="right")) - 1] += sets
    return [
        allocate((edges[i] + edges[i + 1]) / 2, budget(edges, i, percent), bands[i] + bands[i + 1])
        for i in range(len(edges) - 2)
    ]


def _expected(
    edges: list[int], plans: list[tuple[int, int]], counted: list[tuple[int, int]]
) -> float:
    """How many index entries the counted sets have."""
    entries = 0.0
    for sets, total in counted:
        size = total / sets
        band = int(np.searchsorted(edges, size, side="right")) - 1
        for scheme in (band - 1, band):
            if 0 <= scheme < len(plans):
                segments, deleting = plans[scheme]
                entries += sets * (segments + deleting * size / segments)
    return entries


def _indexer(edges: list[int], plans: list[tuple[int, int]], n: int, percent: int):
    def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        claim("ngram_join")
        keys, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
            sets = shingles(text, n)
            if doc_id is None or not len(sets):
                continue
            band = int(np.searchsorted(edges, len(sets), side="right")) - 1
            own = [
                signatures(sets, scheme, *plans[scheme])
                for scheme in (band - 1, band)
                if scheme >= 0 and budget(edges, scheme, percent) > 0
            ]
            if own:
                keys += own
                nodes.append(np.full(sum(map(len, own)), node_of(sets), np.int64))
        return np.concatenate(keys), np.concatenate(nodes)

    return entries


def _items(docs: DataFrame, groups: DataFrame, entries: DataFrame, n: int) -> DataFrame:
    """The sets of the nodes that share a key, one document's for each node."""
    needed = groups.join(entries.select("node").distinct(), "node").select("node", "doc_id")

    def run(batches):
        for batch in _slices(batches):
            sets = [shingles(t, n) for t in batch.column("text").to_pylist()]
            # another row of the doc_id may have another text
            own = [node_of(s) == node for s, node in zip(sets, batch.column("node").to_pylist())]
            batch, sets = batch.filter(pa.array(own, pa.bool_())), [s for s, o in zip(sets, own) if o]
            sketches = np.array([sketch(s) for s in sets], np.int64).reshape(len(sets), -1)
            columns = {
                "node": batch.column("node"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "s": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                "wide": pa.array(map(wide_sketch, sets), pa.list_(pa.int64())),
            }
            columns |= {name: sketches[:, i] for i, name in enumerate(SKETCH)}
            yield pa.record_batch(columns)

    texts = join_small(docs, needed, "doc_id").select("node", "text")
    schema = f"node BIGINT, n BIGINT, s ARRAY<BIGINT>, wide ARRAY<BIGINT>, {SKETCH_SCHEMA}"
    return texts.mapInArrow(run, schema).dropDuplicates(["node"])


def _fitting(items: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """a, b, n_a, n_b: the pairs of nodes whose sizes and sketches allow a link."""
    own = items.select("node", "n", "wide", *SKETCH)
    x, y = own.withColumnRenamed("node", "a").alias("x"), own.withColumnRenamed("node", "b").alias("y")
    return (
        pairs.join(x, "a").join(y, "b").filter(may_link(percent, "x", "y"))
        .filter(may_link_wide(percent, "x", "y"))
        .select("a", "b", F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"))
    )


def _verified(items: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough, as kept tables.

    Sets are moved only for pairs whose sketches allow a link, and in waves, each of which
    ends before the next: a wave moves a set for each of its pairs, in all not much more
    than the sets of all items, whatever the number of pairs.
    """
    fitting = kept(_fitting(items, pairs, percent), "fitting")
    count, moved = fitting.agg(F.count("*"), F.sum(F.col("n_a") + F.col("n_b"))).first()
    held = items.agg(F.sum("n")).first()[0]
    waves = max(1, -(-count // WAVE_PAIRS), -(-(moved or 0) // (held or 1)))
    links = []
    for wave in range(waves):
        some = fitting.filter(F.pmod(F.xxhash64("a", "b"), F.lit(waves)) == wave)
        needed = kept(some.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "needed")
        sets = join_kept(items.select("node", "s"), needed, "node", "left_semi")
        links.append(kept(_similar(some, sets, percent), "links"))
        release(needed)
    release(fitting)
    return reduce(DataFrame.union, links)


def _similar(fitting: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough."""
    both = fitting.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select(
        "a", "b"
    )
