"""From nodes that share a key to components of verified links, without all pairs."""

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import SENT_ROWS, free_shuffles, join_kept, kept, release
from devdata_spark.llm.graph import components

# Rounds in which nodes are compared with one node of each key only.
ROUNDS = 2
BITS = 1024
SKETCH = [f"sketch_{i}" for i in range(BITS // 64)]
SKETCH_SCHEMA = ", ".join(f"{name} BIGINT" for name in SKETCH)


def sketch(sets: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parities of a set's hashes in `bits` classes, a power of two, as 64-bit integers.

    Each element in which two sets differ changes one parity, so sets differ in at least
    as many elements as sketches do in bits.
    """
    parity = np.bincount((sets >> np.uint64(8)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def wide_sketch(sets: np.ndarray) -> np.ndarray:
    """As `sketch`, with at least as many classes as elements; empty where `BITS` are that.

    Any two sets of many more elements than classes differ in half of the parities, which
    is less than large sets may differ in.
    """
    bits = 1 << (len(sets) - 1).bit_length()
    return sketch(sets, bits) if bits > BITS else np.empty(0, np.int64)


def wide_apart(x: np.ndarray, y: np.ndarray) -> int:
    """The bits in which two wide sketches differ, the wider one folded; 0 if one is empty.

    Classes are residues, so a fold by exclusive or is the sketch of fewer classes.
    """
    width = min(len(x), len(y))
    if not width:
        return 0
    x, y = (np.bitwise_xor.reduce(s.reshape(-1, width)) for s in (x, y))
    return int(np.bitwise_count((x ^ y).view(np.uint64)).sum())


def may_link(percent: int, x: str, y: str) -> Column:
    """Whether sizes and sketches allow a Jaccard similarity of `percent`.

    Such sets of r and s elements differ in (r + s) (100 - percent) / (100 + percent)
    elements at most.
    """
    n_x, n_y = F.col(f"{x}.n"), F.col(f"{y}.n")
    bits = [F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in SKETCH]
    apart = reduce(Column.__add__, bits)
    sizes = 100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)
    return sizes & (apart * (100 + percent) <= (n_x + n_y) * (100 - percent))


def may_link_wide(percent: int, x: str, y: str) -> Column:
    """As `may_link`, by the wide sketches that `wide` holds."""

    @F.pandas_udf("boolean")
    def fits(x: pd.Series, y: pd.Series, n: pd.Series) -> pd.Series:
        apart = pd.Series(map(wide_apart, x, y), n.index, "int64")
        return apart * (100 + percent) <= n * (100 - percent)

    return fits(F.col(f"{x}.wide"), F.col(f"{y}.wide"), F.col(f"{x}.n") + F.col(f"{y}.n"))


def linked(
    entries: DataFrame, items: DataFrame, percent: int, verify: Callable[[DataFrame], DataFrame],
    large: int = 256,
) -> DataFrame:
    """node, root: components of the links among nodes that share a key, as a kept table.

    `entries` has (key, node), each once, and keys of two nodes or more; `items` has node, n
    (the size of its set) and its sketch; both are read several times, so they should be
    kept. `verify` takes distinct pairs (a, b) with a < b and returns those that are links.

    In a few rounds each key's nodes are compared with the one of them that shares most
    keys, first of all its nodes, then of those outside its largest component; a copied
    text's nodes mostly meet in these. What is still apart in a key is compared in full,
    by sizes and sketches, inside tasks: only pairs that these allow to link become rows.
    Keys of up to `large` nodes are compared whole; nodes of a larger key are dealt out by
    size, and blocks of them are compared in tasks of their own. So each pair of a key is
    inside one component, ruled out by its sketches or verified.
    """
    spark = entries.sparkSession
    items = items.select("node", "n", *SKETCH)
    ranks = kept(entries.groupBy("node").agg(F.count("*").alias("rank")), "ranks")
    placed = join_kept(entries, ranks, "node").withColumn("root", F.col("node"))
    tested, links, roots = None, None, None
    for round_ in range(ROUNDS):
        open_keys = placed if round_ == 0 else kept(_open(placed), "open")
        inside = F.lit(True) if round_ == 0 else F.col("root") != F.col("top")
        pivots = kept(
            open_keys.filter(inside)
            .groupBy("key")
            .agg(F.max(F.struct("rank", "node", "root")).alias("pivot"))
            .select("key", F.col("pivot.node").alias("pivot"), F.col("pivot.root").alias("pivot_root")),
            "pivots",
        )
        pairs = _without(
            join_kept(open_keys, pivots, "key").filter("root <> pivot_root").select(
                F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
            ).distinct(),
            tested,
        )
        pairs = kept(pairs, "pairs")
        release(pivots)
        if pairs.isEmpty():
            break
        found = kept(verify(pairs), "links")
        free_shuffles(spark)
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        if roots is not None:
            release(roots)
        roots = components(links)
        placed = join_kept(entries, ranks, "node").join(_sent(roots), "node", "left")
        placed = placed.withColumn("root", F.coalesce("root", "node"))
    if roots is None:
        return kept(spark.createDataFrame([], "node LONG, root LONG"), "components")
    rest = kept(_open(placed).select("key", "node", "root", "top"), "open")
    if rest.isEmpty():
        return roots
    sizes = rest.groupBy("key").agg(F.count("*").alias("size"))
    crowded = kept(sizes.filter(F.col("size") > large).select("key"), "crowded")
    few = join_kept(rest, crowded, "key", "left_anti")
    many = join_kept(rest, crowded, "key", "left_semi")
    met = _pairs(few, items, percent)
    if not crowded.isEmpty():
        met = met.union(_block_pairs(many, items, percent))
    late = kept(_without(met.distinct(), tested), "pairs")
    if late.isEmpty():
        return roots
    return components(links.union(kept(verify(late), "links")))


def _sent(table_: DataFrame) -> DataFrame:
    return F.broadcast(table_) if table_.count() <= SENT_ROWS else table_


def _without(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _open(placed: DataFrame) -> DataFrame:
    """The entries of keys that still have several components, and the largest one."""
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("size"))
    largest = kept(
        sizes.groupBy("key")
        .agg(F.count("*").alias("parts"), F.max(F.struct("size", "root")).alias("top"))
        .filter("parts > 1")
        .select("key", F.col("top.root").alias("top")),
        "largest",
    )
    return join_kept(placed, largest, "key")


def _pairs(rest: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """a, b: nodes of one key in two components whose sizes and sketches allow a link.

    The nodes of a key stand together in a task, which makes rows only of what passes; a
    pair is there once for each key.
    """
    rows = rest.join(items, "node").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_key_scorer(percent), "a LONG, b LONG")


def _key_scorer(percent: int):
    def run(batches):
        held = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            held = here if held is None else pa.concat_tables([held, here])
            keys = held["key"].to_numpy()
            # the last key may go on in the next batch
            ended = int(np.searchsorted(keys == keys[-1], True)) if len(keys) else 0
            yield _met_in_keys(held.slice(0, ended), percent)
            held = held.slice(ended)
        if held is not None:
            yield _met_in_keys(held, percent)

    return run


def _met_in_keys(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """The pairs of rows of whole keys, which stand in their order."""
    keys, node, root, top, n = (rows[c].to_numpy() for c in ("key", "node", "root", "top", "n"))
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    ends = np.repeat(np.r_[starts[1:], len(keys)][: len(starts)], np.diff(np.r_[starts, len(keys)]))
    after = ends - np.arange(len(keys)) - 1
    i = np.repeat(np.arange(len(keys)), after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    least, both = np.minimum(n[i], n[j]), n[i] + n[j]
    alive = (100 * least >= percent * (both - least)) & (root[i] != root[j])
    alive &= (root[i] != top[i]) | (root[j] != top[j])
    i, j = i[alive], j[alive]
    fits = _near(rows, rows, "", i, j, n[i] + n[j], percent)
    i, j = node[i[fits]], node[j[fits]]
    return pa.record_batch({"a": pa.array(np.minimum(i, j)), "b": pa.array(np.maximum(i, j))})


def _near(x: pa.Table, y: pa.Table, prefix: str, i: np.ndarray, j: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sketches of rows i of x and j of y allow a link; n: their sizes' sum."""
    apart = np.zeros(len(i), np.int64)
    for name in SKETCH:
        bits = x[name].to_numpy()[i] ^ y[prefix + name].to_numpy()[j]
        apart += np.bitwise_count(bits.view(np.uint64))
    return apart * (100 + percent) <= n * (100 - percent)


def _block_pairs(rest: DataFrame, items: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """As `_pairs`, for keys of many nodes.

    Sets that link are in the same size band of a key or in neighbouring ones. A band is
    split into blocks, and each two blocks that may hold links are one group.
    """
    band = F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("long")
    rows = rest.join(items, "node").withColumn("band", band)
    counts = kept(
        rows.groupBy("key", "band").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks")),
        "bands",
    )
    of_band = [counts.select("key", (F.col("band") + d).alias("band"), F.col("blocks").alias(name))
               for d, name in ((0, "blocks"), (-1, "above"), (1, "below"))]
    for side, how in zip(of_band, ("inner", "left", "left")):
        rows = rows.join(_sent(side), ["key", "band"], how)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("blocks")))

    def partners(low: Column, high: Column, shift: int) -> Column:
        """The blocks low .. high - 1 of a neighbouring band."""
        salts = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(
            salts, lambda s: F.struct((F.col("band") + shift).alias("o_band"), s.alias("o_salt"))
        )

    zero = F.lit(0).cast("long")
    above, below = F.coalesce("above", zero), F.coalesce("below", zero)
    up = F.concat(partners(F.col("salt"), F.col("blocks"), 0), partners(zero, above, 1))
    down = F.concat(partners(zero, F.col("salt") + 1, 0), partners(zero, below, -1))
    own = ["node", "root", "top", "n", *SKETCH]
    x = rows.select("key", F.col("band").alias("b1"), F.col("salt").alias("s1"), *own, F.inline(up))
    x = x.withColumnsRenamed({"o_band": "b2", "o_salt": "s2"})
    y = rows.select("key", F.col("band").alias("b2"), F.col("salt").alias("s2"), *own, F.inline(down))
    y = y.withColumnsRenamed({"o_band": "b1", "o_salt": "s1"})
    key = ["key", "b1", "s1", "b2", "s2"]
    y = y.select(*[F.col(c).alias(f"y_{c}") for c in [*key, *own]])
    pairs = x.groupBy(*key).cogroup(y.groupBy(*[f"y_{c}" for c in key]))
    return pairs.applyInArrow(_block_scorer(percent), "a LONG, b LONG")


def _block_scorer(percent: int):
    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        found = [np.empty((2, 0), np.int64)]
        if len(x) and len(y):
            a, b = ({c: t[p + c].to_numpy() for c in ("node", "root", "top", "n")}
                    for t, p in ((x, ""), (y, "y_")))
            n = a["n"][:, None] + b["n"][None, :]
            least = np.minimum(a["n"][:, None], b["n"][None, :])
            alive = 100 * least >= percent * (n - least)
            alive &= a["root"][:, None] != b["root"][None, :]
            open_ = (a["root"] != a["top"])[:, None] | (b["root"] != b["top"])[None, :]
            i, j = np.nonzero(alive & open_)
            fits = _near(x, y, "y_", i, j, n[i, j], percent)
            i, j = a["node"][i[fits]], b["node"][j[fits]]
            found.append(np.stack([np.minimum(i, j), np.maximum(i, j)]))
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run
