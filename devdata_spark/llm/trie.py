"""The trie of conversations by their first turns, as balanced parentheses in shards.

Every prefix of a conversation is known by a sum of hashes of its turns, so the trie's nodes
are an aggregate. Chains of nodes with the same members become one, which leaves at most two
per conversation. Subtrees of few members are shards: each is written as balanced
parentheses, where the matching close of a node delimits its subtree, so that leaves are a
difference of ranks and savings one of a cumulative array. The spine that the shards hang
from is the same job once more, with the shards' totals as weights.
"""

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import join_small, ship, written

FIRST = 8
CHAINS_PER_BUCKET = 50_000
BLOCK = 64


class Parentheses:
    """Balanced parentheses (True opens) with the least excess of each block in a tree."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = max(-(-len(opens) // BLOCK), 1)
        leaves = 1 << (blocks - 1).bit_length()
        padded = np.full(leaves * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.blocks = padded.reshape(leaves, BLOCK)
        self.tree = np.empty(2 * leaves, np.int64)  # node i has children 2 i and 2 i + 1
        self.tree[leaves:] = self.blocks.min(axis=1)
        level = leaves
        while level > 1:
            half = level // 2
            self.tree[half:level] = self.tree[level : 2 * level].reshape(half, 2).min(axis=1)
            level = half
        pairs = np.zeros(len(opens), np.int64)
        pairs[:-1] = opens[:-1] & ~opens[1:]
        self.pairs = np.concatenate([[0], np.cumsum(pairs)])

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The place of the close that matches each open: the next one of less excess."""
        found = np.empty(len(at), np.int64)
        for start in range(0, len(at), 65_536):
            found[start : start + 65_536] = self._find_close(at[start : start + 65_536])
        return found

    def _find_close(self, at: np.ndarray) -> np.ndarray:
        below = self.excess[at]
        block, leaves = at // BLOCK, len(self.blocks)
        later = (self.blocks[block] < below[:, None]) & (np.arange(BLOCK) > (at % BLOCK)[:, None])
        here = later.any(axis=1)
        node = block + leaves
        todo = np.flatnonzero(~here)
        while len(todo):  # a right child goes up, a left one to its neighbour if that is lower
            own = node[todo]
            left = own % 2 == 0
            met = left & (self.tree[np.where(left, own + 1, own)] < below[todo])
            node[todo] = np.where(left, own + 1, own // 2)
            todo = todo[~met]
        down = np.flatnonzero(~here)
        while len(down := down[node[down] < leaves]):
            left = 2 * node[down]
            node[down] = np.where(self.tree[left] < below[down], left, left + 1)
        away = np.flatnonzero(~here)
        block[away] = node[away] - leaves
        later[away] = self.blocks[block[away]] < below[away, None]
        return block * BLOCK + later.argmax(axis=1)

    def leaves(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """The number of "()" between each open and its close."""
        return self.pairs[closes] - self.pairs[opens]


def parentheses(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest (the parent's place of each node, or -1) in parentheses, and each node's open."""
    order = np.argsort(parent, kind="stable")
    ends = np.searchsorted(parent[order], np.arange(-1, len(parent)), "right")
    starts = np.searchsorted(parent[order], np.arange(-1, len(parent)), "left")
    opens, at = [], np.empty(len(parent), np.int64)
    stack = order[: ends[0]][::-1].tolist()
    while stack:
        node = stack.pop()
        opens.append(node >= 0)
        if node >= 0:
            at[node] = len(opens) - 1
            stack.append(-1)
            stack.extend(order[starts[node + 1] : ends[node + 1]][::-1].tolist())
    return np.array(opens, bool), at


def subtrees(parent: np.ndarray, weight: np.ndarray, hung_leaves: np.ndarray, hung: np.ndarray):
    """children, leaves and weight of the subtree of every node of a forest, the node included.

    `hung` subtrees with `hung_leaves` leaves are below a node, but not in the forest.
    """
    opens, at = parentheses(parent)
    tree = Parentheses(opens)
    close = tree.find_close(at)

    def total(values: np.ndarray) -> np.ndarray:
        along = np.zeros(len(opens) + 1, np.int64)
        along[at + 1] = values
        along = np.cumsum(along)
        return along[close] - along[at]

    children = np.bincount(parent[parent >= 0], minlength=len(parent)) + hung
    bare = (close == at + 1) & (hung > 0)  # "()" in this forest, but no leaf
    leaves = tree.leaves(at, close) + total(hung_leaves - bare)
    return children, leaves, total(weight)


MASK = (1 << 62) - 1


def running(df: DataFrame, key: str, order: list[str], sums: list[str], name: str) -> DataFrame:
    """The rows, written, with `sums` as running sums over the rows of each key.

    Rows are dealt out by ranges of (key, order), so that a key of any size is spread over
    tasks; each task sums its own part, and the sums of the keys that a part ends with, one
    row for each task, are added to the next parts. Sums are kept below 2^62.
    """
    columns = df.columns
    dealt = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    kinds = {f.name: f.dataType for f in df.schema}

    def run(batches):
        part = TaskContext.get().partitionId()
        last, held, schema = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            keys = batch.column(key).to_numpy()
            starts = np.r_[True, keys[1:] != keys[:-1]]
            group = np.cumsum(starts) - 1
            own = dict(zip(schema.names, batch.columns))
            for i, c in enumerate(sums):
                values = batch.column(c).to_numpy()
                along = np.cumsum(values)  # may wrap around, which the mask makes right
                along -= (along - values)[starts][group]
                if last == keys[0]:
                    along[group == 0] += held[i]
                own[c] = pa.array(along & MASK)
            last, held = keys[-1], [own[c][-1].as_py() for c in sums]
            own["part"] = pa.array(np.full(len(keys), part, np.int64))
            own["carry"] = pa.array(np.zeros(len(keys), bool))
            yield pa.record_batch(own)
        if schema is not None:
            end = {c: pa.nulls(1, schema.field(c).type) for c in schema.names}
            end |= {c: pa.array([v], pa.int64()) for c, v in zip([key, *sums], [last, *held])}
            end["part"], end["carry"] = pa.array([part], pa.int64()), pa.array([True])
            yield pa.record_batch(end)

    schema = ", ".join(f"{c} {kinds[c].simpleString()}" for c in columns)
    kept = written(dealt.mapInArrow(run, f"{schema}, part LONG, carry BOOLEAN"), name)
    ends = kept.filter("carry").select("part", key, *sums).orderBy("part").collect()
    rows, summed, before = [], [0] * len(sums), None
    for end in ends:
        if before is not None:
            rows.append((end["part"], before, *summed))
        own = [end[c] for c in sums]
        if end[key] == before:
            own = [(a + b) & MASK for a, b in zip(own, summed)]
        before, summed = end[key], own
    kept = kept.filter("NOT carry")
    if not rows:
        return kept.select(*columns)
    more = [f"{c}_before" for c in sums]
    schema = ", ".join(f"{c} LONG" for c in ["part", key, *more])
    added = F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # one row for each task
    return kept.join(added, ["part", key], "left").select(
        *[
            F.coalesce(F.col(c) + F.col(f"{c}_before"), F.col(c)).bitwiseAND(F.lit(MASK)).alias(c)
            if c in sums else F.col(c)
            for c in columns
        ]
    )


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for every rebuilt conversation and depth: conv, depth, node and parent, bytes.

    (id1, id2) is the node, (p1, p2) its parent, n_bytes those of the node's last text and
    `along` those of the whole prefix.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.md5(said.cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(1).cast("long").alias("place"),
    ).filter("conv IS NOT NULL")
    turns = running(turns, "conv", ["turn", "digest"], ["place"], "turns")
    base = F.col("conv") - F.col("conv") % 5
    heads = (
        turns.filter((F.col("place") <= FIRST) & (F.col("conv") % 5 == 0))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "n_bytes"))).alias("head"))
    )
    asked = F.crc32(F.col("conv").cast("string").cast("binary")) % (FIRST + 1)
    convs = (
        turns.select("conv").distinct().withColumn("base", base).join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), asked.cast("int")))
    )
    convs = written(convs, "heads")
    root = F.struct(
        F.lit(0).cast("long").alias("place"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("n_bytes"),
    )
    first = convs.select("conv", F.inline(F.concat(F.array(root), "head")))
    own = (
        turns.filter(F.col("place") > asked)
        .join(convs.select("conv", F.size("head").alias("taken")), "conv")
        .withColumn("place", F.col("place") - asked + F.col("taken"))
    )
    rows = first.unionByName(own.select(*first.columns))

    def lane(i: int) -> Column:
        hashed = F.xxhash64(F.lit(i), "place", "digest").bitwiseAND(F.lit(MASK))
        return F.when(F.col("place") > 0, hashed).otherwise(0).cast("long")

    rows = rows.select(
        "conv", F.col("place").alias("depth"), "n_bytes", lane(1).alias("x1"), lane(2).alias("x2"),
        lane(1).alias("id1"), lane(2).alias("id2"), F.col("n_bytes").alias("along"),
    )
    summed = running(rows, "conv", ["depth"], ["id1", "id2", "along"], "prefixes")
    return summed.select(
        "conv", "depth", "id1", "id2", "n_bytes", "along",
        (F.col("id1") - F.col("x1")).bitwiseAND(F.lit(MASK)).alias("p1"),
        (F.col("id2") - F.col("x2")).bitwiseAND(F.lit(MASK)).alias("p2"),
    )


CHAIN = "conv_id LONG, n_convs LONG, n_children LONG, n_leaves LONG, saved LONG"


def _forest(chains: pa.Table) -> pa.Table:
    """The subtree sums of the chains of some shards, or of the spine."""
    conv, n = chains["conv_id"].to_numpy(), chains["n_convs"].to_numpy()
    place = {pair: i for i, pair in enumerate(zip(conv.tolist(), n.tolist()))}
    above = zip(chains["parent_conv"].to_pylist(), chains["parent_n"].to_pylist())
    parent = np.array([place.get(pair, -1) for pair in above], np.int64)
    names = ["weight", "hung_leaves", "hung"]
    weight, leaves, hung = (chains[c].to_numpy().astype(np.int64) for c in names)
    found = subtrees(parent, weight, leaves, hung)
    columns = [conv, n, *found]
    return pa.table(
        [pa.array(c, pa.int64()) for c in columns],
        names=["conv_id", "n_convs", "n_children", "n_leaves", "saved"],
    )


def _ends(batches):
    """SHA-256 of the comma-joined ids of each node's rows, which come sorted."""
    node, digest = None, None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("id1", "id2", "conv")))
        done = []
        for id1, id2, conv in rows:
            if (id1, id2) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (id1, id2), hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        yield _hashes(done)
    if node is not None:
        yield _hashes([(*node, digest.hexdigest())])


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    id1, id2, ends = zip(*rows) if rows else ((), (), ())
    return pa.record_batch(
        {
            "id1": pa.array(id1, pa.int64()),
            "id2": pa.array(id2, pa.int64()),
            "ends": pa.array(ends, pa.string()),
        }
    )


def prefix_trie(conversations: DataFrame, members: int | None = None) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `conversations` has (conv_id, turn, role, text), a row for each turn, in the order of
    turn, NULL first; turns of one number come in the order of the MD5 of role and text,
    and repeated rows are turns of their own. NULL role or text is empty; rows of NULL
    conv_id are left out; other columns are ignored. Conversation c is rebuilt from the
    first h turns of conversation c - c % 5 (% as in SQL) and its own after the first h.

    One row for each distinct sequence of first turns; an empty table has none. Sequences
    are told apart by 124 bits: two of 10^14 meet with a chance of 10^-10.

    Subtrees of up to `members` conversations are shards. It is the square root of the
    number of turns, 1,000 at least, so that a shard has twice as many chains at most, and
    so has the spine: each of its nodes stands for that many turns. The list of a node's
    ends is hashed as a stream of sorted ids, so only a digest is held.
    """
    spark = conversations.sparkSession
    ship(spark)
    rows = written(prefixes(conversations), "prefixes")
    if members is None:
        members = max(1000, isqrt(rows.count()))
    node = ["id1", "id2"]
    nodes = written(
        rows.groupBy(*node).agg(
            F.min("conv").alias("conv_id"),
            F.count("*").alias("n_convs"),
            *[F.min(c).alias(c) for c in ("depth", "n_bytes", "along", "p1", "p2")],
        ),
        "nodes",
    )
    # nodes on one path with equally many members have the same ones, and no other child
    chains = nodes.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"),
        F.max(F.struct("depth", "id1", "id2")).alias("last"),
        F.min_by(F.struct("p1", "p2"), "depth").alias("above"),
        F.max("along").alias("end"),
        ((F.col("n_convs") - 1) * (F.max("along") - F.min(F.col("along") - F.col("n_bytes")))).alias(
            "weight"
        ),
    )
    chains = written(
        chains.select(
            "conv_id", "n_convs", "top", F.col("last.depth").alias("bottom"), "end", "weight",
            "last.id1", "last.id2", F.when(F.col("top") > 0, F.col("above")).alias("above"),
        ),
        "chains",
    )
    parents = chains.select(
        F.struct(F.col("id1").alias("p1"), F.col("id2").alias("p2")).alias("above"),
        F.col("conv_id").alias("parent_conv"),
        F.col("n_convs").alias("parent_n"),
    )
    chains = written(chains.join(parents, "above", "left").drop("above"), "chains")
    inside = chains.filter(F.col("n_convs") <= members)
    spine = nodes.filter(F.col("n_convs") > members).select(*node)
    shards = (
        join_small(rows, spine, node, "left_anti")
        .groupBy("conv")
        .agg(F.min(F.struct("depth", *node)).alias("shard"))
    )
    buckets = max(inside.count() // CHAINS_PER_BUCKET, 1)
    tree = ["conv_id", "n_convs", "parent_conv", "parent_n", "weight"]
    zero = F.lit(0).cast("long")
    sums = written(
        inside.join(shards, F.col("conv") == F.col("conv_id"))
        .withColumn("bucket", F.pmod(F.xxhash64("shard"), F.lit(buckets)))
        .select(*tree, "bucket", zero.alias("hung_leaves"), zero.alias("hung"))
        .groupBy("bucket")
        .applyInArrow(_forest, CHAIN),
        "shards",
    )
    hanging = (
        chains.filter((F.col("n_convs") <= members) & (F.col("parent_n") > members))
        .join(sums, ["conv_id", "n_convs"])
        .groupBy("parent_conv", "parent_n")
        .agg(F.sum("n_leaves"), F.count("*"), F.sum("saved"))
        .toDF("conv_id", "n_convs", "hung_leaves", "hung", "hung_saved")
    )
    above = (
        chains.filter(F.col("n_convs") > members)
        .join(hanging, ["conv_id", "n_convs"], "left")
        .fillna(0, ["hung_leaves", "hung", "hung_saved"])
        .withColumn("weight", F.col("weight") + F.col("hung_saved"))
        .select(*tree, "hung_leaves", "hung", F.lit(0).alias("bucket"))
        .groupBy("bucket")
        .applyInArrow(_forest, CHAIN)
    )
    ends = (
        rows.groupBy("conv").agg(F.max(F.struct("depth", *node)).alias("end"))
        .select("conv", "end.id1", "end.id2")
        .repartition(*node).sortWithinPartitions(*node, "conv")
        .mapInArrow(_ends, "id1 LONG, id2 LONG, ends STRING")
    )
    of_chain = (
        chains.join(sums.unionByName(above), ["conv_id", "n_convs"])
        .join(ends, node, "left")
        .select(
            "conv_id", "n_convs", "top", "bottom", "end", "parent_conv", "n_children", "n_leaves",
            (F.col("saved") - F.col("weight")).alias("below"), "ends",
        )
    )
    depth = F.col("depth")
    own = F.col("end") - F.col("along") + F.col("n_bytes")
    return (
        nodes.drop("p1", "p2")
        .join(of_chain, ["conv_id", "n_convs"])
        .select(
            "conv_id",
            depth,
            F.when(depth > F.col("top"), F.col("conv_id"))
            .when(depth > 0, F.col("parent_conv"))
            .alias("parent_conv_id"),
            "n_convs",
            F.when(depth < F.col("bottom"), 1).otherwise(F.col("n_children")).alias("n_children"),
            "n_leaves",
            (F.col("below") + (F.col("n_convs") - 1) * own).alias("saved_tokens"),
            F.when(depth == F.col("bottom"), F.coalesce("ends", F.sha2(F.lit(""), 256)))
            .otherwise(F.sha2(F.lit(""), 256))
            .alias("ends_sha256"),
        )
    )
