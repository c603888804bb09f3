"""Bytes of documents that a long string of a smaller document covers, removed.

A string of `LENGTH` bytes is assigned to the least hash among its `GRAM`-byte grams, its
anchor, so equal strings have equal anchors wherever they stand. Only anchors that two
documents share matter; the strings of such an anchor, one stretch of bytes in each
document, meet in one block, where suffixes are sorted and common prefixes expanded
(see `bwt`). Anchors that very many documents share, or that cover much of one document,
are split into their single strings, which are aggregated before any shuffle, so no task
gathers such a group.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm import bwt
from devdata_spark.llm.common import SENT_ROWS, checkpointed, join_small, ship, written
from devdata_spark.llm.packed import mix, pack, shared

LENGTH = 50
GRAM = 20
# An anchor of more documents than this is split into its strings.
SPLIT_DOCUMENTS = 2_000
BASE = 0x9E3779B97F4A7C15
# The last bit of an entry's key: set where an anchor covers much of a document.
LARGE = np.uint64(1)
SEPARATOR = 256
# Stretches that a task gathers before it packs them.
GATHERED = 100_000
# Strings that a task gathers before it hands them on.
GATHERED_STRINGS = 1_000_000
# Up to so many spans and rows (24 MB) are sent to every task.
SENT_SPANS = 2_000_000
STRETCHES = "bucket INT, keys BINARY, docs BINARY, starts BINARY, sizes BINARY, content BINARY"


def rolling(content: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the `width` bytes from each place, by doubling."""
    count = max(0, len(content) - width + 1)
    out, done, power = np.zeros(count, np.uint64), 0, 1
    hashes = mix(content.astype(np.uint64) + np.uint64(1))
    while count:
        if width & power:
            out = out * np.uint64(pow(BASE, power, 2**64)) + hashes[done : done + count]
            done += power
        if done == width:
            return mix(out)
        hashes = hashes[:-power] * np.uint64(pow(BASE, power, 2**64)) + hashes[power:]
        power *= 2
    return out


def anchors(content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last): runs of string starts first..last that have one anchor gram.

    The anchor of a string is its gram of the least hash, the leftmost of equals. Hashes
    are even: their last bit is `LARGE`.
    """
    strings = len(content) - LENGTH + 1
    if strings <= 0:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    hashes = rolling(content, GRAM)
    span, width = LENGTH - GRAM + 1, 1
    least = hashes
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: strings], least[span - width : span - width + strings])
    fresh = np.r_[True, least[1:] != least[:-1]]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], strings] - 1
    return least[first] & ~LARGE, first, last


def dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: what stays of every document, as bytes.

    A byte goes if a string of `LENGTH` bytes that covers it also starts in a document of
    a smaller doc_id. Strings never cross documents and are judged on the input. NULL text
    counts as empty; rows of NULL doc_id stay whole; repeated rows are one document and
    each get its result; other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    named = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    # whole copies need no search: all their strings start in the first copy
    digests = checkpointed(named.select("doc_id", F.sha2("text", 256).alias("digest")).distinct())
    firsts = (
        digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    copies = checkpointed(
        join_small(digests, firsts, "digest").filter("doc_id > first").select("doc_id")
    )
    rest = join_small(named, copies, "doc_id", "left_anti")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # what is left of an anchor in a block: SPLIT_DOCUMENTS documents of so many bytes at most
    most = bwt.BLOCK // SPLIT_DOCUMENTS
    entries = checkpointed(shared(pack(rest, _anchor_entries(most), buckets)))
    large = F.col("key").bitwiseAND(F.lit(int(LARGE))) == int(LARGE)
    common = entries.filter(~large)
    wide = (
        common.groupBy("key").agg(F.count("*").alias("n"))
        .filter(F.col("n") > SPLIT_DOCUMENTS).select("key")
        .union(entries.filter(large).select(F.col("key") - int(LARGE)))
        .distinct()
    )
    wide = checkpointed(wide)
    spans = (
        _narrow(rest, join_small(common, wide, "key", "left_anti"), buckets)
        .union(_wide(rest, join_small(common, wide, "key", "left_semi")))
        .union(copies.select("doc_id", F.lit(0), F.lit(2**31 - 1)))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
        .mapInArrow(_merged, "doc_id BIGINT, firsts ARRAY<INT>, lasts ARRAY<INT>")
    )
    spans = checkpointed(spans)
    if (spans.agg(F.sum(F.size("firsts") + 2)).first()[0] or 0) <= SENT_SPANS:
        spans = F.broadcast(spans)
    return docs.join(spans, "doc_id", "left").mapInArrow(
        _cut, "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY"
    )


def _keys_of(common: DataFrame) -> DataFrame:
    """doc_id and its shared anchors: no more than the document has."""
    return common.groupBy(F.col("node").alias("doc_id")).agg(F.collect_list("key").alias("keys"))


def _narrow(rest: DataFrame, common: DataFrame, buckets: int) -> DataFrame:
    """doc_id, first, last: covered stretches found among the documents of an anchor."""
    return (
        rest.join(_keys_of(common), "doc_id")
        .mapInArrow(_stretches(buckets), STRETCHES)
        .groupBy("bucket")
        .applyInPandas(_covered, "doc_id BIGINT, first INT, last INT")
    )


def _wide(rest: DataFrame, common: DataFrame) -> DataFrame:
    """doc_id, first, last: covered strings of anchors that very many documents share."""
    strings = written(
        join_small(rest, _keys_of(common), "doc_id").mapInArrow(
            _strings, "doc_id BIGINT, firsts ARRAY<INT>, strings ARRAY<BIGINT>"
        ),
        "strings",
    )
    buckets = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = checkpointed(
        pack(strings, _ends, buckets)
        .groupBy("bucket")
        .applyInPandas(_least, "string BIGINT, least BIGINT")
    )
    if least.count() <= SENT_ROWS:
        known = least.toPandas().sort_values("string")
        sent = rest.sparkSession.sparkContext.broadcast(
            (known["string"].to_numpy(), known["least"].to_numpy())
        )
        return strings.mapInArrow(_runs(sent), "doc_id BIGINT, first INT, last INT")
    each = strings.select("doc_id", F.inline(F.arrays_zip("firsts", "strings")))
    return (
        each.join(least, F.col("strings") == F.col("string"))
        .filter("doc_id > least")
        .select("doc_id", F.col("firsts").alias("first"), (F.col("firsts") + LENGTH).alias("last"))
    )


def _ends(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of each string in a few documents, the smallest and the largest of them."""
    keys, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for doc, strings in zip(batch.column("doc_id").to_pylist(), batch.column("strings")):
        keys.append(np.unique(strings.values.to_numpy()))
        nodes.append(np.full(len(keys[-1]), doc, np.int64))
    key, node = np.concatenate(keys), np.concatenate(nodes)
    first, last = _first_and_last(key, node)
    twice = np.concatenate([first, last[~np.isin(last, first)]])
    return key[twice].view(np.uint64), node[twice]


def _first_and_last(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key's smallest and largest node stand."""
    order = np.lexsort((nodes, keys))
    if not len(order):
        return order, order
    fresh = np.r_[True, keys[order][1:] != keys[order][:-1]]
    return order[fresh], order[np.r_[fresh[1:], True]]


def _least(group: pd.DataFrame) -> pd.DataFrame:
    """The smallest document of each string that several documents have."""
    keys = np.frombuffer(b"".join(group["keys"]), np.int64)
    nodes = np.frombuffer(b"".join(group["nodes"]), np.int64)
    first, last = _first_and_last(keys, nodes)
    several = nodes[first] < nodes[last]
    return pd.DataFrame({"string": keys[first[several]], "least": nodes[first[several]]})


def _runs(sent):
    """Stretches of neighbouring strings that also start in a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, least = sent.value
        for batch in batches:
            docs, begins, ends = [], [], []
            columns = (batch.column(c) for c in ("doc_id", "firsts", "strings"))
            for doc, firsts, strings in zip(*columns) if len(known) else ():
                string, first = strings.values.to_numpy(), firsts.values.to_numpy()
                at = np.minimum(np.searchsorted(known, string), len(known) - 1)
                first = first[(known[at] == string) & (least[at] < doc.as_py())]
                if len(first):
                    fresh = np.r_[True, first[1:] != first[:-1] + 1]
                    begins.append(first[fresh])
                    ends.append((first[np.r_[fresh[1:], True]] + LENGTH).astype(np.int32))
                    docs.append(np.full(len(begins[-1]), doc.as_py(), np.int64))
            if docs:
                columns = {"doc_id": docs, "first": begins, "last": ends}
                yield pa.record_batch({k: np.concatenate(v) for k, v in columns.items()})

    return run


def _anchor_entries(most: int):
    """The anchors of each document; those of more than `most` bytes again, as `LARGE`.

    All occurrences count, each with a separator. A large anchor has two nodes, so that
    `shared` keeps it.
    """

    def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for doc, content in _contents(batch):
            found, first, last = anchors(content)
            own, sizes = np.unique(found), last - first + LENGTH + 1
            large = own[:0]
            # few documents are long enough and have an anchor twice
            if sizes.sum() > most and (len(own) < len(found) or sizes.max() > most):
                of = np.searchsorted(own, found)
                large = own[np.bincount(of, sizes, len(own)) > most] | LARGE
            keys += [own, large, large]
            nodes += [
                np.full(len(own), doc, np.int64),
                np.full(len(large), doc, np.int64),
                np.full(len(large), ~doc, np.int64),
            ]
        return np.concatenate(keys), np.concatenate(nodes)

    return entries


def _contents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        yield doc, np.frombuffer(text.as_buffer(), np.uint8)


def _hits(batch: pa.RecordBatch) -> Iterator[tuple]:
    """doc_id, content, and the runs of strings whose anchor is among the row's keys."""
    for (doc, content), keys in zip(_contents(batch), batch.column("keys")):
        wanted = np.sort(keys.values.to_numpy().view(np.uint64))
        found, first, last = anchors(content)
        hit = wanted[np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)] == found
        yield doc, content, found[hit], first[hit], last[hit]


def _stretches(buckets: int):
    """Packs, by bucket of the anchor, the bytes around each shared anchor."""

    def packed(parts: list) -> pa.RecordBatch:
        keys, docs, starts, sizes = (
            np.concatenate([p[i] for p in parts]) for i in (0, 1, 2, 3)
        )
        contents = [c for p in parts for c in p[4]]
        bucket = (mix(keys) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found, at = np.unique(bucket[order], return_index=True)
        rows = [order[a:b] for a, b in zip(at, np.append(at[1:], len(order)))]
        columns = {"keys": keys, "docs": docs, "starts": starts, "sizes": sizes}
        return pa.record_batch(
            {"bucket": pa.array(found, pa.int32())}
            | {
                name: pa.array([values[r].tobytes() for r in rows], pa.binary())
                for name, values in columns.items()
            }
            | {"content": pa.array([b"".join([contents[i] for i in r]) for r in rows], pa.binary())}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc, content, keys, first, last in _hits(batch):
                if not len(keys):
                    continue
                ends = last + LENGTH
                whole = content.tobytes()
                held.append(
                    (
                        keys,
                        np.full(len(keys), doc, np.int64),
                        first.astype(np.int32),
                        (ends - first).astype(np.int32),
                        [whole[a:b] for a, b in zip(first.tolist(), ends.tolist())],
                    )
                )
                size += len(keys)
                if size >= GATHERED:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return run


def _covered(group: pd.DataFrame) -> pd.DataFrame:
    """Covered stretches of the documents of one bucket of anchors."""
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in group["keys"]]).tolist()
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in group["docs"]]).tolist()
    starts = np.concatenate([np.frombuffer(x, np.int32) for x in group["starts"]]).tolist()
    sizes = [np.frombuffer(x, np.int32) for x in group["sizes"]]
    content = b"".join(group["content"])
    ends = np.cumsum(np.concatenate(sizes, dtype=np.int64)).tolist()
    # equal stretches of one anchor are one, with all their places
    by_key: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
    begin = 0
    for key, doc, start, end in zip(keys, docs, starts, ends):
        places = by_key.setdefault(key, {}).setdefault(content[begin:end], [])
        places.append((doc, start))
        begin = end
    out: list[tuple[int, int, int]] = []
    block: list[tuple[bytes, int, list[tuple[int, int]]]] = []
    size = 0
    for stretches in by_key.values():
        if len(stretches) > 1:
            needed = sum(map(len, stretches)) + len(stretches)
            if size + needed > bwt.BLOCK and block:
                _expand(block, out)
                block, size = [], 0
            size += needed
        for stretch, places in stretches.items():
            least = min(places)[0]
            whole = ((d, s, s + len(stretch)) for d, s in places if d > least)
            out.extend(whole)
            if len(stretches) > 1:
                block.append((stretch, least, [p for p in places if p[0] == least]))
    if block:
        _expand(block, out)
    columns = list(zip(*out)) or [(), (), ()]
    return pd.DataFrame(
        {
            "doc_id": np.array(columns[0], np.int64),
            "first": np.array(columns[1], np.int32),
            "last": np.array(columns[2], np.int32),
        }
    )


def _expand(block: list, out: list[tuple[int, int, int]]) -> None:
    """Adds the strings of a block's stretches that also start in a smaller document."""
    sizes = np.array([len(stretch) for stretch, _, _ in block])
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    symbols = np.full(int(ends[-1]) + 1, SEPARATOR, np.uint16)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(s for s, _, _ in block), np.uint8)
    of = np.repeat(np.arange(len(block)), sizes + 1)
    string = np.arange(len(symbols)) + LENGTH <= ends[of]
    own = np.array([least for _, least, _ in block], np.int64)[of]
    order, group = bwt.groups(symbols, LENGTH)
    least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    hit = string[order]
    np.minimum.at(least, group[hit], own[order][hit])
    known = np.empty(len(symbols), np.int64)
    known[order] = least[group]
    covered = string & (known < own)
    edge = np.flatnonzero(np.diff(np.r_[False, covered, False]))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        _, _, places = block[of[a]]
        shift = int(begins[of[a]])
        out.extend((d, s + a - shift, s + b - 1 - shift + LENGTH) for d, s in places)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of each document's wanted anchors: their places and hashes."""

    def batch_of(held: list) -> pa.RecordBatch:
        docs, firsts, strings = zip(*held)
        return pa.record_batch(
            {
                "doc_id": pa.array(docs, pa.int64()),
                "firsts": pa.array(firsts, pa.list_(pa.int32())),
                "strings": pa.array(strings, pa.list_(pa.int64())),
            }
        )

    for batch in batches:
        held, size = [], 0
        for doc, content, _, first, last in _hits(batch):
            if not len(first):
                continue
            at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
            held.append((doc, at.astype(np.int32), rolling(content, LENGTH)[at].view(np.int64)))
            size += len(at)
            if len(held) == 64 or size >= GATHERED_STRINGS:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and adjacent spans of a document as one."""
    for batch in batches:
        firsts, lasts = [], []
        for spans in batch.column("spans"):
            first = spans.values.field("first").to_numpy().astype(np.int64)
            last = spans.values.field("last").to_numpy().astype(np.int64)
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order])
            fresh = np.r_[True, first[1:] > last[:-1]]
            firsts.append(first[fresh])
            lasts.append(last[np.r_[fresh[1:], True]])
        ints = pa.list_(pa.int32())
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "firsts": pa.array(firsts, ints),
                "lasts": pa.array(lasts, ints),
            }
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (batch.column(c) for c in ("doc_id", "text", "firsts", "lasts"))
        for doc, text, firsts, lasts in zip(*columns):
            content = text.as_buffer().to_pybytes()
            spans = []
            if firsts.is_valid:
                ends = (min(x, len(content)) for x in lasts.as_py())
                spans = [(a, b) for a, b in zip(firsts.as_py(), ends) if a < b]
            edges = [0, *(x for span in spans for x in span), len(content)]
            kept = b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((doc.as_py(), len(content), len(content) - len(kept), len(spans), kept))
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch(
            {n: pa.array(v, k) for n, k, v in zip(names, kinds, zip(*rows))}
            if rows
            else {n: pa.array([], k) for n, k in zip(names, kinds)}
        )
