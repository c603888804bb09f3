"""Benchmark passages in documents, up to a few edits: q-gram counts, then alignment.

A probe of L characters that occurs with at most e edits shares at least
L - q + 1 - q e of its q-grams with the place, on diagonals (place in the document minus
place in the probe) at most e apart. So q-grams are counted in overlapping diagonal bands,
and only bands that reach the count are aligned, in a band as wide as the edits allow.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import claim, ship

Q = 12
PROBE = 80  # characters of a probe; shorter items are one probe
STEP = 20  # between probes, so that any passage of 99 characters holds a whole probe
EDITS = 0.05  # of a probe's length
SHORTEST = 24  # items of fewer characters say nothing about where a text is from
# Characters of one index, which each task holds: some 50 MB. Larger benchmarks are
# looked up index by index.
INDEX_CHARS = 500_000
CHUNK_CHARS = 1_000_000
BASE = 0x9E3779B97F4A7C15
FILTER_BITS = 22
FOUND = "array<struct<item_id:bigint,probe:int,start:int,edits:int>>"

_table: np.ndarray | None = None


def normalised(text: str) -> np.ndarray:
    """Code points in lower case, runs of other than letters and digits as one space."""
    global _table
    if _table is None:
        plane = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x10000)]
        lower = [c.lower() if len(c.lower()) == 1 else c for c in plane]
        _table = np.array([ord(c) if c.isalnum() else 32 for c in lower], np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if len(codes) and codes.max() >= 0x10000:
        codes = np.where(codes < 0x10000, _table[np.minimum(codes, 0xFFFF)], codes)
    else:
        codes = _table[codes]
    space = codes == 32
    return codes[~(space & np.r_[True, space[:-1]])] if len(codes) else codes


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q code points from each place, by doubling."""
    done, width, hashes = 0, 1, codes.astype(np.uint64) + np.uint64(1)
    out = np.zeros(max(0, len(codes) - Q + 1), np.uint64)
    power = 1
    while True:
        if Q & width:
            out *= np.uint64(pow(BASE, width, 2**64))
            out += hashes[done : done + len(out)]
            done += width
        if done == Q:
            return out * np.uint64(0xD6E8FEB86659FD93)
        power = pow(BASE, width, 2**64)
        hashes = hashes[:-width] * np.uint64(power) + hashes[width:]
        width *= 2


class Index:
    """Q-grams of the probes of some benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.probes: list[tuple[int, int, str]] = []  # item, start in it, characters
        for item, text in items:
            codes = normalised(text or "")
            if len(codes) and codes[-1] == 32:
                codes = codes[:-1]
            if len(codes) < SHORTEST:
                continue
            last = max(0, len(codes) - PROBE)
            for start in sorted({*range(0, last, STEP), last}):
                part = codes[start : start + PROBE].tobytes().decode("utf-32-le")
                self.probes.append((item, start, part))
        grams = [gram_hashes(_codes(p)) for _, _, p in self.probes]
        sizes = np.array([len(p) for _, _, p in self.probes], np.int64)
        self.edits = np.minimum((sizes * EDITS).astype(np.int64), np.maximum(sizes - Q, 0) // Q)
        self.needed = sizes - Q + 1 - Q * self.edits
        hashes = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        probe = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        offset = np.concatenate([*map(np.arange, map(len, grams)), np.empty(0)]).astype(np.int64)
        self.grams, starts = np.unique(hashes[order], return_index=True)
        self.starts = np.append(starts, len(hashes))
        self.probe, self.offset = probe[order], offset[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.grams >> np.uint64(64 - FILTER_BITS)] = True

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text, its matches: item, probe's start, place, edits."""
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if not self.probes:
            return found
        held, size = [], 0
        for row, text in enumerate(texts):
            codes = normalised(text or "")
            held.append((row, codes))
            size += len(codes)
            if size >= CHUNK_CHARS or row == len(texts) - 1:
                self._search(held, found)
                held, size = [], 0
        return found

    def _search(self, held: list[tuple[int, np.ndarray]], found: list) -> None:
        sizes = np.array([len(codes) for _, codes in held])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        whole = np.concatenate([codes for _, codes in held])
        if len(whole) < Q:
            return
        hashes = gram_hashes(whole)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        gram = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        real = self.grams[gram] == hashes[at]
        at, gram = at[real], gram[real]
        text = np.searchsorted(ends, at, side="right")
        inside = at + Q <= ends[text]
        at, gram, text = at[inside], gram[inside], text[inside]
        if not len(at):
            return
        counts = self.starts[gram + 1] - self.starts[gram]
        hit = np.repeat(np.arange(len(at)), counts)
        entry = np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts)
        entry += self.starts[gram][hit]
        probe, text = self.probe[entry], text[hit]
        diagonal = at[hit] - self.offset[entry]
        edits = self.edits[probe]
        band = diagonal // (edits + 1)
        for text_at, probe_at, low in self._bands(text, probe, band, edits):
            match = self._align(held[text_at][1], int(starts[text_at]), probe_at, low)
            if match is not None:
                found[held[text_at][0]].append(match)

    def _bands(self, text, probe, band, edits):
        """(text, probe, lowest diagonal) of bands with enough q-grams; each gram in two."""
        keys = np.concatenate(
            [np.stack([text, probe, band]), np.stack([text, probe, band - 1])], axis=1
        )
        order = np.lexsort(keys)
        keys = keys[:, order]
        fresh = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        counts = np.diff(np.r_[fresh, keys.shape[1]])
        keys = keys[:, fresh]
        for t, p, b in keys[:, counts >= self.needed[keys[1]]].T.tolist():
            yield t, p, b * (int(self.edits[p]) + 1)

    def _align(self, codes: np.ndarray, start: int, probe: int, low: int):
        """The probe against the band's place in the text, if the edits suffice."""
        item, probe_start, wanted = self.probes[probe]
        edits = int(self.edits[probe])
        first = max(0, low - start - edits)
        last = min(len(codes), low - start + 3 * (edits + 1) + len(wanted))
        place = codes[first:last].tobytes().decode("utf-32-le", "replace")
        exact = place.find(wanted)
        if exact >= 0:
            return item, probe_start, first + exact, 0
        best, end = banded_distance(_codes(wanted), codes[first:last], edits)
        return (item, probe_start, max(0, first + end - len(wanted)), best) if best <= edits else None


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def banded_distance(probe: np.ndarray, place: np.ndarray, edits: int) -> tuple[int, int]:
    """The least edits between the probe and any part of the place, and where it ends.

    Only diagonals are kept on which the probe can still end inside the place; the first
    row is free, so a match may start anywhere.
    """
    width = max(len(place) - len(probe), 0) + 2 * edits + 1
    far = len(probe) + len(place) + 1
    shift = np.arange(width)
    # column c of row i stands for the place's prefix of i + c - edits characters
    row = np.where((shift - edits >= 0) & (shift - edits <= len(place)), 0, far)
    for i in range(1, len(probe) + 1):
        ends = i + shift - edits
        at = np.clip(ends - 1, 0, max(len(place) - 1, 0))
        differs = (place[at] != probe[i - 1]) if len(place) else np.ones(width, bool)
        fresh = np.minimum(row + differs, np.r_[row[1:], far] + 1)
        fresh[(ends < 1) | (ends > len(place))] = far
        fresh[ends == 0] = i
        row = np.minimum.accumulate(fresh - shift) + shift
        row[(ends < 0) | (ends > len(place))] = far
        if row.min() > edits:
            return int(row.min()), 0
    best = int(np.argmin(row))
    return int(row[best]), len(probe) + best - edits


def finder(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", batched: bool = True
):
    """A column function from a text to its matches: `FOUND`, empty if there are none.

    Items are indexed in shards of `INDEX_CHARS` characters, so what a task holds does not
    grow with the benchmark. Items of NULL id or of under `SHORTEST` characters are left
    out; repeated items are found once. NULL and empty texts match nothing. Texts not
    `batched` come in Spark's pickled batches of 100 rows, which hold less memory than its
    Arrow batches of 10,000; the same probes are found, some at another place of theirs
    (bands begin where a batch does).
    """
    ship(benchmark.sparkSession)
    items = benchmark.select(
        F.col(item).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")
    ).filter("id IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    shards = -(-total // INDEX_CHARS) or 1
    functions = []
    for shard in range(shards):
        own = items.filter(F.pmod(F.xxhash64("id"), F.lit(shards)) == shard).orderBy("id", "t")
        functions.append(_searcher(benchmark.sparkSession, [tuple(r) for r in own.collect()], batched))

    def find(column: Column) -> Column:
        return F.flatten(F.array(*[function(column) for function in functions]))

    return find


def _searcher(spark, items: list[tuple[int, str]], batched: bool):
    index = spark.sparkContext.broadcast(Index(items))

    def search_one(text: str | None) -> list[tuple[int, int, int, int]]:
        claim("contamination")
        return index.value.search([text])[0]

    if not batched:
        return F.udf(search_one, FOUND, useArrow=False)

    def search(texts: pd.Series) -> pd.Series:
        claim("contamination")
        return pd.Series(
            [
                [dict(zip(("item_id", "probe", "start", "edits"), m)) for m in matches]
                for matches in index.value.search(list(texts))
            ],
            index=texts.index,
            dtype=object,
        )

    return F.pandas_udf(search, FOUND)
