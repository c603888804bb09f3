"""Each operator against plain Python on small tables with odd rows."""

import hashlib
import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from devdata_spark.llm import (
    chat,
    common,
    contamination,
    licenses,
    line_dedup,
    linking,
    ngram_join,
    packed,
    pii,
    suffix_dedup,
    topk,
    toxicity,
)
from devdata_spark.llm.graph import components

DOC = "doc_id BIGINT, text STRING, lines INT, node STRING, base INT, words STRING, key INT"


def table(spark, rows):
    """Documents with columns that clash with names the operators use."""
    return spark.createDataFrame([(i, t, 1, "n", 2, "w", 3) for i, t in rows], DOC).repartition(3)


def words(rng, n, of=400):
    return " ".join(f"w{rng.randrange(of)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeated rows, NULLs, empty and long texts."""
    rng = random.Random(17)
    rows = [(i, words(rng, rng.randrange(1, 60))) for i in range(0, 60)]
    rows += [(None, "no id " * 20), (None, None), (61, None), (62, ""), (63, " \n\n "), (64, "x")]
    base = words(rng, 120)
    rows += [(i, base) for i in range(70, 76)]
    for i in range(80, 95):
        changed = base.split()
        for _ in range(rng.randrange(1, 3)):
            changed[rng.randrange(120)] = f"new{rng.randrange(999)}"
        rows.append((i, " ".join(changed)))
    passage = words(rng, 25)
    rows += [(i, f"{words(rng, 9)}\n{passage}\n{words(rng, 9)}") for i in range(100, 112)]
    rows += [(100, rows[-12][1]), (120, words(rng, 4000)), (121, "aé中" * 400)]
    rows += [(122, rows[-2][1] + "\n" + rows[-2][1])]
    rng.shuffle(rows)
    return rows


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_are_those_of_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(200)]
    links += [(7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a LONG, b LONG")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == roots_of({n for link in real for n in link}, real)
    assert components(spark.createDataFrame([], "a LONG, b LONG")).collect() == []


def test_linked_verifies_all_pairs_that_matter(spark):
    # every node shares one key; only neighbours are links, and the smallest node has none
    entries = spark.createDataFrame([(1, n) for n in range(12)] + [(2, 50)], "key LONG, node LONG")

    def verify(pairs):
        return pairs.filter("a > 0 AND b - a = 1 AND b <> 7")

    plain = [F.lit(0).cast("long").alias(name) for name in linking.SKETCH]
    items = entries.select("node", F.lit(1).cast("long").alias("n"), *plain)
    found = {r.node: r.root for r in linking.linked(entries, items, 90, verify).collect()}
    assert found == {**{n: 1 for n in range(1, 7)}, **{n: 7 for n in range(7, 12)}}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=9))
def test_sketches_differ_in_no_more_bits_than_sets_in_elements(some, change):
    a, b = (np.array(sorted(s), np.uint64) for s in (some, some ^ change))
    bits = np.unpackbits((linking.sketch(a) ^ linking.sketch(b)).view(np.uint8)).sum()
    assert bits <= len(change) and len(linking.sketch(a)) == len(linking.SKETCH)


@settings(max_examples=50, deadline=None)
@given(st.integers(900, 5000), st.integers(0, 400), st.integers(0, 400), st.integers(0, 2**32))
def test_wide_sketches_differ_in_no_more_bits_than_sets_in_elements(size, less, more, seed):
    made = np.random.default_rng(seed).integers(0, 2**64, size + more, np.uint64)
    a, b = np.unique(made[:size]), np.unique(made[less:])
    x, y = linking.wide_sketch(a), linking.wide_sketch(b)
    assert linking.wide_apart(x, y) <= len(np.setxor1d(a, b))
    assert (len(x) * 64 >= len(a)) == (len(a) > linking.BITS)
    if min(len(x), len(y)):
        assert linking.wide_apart(x, linking.sketch(a, linking.BITS)) == 0


def large_sets():
    """Sets of 1,500 to 4,000 elements; each even one and the next differ little."""
    rng = np.random.default_rng(12)
    sets = {n: np.unique(rng.integers(0, 2**64, 1500 + 100 * n, np.uint64)) for n in range(0, 26, 2)}
    for n in list(sets):
        other = rng.integers(0, 2**64, len(sets[n]) // 16 + 3 * n, np.uint64)
        sets[n + 1] = np.unique(np.r_[sets[n][len(other) :], other])
    return sets


def items_of(spark, sets):
    rows = [
        (n, len(s), s.view(np.int64).tolist(), linking.wide_sketch(s).tolist(), *linking.sketch(s).tolist())
        for n, s in sets.items()
    ]
    schema = f"node LONG, n LONG, s ARRAY<LONG>, wide ARRAY<LONG>, {linking.SKETCH_SCHEMA}"
    return spark.createDataFrame(rows, schema)


def test_large_sets_are_moved_only_for_pairs_that_may_link(spark, monkeypatch):
    sets = large_sets()
    pairs = [(a, b) for a in sets for b in sets if a < b]
    moved, similar = [], ngram_join._similar

    def spied(fitting, own, percent):
        moved.extend((r.a, r.b) for r in fitting.collect())
        assert {r.node for r in own.collect()} == {n for pair in moved for n in pair}
        return similar(fitting, own, percent)

    monkeypatch.setattr(ngram_join, "_similar", spied, raising=False)
    found = ngram_join._verified(items_of(spark, sets), spark.createDataFrame(pairs, "a LONG, b LONG"), 80)
    expected = {
        (a, b) for a, b in pairs
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    }
    assert {(r.a, r.b) for r in found.collect()} == expected
    assert expected and expected <= set(moved) <= {(n, n + 1) for n in sets if n % 2 == 0}


@pytest.mark.parametrize("most", [3, 1000])
def test_pairs_are_verified_in_waves(spark, monkeypatch, most):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 200, np.uint64)
    sets = {n: np.unique(np.r_[base[n:], rng.integers(0, 2**64, n // 2, np.uint64)]) for n in range(24)}
    pairs = [(a, b) for a in sets for b in sets if a < b]
    waves, similar = [], ngram_join._similar

    def spied(fitting, own, percent):
        waves.append(fitting.select(F.sum(F.col("n_a") + F.col("n_b"))).first()[0] or 0)
        return similar(fitting, own, percent)

    monkeypatch.setattr(ngram_join, "_similar", spied)
    monkeypatch.setattr(ngram_join, "WAVE_PAIRS", most)
    found = ngram_join._verified(items_of(spark, sets), spark.createDataFrame(pairs, "a LONG, b LONG"), 90)
    expected = {
        (a, b) for a, b in pairs
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))
    }
    assert sorted((r.a, r.b) for r in found.collect()) == sorted(expected)
    assert len(waves) > 5 and max(waves) < sum(waves) / 2


def test_shared_keys(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(60), rng.randrange(1, 9)) for _ in range(150)]

    def entries(batch):
        keys = np.array(batch.column("k").to_pylist(), np.uint64)
        return keys, np.array(batch.column("n").to_pylist(), np.int64)

    df = spark.createDataFrame(rows, "k LONG, n LONG").repartition(4)
    found = sorted((r.key, r.node) for r in packed.shared(packed.pack(df, entries, 5)).collect())
    by_key = defaultdict(set)
    for k, n in rows:
        by_key[k].add(n)
    assert found == sorted((k, n) for k, ns in by_key.items() if len(ns) > 1 for n in ns)
    assert packed.shared(packed.pack(df.filter("false"), entries, 5)).collect() == []
    groups = defaultdict(set)
    for r in packed.shared(packed.pack(df, entries, 5, short=True), short=True).collect():
        groups[r.key].add(r.node)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(ns) for ns in by_key.values() if len(ns) > 1)


def test_ngram_join_equals_all_pairs(spark, corpus):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in w]
        if len(w) < 3:
            return {tuple(w)} if w else set()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    sets = {i: shingles(t) for i, t in corpus if i is not None}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    roots = roots_of(sets, links)
    found = ngram_join.classes(table(spark, corpus)).collect()
    assert len(found) == len(corpus) and len(set(roots.values())) < len(sets) - 10
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), roots[r.doc_id])
    assert ngram_join.classes(table(spark, corpus).filter("false")).collect() == []


def test_ngram_join_of_rows_of_one_id_with_different_texts(spark):
    rng = random.Random(43)
    rows = []
    for i in range(0, 80, 4):
        a, b = words(rng, 60, 9000), words(rng, 60, 9000)
        rows += [(i, a), (i, b), (i + 1, a + " more"), (i + 2, b + " other")]
    found = ngram_join.classes(table(spark, rows)).collect()
    assert len(found) == 80 and all(r.component_id == r.doc_id // 4 * 4 for r in found)


@pytest.mark.parametrize("n, percent", [(5, 80), (2, 60)])
def test_ngram_join_by_other_thresholds(spark, n, percent):
    rng = random.Random(41)
    rows = []
    for group in range(12):
        base = words(rng, rng.randrange(20, 200), 5000).split()
        for i in range(6):
            more = words(rng, rng.randrange(1, len(base) // 3), 5000).split()
            rows.append((10 * group + i, " ".join(base + more)))
    sets = {
        i: {tuple(t.split()[at : at + n]) for at in range(len(t.split()) - n + 1)} for i, t in rows
    }
    links = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = ngram_join.classes(table(spark, rows), n=n, percent=percent).collect()
    assert links and {r.doc_id: r.component_id for r in found} == roots_of(sets, links)


def suffix_brute_force(rows):
    size = suffix_dedup.LENGTH
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    first = {}
    for i in sorted(texts):
        for at in range(len(texts[i]) - size + 1):
            first.setdefault(texts[i][at : at + size], i)
    out = {}
    for i, content in texts.items():
        gone = bytearray(len(content))
        for at in range(len(content) - size + 1):
            if first[content[at : at + size]] < i:
                gone[at : at + size] = b"\1" * size
        kept = bytes(c for c, g in zip(content, gone) if not g)
        out[i] = (len(content), sum(gone), len(re.findall(b"\1+", gone)), kept)
    return out


@pytest.mark.parametrize("split", [(2_000, 10), (3, 100_000), (3, 10)])
def test_suffix_dedup_equals_brute_force(spark, corpus, split, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPLIT_DOCUMENTS", split[0])
    monkeypatch.setattr(suffix_dedup, "SENT_ROWS", split[1])
    expected = suffix_brute_force(corpus)
    found = suffix_dedup.dedup(table(spark, corpus)).collect()
    assert len(found) == len(corpus)
    for r in found:
        got = (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        if r.doc_id is None:
            assert got[1:3] == (0, 0)
        else:
            assert got == expected[r.doc_id]
    assert sum(e[1] for e in expected.values()) > 2000
    assert suffix_dedup.dedup(table(spark, corpus).filter("false")).collect() == []


def test_suffix_dedup_of_long_periodic_texts(spark):
    # one anchor each, and more bytes of it than a block has places
    rows = [(2, "ab" * 300_000 + "end of two"), (1, "ab" * 290_000), (3, "x" * 40 + "ab" * 60 + "é")]
    rows += [(5, "abc" * 200_000), (4, "one " + "bca" * 150_000), (6, "z" * 600_000), (7, "z" * 500_000)]
    expected = suffix_brute_force(rows)
    found = suffix_dedup.dedup(table(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id]
    assert sum(e[1] for e in expected.values()) > 1_500_000


def test_line_dedup_equals_all_pairs(spark):
    rng = random.Random(23)
    lines = [words(rng, rng.randrange(8, 30)) for _ in range(40)]
    near = [line[:10] + "Z" + line[11:] for line in lines if len(line) > 60]
    pool = lines + near + ["", " ", "ab", "ab", "x" * 200, "x" * 250]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(40)]
    rows += [(50, None), (51, ""), (None, lines[0]), (52, "\n"), (53, "y" * 30_000)]
    rows += [(0, rows[0][1])]

    def similar(a, b):
        s, t = line_dedup.shingle_set(a), line_dedup.shingle_set(b)
        return len(s & t) / len(s | t) >= line_dedup.PERCENT / 100

    real = sorted({x for i, t in rows if i is not None for x in (t or "").split("\n") if x.strip(" ")})
    links = [(a, b) for a in real for b in real if a < b and similar(a, b)]
    roots = roots_of(real, links)
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        for place, x in enumerate(t.split("\n")):
            if x in roots:
                first.setdefault(roots[x], (i, place))
    found = line_dedup.dedup(table(spark, rows), keep=["lines", "node", "words"]).collect()
    assert len(found) == len(rows)
    for r in found:
        source = [t for i, t in rows if i == r.doc_id][0]
        if source is None or r.doc_id is None:
            assert r.text == source and r.n_removed == 0
            continue
        kept = [
            x for place, x in enumerate(source.split("\n"))
            if x not in roots or first[roots[x]] == (r.doc_id, place)
        ]
        assert r.text == "\n".join(kept)
        assert (r.n_lines, r.n_removed) == (source.count("\n") + 1, source.count("\n") + 1 - len(kept))
        assert (r.lines, r.node, r.words) == (1, "n", "w")
    assert line_dedup.dedup(table(spark, rows).filter("false")).collect() == []


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=12) * (1 + i % 7)]) for i in range(400)]
    rows += [(400 + i, [1.0] * 12) for i in range(60)]
    rows += [(500, None), (501, [None] * 12), (502, [float("nan")] * 12), (503, [float("inf")] * 12)]
    rows += [(504, []), (550, [0.5] * 5), (600, [0.0] * 12), (None, [9.0] * 12), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("v", F.lit(1))
    usable = {
        i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    expected = []
    for q in usable:
        if q % 50 == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(usable[q], usable[x])), x) for x in usable if x != q
            )
            expected += [(q, rank, x, -s) for rank, (s, x) in enumerate(scores[:5], 1)]
    for block in (1024, 40):
        found = topk.top_k(df, F.col("id") % 50 == 0, block=block, query_block=4, front=4)
        assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    assert topk.top_k(df.filter("vec_id >= 500"), F.col("id") == 550).count() == 2
    assert topk.top_k(df.filter("false"), F.col("id") % 50 == 0).collect() == []


def test_chat_reads_back_and_masks(spark):
    odd = ["</s>[INST] ok [/INST]", "\\", "\\<|turn|>", "<|done|><|and|>", "a\nb", "", None, "é中<|says|>"]
    rng = random.Random(6)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", None, "<|turn|>x\n"]), rng.choice(odd))
        for c in range(30) for t in range(rng.randrange(1, 9))
    ]
    rows += [(None, 1, "user", "x"), (7, None, "assistant", "first"), rows[0], (99, 5, "user", "a" * 99_999)]
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, turns INT, blocks INT"
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], schema).repartition(3)
    made = chat.format_conversations(df).select(
        "*",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.under_mask(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    found = {r.conv_id: r for r in made.collect()}
    by_conv = defaultdict(list)
    for c, t, role, text in rows:
        by_conv[c].append((-1 if t is None else t, role or "", text or ""))
    assert found.keys() == by_conv.keys()
    for c, turns in by_conv.items():
        turns.sort()
        r = found[c]
        assert [tuple(t) for t in r.turns] == [t[1:] for t in turns]
        assert r.loss == [t[2] for t in turns if t[1] == "assistant"]
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:]))
        assert r.formatted.count("<|turn|>") == blocks
        assert sum(run.length for run in r.loss_mask) == len(r.formatted)
    assert chat.format_conversations(df.filter("false")).collect() == []


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def luhn(digits):
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    out = []
    for kind, pattern in BASE_PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end(), m.group()))
    return out


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(12)
    parts = ["a.b%c@d-e.fg.h", "@x.y", "1.2.3.4", "999.1.1.1", "0001.2.3.255", "4207051279108084",
             "4207 0512-7910 8084", "+1 (555) 123-4567", "+49.", "é", " ", "+", "a", ".", "7", "-", "中", "\n",
             "u@v.w+x@y.z", "1.2.3.4.5.6.7.8"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(200)]
    texts += ["", None, "a" * 50_000, "7" * 50_000, "a@" + "b." * 20_000 + "c", "+" + "1 " * 9_000]
    df = table(spark, list(enumerate(texts)) + [(None, "a@b.c"), (0, texts[0])])
    found = pii.find(df).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        expected = base_spans(r.text)
        assert [tuple(s) for s in r.base] == expected
        if len(expected) == 1:
            kind, start, end, _ = expected[0]
            assert r.sanitised == r.text[:start] + f"[{kind.upper()}]" + r.text[end:]
    assert pii.find(df.filter("false")).collect() == []


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 30, 50).replace("w", "filler") + " common") for i in range(60)]
    rows += [
        (100 + i, f"common filler {'abcdef'[i] * 4} zanzibarite ann@secret.org {'uvwxyz'[i] * 4} common")
        for i in range(6)
    ]
    rows += [(200, "zanzibarite alone"), (201, "ann@secret.org met a Zanzibarite; " + "pad " * 100 + "zanzibarite")]
    rows += [(300 + i, "quux copied bob@copy.org text") for i in range(9)]
    found = {r.doc_id: r for r in pii.find(table(spark, rows)).collect()}
    terms = {(i, s.found.lower()) for i, r in found.items() for s in r.terms}
    assert {t for _, t in terms} == {"zanzibarite"}
    assert {i for i, _ in terms} == {*range(100, 106), 201}
    assert len(found[201].terms) == 2 and "anzibarite" not in found[201].sanitised
    assert found[201].sanitised.startswith("[EMAIL] met a ")
    assert found[300].terms == [] and "[EMAIL]" in found[300].sanitised
    named = pii.find(table(spark, rows), protected=["zanzibarite alone"]).collect()
    assert len(named) == len(rows)


def test_license_scan_equals_plain_rules(spark):
    rng = random.Random(9)
    parts = ["Under the MIT License", "under_the MIT--license", "Apache License, Version 2", "(CC) BY NC 4.0",
             "CC-BY-NC", "GNU General Public License, version 3", "or any later version", "GPL v2 only", "All rights reserved.",
             "2-clause BSD", "é", "MIT", "license", "\n", "12", "Creative Commons Attribution-ShareAlike 3.0", "ÀMIT"]
    texts = [" ".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(150)]
    texts += [None, "", "x" * 30_000, "mit " * 3_000 + "under the mit license"]
    rows = list(enumerate(texts)) + [(None, "cc by nc"), (3, texts[3])]
    ordered = [(a, k, re.compile(rf"(?<= )(?:{p})(?= )"), w) for a, k, p, w in licenses.rules()]
    assert len(ordered) > 200
    for r in licenses.scan(table(spark, rows)).collect():
        text = dict(rows)[r.doc_id] or ""
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))
        joined = " " + " ".join(w) + " "
        hits = [
            (joined[: m.start()].count(" ") - 1, joined[: m.end()].count(" "), rank)
            for rank, (_, keyword, pattern, _) in enumerate(ordered) if f" {keyword} " in joined
            for m in pattern.finditer(joined)
        ]
        kept = [
            h for h in hits
            if h[2] < 3 or not any(o[0] <= h[0] and h[1] <= o[1] and o[2] < h[2] for o in hits)
        ]
        assert r.n_words == len(w)
        assert sorted((d.start, d.end, d.rank) for d in r.detections) == sorted(kept)
        assert sorted((d.start, d.end, d.rank) for d in r.base) == sorted(h for h in hits if h[2] < 3)
    assert licenses.scan(table(spark, rows).filter("false")).collect() == []


def test_terms_that_give_rare_entities_away(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 30, 50).replace("w", "filler") + f" common {i}") for i in range(60)]
    # two texts; the word stands far from the entity
    rows += [(100 + i, f"ann@secret.org {'common ' * 40} zanzibarite {i}") for i in range(2)]
    # one text for each value, but several of its domain or prefix
    rows += [(110 + i, f"common quuxville {name}@rare.org") for i, name in enumerate(["bo", "cy", "di"])]
    rows += [(120 + i, f"common graultown 10.20.30.{i}") for i in range(3)]
    # copies of one text are one text
    rows += [(130 + i, "copied eve@copy.org common") for i in range(5)]
    found = {r.doc_id: r for r in pii.find(table(spark, rows)).collect()}
    terms = {i: {s.found for s in r.terms} for i, r in found.items() if r.terms}
    assert terms == (
        {i: {"zanzibarite"} for i in (100, 101)}
        | {i: {"quuxville"} for i in (110, 111, 112)}
        | {i: {"graultown"} for i in (120, 121, 122)}
    )


def license_forms(pattern, rng):
    """A string that the pattern matches."""
    out = []
    for op, value in pattern:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(value))
        elif name == "IN":
            kind, x = rng.choice(value)
            out.append(chr(x if str(kind) == "LITERAL" else rng.randint(*x)) if str(kind) != "NEGATE" else "")
        elif name == "NOT_LITERAL":
            out.append("q")
        elif name == "SUBPATTERN":
            out.append(license_forms(value[3], rng))
        elif name == "BRANCH":
            out.append(license_forms(rng.choice(value[1]), rng))
        elif name == "MAX_REPEAT":
            low, high, inner = value
            out += [license_forms(inner, rng) for _ in range(rng.randint(low, min(int(high), low + 1)))]
        else:
            assert name == "ASSERT_NOT"
    return "".join(out)


def test_license_scan_finds_what_any_rule_matches(spark):
    rng = random.Random(14)
    ordered = [re.compile(rf"(?<= )(?:{p})(?= )") for _, _, p, _ in licenses.rules()]
    made = [
        license_forms(re._parser.parse(p), rng) for _, _, p, _ in licenses.rules() for _ in range(20)
    ]
    texts = ["Licensed under GPLv3", "gpl3", "LGPLv2.1", "lgplv3 or later", "AGPLv3", "GFDL1.3", "0BSD",
             "Open RAIL", *sorted(set(made))]
    found = {r.doc_id: r for r in licenses.scan(table(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        joined = " " + " ".join(re.findall("[a-z0-9]+", text.lower())) + " "
        hits = [
            (joined[: m.start()].count(" ") - 1, joined[: m.end()].count(" "), rank)
            for rank, pattern in enumerate(ordered) for m in pattern.finditer(joined)
        ]
        kept = [
            h for h in hits
            if h[2] < 3 or not any(o[0] <= h[0] and h[1] <= o[1] and o[2] < h[2] for o in hits)
        ]
        assert sorted((d.start, d.end, d.rank) for d in found[i].detections) == sorted(kept), text
        assert i >= 8 or kept


def test_rules_of_licenses_that_are_written_out(spark):
    texts = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
        "GNU Lesser General Public License v2.1 or later": "lgpl-2.1-or-later",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0,cc-by-nc",
        "Mozilla Public License 2.0": "mpl-2.0",
        "The 3-Clause BSD license": "bsd-3-clause",
        "Copyright (c) 2020. All rights reserved.": "copyright,all-rights-reserved",
        "no terms here": "",
    }
    rows = list(enumerate(texts))
    for r in licenses.scan(table(spark, rows)).collect():
        expected = set(filter(None, texts[rows[r.doc_id][1]].split(",")))
        assert expected <= {d.label for d in r.detections}, rows[r.doc_id]


def test_contamination_column(spark):
    rng = random.Random(31)
    items = [(i, words(rng, 40)) for i in range(5)] + [(None, "x" * 100), (9, None), (10, "short"), (0, "")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    leak = items[2][1]
    typo = leak[:40] + "#" + leak[41:]
    rows = [(1, f"Intro. {leak.upper()} end"), (2, words(rng, 300)), (3, None), (4, ""), (None, leak),
            (5, "pad " * 9000 + typo), (5, "pad " * 9000 + typo), (6, leak[:60]), (7, leak[50:200])]
    for size in (500_000, 200):
        old, contamination.INDEX_CHARS = contamination.INDEX_CHARS, size
        find = contamination.finder(bench)
        contamination.INDEX_CHARS = old
        found = table(spark, rows).select("doc_id", find(F.col("text")).alias("found")).collect()
        hits = [(r.doc_id, {m.item_id for m in r.found}) for r in found if r.found]
        assert sorted(hits, key=str) == sorted(
            [(1, {2}), (None, {2}), (5, {2}), (5, {2}), (7, {2})], key=str
        )
    none = contamination.finder(bench.filter("false"))
    assert all(r.f == [] for r in table(spark, rows).select(none(F.col("text")).alias("f")).collect())


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(13)
    bad, dull = ["idiot", "scumbag", "moronic"], ["aaa!!", "bbb!!", "ccc!!"]
    rows, labels = [], []
    for i in range(600):
        toxic, low = rng.random() < 0.2, rng.random() < 0.2
        text = words(rng, rng.randrange(5, 40)).replace("w", "word")
        text = re.sub("[0-9]", lambda m: "abcdefghij"[int(m.group())], text)
        text += " " + (rng.choice(bad) if toxic else "") + (" " + rng.choice(dull)) * low
        rows.append((i, text))
        if i < 400:
            labels.append((i, int(not low), int(toxic)))
        rows[i] = (i, text, toxic)
    labels += [(0, None, None), (None, 1, 1), (9999, 1, 1), labels[5]]
    marked = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    docs = table(spark, [r[:2] for r in rows] + [(700, None), (701, ""), (None, "idiot"), (1, rows[1][1])])
    chain = toxicity.fit(docs, marked, sample_rows=350)
    found = [(r.document.doc_id, r.p.toxic, r.document.node) for r in toxicity.score(docs, chain).collect()]
    assert len(found) == 604 and all(n == "n" and 0 <= p <= 1 for _, p, n in found)
    right = sum((p >= 0.5) == rows[i][2] for i, p, _ in found if i is not None and 400 <= i < 600)
    assert right >= 190
    assert len(chain) == 2 and len(chain[1].earlier) == 1
    for few in (marked.filter("false"), marked.filter("doc_id = 3")):
        lone = toxicity.score(docs, toxicity.fit(docs, few)).collect()
        assert len({r.p.toxic for r in lone}) == 1
    assert toxicity.score(docs.filter("false"), chain).collect() == []


def test_digest_is_of_the_whole_text(spark):
    text = "z" * 100_000 + "é"
    row = table(spark, [(1, text)]).select(F.sha2("text", 256).alias("h")).first()
    assert row.h == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("at_once", [0, 10_000])
def test_components_of_any_number_of_links(spark, at_once):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(900, 950)]
    found = components(spark.createDataFrame(links, "a LONG, b LONG"), at_once=at_once).collect()
    assert {r.node: r.root for r in found} == roots_of({n for l in links if l[0] != l[1] for n in l}, links)


def test_a_key_of_many_nodes_is_compared_in_blocks(spark):
    rng = np.random.default_rng(6)
    sets = {n: rng.integers(0, 2**64, 40 + n % 90, np.uint64) for n in range(600)}
    for n in range(0, 200, 2):  # the next one has most of its elements
        sets[n + 1] = np.r_[sets[n][: max(4, len(sets[n]) - 3)], rng.integers(0, 2**64, 2, np.uint64)]
    items = [(n, len(s), *linking.sketch(s).tolist()) for n, s in sets.items()]
    items = spark.createDataFrame(items, f"node LONG, n LONG, {linking.SKETCH_SCHEMA}")
    rest = spark.createDataFrame([(1, n, n, -1) for n in sets], "key LONG, node LONG, root LONG, top LONG")
    found = {(r.a, r.b) for r in linking._block_pairs(rest, items, 80, block=16).collect()}
    assert found == {(r.a, r.b) for r in linking._pairs(rest, items, 80).collect()}
    assert all((n, n + 1) in found for n in range(0, 200, 2) if len(sets[n]) > 30)

    def verify(pairs):
        return pairs.filter("a % 2 = 0 AND b = a + 1 AND b < 200")

    entries = rest.select("key", "node")
    roots = {r.node: r.root for r in linking.linked(entries, items, 80, verify, large=10).collect()}
    assert roots == {n: n - n % 2 for n in range(200)}


def test_similar_lines_equal_shingle_sets():
    rng = random.Random(12)
    lines = ["", "a", "abcdefgh", "abcdefghi", "é" * 30] + ["".join(rng.choices("ab ", k=rng.randrange(60))) for _ in range(60)]
    pairs = [(a, b) for a in lines for b in lines]
    expected = []
    for a, b in pairs:
        s, t = line_dedup.shingle_set(a), line_dedup.shingle_set(b)
        expected.append(100 * len(s & t) >= line_dedup.PERCENT * len(s | t))
    assert line_dedup.similar_lines(*map(list, zip(*pairs))) == expected
    assert line_dedup.similar_lines([], []) == []


def test_lines_of_any_white_space_stay(spark):
    rows = [(i, f"own line {i}\n\t\n   \n\r\nshared by all of them") for i in range(3)]
    found = {r.doc_id: r.text for r in line_dedup.dedup(table(spark, rows)).collect()}
    assert found == {0: rows[0][1], **{i: f"own line {i}\n\t\n   \n\r\n".removesuffix("\n") for i in (1, 2)}}


def test_kept_tables_leave_no_shuffle_files(spark):
    folders = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def files():
        return {p for f in folders for p in Path(f).rglob("shuffle_*.data")}

    setting = spark.conf.get(common.CLEANUP)
    rows = spark.range(5000).groupBy((F.col("id") * 7 % 1000).alias("key")).agg(F.max("id").alias("most"))
    joined = rows.join(rows.select("key"), ["key"])
    before = files()
    plain = common.written(joined, "plain")
    between = files()
    assert between - before and plain.count() == 1000
    between = files()
    table = common.kept(joined, "table")
    assert files() <= between
    assert table.count() == 1000 and spark.conf.get(common.CLEANUP) == setting
    common.release(table)
