"""The conversation trie against a plain trie of Python dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from devdata_spark.llm import trie

SCHEMA = (
    "conv_id LONG, turn LONG, role STRING, text STRING, place INT, digest STRING, depth INT, conv INT"
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", 2, 3) for r in rows], SCHEMA).repartition(4)


def plain(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            digest = hashlib.md5(f"{len(said[0])}:{said[0]}{said[1]}".encode()).digest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), digest, said))
    own = {c: [t[2] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in convs.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        own_bytes = len(node[-1][1].encode()) if node else 0
        saved[node] = saved.get(node, 0) + (len(nodes[node]) - 1) * own_bytes
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return {
        (
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
            children.get(node, 0), leaves[node], saved[node],
            hashlib.sha256(
                ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(node)).encode()
            ).hexdigest(),
        )
        for node, members in nodes.items()
    }


def random_forest(rng, n):
    parent = np.array([rng.randrange(-1, i) if i else -1 for i in range(n)], np.int64)
    names = list(range(n))
    rng.shuffle(names)  # parents need not come first
    shuffled = np.empty(n, np.int64)
    for i, p in enumerate(parent):
        shuffled[names[i]] = names[p] if p >= 0 else -1
    return shuffled


@pytest.mark.parametrize("n", [1, 2, 40, 700])
def test_subtrees_by_parentheses(n):
    rng = random.Random(n)
    for parent in (random_forest(rng, n), np.arange(-1, n - 1)):
        weight = np.array([rng.randrange(100) for _ in range(n)])
        hung = np.array([rng.choice([0, 0, 2]) for _ in range(n)])
        hung_leaves = hung * 3
        children, leaves, total = trie.subtrees(parent, weight, hung_leaves, hung)
        inside = {i: {i} for i in range(n)}
        for i in range(n):
            up = parent[i]
            while up >= 0:
                inside[up].add(i)
                up = parent[up]
        for i in range(n):
            below = inside[i]
            bare = sum(1 for j in below if not (parent == j).any() and not hung[j])
            assert children[i] == (parent == i).sum() + hung[i]
            assert leaves[i] == bare + sum(hung_leaves[j] for j in below)
            assert total[i] == sum(weight[j] for j in below)


def test_close_of_every_open():
    opens, _ = trie.parentheses(random_forest(random.Random(1), 3000))
    found = trie.Parentheses(opens).find_close(np.flatnonzero(opens))
    stack, expected = [], {}
    for i, is_open in enumerate(opens):
        if is_open:
            stack.append(i)
        else:
            expected[stack.pop()] = i
    assert dict(zip(np.flatnonzero(opens).tolist(), found.tolist())) == expected


def test_running_sums_cross_tasks(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.randrange(1 << 61)) for i in range(3000)]  # one key holds most rows
    rows += [(k, i, rng.randrange(1 << 61)) for k in range(2, 40) for i in range(5)]
    df = spark.createDataFrame(rows, "k LONG, at LONG, x LONG").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = trie.running(df, "k", ["at"], ["x"], "running").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums, expected = {}, {}
    for k, at, x in sorted(rows):
        sums[k] = (sums.get(k, 0) + x) % (1 << 62)
        expected[k, at] = sums[k]
    assert {(r.k, r.at): r.x for r in found} == expected


def conversations():
    rng = random.Random(8)
    openings = [("system", "Be brief."), ("system", "Bé kind."), ("user", "hello")]
    rows = []
    for c in range(-6, 130):
        turns = [rng.choice(openings) for _ in range(rng.randrange(1, 3))]
        turns += [(rng.choice("ua"), f"t{rng.randrange(4)}") for _ in range(rng.randrange(12))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    for c in (200, 205, 207, 210):  # copies
        rows += [(c, i, "user", "same") for i in range(40)]
    rows += [(300, i, "user", f"long {i // 2}") for i in range(400)]
    rows += [(301, None, None, None), (301, 1, "u", ""), (301, 1, "u", ""), (301, 1, "", "u")]
    rows += [(None, 1, "u", "x"), (None, None, None, None), (403, 0, "u", "only"), (406, 1, "x", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("members", [None, 1, 5, 40])
def test_trie_of_odd_conversations(spark, members):
    rows = conversations()
    found = trie.prefix_trie(frame(spark, rows), members).collect()
    expected = plain(rows)
    assert len(found) == len(expected)
    assert {tuple(r) for r in found} == expected


def test_tries_of_few_rows(spark):
    assert trie.prefix_trie(frame(spark, [])).collect() == []
    assert trie.prefix_trie(frame(spark, [(None, 0, "u", "x")])).collect() == []
    for rows in ([(0, 0, "u", "x")], [(2, 0, "u", "x")], [(7, 0, "u", "x"), (8, 0, "u", "x")]):
        assert {tuple(r) for r in trie.prefix_trie(frame(spark, rows)).collect()} == plain(rows)
