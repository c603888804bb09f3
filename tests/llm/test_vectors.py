"""Nearest neighbours and hard negatives against brute force."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from devdata_spark.llm import negatives, neighbours, queries
from devdata_spark.llm.blocks import matrix

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.1")
NAN, INF = float("nan"), float("inf")

# columns that clash with names inside the operators
SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, id INT, v STRING, point INT, block INT"


def odd_vectors(seed, n=260, width=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(width)], rng.randrange(3)) for i in range(n)]
    same = [0.5, -0.25, 0.0, 1.0, 0.0, 0.75]
    rows += [(1000 + i, same, i % 3) for i in range(40)]  # copies, some of them queries
    rows += [(2000 + i, [x * (i + 1) for x in same], 1) for i in range(3)]
    rows += [(3000, [1.0, 2.0], 0), (3001, [], 1), (3002, [0.0] * width, 1)]
    rows += [(3050, None, 1), (3100, [1.0, None], 1), (3150, [NAN] * width, 1)]
    rows += [(3200, [INF] * width, 1), (None, same, 1), (3250, same, None)]
    rows += [(0, rows[0][1], rows[0][2])]  # a repeated row
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", 2, 3) for r in rows], SCHEMA).repartition(3)


def usable(rows, width=6):
    found = {}
    for i, v, label in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = np.array([*v, *[0.0] * (width - len(v))], np.float32).astype(np.float64)
        found.setdefault(i, (v, label))
    return found


def cosines(rows):
    rows = {i: v for i, (v, _) in usable(rows).items() if v.any()}
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids])
    x /= np.linalg.norm(x, axis=1)[:, None]
    return ids, x @ x.T


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(0).normal(size=(5, 16))
    turned = neighbours.hadamard(x)
    assert np.allclose(neighbours.hadamard(turned), x)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))


def test_a_vector_falls_to_its_first_probe():
    x = neighbours.unit(np.random.default_rng(1).normal(size=(50, 20)))
    for levels in (1, 2):
        hashing = neighbours.CrossPolytope(20, 2, levels)
        probes = hashing.probes(x, 1, 40)
        assert (probes[:, 0] == hashing.buckets(x, 1)).all()
        assert all(len(set(p)) == 40 for p in probes.tolist())
        closeness = sum(
            np.take_along_axis(
                hashing.sides(x, 1, level), probes // (64 ** (levels - 1 - level)) % 64, 1
            )
            for level in range(levels)
        )
        assert (np.diff(closeness, axis=1) <= 1e-12).all()


def test_unit_does_not_overflow():
    x = np.array([[3e300, 4e300], [3e-310, 4e-310]])
    assert np.allclose(neighbours.unit(x), [[0.6, 0.8]] * 2)


@pytest.mark.parametrize("block", [4096, 8])
def test_neighbours_of_odd_rows(spark, block):
    rows = odd_vectors(3)
    # with all probes of a single turn, everything is found
    found = neighbours.nearest(
        frame(spark, rows), F.col("id") % 20 == 0, tables=2, recall=1.0, block=block
    ).collect()
    ids, scores = cosines(rows)
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by_query) == [i for i in ids if i % 20 == 0]
    hits = 0
    for q, results in by_query.items():
        assert [rank for rank, _, _ in sorted(results)] == list(range(1, 6))
        near = sorted(results)
        at = ids.index(q)
        for _, x, score in near:
            assert x != q and abs(score - scores[at, ids.index(x)]) < 1e-12
        assert all(
            a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(near, near[1:])
        )
        best = sorted(np.delete(scores[at], at))[-5:]
        hits += sum(score >= best[0] - 1e-12 for _, _, score in near)
    assert hits >= (1.0 if block == 4096 else 0.9) * 5 * len(by_query)


def test_equal_vectors_give_the_smallest_ids(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(50)] + [(77, [0.0, 0.0], 1)]
    found = neighbours.nearest(frame(spark, rows), F.col("id") % 10 == 0).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    assert by_query == {
        q: [i for i in range(6) if i != q][:5] for q in range(0, 50, 10)
    }


def test_few_rows_and_empty_tables(spark):
    few = [(0, [1.0, 0.0], 1), (3, [0.5, 0.5], 1)]
    assert [tuple(r)[:3] for r in neighbours.nearest(frame(spark, few), F.col("id") == 0).collect()] == [(0, 1, 3)]
    assert neighbours.nearest(frame(spark, []), F.col("id") == 0).collect() == []
    assert neighbours.nearest(frame(spark, few[:1]), F.col("id") == 0).collect() == []
    assert negatives.hard_negatives(frame(spark, []), F.col("id") == 0).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
def test_recall_of_hashed_tables(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [tuple(r) for r in vectors.collect()]
    ids, scores = cosines([(i, v, 0) for i, v, *_ in rows]) if len(rows[0][1]) <= 6 else _wide(rows)
    found = neighbours.nearest(vectors, F.col("id") % 50 == 0, block=100).collect()
    hits = total = 0
    for q in (i for i in ids if i % 50 == 0):
        at = ids.index(q)
        best = set(np.array(ids)[np.argsort(-np.r_[scores[at, :at], -2, scores[at, at + 1 :]])[:5]])
        hits += len(best & {r.vec_id for r in found if r.query_id == q})
        total += 5
    assert hits >= 0.93 * total


def _wide(rows):
    ids = sorted(r[0] for r in rows)
    by_id = {r[0]: r[1] for r in rows}
    x = np.array([by_id[i] for i in ids], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    return ids, x @ x.T


def test_query_is_exact_where_one_bucket_holds_all(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, scores = _wide(rows)
    np.fill_diagonal(scores, -2)
    expected = {
        (q, rank + 1, ids[j])
        for at, q in enumerate(ids) if q % 50 == 0
        for rank, j in enumerate(np.argsort(-scores[at])[:5])
    }
    found = queries.QUERIES["op11_cross_polytope"](spark, folder).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == expected


def test_lists_become_matrices():
    lists = pa.array([[1, 2], [], [3]], pa.list_(pa.int64()))
    assert matrix(lists, 2, np.int64).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert matrix(lists.slice(1), 2, np.int64).tolist() == [[0, 0], [3, 0]]


def test_products_are_exact_for_any_size():
    rng = np.random.default_rng(5)
    for size, width in ((3, 2), (200, 64), (20_000, 700), (10**8, 30)):
        q = rng.integers(-size, size + 1, (7, width))
        x = rng.integers(-size, size + 1, (9, width))
        x[0], q[0] = size, size
        x[1] = -size
        primes = negatives.primes_for(float(size) ** 2 * width)
        found = negatives.products(
            [negatives.residues(q, p) for p in primes], [negatives.residues(x, p) for p in primes], primes
        )
        exact = [[sum(a * b for a, b in zip(r, s)) for s in x.tolist()] for r in q.tolist()]
        assert found.tolist() == exact
    with pytest.raises(ValueError):
        negatives.primes_for(2.0**62)


@pytest.mark.parametrize("blocks", [{}, {"anchor_block": 4, "block": 10}])
def test_hard_negatives_of_odd_rows(spark, blocks):
    rows = odd_vectors(9)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(frame(spark, rows), F.col("id") % 10 == 0, label=label, **blocks)
    left = {
        i: (np.floor(256 * v).astype(int), (label + 1) % 10 if i % 7 == 0 else label)
        for i, (v, label) in usable(rows).items()
        if label is not None
    }
    expected = set()
    for a in (i for i in left if i % 10 == 0):
        scored = sorted((-int(v @ left[a][0]), i) for i, (v, _) in left.items() if i != a)
        for s, p in [x for x in scored if left[x[1]][1] == left[a][1]][:5]:
            fitting = [
                (t, i) for t, i in scored
                if left[i][1] != left[a][1] and 80 * -s <= 100 * -t <= 100 * -s
            ][:5]
            expected |= {(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(fitting, 1)}
    assert {tuple(r) for r in found.collect()} == expected and expected
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
