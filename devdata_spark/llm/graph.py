"""Connected components of links, as joins and aggregates."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import kept, release, ship

# So many links (8 MB) are the work of a single task.
AT_ONCE = 500_000
NODES = "node BIGINT, root BIGINT"


def components(links: DataFrame, most_rounds: int = 60, at_once: int = AT_ONCE) -> DataFrame:
    """node, root: the smallest node that each linked node reaches, as a kept table.

    `links` has two BIGINT columns a, b; direction, repeats and loops do not matter; links
    with NULL are left out, and so are nodes without a link to another. Union-find as
    alternating stars: each node's larger neighbours are linked to its smallest one, then
    its smaller ones, until nothing changes; components shrink to stars in a logarithmic
    number of rounds in practice. Neighbours are only aggregated, never gathered, so a node
    with very many links is no problem. Up to `at_once` links are solved by one task.
    """
    ship(links.sparkSession)
    edges = kept(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    if edges.count() <= at_once:
        found = kept(edges.coalesce(1).mapInArrow(_solved, NODES), "components")
        release(edges)
        return found
    before = _mark(edges)
    for _ in range(most_rounds):
        larger = kept(_small_star(_large_star(edges)), "edges")
        release(edges)
        edges, after = larger, _mark(larger)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = kept(stars.union(roots), "components")
    release(edges)
    return found


def _solved(batches):
    parts = [np.stack([b.column(c).to_numpy() for c in ("u", "v")]) for b in batches]
    edges = np.concatenate([np.empty((2, 0), np.int64), *parts], axis=1)
    nodes, places = np.unique(edges, return_inverse=True)
    root = roots(len(nodes), *places.reshape(edges.shape))
    yield pa.record_batch({"node": pa.array(nodes), "root": pa.array(nodes[root])})


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches by the links u - v."""
    root = np.arange(n)
    while len(u):
        high, low = np.maximum(root[u], root[v]), np.minimum(root[u], root[v])
        apart = high != low
        u, v, high, low = u[apart], v[apart], high[apart], low[apart]
        np.minimum.at(root, high, low)
        while not np.array_equal(above := root[root], root):
            root = above
    return root


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
