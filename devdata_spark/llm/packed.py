"""Keys that several nodes share, with keys and nodes shuffled as packed arrays.

A corpus has billions of (key, node) entries of two 64-bit integers. As rows they cost a
shuffle many times their size in headers and calls; here a task packs the entries of a
batch into one binary pair per bucket, and each bucket is sorted as arrays.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from devdata_spark.llm.common import trim

PACKED = "bucket INT, keys BINARY, nodes BINARY"
# Entries that a task gathers before it packs them, to bound its memory.
GATHERED = 250_000
# Rows that are looked at together: few enough for their arrays to stay in the cache.
ROWS = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(
    df: DataFrame, entries: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], buckets: int,
    short: bool = False,
) -> DataFrame:
    """Rows of `PACKED`: the entries of each batch, without repeats, by bucket of the key.

    `entries` makes (keys as uint64, nodes as int64) of a batch of rows. With `short` a key
    is its bucket and 32 more bits, which is enough where what meets by chance is compared
    later: as buckets grow with the entries, about one entry in a thousand meets another so.
    """

    def packed(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])][: len(keys)]
        keys, nodes = keys[fresh], nodes[fresh]
        spread = mix(keys)
        bucket = (spread % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        if short:
            keys = (spread >> np.uint64(32)).astype(np.uint32)
        keys, nodes, bucket = keys[order], nodes[order], bucket[order]
        found, starts = np.unique(bucket, return_index=True)
        ends = np.append(starts[1:], len(bucket))
        return pa.record_batch(
            {
                "bucket": pa.array(found, pa.int32()),
                "keys": pa.array(
                    [keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()
                ),
                "nodes": pa.array(
                    [nodes[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()
                ),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                held.append(entries(batch.slice(start, ROWS)))
                size += len(held[-1][0])
                if size >= GATHERED:
                    yield packed(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if size:
            yield packed(*map(np.concatenate, zip(*held)))
        trim()

    return df.mapInArrow(run, PACKED)


def shared(packed: DataFrame, short: bool = False) -> DataFrame:
    """key, node: every entry whose key has at least two nodes, once each.

    With `short`, which is then that of `pack`, keys are not those that went in.
    """

    def unpack(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), np.uint32 if short else np.uint64)
        if short:
            keys = keys | np.uint64(group["bucket"].iloc[0]) << np.uint64(32)
        nodes = np.frombuffer(b"".join(group["nodes"]), np.int64)
        # most keys occur once: sorting them alone is cheaper than sorting entries
        ordered = np.sort(keys)
        repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(repeated):
            return pd.DataFrame({"key": np.empty(0, np.int64), "node": np.empty(0, np.int64)})
        at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
        hit = repeated[at] == keys
        keys, nodes = keys[hit].view(np.int64), nodes[hit]
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        same = (keys[1:] == keys[:-1]) & (nodes[1:] == nodes[:-1])
        fresh = np.r_[True, ~same]
        keys, nodes = keys[fresh], nodes[fresh]
        starts = np.r_[True, keys[1:] != keys[:-1]]
        group_of = np.cumsum(starts) - 1
        several = np.bincount(group_of)[group_of] > 1
        return pd.DataFrame({"key": keys[several], "node": nodes[several]})

    return packed.groupBy("bucket").applyInPandas(unpack, "key BIGINT, node BIGINT")
