"""Blocks of vectors inside tasks: Arrow lists as matrices, and the best of each row."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def matrix(lists: pa.ChunkedArray | pa.Array, width: int, dtype) -> np.ndarray:
    """Lists of numbers as rows of a matrix; missing components are 0."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    if len(values) == len(lists) * width and (np.diff(ends, prepend=0) == width).all():
        return values.astype(dtype).reshape(len(lists), width)
    out = np.zeros((len(lists), width), dtype)
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = values
    return out


def first_of_rows(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each row by falling score, then id; in that order."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]][: len(rows)])
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    return order[place < k]


def candidates(scores: np.ndarray, valid: np.ndarray, k: int, least, slack: float = 0):
    """Rows and columns of the valid entries that can be among the k best of their row.

    `least` is the value of entries that are not valid; with `slack`, entries that are
    lower than the k-th best by no more than it are also given.
    """
    scores = np.where(valid, scores, least)
    if scores.shape[1] > k:
        kth = np.partition(scores, -k, axis=1)[:, -k]
        valid = valid & (scores >= kth[:, None] - slack)
    return np.nonzero(valid)
