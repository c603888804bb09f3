"""Repeats of a minimum length in one block of bytes, from common prefixes of suffixes.

Suffixes are sorted only as deep as the minimum length needs. Common prefixes of
neighbours are then found by increasing value: where two neighbours start with the same
byte, they share one byte more than the suffixes behind that byte do, so the place between
them gets the value l as soon as, between the places their suffixes come from in the
Burrows-Wheeler order, some value l - 1 or less is known. Places that are still open at
the minimum length separate suffixes that agree that far.
"""

import numpy as np

# Positions of a block; ranks of two halves and a position share 61 bits of a sort key.
BLOCK_BITS = 20
BLOCK = 1 << BLOCK_BITS
MASK = np.uint64(BLOCK - 1)


def suffix_ranks(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first `depth` symbols at least, and each one's place.

    `symbols` are below 512 and no more than `BLOCK`. The end of the block sorts first.
    """
    n = len(symbols)
    if n > BLOCK:
        raise ValueError(f"a block of {n} symbols: there are places for {BLOCK}")
    bits = np.uint64(BLOCK_BITS)
    position = np.arange(n, dtype=np.uint64)
    padded = np.zeros(n + 3, np.uint64)
    padded[:n] = symbols.astype(np.uint64) + np.uint64(1)
    key = padded[:n]
    for i in range(1, 4):
        key = (key << np.uint64(10)) | padded[i : n + i]
    length = 4
    while True:
        ordered = np.sort((key << bits) | position)
        order = (ordered & MASK).astype(np.int64)
        high = ordered >> bits
        fresh = np.r_[True, high[1:] != high[:-1]]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(fresh).astype(np.uint64) - np.uint64(1)
        if length >= depth or fresh.all():
            break
        second = np.zeros(n, np.uint64)
        second[: max(0, n - length)] = rank[length:] + np.uint64(1)
        key = (rank << np.uint64(BLOCK_BITS + 1)) | second
        length *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def groups(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and for each the number of its group.

    Suffixes of a group are those that agree in the first `length` symbols.
    """
    n = len(symbols)
    order, place = suffix_ranks(symbols, length + 1)
    first = symbols[order]
    known = np.zeros(n + 1, bool)  # known[t]: the value between suffixes t - 1 and t
    known[0] = known[n] = True
    known[1:n] = first[1:] != first[:-1]
    # the open places, and the stretch of the order that their suffixes come from
    open_places = np.flatnonzero(~known[:n])
    behind = np.r_[place[1:], -1]  # place of the suffix without its first symbol
    a, b = behind[order[open_places - 1]], behind[order[open_places]]
    low, high = np.minimum(a, b), np.maximum(a, b)
    for _ in range(1, length):
        count = np.cumsum(known)
        # the empty suffix (-1) sorts before all and shares nothing
        found = (low < 0) | (count[high] > count[np.maximum(low, 0)])
        if not found.any():
            break  # each value comes from the one before
        known[open_places[found]] = True
        still = ~found
        open_places, low, high = open_places[still], low[still], high[still]
    return order, np.cumsum(known[:n]) - 1
