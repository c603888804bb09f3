"""Byte-level BPE by a table over prefixes: one valid last token for each byte prefix.

A token sequence is what byte-pair merging yields exactly when each two neighbours are:
merging the bytes of both gives the same two tokens. So every prefix of a piece has one
valid last token, found from shorter prefixes. The table of a piece grows by appends and,
after an edit, changes only until it agrees with the old one again.
"""

from __future__ import annotations

import base64
import gc
import re
import threading
import time
from array import array
from functools import lru_cache
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from devdata_spark.llm.common import claim, memo, ship, trim

# Entries of each of the three memos (pieces, seams, prefixes) before they become old ones.
# Old ones that are asked for become new again, the others go when the next take their
# place, so a memo holds twice as many, all three together some 265 MB in a worker. It keeps
# them from task to task, until another operator's function starts there or nothing has been
# encoded for some seconds.
MEMO = 250_000
IDLE_SECONDS = 1.0
# Longer pieces are seldom met again and are not remembered.
MEMO_PIECE_BYTES = 48
# A piece that ends this many characters before an edit cannot change: the splitting
# pattern looks at no more than two characters after a match.
LOOKAHEAD = 4


# Letters, numbers and all other characters up to U+024F, where the standard library's
# faster patterns can name the classes; fixed values of the Unicode standard.
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
BEYOND_LATIN = re.compile("[^\\x00-\u024f]")


class Encoder:
    """Ranks of a byte-level vocabulary, and the pattern that splits a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, entries: int = MEMO):
        self.ranks, self.entries = ranks, entries
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        # \s of this module also takes four separators that are not Unicode white space
        self.split = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}")
            .replace(r"\s", r"\p{White_Space}")
        )
        classes = {r"\P{White_Space}": r"[^\t-\r \x85\xa0]", r"[^\p{White_Space}": r"[^\t-\r \x85\xa0",
                   r"\p{White_Space}": r"[\t-\r \x85\xa0]"}
        latin = self.split.pattern.replace(r"\p{L}\p{N}]", f"{LETTERS}{NUMBERS}]")
        for name, same in (classes | {r"\p{L}": f"[{LETTERS}]", r"\p{N}": f"[{NUMBERS}]"}).items():
            latin = latin.replace(name, same)
        self.split_latin = None if r"\p" in latin or r"\P" in latin else re.compile(latin)
        self._tokens = [self.bytes_of.get(i) for i in range(max(self.bytes_of, default=-1) + 1)]
        self._last: dict[bytes, int] = {}
        self._old_last: dict[bytes, int] = {}
        self._fits: dict[int, bool] = {}  # by left token << 32 | right token
        self._old_fits: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.packed = _Pieces(self)

    @classmethod
    def parse(cls, content: bytes, pattern: str, entries: int = MEMO) -> Encoder:
        """From lines of a base64 token and its rank."""
        lines = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern, entries)

    def merged(self, content: bytes, stop: int = 1) -> list[bytes]:
        """Plain byte-pair merging down to `stop` parts: lowest rank first, then leftmost."""
        parts = [content[i : i + 1] for i in range(len(content))]
        while len(parts) > stop:
            ranked = [
                (self.ranks[pair], i)
                for i in range(len(parts) - 1)
                if (pair := parts[i] + parts[i + 1]) in self.ranks
            ]
            if not ranked:
                break
            _, at = min(ranked)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one last; (-1, -1) for a byte.

        None if merging the token's own bytes does not give the token.
        """
        known = self._halves.get(token, False)
        if known is False:
            content = self.bytes_of[token]
            known = (-1, -1) if len(content) == 1 else self._last_merge(content)
            self._halves[token] = known
        return known

    def _last_merge(self, content: bytes) -> tuple[int, int] | None:
        parts = self.merged(content, stop=2)
        if len(parts) > 2 or b"".join(parts) not in self.ranks:
            return None
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand next to each other.

        Merging runs from low to high rank, so the seam is looked at backwards: the side
        that was merged last is taken apart, and at no time may the two tokens at the seam
        have a common merge that comes before the next merge of either side. Of equal
        ranks the left merge comes first.
        """
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            known = self._old_fits.pop(key, None)
            if known is None:
                known = self._seam_holds(left, right)
            if len(self._fits) >= self.entries:
                # the dict itself stays, since a table in progress holds its method
                self._old_fits = dict(self._fits)
                self._fits.clear()
            self._fits[key] = known
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        before = None  # a common merge of a lower rank than this would have come first
        while True:
            common = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if common is not None and (before is None or common < before):
                return False
            inner_left, inner_right = self.halves(left)[1], self.halves(right)[0]
            if inner_left < 0 and inner_right < 0:
                return True
            if inner_right < 0 or (inner_left >= 0 and left > right):
                before, left = left, inner_left
            else:
                before, right = right + 1, inner_right

    def last_token(self, content: bytes, table: list[int], end: int) -> int:
        """The one valid last token of the prefix of `end` bytes, from shorter prefixes."""
        rank_of, fits, halves = self.ranks.get, self._fits.get, self._halves.get
        for start in range(max(0, end - self.longest), end):
            token = rank_of(content[start:end])
            if token is None or (halves(token) or self.halves(token)) is None:
                continue
            if start == 0:
                return token
            known = fits(table[start] << 32 | token)
            if known or known is None and self.fits(table[start], token):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def table(self, content: bytes) -> list[int]:
        """Last tokens by prefix length; the empty prefix has -1."""
        return self.extended(b"", [-1], content)

    def extended(self, content: bytes, table: list[int], more: bytes) -> list[int]:
        """The table after an append; entries of old prefixes are final and stay."""
        whole, longer = content + more, list(table)
        for end in range(len(content) + 1, len(whole) + 1):
            longer.append(self.last_token(whole, longer, end))
        return longer

    def replaced(
        self, content: bytes, table: list[int], start: int, end: int, new: bytes
    ) -> tuple[bytes, list[int]]:
        """The piece and its table after bytes start..end become `new`.

        Entries up to `start` stay. Behind the new bytes, the old entries hold again once
        as many in a row agree as the longest token has bytes, since each depends on no
        more than those before it.
        """
        whole = content[:start] + new + content[end:]
        fresh, agreed, shift = table[: start + 1], 0, end - start - len(new)
        for at in range(start + 1, len(whole) + 1):
            fresh.append(self.last_token(whole, fresh, at))
            # the candidates before `start + len(new)` see changed bytes
            same = at >= start + len(new) + self.longest and fresh[at] == table[at + shift]
            agreed = agreed + 1 if same else 0
            if agreed >= self.longest:
                return whole, fresh + table[at + shift + 1 :]
        return whole, fresh

    def tokens(self, content: bytes, table: list[int]) -> list[int]:
        """The tokens of a piece, read off its table from the end."""
        if content in self.ranks:
            return [self.ranks[content]]
        found, at = [], len(content)
        while at:
            found.append(table[at])
            at -= len(self.bytes_of[table[at]])
        return found[::-1]

    def piece(self, content: bytes) -> list[int]:
        """The tokens of one piece; a piece that is a token is that token.

        Last tokens of prefixes are shared among pieces, and found only where a candidate
        for a longer prefix asks for them.
        """
        if content in self.ranks:
            return [self.ranks[content]]
        if len(content) > MEMO_PIECE_BYTES:
            return self.tokens(content, self.table(content))
        if len(self._last) >= self.entries:
            self._old_last, self._last = self._last, {}
        found = []
        while content:
            token = self._last.get(content) or self._last_token(content)
            found.append(token)
            content = content[: -len(self._tokens[token])]
        return found[::-1]

    def _last_token(self, prefix: bytes) -> int:
        """The last token of a prefix; those of the shorter prefixes it needs are kept."""
        rank_of, last, halves = self.ranks.get, self._last, self._halves.get
        known = self._old_last.pop(prefix, None)
        if known is not None:
            last[prefix] = known
            return known
        for start in range(max(0, len(prefix) - self.longest), len(prefix)):
            token = rank_of(prefix[start:])
            if token is None or (halves(token) or self.halves(token)) is None:
                continue
            if start:
                before = last.get(prefix[:start]) or self._last_token(prefix[:start])
                known = self._fits.get(before << 32 | token)
                if not (known or known is None and self.fits(before, token)):
                    continue
            last[prefix] = token
            return token
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, text: str) -> bytes:
        """Tokens of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.pieces(text)))

    def pieces(self, text: str) -> list[str]:
        """The text's pieces, by the standard library where that comes to the same."""
        if self.split_latin is not None and not BEYOND_LATIN.search(text):
            return self.split_latin.findall(text)
        return self.split.findall(text)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the tokens stand for."""
        return b"".join(map(self._tokens.__getitem__, memoryview(ids).cast("I")))


class _Pieces(dict):
    """Packed tokens by piece; what is missing is encoded when asked for."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.pop(piece, None)
        if packed is None:
            content = piece.encode("utf-8", "replace")
            packed = array("I", self.encoder.piece(content)).tobytes()
            if len(content) > MEMO_PIECE_BYTES:
                return packed
        if len(self) >= self.encoder.entries:
            self.old = dict(self)
            self.clear()
        self[piece] = packed
        return packed


class EditableText:
    """A text with its tokens, kept exact under appends and edits.

    Only pieces near the edit are split again and only changed pieces are encoded again;
    the rest is taken over.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.pieces = encoder.pieces(text)

    def ids(self) -> bytes:
        return b"".join(map(self.encoder.packed.__getitem__, self.pieces))

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Characters start..end become `new`."""
        kept = at = 0
        while kept < len(self.pieces) and at + len(self.pieces[kept]) <= start - LOOKAHEAD:
            at += len(self.pieces[kept])
            kept += 1
        old, old_at, shift = kept, at, len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        fresh = []
        for match in self.encoder.split.finditer(self.text, at):
            while old < len(self.pieces) and old_at + shift < match.start():
                old_at += len(self.pieces[old])
                old += 1
            behind = match.start() >= start + len(new)
            if behind and old < len(self.pieces) and old_at + shift == match.start():
                break
            fresh.append(match.group())
        else:
            old = len(self.pieces)
        self.pieces[kept:] = fresh + self.pieces[old:]


@lru_cache(maxsize=2)
def _encoder(content: bytes, pattern: str, entries: int) -> Encoder:
    trim()  # what others held in this worker and Spark has let go since
    return Encoder.parse(content, pattern, entries)


def _forget() -> bool:
    known = _encoder.cache_info().currsize > 0
    _encoder.cache_clear()
    return known


memo("bpe", _forget)


class _Use:
    """Encoding or decoding in progress; a worker that has none for a while forgets."""

    def __init__(self):
        self.running, self.ended, self.watch = 0, 0.0, None

    def __enter__(self):
        self.running += 1
        if self.watch is None:
            self.watch = threading.Thread(target=self._forget_when_idle, daemon=True)
            self.watch.start()

    def __exit__(self, *error):
        self.ended = time.monotonic()
        self.running -= 1

    def _forget_when_idle(self) -> None:
        while True:
            time.sleep(IDLE_SECONDS)
            if not self.running and time.monotonic() - self.ended > IDLE_SECONDS and _forget():
                gc.collect()
                trim()


_use = _Use()


def _each(content: bytes, pattern: str, what: str, values: pd.Series) -> pd.Series:
    """Values encoded or decoded, by what this worker remembers."""
    claim("bpe")
    with _use:
        one = getattr(_encoder(content, pattern, MEMO), what)
        return pd.Series([None if v is None else one(v) for v in values], dtype=object)


def _both(
    content: bytes, pattern: str, entries: int, text: str | None
) -> tuple[bytes | None, bytes | None]:
    """A text encoded, and that decoded, by what this worker remembers."""
    if text is None:
        return None, None
    claim("bpe")
    with _use:
        encoder = _encoder(content, pattern, entries)
        ids = encoder.encode(text)
        return ids, encoder.decode(ids)


def _sent(spark: SparkSession, path: str):
    """The content of a vocabulary file as a broadcast variable."""
    content = Path(path).read_bytes()
    if len(content) > 10_000_000:
        raise ValueError(f"{path} is too large for a vocabulary")
    ship(spark)
    return spark.sparkContext.broadcast(content)


def codec(spark: SparkSession, path: str, pattern: str):
    """Two column functions, encode and decode, for the vocabulary file at `path`.

    encode: text to tokens, as binary of little-endian unsigned 32-bit integers.
    decode: such tokens to the bytes they stand for. NULL stays NULL, the empty text has
    no tokens. The whole text is encoded, however long. The file is read on the driver
    and its content (under 10 MB, whatever the corpus) is sent to each executor once.
    """
    sent = _sent(spark, path)

    def encode(texts: pd.Series) -> pd.Series:
        return _each(sent.value, pattern, "encode", texts)

    def decode(ids: pd.Series) -> pd.Series:
        return _each(sent.value, pattern, "decode", ids)

    return F.pandas_udf(encode, "binary"), F.pandas_udf(decode, "binary")


def round_trip(spark: SparkSession, path: str, pattern: str, entries: int = MEMO):
    """A column function from a text to `ids`, its tokens, and `decoded`, the bytes of these.

    Both are as the functions of `codec` give them. A text is encoded once, where decode of
    encode has Spark encode it again, and a worker holds the texts, tokens and bytes of the
    100 rows that Spark pickles at a time, not of an Arrow batch of 10,000. Fewer `entries`
    of memos take less memory and more time; the results are the same.
    """
    sent = _sent(spark, path)

    def both(text: str | None) -> tuple[bytes | None, bytes | None]:
        return _both(sent.value, pattern, entries, text)

    return F.udf(both, "ids binary, decoded binary", useArrow=False)


def n_tokens(ids: Column) -> Column:
    """The number of tokens in an encoded column."""
    return (F.octet_length(ids) / 4).cast("long")
