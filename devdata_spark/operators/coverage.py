"""Which periods each series covers, as bitmaps.

A bitmap is an array of 64-bit words, one bit per period from `first` to `last`. It is
made by one aggregation that ors single bits, combined before the shuffle, so what
moves is one small row per series and task and never a row of the table. Gaps are read
from the bitmap; requested periods are not joined with the table. Bitmaps of parts of a
table are merged by `merge`, so a new part need not read the others again.

Periods are whole numbers, such as years. NULL periods and those outside the range do
not count; NULL keys are series like any other.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.operators import joins

WORD = 64
COVERED = "covered"


def bitmaps(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    first: int,
    last: int,
    *,
    value: str | None = None,
) -> DataFrame:
    """One row per series, with `covered`. With `value`, blank rows cover nothing."""
    bit = (F.col(period) - first).cast("bigint")
    counts = F.col(period).between(first, last)
    if value is not None:
        counts = counts & F.col(value).isNotNull()
    words = {
        name: F.when(
            counts & (F.floor(bit / WORD) == i),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % WORD).cast("int")),
        )
        for i, name in enumerate(_words(first, last))
    }
    marked = df.select(*keys, *[word.alias(name) for name, word in words.items()])
    return _packed(marked.groupBy(*keys).agg(*[F.bit_or(w).alias(w) for w in words]), keys, words)


def merge(parts: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """The bitmaps of a whole table from those of its parts, over the same periods."""
    names = _words(first, last)
    ored = parts.groupBy(*keys).agg(
        *[F.bit_or(F.col(COVERED)[i]).alias(name) for i, name in enumerate(names)]
    )
    return _packed(ored, keys, names)


def gaps(
    covered: DataFrame,
    keys: Sequence[str],
    period: str,
    first: int,
    last: int,
    *,
    series: DataFrame | None = None,
) -> DataFrame:
    """The periods that each series lacks, a row for each.

    `series` are those asked for, by default those that have a bitmap; one without lacks
    every period.
    """
    if series is not None:
        covered = joins.attach(series.select(*keys).distinct(), covered, keys, derived=True)
    missing = F.filter(_all(first, last), lambda p: ~_has(F.col(COVERED), p, first))
    return covered.select(*keys, F.explode(missing).alias(period))


def report(covered: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Per series: `n_periods`, `first_period`, `last_period`, and `n_gaps` between them."""
    having = F.filter(_all(first, last), lambda p: _has(F.col(COVERED), p, first))
    counted = covered.select(
        *keys,
        F.size(having).alias("n_periods"),
        F.array_min(having).alias("first_period"),
        F.array_max(having).alias("last_period"),
    )
    inside = F.col("last_period") - F.col("first_period") + 1 - F.col("n_periods")
    return counted.withColumn("n_gaps", F.coalesce(inside, F.lit(0)))


def _words(first: int, last: int) -> list[str]:
    return [f"_word_{i}" for i in range((last - first) // WORD + 1)]


def _packed(df: DataFrame, keys: Sequence[str], words: Sequence[str]) -> DataFrame:
    filled = [F.coalesce(w, F.lit(0).cast("bigint")) for w in words]
    return df.select(*keys, F.array(*filled).alias(COVERED))


def _all(first: int, last: int) -> Column:
    return F.sequence(F.lit(first), F.lit(last))


def _has(covered: Column, period: Column, first: int) -> Column:
    bit = period - first
    word = F.get(covered, F.floor(bit / WORD).cast("int"))
    return F.coalesce(F.getbit(word, (bit % WORD).cast("int")) == 1, F.lit(False))
