"""Dates read as their column is written.

05/04/2024 alone can be a day of April or of May. Which one is meant shows in the other
cells of the column: each cell has a mask of the forms in which it is a date, and the
masks of a column are combined by `bit_and`, per file, in one aggregate.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark import scratch
from devdata_spark.functions import dates
from devdata_spark.operators import joins


def forms(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """How the dates of a column are written: one row for each `by`, or one in all.

    `form` is the form that fits all cells which are dates in some form, NULL if there is
    none; `ambiguous_form` the same among the ambiguous forms; `allowed` is the latter as a
    mask. `mixed` tells that cells of ambiguous forms contradict each other. `n_dates`,
    `n_unparsed` and `n_empty` count cells.
    """
    cells = df.select(*by, F.col(column).alias("_cell"), dates.form_mask(F.col(column)).alias("_mask"))
    mask = F.col("_mask")
    some = F.when(mask != 0, mask)
    ambiguous = mask.bitwiseAND(F.lit(dates.AMBIGUOUS_BITS))
    found = cells.groupBy(*by).agg(
        F.coalesce(F.bit_and(some), F.lit(0)).alias("_all"),
        F.coalesce(F.bit_and(F.when(ambiguous != 0, ambiguous)), F.lit(0)).alias("allowed"),
        F.coalesce(F.bit_or(ambiguous), F.lit(0)).alias("_seen"),
        F.count_if(mask != 0).alias("n_dates"),
        F.count_if(F.col("_cell").isNotNull() & (F.coalesce(mask, F.lit(0)) == 0)).alias("n_unparsed"),
        F.count_if(F.col("_cell").isNull()).alias("n_empty"),
    )
    return found.select(
        *by,
        _first_form(F.col("_all")).alias("form"),
        _first_form(F.col("allowed")).alias("ambiguous_form"),
        "allowed",
        ((F.col("_seen") != 0) & (F.col("allowed") == 0)).alias("mixed"),
        "n_dates", "n_unparsed", "n_empty",
    )


def parse(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The columns as dates, NULL where no known form fits.

    Cells of an ambiguous form are read in the one that fits all such cells of the column
    with the same `by`, such as the file; the day goes first if both fit, and cell by cell
    if neither does (see `mixed` of `forms`). Two passes: the masks of all columns are one
    aggregate, with a row for each `by`, which is kept and measured before it is joined.
    """
    masks = {c: dates.form_mask(F.col(f"`{c}`"), dates.AMBIGUOUS) for c in columns}
    found = df.groupBy(*by).agg(
        *[F.bit_and(F.when(m != 0, m)).alias(f"_allowed_{c}") for c, m in masks.items()]
    )
    if by:
        marked = joins.attach(df, scratch.materialise(found, "forms"), list(by), validate=False)
        allowed = {c: F.col(f"`_allowed_{c}`") for c in columns}
    else:
        marked, row = df, found.first()
        allowed = {c: F.lit(row[i]).cast("bigint") for i, c in enumerate(columns)}
    parsed = {c: dates.parse_free_form(F.col(f"`{c}`"), allowed[c]) for c in columns}
    return marked.withColumns(parsed).select(*[f"`{c}`" for c in df.columns])


def _first_form(mask: Column) -> Column:
    """The first form of a mask by name."""
    names = [
        F.when(mask.bitwiseAND(F.lit(dates.form_bit(p))) != 0, F.lit(p))
        for p in dates.FREE_FORM_PATTERNS
    ]
    return F.coalesce(*names)
