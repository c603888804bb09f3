"""Row filters. Arguments are checked first, so a wrong one fails without a job."""

from collections.abc import Iterable, Sequence
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdata_spark import fields
from devdata_spark.functions import dates
from devdata_spark.operators import joins

T = TypeVar("T")


def as_list(values: object | Sequence[object] | None) -> list | None:
    """One value or several as a sorted list without duplicates; None stays None."""
    if values is None:
        return None
    many = [values] if isinstance(values, (str, int)) else values
    return sorted(set(many))


def check_choice(value: T, choices: Iterable[T], what: str) -> T:
    """Return `value` if it is one of `choices`, else raise a ValueError naming them."""
    if value not in choices:
        raise ValueError(f"Invalid {what}: {value}. Choose from {list(choices)}")
    return value


def drop_missing(df: DataFrame, column: str, *, blank: bool = False) -> DataFrame:
    """Drop rows whose `column` is NULL, and with `blank` also the empty text."""
    c = F.col(f"`{column}`")
    kept = c.isNotNull() & (c != "") if blank else c.isNotNull()
    return df.where(kept)


def drop_first_row(df: DataFrame, order: str, by: str) -> DataFrame:
    """Drop the first row of each file, such as a header read as data.

    `order` gives the row order inside the file `by`. The first row is found with
    a minimum per file, which is combined before the shuffle, and the rows
    themselves never move: a window over a file would sort that whole file in
    one task.
    """
    first = df.groupBy(by).agg(F.min(order).alias("_first"))
    return (
        joins.attach(df, first, [by], validate=False)
        .where(F.col(order) > F.col("_first"))
        .drop("_first")
    )


def select_values(df: DataFrame, column: str, values) -> DataFrame:
    """Keep rows whose `column` is one of `values`; None keeps every row."""
    wanted = as_list(values)
    return df if wanted is None else df.where(F.col(column).isin(wanted))


def select_years(
    df: DataFrame, start: int | None = None, end: int | None = None, column: str = fields.YEAR
) -> DataFrame:
    """Keep an inclusive range of years; an open end is not limited."""
    bounds = dates.year_bounds(start, end)
    return df if bounds is None else df.where(F.col(column).between(*bounds))


def skip_blanks(df: DataFrame, column: str = fields.VALUE) -> DataFrame:
    """Drop rows without an observation."""
    return df.where(F.col(column).isNotNull())


def skip_aggregates(
    df: DataFrame, entities: DataFrame | None = None, key: str = fields.ENTITY_CODE
) -> DataFrame:
    """Drop aggregate entities such as regions and the world.

    Uses the table's own `is_aggregate` flag when there is one, and otherwise the
    flag of the `entities` dimension. An entity that the dimension does not know
    is kept.
    """
    if "is_aggregate" in df.columns:
        return df.where(~F.coalesce(F.col("is_aggregate"), F.lit(False)))
    if entities is None:
        raise ValueError("Without an is_aggregate column the entities table is needed")
    aggregates = entities.where("is_aggregate").select(key)
    return joins.attach(df, aggregates, [key], how="left_anti")


def in_group(df: DataFrame, members: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep rows whose key is in the `members` table, such as the countries of a region."""
    keys = [key] if isinstance(key, str) else list(key)
    return joins.attach(df, members.select(*keys), keys, how="left_semi")
