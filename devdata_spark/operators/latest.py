"""Most recent periods, values and releases."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devdata_spark import fields
from devdata_spark.errors import DataExtractionError
from devdata_spark.operators import joins


def most_recent_periods(
    df: DataFrame, n: int, *, series: Sequence[str] = (), period: str = fields.YEAR
) -> DataFrame:
    """Rows of the `n` most recent periods, the same periods for every entity.

    With `series` the periods are found for each series on its own. Only distinct
    periods are ranked, and at most `n` of them per series cross the shuffle.
    """
    _check_count(n)
    if not series:
        latest = df.select(period).distinct().orderBy(F.desc_nulls_last(period)).limit(n)
        first = latest.agg(F.min(period)).first()[0]
        return df.where(F.col(period) >= F.lit(first))
    periods = df.select(*series, period).distinct()
    ranked = top_rows(periods, n, by=series, order=[F.desc_nulls_last(period)])
    first = ranked.groupBy(*series).agg(F.min(period).alias("_first"))
    return (
        joins.attach(df, first, list(series), derived=True)
        .where(F.col(period) >= F.col("_first"))
        .drop("_first")
    )


def most_recent_values(
    df: DataFrame,
    n: int,
    *,
    by: Sequence[str] = (fields.ENTITY_CODE, fields.INDICATOR_CODE),
    period: str = fields.YEAR,
    value: str = fields.VALUE,
) -> DataFrame:
    """The `n` most recent rows with a value, for each entity and series."""
    _check_count(n)
    filled = df.where(F.col(value).isNotNull())
    # the other columns settle ties, so that reruns pick the same rows
    ties = [F.col(c) for c in df.columns if c not in {*by, period}]
    return top_rows(filled, n, by=by, order=[F.desc_nulls_last(period), *ties])


def top_rows(df: DataFrame, n: int, *, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first `n` rows of each group by `order`, exactly.

    For counts up to `spark.sql.optimizer.windowGroupLimitThreshold` Spark keeps
    just `n` rows per group in each task before the shuffle. Above it the rows that
    each input partition holds of a group are ranked on their own first, so that no
    task ranks a whole group. Only `by` and `order` are compared.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit:
        cut = df.withColumn("_part", F.spark_partition_id())
        df = _ranked(cut, n, [*by, "_part"], order).drop("_part")
    return _ranked(df, n, by, order)


def latest_release(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows of the newest release, given the columns or expressions that date it.

    The newest release is looked up first (one row), so that it reaches the scan
    as a constant and prunes partitions or row groups.
    """
    names = [f"_o{i}" for i in range(len(order))]
    dated = [c.alias(name) for c, name in zip(order, names)]
    newest = df.select(F.struct(*dated).alias("_r")).agg(F.max("_r").alias("_r")).first()._r
    if newest is None:
        raise DataExtractionError("No release found")
    for column, name in zip(order, names):
        df = df.where(column.eqNullSafe(F.lit(newest[name])))
    return df


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key. Ties are settled by the remaining columns.

    A maximum over whole rows: it is combined before the shuffle, unlike a window.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def _ranked(df: DataFrame, n: int, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def _check_count(n: int) -> None:
    if n < 1:
        raise ValueError("At least one period is needed")
