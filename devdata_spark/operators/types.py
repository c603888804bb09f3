"""Column types found in the data, and explicit casts."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devdata_spark.functions import text
from devdata_spark.operators import columns


def infer_types(df: DataFrame) -> DataFrame:
    """The narrowest type that holds every value, one row per column.

    Columns: `column_name`, `rows_with_value`, `inferred_type`. Text is tried as
    boolean, bigint and double; a fractional type becomes bigint when every value
    is whole. One aggregation over the table, combined before the shuffle.
    """
    df = columns.nan_to_null(df)
    checks = [_column_checks(f).alias(f"_{i}") for i, f in enumerate(df.schema.fields)]
    found = df.agg(*checks)
    return found.select(F.inline(F.array(*[F.col(c) for c in found.columns])))


def convert_types(df: DataFrame, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Cast every column to its inferred type, then apply the explicit `casts`."""
    _check_known(df, casts)
    inferred = {r.column_name: r.inferred_type for r in infer_types(df).collect()}
    return cast(columns.nan_to_null(df), inferred | dict(casts or {}))


def cast(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Explicit casts. A column that does not exist is a KeyError."""
    _check_known(df, casts)
    return df.withColumns({c: text.strict(F.col(f"`{c}`"), t) for c, t in casts.items()})


def safe_cast(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Casts that give NULL where a value does not fit."""
    _check_known(df, casts)
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in casts.items()})


def _column_checks(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    current = F.lit(field.dataType.simpleString())
    if isinstance(field.dataType, T.StringType):
        inferred = (
            F.when(F.count(c) == 0, current)
            .when(_all(c, c.rlike("^(?i)(true|false)$")), F.lit("boolean"))
            .when(_all(c, text.to_integer(c, "bigint").isNotNull()), F.lit("bigint"))
            .when(_all(c, text.to_double(c).isNotNull()), F.lit("double"))
            .otherwise(current)
        )
    elif isinstance(field.dataType, T.FractionalType):
        whole = c.try_cast("bigint").cast("double") == c.cast("double")
        inferred = F.when(_all(c, F.coalesce(whole, F.lit(False))), "bigint").otherwise(current)
    else:
        inferred = current
    return F.struct(
        F.lit(field.name).alias("column_name"),
        F.count(c).alias("rows_with_value"),
        inferred.alias("inferred_type"),
    )


def _all(c: Column, condition: Column) -> Column:
    return F.coalesce(F.bool_and(F.when(c.isNotNull(), condition)), F.lit(False))


def _check_known(df: DataFrame, casts: Mapping[str, str] | None) -> None:
    unknown = [c for c in casts or {} if c not in df.columns]
    if unknown:
        raise KeyError(f"Columns not found: {unknown}")
