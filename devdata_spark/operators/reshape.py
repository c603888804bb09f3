"""Wide to long, nested to flat."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devdata_spark import fields
from devdata_spark.functions import text

# Cells of wide tables that stand for a number nobody has.
MISSING_NUMBERS = ["..", "...", "-"]


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    *,
    variable: str = fields.INDICATOR_CODE,
    value: str = fields.VALUE,
) -> DataFrame:
    """One row per id and value column, with a double value. NULLs are kept.

    `values` defaults to every column that is not an id. Missing-value markers become
    NULL; any other text cell that is not a number stops the job. No shuffle: rows
    are expanded where they are.
    """
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema.fields}
    id_columns = [F.col(f"`{c}`") for c in ids]
    if all(is_text[c] for c in values):
        # one type already: cast the one value column, not every wide column
        value_columns = [F.col(f"`{c}`") for c in values]
        long = df.unpivot(id_columns, value_columns, variable, value)
        return long.withColumn(value, _to_number(F.col(value)))
    doubles = [
        (_to_number(F.col(f"`{c}`")) if is_text[c] else F.col(f"`{c}`").cast("double"))
        .alias(c)
        for c in values
    ]
    return df.select(*id_columns, *doubles).unpivot(
        id_columns, [F.col(f"`{c}`") for c in values], variable, value
    )


def _to_number(cell: Column) -> Column:
    # one set of markers: Spark cannot compile a short list inside a chain of conditions
    # over an unpivoted column, and would interpret the whole stage
    trimmed = F.trim(cell)
    known = F.when(~trimmed.isin([*MISSING_NUMBERS, *text.MISSING_MARKERS]), trimmed)
    return text.strict(known, "double")


def split_code_year(
    df: DataFrame, column: str = fields.INDICATOR_CODE, year: str = fields.YEAR
) -> DataFrame:
    """Split `CODE_YEAR` at its last underscore into a code and an integer year.

    Without an underscore the code is unchanged and the year NULL; the year is
    also NULL where the ending is not a number.
    """
    return df.withColumns(
        {
            column: text.before_last_underscore(F.col(column)),
            year: text.to_integer(text.after_last_underscore(F.col(column))),
        }
    )


def array_to_rows(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per struct of an array column, its fields as columns after `keep`.

    Dropping empty arrays after the expansion, not before, lets Spark work out the
    array (often parsed JSON) once per row instead of once more for a filter.
    """
    points = df.select(*keep, F.posexplode_outer(F.col(column)).alias("_at", "_point"))
    return points.where(F.col("_at").isNotNull()).select(*keep, "_point.*")


def map_to_rows(df: DataFrame, column: str, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of a map of structs: the map key, then the struct's fields."""
    return df.select(*keep, F.explode(F.col(column)).alias(key, "_entry")).select(
        *keep, key, "_entry.*"
    )
