"""Data-quality gates and reports.

`validate` runs at once and raises; the report functions return tables.
"""

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devdata_spark import fields, schemas
from devdata_spark.errors import (
    DataExtractionError,
    DataFormattingError,
    DataValidationError,
)
from devdata_spark.operators import combine, joins

logger = logging.getLogger(__name__)


def validate(
    df: DataFrame,
    required: Sequence[str] = (),
    *,
    schema: str | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Check a table and return it: not empty, columns, types, NULLs, in that order.

    `schema` is a DDL string; columns it names must have its types. Columns and
    types need no job. Emptiness and NULLs share one.
    """
    counted = [c for c in not_null if c in df.columns]
    nulls = {}
    if counted:
        counts = df.agg(
            F.count("*").alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in counted],
        ).first()
        empty = counts._rows == 0
        nulls = {c: counts[c] for c in counted if counts[c]}
    else:
        empty = df.isEmpty()
    if empty:
        raise DataValidationError("The table is not valid: DataFrame is empty.")
    check_columns(df, [*required, *not_null])
    if schema:
        check_types(df, schema)
    if nulls:
        raise DataFormattingError(f"Null values found: {nulls}")
    return df


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise where a required column is absent; the message lists all of them."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataValidationError(f"The table is not valid: Missing columns: {missing}")
    return df


def check_types(df: DataFrame, schema: str) -> DataFrame:
    """Raise where a column does not have its declared type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for field in schemas.parse(schema).fields:
        declared = field.dataType.simpleString()
        if field.name in actual and actual[field.name] != declared:
            raise DataValidationError(
                f"The table is not valid: Column '{field.name}' is "
                f"{actual[field.name]}, expected {declared}."
            )
    return df


def column_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: `n_rows`, and the count of values of each column as `n_<column>`."""
    return df.agg(
        F.count("*").alias("n_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in columns],
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count `n`."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless every key occurs once; returns the table."""
    if not key_violations(df, keys).isEmpty():
        raise DataValidationError(f"The table is not valid: {list(keys)} is not unique.")
    return df


def missing_codes(available: DataFrame, column: str, requested: Sequence[str]) -> DataFrame:
    """Requested codes that the table does not have, as a column `missing_code`.

    The table is reduced to requested codes in the scan, so at most one row per
    request is compared.
    """
    wanted = sorted(set(requested))
    found = available.where(F.col(column).isin(wanted)).select(
        F.col(column).cast("string").alias("missing_code")
    )
    rows = combine.of_values(available.sparkSession, [str(c) for c in wanted], "missing_code")
    return rows.join(found.distinct(), "missing_code", "left_anti")


def require_codes(available: DataFrame, column: str, requested: Sequence[str]) -> None:
    """Raise unless the table has every requested code."""
    missing = [r.missing_code for r in missing_codes(available, column, requested).collect()]
    if len(missing) == len(set(requested)):
        raise DataExtractionError("No metadata found for indicator code(s).")
    if missing:
        raise DataExtractionError(f"Metadata not found for indicator code(s): {sorted(missing)}")


def missing_series(requested: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested series for which the table has no rows."""
    return joins.attach(requested.select(*keys), present, list(keys), how="left_anti")


def entities_without_code(
    df: DataFrame, code: str = fields.ENTITY_CODE, name: str = fields.ENTITY_NAME
) -> DataFrame:
    """The distinct names of entities that have no code."""
    return df.where(F.col(code).isNull()).select(name).distinct()


def warn_entities_without_code(df: DataFrame, name: str = fields.ENTITY_NAME) -> DataFrame:
    """Log the names of entities that have no code, all of them in order; return them.

    Entities are countries and their groups, a few hundred names however many rows.
    """
    gaps = entities_without_code(df, name=name).where(F.col(name).isNotNull())
    names = sorted(r[0] for r in gaps.collect())
    if names:
        logger.warning(
            "No legacy code for %d entities: %s; entity_code is null there.",
            len(names), ", ".join(names),
        )
    return gaps
