"""Macroeconomic outlook, published in April and October.

Landed as parquet: `<root>/vintage_year=2024/vintage_month=April/`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality
from devdata_spark.errors import DataExtractionError, DataFormattingError
from devdata_spark.functions import text
from devdata_spark.operators import columns, filters, latest
from devdata_spark.sources import files

# Publisher columns and their harmonised names, release months.
COLUMNS = {
    "OBS_VALUE": fields.VALUE,
    "TIME_PERIOD": fields.YEAR,
    "REF_AREA_CODE": fields.ENTITY_CODE,
    "REF_AREA_IMF_CODE": fields.IMF_CODE,
    "REF_AREA_LABEL": fields.ENTITY_NAME,
    "CONCEPT_CODE": fields.INDICATOR_CODE,
    "CONCEPT_LABEL": fields.INDICATOR_NAME,
    "UNIT_LABEL": fields.UNIT,
    "LASTACTUALDATE": "last_actual_date",
}
MONTHS = ["April", "October"]
VINTAGE_YEAR, VINTAGE_MONTH = "vintage_year", "vintage_month"
REQUIRED = [fields.VALUE, fields.YEAR, fields.ENTITY_CODE, fields.INDICATOR_CODE]


def data(
    spark: SparkSession,
    root: str,
    version: str | tuple[str, int] = "latest",
    *,
    legacy_entity_codes: bool = False,
) -> DataFrame:
    """One release: the latest, or a pinned one such as `("April", 2023)`.

    The latest one is found among the folder names, so only its files are opened.
    """
    vintages = files.read_parquet(spark, root)
    if version == "latest":
        version = newest_version(spark, root)
    raw = select_version(vintages, version).drop(VINTAGE_YEAR, VINTAGE_MONTH)
    df = shape(raw)
    if legacy_entity_codes:
        df = with_legacy_codes(df)
        quality.warn_entities_without_code(df)
    return quality.validate(df, REQUIRED)


def newest_version(spark: SparkSession, root: str) -> tuple[str, int]:
    """Month and year of the newest landed release, from the listing alone."""
    found = files.list_files(spark, f"{root}/{VINTAGE_YEAR}=*/{VINTAGE_MONTH}=*")
    year = F.regexp_extract("path", f"/{VINTAGE_YEAR}=([0-9]+)/", 1).cast("int")
    month = F.regexp_extract("path", f"/{VINTAGE_MONTH}=([^/]+)/", 1)
    # April sorts before October as text too
    newest = found.agg(F.max(F.struct(year.alias("y"), month.alias("m"))).alias("v")).first().v
    if newest is None:
        raise DataExtractionError("No release found")
    return newest.m, newest.y


def select_version(vintages: DataFrame, version: str | tuple[str, int] = "latest") -> DataFrame:
    """Rows of one release; the choice prunes partitions."""
    if version == "latest":
        # April sorts before October as text too
        return latest.latest_release(vintages, [F.col(VINTAGE_YEAR), F.col(VINTAGE_MONTH)])
    month, year = version
    filters.check_choice(month, MONTHS, "release month")
    chosen = vintages.where((F.col(VINTAGE_YEAR) == year) & (F.col(VINTAGE_MONTH) == month))
    if chosen.isEmpty():
        raise DataExtractionError(f"No release found for {month} {year}")
    return chosen


def shape(raw: DataFrame) -> DataFrame:
    """Harmonised names, other names in lower case, rows without a value dropped."""
    df = columns.lower_names(columns.rename(raw, COLUMNS))
    typed = columns.clean(df, value=lambda c: text.strict(c, "double"), year=lambda c: text.strict(c, "int"))
    return filters.skip_blanks(columns.nan_to_null(typed))


def with_legacy_codes(df: DataFrame) -> DataFrame:
    """Replace the entity code by the old numeric code, NULL where there is none."""
    if fields.IMF_CODE not in df.columns:
        raise DataFormattingError(
            f"Legacy entity codes need the column '{fields.IMF_CODE}', which the files lack"
        )
    return df.withColumn(fields.ENTITY_CODE, F.col(fields.IMF_CODE))
