"""Inflation and insufficient food consumption, country by country.

Landed replies, one folder per country:

    <root>/registry/*.json
    <root>/inflation/indicator_id=116/iso3_code=KEN/*.csv
    <root>/national/iso3_code=KEN/*.json
    <root>/subnational/iso3_code=KEN/*.json

All countries are read in one scan; a request for some reads just their folders.
`country_table` gives short names and resolves names of unknown form, see
`operators.resolve`.
"""

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas
from devdata_spark.functions import dates, text
from devdata_spark.operators import columns, filters, reshape, resolve
from devdata_spark.sources import files

logger = logging.getLogger(__name__)

# Indicator names and ids, publisher columns, harmonised names,
# date formats and constant cells.
INFLATION_INDICATORS = {
    "Headline inflation (YoY)": 116,
    "Headline inflation (MoM)": 117,
    "Food inflation": 71,
}
LEVELS = ["national", "subnational"]
INFLATION_COLUMNS = {
    "Date": fields.DATE,
    "Value": fields.VALUE,
    "SourceOfTheData": fields.SOURCE,
}
INFLATION_DROPPED = ["IndicatorName", "CountryName"]
INFLATION_DATES = "dd/MM/yyyy"
SERIES_COLUMNS = {
    "x": fields.DATE,
    "fcs": fields.VALUE,
    "fcsHigh": fields.VALUE_UPPER,
    "fcsLow": fields.VALUE_LOWER,
}
SERIES_DATES = "yyyy-MM-dd"
SERIES_CONSTANTS = {
    fields.INDICATOR_NAME: "people with insufficient food consumption",
    fields.SOURCE: "World Food Programme",
}
INDICATOR_ID = "indicator_id"


# --- readers -----------------------------------------------------------------


def countries(
    spark: SparkSession, root: str, country_table: DataFrame, *, with_data: bool = True
) -> DataFrame:
    """The country registry; by default only countries that have food data."""
    raw = files.read_json(
        spark, f"{root}/registry", schemas.FOOD_REGISTRY_RAW, multi_line=True
    )
    return shape_registry(raw, country_table, with_data=with_data)


def inflation(
    spark: SparkSession,
    root: str,
    country_table: DataFrame,
    indicators: str | Sequence[str] | None = None,
    countries: str | Sequence[str] | None = None,
) -> DataFrame:
    """Inflation of the given indicators and countries, by default all."""
    names = list(INFLATION_INDICATORS) if indicators is None else filters.as_list(indicators)
    for name in names:
        filters.check_choice(name, INFLATION_INDICATORS, "indicator")
    codes = None if countries is None else resolve.requested_codes(countries, country_table)
    raw = files.read_csv(
        spark, f"{root}/inflation", schemas.INFLATION_RAW,
        partitions=f"{INDICATOR_ID} INT, {fields.ISO3_CODE} STRING",
    )
    raw = filters.select_values(raw, INDICATOR_ID, [INFLATION_INDICATORS[n] for n in names])
    raw = filters.select_values(raw, fields.ISO3_CODE, codes)
    _warn_without_rows(raw, codes, names)
    return quality.check_types(shape_inflation(raw, country_table), schemas.INFLATION_DATA)


def security(
    spark: SparkSession,
    root: str,
    country_table: DataFrame,
    countries: str | Sequence[str] | None = None,
    level: str = "national",
    *,
    multi_line: bool = True,
) -> DataFrame:
    """Insufficient food consumption of the given countries, by default all.

    Countries that the registry lists without data are left out. Replies are one
    document per file; with `multi_line` off one per line, which can be split.
    """
    filters.check_choice(level, LEVELS, "level")
    codes = None if countries is None else resolve.requested_codes(countries, country_table)
    raw_schema, schema = {
        "national": (schemas.FOOD_NATIONAL_RAW, schemas.FOOD_NATIONAL),
        "subnational": (schemas.FOOD_SUBNATIONAL_RAW, schemas.FOOD_SUBNATIONAL),
    }[level]
    raw = files.read_json(
        spark, f"{root}/{level}", f"{raw_schema}, {fields.ISO3_CODE} STRING",
        multi_line=multi_line,
    )
    listed = _registry(
        files.read_json(
            spark, f"{root}/registry", schemas.FOOD_REGISTRY_RAW, multi_line=multi_line
        )
    )
    raw = filters.in_group(
        filters.select_values(raw, fields.ISO3_CODE, codes), _with_data(listed), fields.ISO3_CODE
    )
    shape = shape_national if level == "national" else shape_subnational
    landed = files.list_files(spark, f"{root}/{level}/*")
    _warn_unlisted(_with_data(listed), landed, codes)
    return quality.check_types(shape(raw, country_table), schema)


def missing_countries(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Requested countries for which the table has no rows, as `missing_code`."""
    return quality.missing_codes(df, fields.ISO3_CODE, codes)


# --- tables ------------------------------------------------------------------


def shape_registry(
    raw: DataFrame, country_table: DataFrame, *, with_data: bool = True
) -> DataFrame:
    """One row per country of the registry reply."""
    listed = _registry(raw)
    named = resolve.add_short_name(_with_data(listed) if with_data else listed, country_table)
    return columns.require(named, schemas.names(schemas.FOOD_REGISTRY))


def shape_inflation(raw: DataFrame, country_table: DataFrame) -> DataFrame:
    """Harmonised names, dates, and the indicator and country the folder names."""
    # a file of another layout stops here, not with wrong columns
    columns.require(raw, [*INFLATION_DROPPED, *INFLATION_COLUMNS])
    df = columns.rename(raw.drop(*INFLATION_DROPPED), INFLATION_COLUMNS)
    ids = text.strict(F.col(INDICATOR_ID), "int")
    name = F.coalesce(*[F.when(ids == i, F.lit(n)) for n, i in INFLATION_INDICATORS.items()])
    typed = df.withColumns(
        {
            fields.DATE: dates.parse_strict(F.col(fields.DATE), INFLATION_DATES),
            fields.VALUE: text.strict(text.missing_to_null(F.col(fields.VALUE).cast("string")), "double"),
            fields.INDICATOR_NAME: name,
        }
    )
    unit = columns.constants(typed, {fields.UNIT: fields.PERCENT})
    named = resolve.add_short_name(unit, country_table)
    return columns.require(named, schemas.names(schemas.INFLATION_DATA))


def shape_national(raw: DataFrame, country_table: DataFrame) -> DataFrame:
    """The points of each country's series."""
    series = raw.withColumn("fcsGraph", _present("fcsGraph", "the country's series"))
    rows = reshape.array_to_rows(series, "fcsGraph", [fields.ISO3_CODE])
    return _series(rows, country_table, schemas.FOOD_NATIONAL)


def shape_subnational(raw: DataFrame, country_table: DataFrame) -> DataFrame:
    """The points of each region's series."""
    features = raw.withColumn("features", _present("features", "the list of regions"))
    regions = reshape.array_to_rows(features, "features", [fields.ISO3_CODE]).select(
        fields.ISO3_CODE,
        F.col("properties.Name").alias(fields.REGION_NAME),
        F.col("properties.fcsGraph").alias("fcsGraph"),
    )
    series = regions.withColumn("fcsGraph", _present("fcsGraph", "the region's series"))
    rows = reshape.array_to_rows(series, "fcsGraph", [fields.ISO3_CODE, fields.REGION_NAME])
    return _series(rows, country_table, schemas.FOOD_SUBNATIONAL)


def _series(rows: DataFrame, country_table: DataFrame, schema: str) -> DataFrame:
    df = columns.rename(rows, SERIES_COLUMNS).withColumn(
        fields.DATE, dates.parse_strict(F.col(fields.DATE), SERIES_DATES)
    )
    named = resolve.add_short_name(columns.constants(df, SERIES_CONSTANTS), country_table)
    return columns.require(named, schemas.names(schema))


def _present(name: str, what: str) -> Column:
    """The column, or an error in the job where a reply lacks it."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"The reply lacks {what} ({name})")))


def _registry(raw: DataFrame) -> DataFrame:
    features = raw.select(F.col("body.features").alias("features"))
    return reshape.array_to_rows(features, "features").select(
        F.col("properties.iso3").alias(fields.ISO3_CODE),
        F.col("properties.adm0_id").alias(fields.ENTITY_CODE),
        F.col("properties.dataType").alias(fields.DATA_TYPE),
    )


def _with_data(registry: DataFrame) -> DataFrame:
    return filters.drop_missing(registry, fields.DATA_TYPE)


def _warn_without_rows(raw: DataFrame, codes: list[str] | None, names: Sequence[str]) -> None:
    """Log the requested countries, and indicators of them, whose files hold no row.

    Only the folder values are asked for, of the requested folders: no cell is parsed.
    """
    if not codes:
        return
    found = {(r[0], r[1]) for r in raw.select(INDICATOR_ID, fields.ISO3_CODE).distinct().collect()}
    for code in codes:
        missing = [name for name in names if (INFLATION_INDICATORS[name], code) not in found]
        if len(missing) == len(names):
            logger.warning("Data not found for country - %s", code)
            continue
        for name in missing:
            logger.warning("Data not found for country - %s, indicator - %s", code, name)


def _warn_unlisted(listed: DataFrame, found: DataFrame, codes: list[str] | None) -> None:
    """Log the requested countries that the registry or the folders do not have."""
    if not codes:
        return
    code = F.col(fields.ISO3_CODE)
    folders = found.select(F.regexp_extract("path", f"/{fields.ISO3_CODE}=([^/]+)/", 1).alias("c"))
    known = {r[0] for r in listed.where(code.isin(codes)).select(code).distinct().collect()}
    known &= {r.c for r in folders.where(F.col("c").isin(codes)).distinct().collect()}
    for missing in sorted(set(codes) - known):
        logger.warning("Data not found for country - %s", missing)
