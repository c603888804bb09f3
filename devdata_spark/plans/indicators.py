"""Indicator databases: observations, and the tables that describe them.

Landed replies as JSON lines, one folder per database:

    <root>/databases/
    <root>/data/db=2/  <root>/entities/db=2/  <root>/series/db=2/  <root>/metadata/db=2/
"""

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas
from devdata_spark.errors import DataExtractionError, DataFormattingError
from devdata_spark.functions import text
from devdata_spark.operators import columns, filters, joins, latest, records
from devdata_spark.sources import files

# Database ids, publisher columns and their harmonised names.
DEFAULT_DATABASE, DEBT_DATABASE = 2, 6
ENTITY_COLUMNS = {
    "id": fields.ENTITY_CODE,
    "value": fields.ENTITY_NAME,
    "aggregate": "is_aggregate",
    "longitude": "longitude",
    "latitude": "latitude",
    "capitalCity": "capital_city",
    "region_id": fields.REGION_CODE,
    "region_value": fields.REGION_NAME,
    "adminregion_id": "admin_region_code",
    "adminregion_value": "admin_region_name",
    "lendingType_id": "lending_type_code",
    "lendingType_value": "lending_type_name",
    "incomeLevel_id": fields.INCOME_LEVEL_CODE,
    "incomeLevel_value": fields.INCOME_LEVEL_NAME,
}
METADATA_COLUMNS = {
    "IndicatorName": fields.INDICATOR_NAME,
    "Aggregationmethod": "aggregation_method",
    "Dataset": "dataset",
    "Developmentrelevance": "development_relevance",
    "License_Type": "license_Type",
    "License_URL": "license_url",
    "Limitationsandexceptions": "limitations_and_exceptions",
    "Longdefinition": "long_definition",
    "Othernotes": "other_notes",
    "Periodicity": "periodicity",
    "Referenceperiod": "reference_period",
    "Shortdefinition": "short_definition",
    "Source": "source",
    "Statisticalconceptandmethodology": "statistical_concept_and_methodology",
    "Topic": "topic",
    "Unitofmeasure": fields.UNIT,
}
# harmonised name: publisher columns that can hold it, preferred first
DATA_COLUMNS = {
    fields.YEAR: ["time_value", "time"],
    fields.ENTITY_CODE: ["economy", "economy_id"],
    fields.ENTITY_NAME: ["economy_value"],
    "is_aggregate": ["economy_aggregate", "aggregate"],
    fields.INDICATOR_CODE: ["series", "series_id"],
    fields.INDICATOR_NAME: ["series_value"],
    fields.COUNTERPART_CODE: ["counterpart_area", "counterpart_area_id"],
    fields.COUNTERPART_NAME: ["counterpart_area_value"],
    fields.VALUE: ["value"],
}
DROPPED_COLUMN = "time_id"
# harmonised columns that are not text
DATA_TYPES = {"is_aggregate": "boolean", fields.VALUE: "double"}
SERIES_COLUMNS = {"id": fields.INDICATOR_CODE, "value": fields.INDICATOR_NAME}
DEBT_STOCK_CODES = [
    "DT.DOD.BLAT.CD",
    "DT.DOD.MLAT.CD",
    "DT.DOD.PBND.CD",
    "DT.DOD.PCBK.CD",
    "DT.DOD.PROP.CD",
]
DEBT_SERVICE_CODES = [
    "DT.AMT.BLAT.CD",
    "DT.AMT.MLAT.CD",
    "DT.AMT.PBND.CD",
    "DT.AMT.PCBK.CD",
    "DT.AMT.PROP.CD",
    "DT.INT.BLAT.CD",
    "DT.INT.MLAT.CD",
    "DT.INT.PBND.CD",
    "DT.INT.PCBK.CD",
    "DT.INT.PROP.CD",
]
REQUIRED = [fields.YEAR, fields.INDICATOR_CODE, fields.ENTITY_CODE, fields.VALUE]

_PAIR = "STRUCT<id: STRING, value: STRING>"
RAW_RECORDS = "time STRING, economy STRING, aggregate BOOLEAN, series STRING, value DOUBLE"
RAW_LABELLED_RECORDS = (
    f"time {_PAIR}, economy STRUCT<id: STRING, value: STRING, aggregate: BOOLEAN>, "
    f"series {_PAIR}, value DOUBLE"
)
RAW_ENTITIES = (
    "id STRING, value STRING, aggregate BOOLEAN, longitude STRING, latitude STRING, "
    f"capitalCity STRING, region {_PAIR}, adminregion {_PAIR}, lendingType {_PAIR}, "
    f"incomeLevel {_PAIR}"
)
RAW_SERIES = "id STRING, value STRING"
RAW_METADATA = "id STRING, metadata MAP<STRING, STRING>"
RAW_DATABASES = "id STRING, name STRING, code STRING, lastupdated STRING"


# --- readers -----------------------------------------------------------------


def data(
    spark: SparkSession,
    root: str,
    indicator_code: str | Sequence[str],
    entity_code: str | Sequence[str] | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    db: int = DEFAULT_DATABASE,
    skip_blanks: bool = False,
    skip_aggs: bool = False,
    include_labels: bool = False,
    labelled_records: bool = False,
    counterparts: bool = False,
    undeclared: bool = False,
    mrv: int | None = None,
    mrnev: int | None = None,
) -> DataFrame:
    """Observations of the given indicators.

    `labelled_records` says that records were landed with names beside codes;
    where they were not, `include_labels` joins the names from the entity and
    series tables. `counterparts` says that records also have a counterpart area.
    `undeclared` finds both in the records themselves, at the price of one more pass
    over them, and keeps every field that has no declared name.
    `mrv` keeps the most recent periods of each indicator, `mrnev` the most recent
    values of each entity.
    """
    check_database(spark, root, db)
    path = f"{root}/data/db={db}"
    if undeclared:
        df = shape_found_records(files.read_lines(spark, path), "value")
        labelled_records = fields.ENTITY_NAME in df.columns
        counterparts = fields.COUNTERPART_CODE in df.columns
    else:
        schema = RAW_LABELLED_RECORDS if labelled_records else RAW_RECORDS
        if counterparts:
            schema += f", counterpart_area {_PAIR if labelled_records else 'STRING'}"
        df = shape_records(files.read_json(spark, path, schema))
    df = select(
        df, indicator_code, entity_code, start_year, end_year,
        skip_blanks=skip_blanks or mrnev is not None,
    )
    if skip_aggs:
        df = filters.skip_aggregates(df)
    # asked of the filtered scan, before anything that shuffles
    if df.isEmpty():
        raise DataExtractionError("No data found for the request.")
    series = [fields.INDICATOR_CODE]
    if mrv is not None:
        df = latest.most_recent_periods(df, mrv, series=series)
    if mrnev is not None:
        by = [fields.ENTITY_CODE, *series, *([fields.COUNTERPART_CODE] if counterparts else [])]
        df = latest.most_recent_values(df, mrnev, by=by)
    if not labelled_records:
        df = df.drop("is_aggregate")
        if include_labels:
            df = with_labels(df, entities(spark, root, db), catalogue(spark, root, db))
    elif not include_labels:
        df = df.drop(
            fields.ENTITY_NAME, "is_aggregate", fields.INDICATOR_NAME, fields.COUNTERPART_NAME
        )
    return quality.check_columns(df, REQUIRED)


def databases(spark: SparkSession, root: str) -> DataFrame:
    """The databases and when each was last updated."""
    return shape_databases(files.read_json(spark, f"{root}/databases", RAW_DATABASES))


def entities(
    spark: SparkSession,
    root: str,
    db: int | None = DEFAULT_DATABASE,
    *,
    skip_aggs: bool = False,
) -> DataFrame:
    """The entities of a database, with region, lending type and income level.

    `None` stands for all databases, here and for indicators and descriptions.
    """
    df = _described(spark, root, "entities", RAW_ENTITIES, shape_entities, db)
    return filters.skip_aggregates(df) if skip_aggs else df


def catalogue(spark: SparkSession, root: str, db: int | None = DEFAULT_DATABASE) -> DataFrame:
    """The indicators of a database: codes and names."""
    return _described(spark, root, "series", RAW_SERIES, shape_catalogue, db)


def metadata(
    spark: SparkSession,
    root: str,
    indicator_code: str | Sequence[str],
    db: int | None = DEFAULT_DATABASE,
) -> DataFrame:
    """The description of each given indicator; one without any is an error."""
    codes = filters.as_list(indicator_code)
    described = _described(spark, root, "metadata", RAW_METADATA, shape_metadata, db)
    quality.require_codes(described, fields.INDICATOR_CODE, codes)
    return filters.select_values(described, fields.INDICATOR_CODE, codes)


def check_database(spark: SparkSession, root: str, db: int) -> int:
    """Return the database id if there is such a database."""
    ids = sorted(r.id for r in databases(spark, root).select("id").distinct().collect())
    return filters.check_choice(db, ids, "database id")


def last_updated(spark: SparkSession, root: str, db: int = DEBT_DATABASE) -> date:
    """When the database was last updated."""
    check_database(spark, root, db)
    return databases(spark, root).where(F.col("id") == db).first().last_updated


def debt_stock_indicators(spark: SparkSession, root: str) -> DataFrame:
    """The descriptions of the public debt stock indicators."""
    return metadata(spark, root, DEBT_STOCK_CODES, DEBT_DATABASE)


def debt_service_indicators(spark: SparkSession, root: str) -> DataFrame:
    """The descriptions of the public debt service indicators."""
    return metadata(spark, root, DEBT_SERVICE_CODES, DEBT_DATABASE)


# --- tables ------------------------------------------------------------------


def shape_records(raw: DataFrame) -> DataFrame:
    """Flat records with harmonised names and an integer year."""
    flat = columns.flatten(raw).drop(DROPPED_COLUMN)
    df = columns.rename_first(flat, DATA_COLUMNS)
    return columns.clean(df, year=lambda c: text.strict(c, "int"))


def shape_found_records(texts: DataFrame, column: str) -> DataFrame:
    """JSON texts as flat records: harmonised columns, and all others as found.

    Harmonised columns have their declared types whatever they were written as; a cell
    that does not fit, or an object where a code belongs, stops the job. Other fields
    have the narrowest type that holds all their values.
    """
    found = records.widen(records.parse(texts, column))
    known = {raw for raws in DATA_COLUMNS.values() for raw in raws}
    harmonised = [c for c in found.columns if c not in known and c.lower() in DATA_COLUMNS]
    if harmonised:
        raise DataFormattingError(f"Records use harmonised names: {harmonised}")
    typed = columns.clean(found, **{
        raw: lambda c, to=DATA_TYPES.get(name): text.strict(c, to) if to else _code(c)
        for name, raws in DATA_COLUMNS.items()
        for raw in raws
    })
    shaped = shape_records(typed)
    return quality.check_columns(shaped, REQUIRED)


def _code(c: Column) -> Column:
    written = c.cast("string")
    broken = F.raise_error(F.concat(F.lit("Not a code: "), written)).cast("string")
    return F.when(written.startswith("{") | written.startswith("["), broken).otherwise(written)


def select(
    df: DataFrame,
    indicator_code: str | Sequence[str] | None = None,
    entity_code: str | Sequence[str] | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    skip_blanks: bool = False,
) -> DataFrame:
    """Rows of the given indicators, entities and years; all of it reaches the scan."""
    df = filters.select_values(df, fields.INDICATOR_CODE, indicator_code)
    df = filters.select_values(df, fields.ENTITY_CODE, entity_code)
    df = filters.select_years(df, start_year, end_year)
    return filters.skip_blanks(df) if skip_blanks else df


def with_labels(df: DataFrame, entities: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add entity and indicator names, and whether the entity is an aggregate."""
    about = entities.select(fields.ENTITY_CODE, fields.ENTITY_NAME, "is_aggregate")
    named = joins.attach(df, about, [fields.ENTITY_CODE])
    if fields.COUNTERPART_CODE in df.columns:
        partner = entities.select(
            F.col(fields.ENTITY_CODE).alias(fields.COUNTERPART_CODE),
            F.col(fields.ENTITY_NAME).alias(fields.COUNTERPART_NAME),
        )
        named = joins.attach(named, partner, [fields.COUNTERPART_CODE])
    return joins.attach(named, catalogue, [fields.INDICATOR_CODE])


def shape_entities(raw: DataFrame) -> DataFrame:
    """Flat, renamed, in fixed order, empty cells as NULL."""
    flat = columns.require_renamed(columns.flatten(raw), ENTITY_COLUMNS)
    return columns.marker_to_null(flat, "")


def shape_catalogue(raw: DataFrame) -> DataFrame:
    """Indicator codes and names."""
    return columns.require_renamed(raw, SERIES_COLUMNS)


def shape_databases(raw: DataFrame) -> DataFrame:
    """Integer ids and dates."""
    df = columns.rename(raw, {"lastupdated": "last_updated"})
    typed = df.withColumns(
        {"id": F.col("id").cast("int"), "last_updated": F.to_date("last_updated", "yyyy-MM-dd")}
    )
    return columns.require(typed, schemas.names(schemas.DATABASES))


def shape_metadata(raw: DataFrame) -> DataFrame:
    """The indicator code, the known description fields as columns, and the others.

    `other_fields` holds, as JSON with sorted keys, what the publisher says beyond the
    known fields; NULL where there is nothing else.
    """
    described = [
        F.col("metadata").getItem(key).alias(name) for key, name in METADATA_COLUMNS.items()
    ]
    rest = F.map_filter("metadata", lambda key, _: ~key.isin(list(METADATA_COLUMNS)))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(rest)))
    other = F.when(F.size(rest) > 0, F.to_json(ordered)).alias("other_fields")
    return raw.select(F.col("id").alias(fields.INDICATOR_CODE), *described, other)


def in_indicator_group(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Rows of a named group of indicators, such as `DEBT_STOCK_CODES`."""
    return filters.select_values(df, fields.INDICATOR_CODE, codes)


def _described(
    spark: SparkSession,
    root: str,
    table: str,
    schema: str,
    shape: Callable[[DataFrame], DataFrame],
    db: int | None,
) -> DataFrame:
    """A describing table of one database, or the distinct rows of all of them."""
    if db is not None:
        return shape(files.read_json(spark, f"{root}/{table}/db={db}", schema))
    return shape(files.read_json(spark, f"{root}/{table}", schema).drop("db")).distinct()
