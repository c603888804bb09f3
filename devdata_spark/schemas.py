"""Declared schemas, as Spark DDL strings.

Raw schemas name the publisher's columns (all text where the publisher ships
CSV, so that a bad cell is seen by an explicit cast and never by the reader).
Tidy schemas are the contract of each dataset and are what `quality.validate`
compares against. All column names and types here are fixed values.
"""

from pyspark.sql import types as T

# trade
TRADE_RAW = "t STRING, i STRING, j STRING, k STRING, v STRING, q STRING"
TRADE_FLOWS = (
    "year INT, exporter_code BIGINT, importer_code BIGINT, product_code STRING, "
    "value DOUBLE, quantity DOUBLE"
)
TRADE_PRODUCTS = "product_code STRING, product_description STRING"
TRADE_COUNTRIES = "country_code BIGINT, country_name STRING, iso3_code STRING"

# debt sustainability
DEBT_RAW = (
    "_c0 STRING, _c1 STRING, _c2 STRING, _c3 STRING, _c4 STRING, _c5 STRING, "
    "_c6 STRING, _c7 STRING"
)
DEBT_ASSESSMENTS = (
    "country_name STRING, latest_publication DATE, risk_of_debt_distress STRING, "
    "debt_sustainability_assessment STRING, joint_with_world_bank BOOLEAN, "
    "latest_dsa_discussed DATE"
)

# human development
HDI_DATA = (
    "entity_code STRING, entity_name STRING, region_code STRING, hdi_group STRING, "
    "indicator_code STRING, value DOUBLE, year INT, indicator_name STRING"
)

# health expenditure
HEALTH_DATA = (
    "country_name STRING, iso3_code STRING, year INT, indicator_code STRING, "
    "value DOUBLE, indicator_name STRING, unit STRING, currency STRING"
)

# HIV
HIV_DATA = (
    "indicator_name STRING, unit STRING, subgroup STRING, entity_name STRING, "
    "entity_code STRING, year INT, source STRING, value STRING, "
    "value_formatted STRING, footnote STRING, value_numeric DOUBLE"
)

# inflation
INFLATION_RAW = (
    "IndicatorName STRING, CountryName STRING, Date STRING, Value STRING, "
    "SourceOfTheData STRING"
)
INFLATION_DATA = (
    "date DATE, value DOUBLE, source STRING, indicator_name STRING, "
    "iso3_code STRING, country_name STRING, unit STRING"
)

# food security
SERIES_POINTS = "ARRAY<STRUCT<x: STRING, fcs: DOUBLE, fcsHigh: DOUBLE, fcsLow: DOUBLE>>"
FOOD_NATIONAL_RAW = f"fcsGraph {SERIES_POINTS}"
FOOD_SUBNATIONAL_RAW = (
    f"features ARRAY<STRUCT<properties: STRUCT<Name: STRING, fcsGraph: {SERIES_POINTS}>>>"
)
FOOD_REGISTRY_RAW = (
    "body STRUCT<features: ARRAY<STRUCT<properties: "
    "STRUCT<iso3: STRING, adm0_id: BIGINT, dataType: STRING>>>>"
)
FOOD_NATIONAL = (
    "date DATE, value DOUBLE, value_upper DOUBLE, value_lower DOUBLE, "
    "iso3_code STRING, country_name STRING, indicator_name STRING, source STRING"
)
FOOD_SUBNATIONAL = (
    "date DATE, value DOUBLE, value_upper DOUBLE, value_lower DOUBLE, "
    "region_name STRING, iso3_code STRING, country_name STRING, "
    "indicator_name STRING, source STRING"
)
FOOD_REGISTRY = (
    "iso3_code STRING, entity_code BIGINT, data_type STRING, country_name STRING"
)

# indicator databases
DATABASES = "id INT, name STRING, code STRING, last_updated DATE"


def parse(ddl: str) -> T.StructType:
    """The schema object behind a DDL string."""
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    """The column names of a DDL string, in order."""
    return parse(ddl).fieldNames()
