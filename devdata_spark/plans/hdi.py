"""Human development indices: one wide CSV file and a sheet that describes it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas
from devdata_spark.operators import columns, filters, joins, reshape
from devdata_spark.sources import files

# Publisher columns and their harmonised names, file encoding.
DATA_COLUMNS = {
    "iso3": fields.ENTITY_CODE,
    "country": fields.ENTITY_NAME,
    "region": fields.REGION_CODE,
    "hdicode": "hdi_group",
}
METADATA_COLUMNS = {
    "Full name": fields.INDICATOR_NAME,
    "Short name": fields.INDICATOR_CODE,
    "Time series": fields.TIME_RANGE,
    "Note": fields.NOTES,
}
ENCODING = "ISO-8859-1"
REQUIRED = [
    fields.INDICATOR_CODE,
    fields.INDICATOR_NAME,
    fields.YEAR,
    fields.VALUE,
    fields.ENTITY_CODE,
    fields.ENTITY_NAME,
]


def data(
    spark: SparkSession, path: str, metadata_path: str, *, encoding: str = ENCODING
) -> DataFrame:
    """One row per country, index and year."""
    # the many value columns are cleaned once they are one column
    raw = files.read_csv(spark, path, encoding=encoding, markers=list(DATA_COLUMNS))
    df = shape(raw, _described(spark, metadata_path), files.ROW)
    return quality.validate(df, REQUIRED, schema=schemas.HDI_DATA)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Index names, codes, time ranges and notes."""
    df = _described(spark, path).drop(files.FILE, files.ROW)
    return quality.validate(df, [fields.INDICATOR_NAME, fields.INDICATOR_CODE])


def shape(raw: DataFrame, described: DataFrame, order: str) -> DataFrame:
    """Wide to long, code and year split, index names added.

    Where `described` repeats a code its last row by `order` gives the name.
    """
    named = columns.rename(raw, DATA_COLUMNS)
    long = reshape.split_code_year(reshape.to_long(named, list(DATA_COLUMNS.values())))
    labelled = joins.map_codes(
        long, described, fields.INDICATOR_CODE, fields.INDICATOR_NAME, order
    )
    return columns.require(labelled, schemas.names(schemas.HDI_DATA))


def shape_metadata(raw: DataFrame) -> DataFrame:
    """Harmonised names; rows without a time range are remarks and are dropped."""
    kept = filters.drop_missing(raw, "Time series")
    return columns.rename(kept, METADATA_COLUMNS).withColumn(
        fields.TIME_RANGE, F.col(fields.TIME_RANGE).cast("string")
    )


def _described(spark: SparkSession, path: str) -> DataFrame:
    return shape_metadata(files.read_csv(spark, path, multi_line=True, row_order=True))
