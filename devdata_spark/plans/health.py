"""Health expenditure: the three sheets of one workbook, landed as CSV folders.

    <root>/data/  <root>/codebook/  <root>/metadata/
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas
from devdata_spark.errors import DataExtractionError
from devdata_spark.operators import columns, filters, joins, reshape
from devdata_spark.sources import files

# Publisher columns and their harmonised names, the empty mark.
ID_COLUMNS = ["location", "code", "year"]
DROPPED_COLUMNS = ["region", "income"]
DATA_COLUMNS = {"location": fields.COUNTRY_NAME, "code": fields.ISO3_CODE}
CODEBOOK_COLUMNS = {
    "variable code": fields.INDICATOR_CODE,
    "variable name": fields.INDICATOR_NAME,
    "long code (GHED data explorer)": "indicator_long_code",
    "category 1": "category_1",
    "category 2": "category_2",
    "Method of measurement (INDICATORS category1)": "measurement_method",
}
METADATA_COLUMNS = {
    "location": fields.COUNTRY_NAME,
    "code": fields.ISO3_CODE,
    "variable name": fields.INDICATOR_NAME,
    "variable code": fields.INDICATOR_CODE,
    "Sources": "sources",
    "Comments": "comments",
    "Data type": "data_type",
    "Methods of estimation": "methods_of_estimation",
    "Countries and territories footnote": "country_footnote",
}
EMPTY_MARK = "-"
SHEETS = ["data", "codebook", "metadata"]
LABELS = [fields.INDICATOR_CODE, fields.INDICATOR_NAME, fields.UNIT, fields.CURRENCY]


def data(spark: SparkSession, root: str) -> DataFrame:
    """One row per country, year and indicator, with indicator names and units."""
    df = shape_data(_sheet(spark, root, "data"), indicators(spark, root))
    required = [c for c in schemas.names(schemas.HEALTH_DATA) if c not in LABELS[2:]]
    return quality.validate(df, required, schema=schemas.HEALTH_DATA)


def indicators(spark: SparkSession, root: str) -> DataFrame:
    """The indicators and what they measure."""
    return shape_codebook(_sheet(spark, root, "codebook"))


def metadata(spark: SparkSession, root: str) -> DataFrame:
    """Sources, methods and footnotes of each country and indicator."""
    return shape_metadata(_sheet(spark, root, "metadata"))


def export(
    spark: SparkSession,
    root: str,
    directory: str,
    file_name: str = "ghed",
    *,
    overwrite: bool = False,
) -> None:
    """Write the raw sheets as tables to `<directory>/<file_name>/<sheet>`."""
    try:
        files.list_files(spark, directory)
    except DataExtractionError as e:
        raise FileNotFoundError(f"The directory {directory} does not exist.") from e
    for sheet in SHEETS:
        target = f"{directory}/{file_name}/{sheet}"
        files.write_table(
            _sheet(spark, root, sheet), target, format="csv", overwrite=overwrite,
            header=True, escape='"',
        )


def shape_data(raw: DataFrame, codebook: DataFrame) -> DataFrame:
    """Wide to long, then labels; a code that the codebook repeats repeats the row."""
    columns.require(raw, [*ID_COLUMNS, *DROPPED_COLUMNS])
    long = reshape.to_long(raw.drop(*DROPPED_COLUMNS), ID_COLUMNS)
    named = columns.rename(long, DATA_COLUMNS).withColumn(
        fields.YEAR, F.col(fields.YEAR).cast("int")
    )
    labels = columns.require(codebook, LABELS)
    labelled = joins.attach(named, labels, [fields.INDICATOR_CODE], validate=False)
    return columns.require(labelled, schemas.names(schemas.HEALTH_DATA))


def shape_codebook(raw: DataFrame) -> DataFrame:
    """Harmonised names, empty marks as NULL, headings without a long code dropped."""
    columns.require(raw, list(CODEBOOK_COLUMNS))
    df = columns.marker_to_null(columns.rename(raw, CODEBOOK_COLUMNS), EMPTY_MARK)
    return filters.drop_missing(df, "indicator_long_code")


def shape_metadata(raw: DataFrame) -> DataFrame:
    """Exactly the described columns, harmonised."""
    return columns.require_renamed(raw, METADATA_COLUMNS)


def _sheet(spark: SparkSession, root: str, sheet: str) -> DataFrame:
    # the many value columns of the data sheet are cleaned once they are one column
    wide = sheet == "data"
    markers = [*ID_COLUMNS, *DROPPED_COLUMNS] if wide else True
    return files.read_csv(spark, f"{root}/{sheet}", multi_line=not wide, markers=markers)
