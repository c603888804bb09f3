"""HIV statistics: four datasets, each one CSV file or a zip archive of one.

    <root>/dataset=Estimates/ ...
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas
from devdata_spark.functions import text
from devdata_spark.operators import columns, filters
from devdata_spark.sources import archives, files

# Dataset names, publisher columns and their harmonised names.
DATASETS = ["Estimates", "Laws and Policies", "Key Populations", "GAM"]
COLUMNS = {
    "Indicator": fields.INDICATOR_NAME,
    "Unit": fields.UNIT,
    "Subgroup": "subgroup",
    "Area": fields.ENTITY_NAME,
    "Area ID": fields.ENTITY_CODE,
    "Time Period": fields.YEAR,
    "Source": fields.SOURCE,
    "Data value": fields.VALUE,
    "Formatted": "value_formatted",
    "Footnote": fields.FOOTNOTE,
}
REQUIRED = [
    fields.YEAR,
    fields.ENTITY_CODE,
    fields.ENTITY_NAME,
    fields.INDICATOR_NAME,
    fields.VALUE,
]


def data(spark: SparkSession, root: str, dataset: str = "Estimates") -> DataFrame:
    """One dataset. `value` is text, as laws are answers; see `value_numeric`."""
    filters.check_choice(dataset, DATASETS, "dataset")
    folder = f"{root}/dataset={dataset}"
    if files.list_files(spark, folder, "*.zip").isEmpty():
        raw = files.read_csv(spark, folder)
    else:
        archives.require_one_member(spark, folder)
        cells = list(COLUMNS)
        extra = [c for c, name in COLUMNS.items() if name not in REQUIRED]
        rows = archives.csv_rows(spark, folder, cells, optional=extra)
        raw = columns.clean(rows.select(*cells), **{c: text.missing_to_null for c in cells})
    quality.check_columns(columns.rename(raw, COLUMNS), REQUIRED)
    return quality.validate(shape(raw), REQUIRED, schema=schemas.HIV_DATA)


def shape(raw: DataFrame) -> DataFrame:
    """Harmonised names, an integer year, and the value as a number where it is one."""
    df = columns.rename(raw, COLUMNS)
    return df.withColumns(
        {
            fields.YEAR: text.to_integer(F.col(fields.YEAR).cast("string")),
            fields.VALUE: F.col(fields.VALUE).cast("string"),
            "value_numeric": text.to_double(F.col(fields.VALUE).cast("string")),
        }
    )
