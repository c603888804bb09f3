"""Debt sustainability assessments of low-income countries.

Landed as CSV files of the publisher's table, eight columns, without a header of
their own: the table's first row holds the column titles.
"""

from pyspark.sql import DataFrame, SparkSession

from devdata_spark import fields, quality, schemas
from devdata_spark.functions import text
from devdata_spark.operators import columns, date_forms, filters
from devdata_spark.sources import files

# Positions of the kept columns, and their harmonised names.
POSITIONS = {
    1: fields.COUNTRY_NAME,
    2: "latest_publication",
    3: "risk_of_debt_distress",
    5: "debt_sustainability_assessment",
    6: "joint_with_world_bank",
    7: "latest_dsa_discussed",
}
DATE_POSITIONS = [2, 7]


def assessments(spark: SparkSession, path: str) -> DataFrame:
    """The list of assessments, one row per country."""
    raw = files.read_csv(
        spark, path, schemas.DEBT_RAW, header=False, multi_line=True, row_order=True, markers=False
    )
    return quality.validate(
        shape(raw, files.ROW, files.FILE),
        list(POSITIONS.values()),
        schema=schemas.DEBT_ASSESSMENTS,
        not_null=[fields.COUNTRY_NAME],
    )


def shape(raw: DataFrame, order: str, by: str) -> DataFrame:
    """Drop blank rows and the titles, name the columns, clean the cells."""
    first = raw.columns[0]
    body = filters.drop_first_row(filters.drop_missing(raw, first, blank=True), order, by)
    # a join may put its key first: back to the positions of the raw table
    rows = body.select(*raw.columns)
    dated = date_forms.parse(rows, [raw.columns[i] for i in DATE_POSITIONS], [by])
    return clean(columns.by_position(dated, POSITIONS))


def clean(df: DataFrame) -> DataFrame:
    """Footnote markers, labels and the yes/no column."""
    return columns.clean(
        df,
        country_name=text.strip_footnote,
        risk_of_debt_distress=text.label,
        debt_sustainability_assessment=text.label,
        joint_with_world_bank=text.is_yes,
    )
