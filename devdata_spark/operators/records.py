"""JSON records whose fields nobody declared, as tidy columns.

A record is parsed once into the VARIANT type. One aggregate merges the schemas of
all records, so fields that a publisher adds, nests or widens become columns by
themselves, and no record is read by the schema of another.

* A field that is a whole number here and a fraction there gets the wider number.
* A field of kinds that do not fit together (text and number, say) becomes text.
* A field that is always null, or always an empty object, is text too.
* NULL and blank texts are no records and are left out.
* A text that is not JSON, or not an object, is an error, as are two fields whose
  columns would have the same name.
"""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devdata_spark.errors import DataFormattingError
from devdata_spark.operators import columns

# Beyond this, keys are data (dates, codes) and belong in rows: see `field_report`.
MAX_FIELDS = 2_000

_QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<>|OBJECT<|VARIANT|VOID")
_AS_DECLARED = {"OBJECT<": "STRUCT<", "OBJECT<>": "STRING", "VARIANT": "STRING", "VOID": "STRING"}


def parse(df: DataFrame, text: str, into: str = "record") -> DataFrame:
    """Replace a column of JSON texts by a VARIANT column; NULL where it is no object."""
    present = df.where(F.col(text).rlike(r"\S"))
    is_object = F.col(text).rlike(r"^\s*\{")
    parsed = present.withColumn("_record", F.when(is_object, F.try_parse_json(F.col(text))))
    return parsed.drop(text).withColumnRenamed("_record", into)


def merged_schema(df: DataFrame, column: str = "record") -> T.StructType:
    """The fields that any record has, from one pass over the table."""
    found = df.agg(
        F.schema_of_variant_agg(F.col(column)).alias("schema"),
        F.count_if(F.col(column).isNull()).alias("n_others"),
    ).first()
    if found.n_others or not found.schema.startswith(("OBJECT<", "VOID")):
        raise DataFormattingError(f"Records are not JSON objects ({found.n_others} no records)")
    declared = declared_type(found.schema)
    if declared == "STRING":
        return T.StructType()
    schema = T.DataType.fromDDL(declared)
    names = [name.lower() for name in _leaf_names(schema)]
    if len(names) > MAX_FIELDS:
        raise DataFormattingError(f"Records have {len(names)} fields, over {MAX_FIELDS}")
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise DataFormattingError(f"Records name columns twice: {twice}")
    return schema


def declared_type(variant_schema: str) -> str:
    """The type of a column that holds all values of a merged VARIANT schema, as DDL."""
    return _QUOTED_OR_OBJECT.sub(lambda m: _AS_DECLARED.get(m[0], m[0]), variant_schema)


def widen(df: DataFrame, column: str = "record", schema: T.StructType | None = None) -> DataFrame:
    """Replace a VARIANT column by its fields, nested ones by their paths.

    `schema` is that of `merged_schema`, found here if it is not given. Other columns
    are kept in front; one that has the name of a field is an error.
    """
    schema = merged_schema(df, column) if schema is None else schema
    kept = [c for c in df.columns if c != column]
    clashes = sorted({c.lower() for c in kept} & {n.lower() for n in _leaf_names(schema)})
    if clashes:
        raise DataFormattingError(f"Records name columns of the table: {clashes}")
    if not schema.fields:
        return df.select(*kept)
    typed = df.withColumn(column, F.col(column).cast(schema))
    return typed.select(*kept, *columns.leaves(schema, column))


def field_report(df: DataFrame, column: str = "record") -> DataFrame:
    """Each field of the records: `field`, its merged `type`, `n_records`, `n_values`.

    Fields are rows here, so there may be any number of them.
    """
    return df.sparkSession.sql(
        f"""
        SELECT key AS field, schema_of_variant_agg(value) AS type,
          count(*) AS n_records, count_if(NOT is_variant_null(value)) AS n_values
        FROM {{df}}, LATERAL variant_explode(`{column}`)
        WHERE key IS NOT NULL
        GROUP BY key
        """,
        df=df,
    )


def _leaf_names(schema: T.StructType, path: str = "") -> list[str]:
    names = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            names += _leaf_names(field.dataType, f"{path}{field.name}_")
        else:
            names.append(path + field.name)
    return names
