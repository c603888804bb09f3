"""Compare Spark results with DuckDB results: rows, columns, types and values."""

import datetime
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KINDS = {
    T.ByteType: "integer", T.ShortType: "integer", T.IntegerType: "integer",
    T.LongType: "integer", T.DoubleType: "float", T.FloatType: "float",
    T.StringType: "text", T.BooleanType: "boolean", T.DateType: "date",
    T.TimestampType: "timestamp", T.TimestampNTZType: "timestamp", T.DecimalType: "decimal",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _duck_kind(name: str) -> str:
    name = str(name)
    if name.startswith("DECIMAL"):
        return "decimal"
    if name.startswith("TIMESTAMP"):
        return "timestamp"
    if "INT" in name:
        return "integer"
    return {"DOUBLE": "float", "FLOAT": "float", "VARCHAR": "text", "BOOLEAN": "boolean",
            "DATE": "date"}.get(name, name)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """What differs between a Spark result and a DuckDB result; empty when equal."""
    names = sorted(df.columns)
    relation = connection.sql(sql)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    kinds = {f.name: KINDS.get(type(f.dataType), str(f.dataType)) for f in df.schema.fields}
    expected_kinds = dict(zip(relation.columns, map(_duck_kind, relation.types)))
    found = [
        f"type of {c}: {kinds[c]} != {expected_kinds[c]}"
        for c in names
        if kinds[c] != expected_kinds[c]
    ]
    spark_rows = Counter(tuple(_plain(row[c]) for c in names) for row in df.collect())
    order = [relation.columns.index(c) for c in names]
    duck_rows = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    if spark_rows.total() != duck_rows.total():
        found.append(f"rows {spark_rows.total()} != {duck_rows.total()}")
    if spark_rows != duck_rows:
        found.append(f"only Spark: {list((spark_rows - duck_rows).items())[:3]}")
        found.append(f"only DuckDB: {list((duck_rows - spark_rows).items())[:3]}")
    return found
