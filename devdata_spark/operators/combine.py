"""Stacking tables, and tables of a few given values."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name, absent ones NULL."""
    if not tables:
        raise ValueError("No tables to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def of_values(spark: SparkSession, values: Sequence[str], name: str) -> DataFrame:
    """A one-column text table of a caller's list, made without Python workers."""
    listed = F.array(*[F.lit(v) for v in values]).cast("array<string>")
    return spark.range(0, 1, 1, 1).select(F.explode(listed).alias(name))
