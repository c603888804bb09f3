"""Writing a table only if it keeps its quality rules, in one pass over it.

The rules are counted as metrics of the write itself. The rows go to a folder beside the
table; when they are complete the metrics are judged, and only a table that passes takes
its place by a rename. A broken rule leaves nothing.
"""

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from devdata_spark import quality
from devdata_spark.errors import DataFormattingError, DataValidationError
from devdata_spark.sources import files


def write_checked(
    df: DataFrame,
    path: str,
    *,
    required: Sequence[str] = (),
    schema: str | None = None,
    not_null: Sequence[str] = (),
    rules: Mapping[str, Column] | None = None,
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write a Parquet table and return its counts: `rows`, and broken cells by rule.

    Columns and types are checked before anything runs. The table may not be empty, the
    columns `not_null` may hold no NULL, and each of `rules` must be true on every row
    (NULL is not true). All broken rules are named in the error.
    """
    quality.check_columns(df, [*required, *not_null])
    if schema:
        quality.check_types(df, schema)
    broken = {f"NULL in {c}": F.col(f"`{c}`").isNull() for c in not_null}
    broken |= {name: ~F.coalesce(rule, F.lit(False)) for name, rule in (rules or {}).items()}
    counts = [F.count_if(condition).alias(f"broken_{i}") for i, condition in enumerate(broken.values())]
    observation = Observation()
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)

    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not overwrite and store.exists(target):
        raise FileExistsError(f"{path} already exists. Set overwrite=True to replace it.")
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    staged = hadoop.Path(beside)
    try:
        files.write_table(observed, beside, partition_by=partition_by)
        found = observation.get
        judge(found["rows"], {name: found[f"broken_{i}"] for i, name in enumerate(broken)})
        if overwrite:
            store.delete(target, True)
        if not store.rename(staged, target):
            raise FileExistsError(f"{path} appeared while it was written")
    finally:
        store.delete(staged, True)
    return {"rows": found["rows"]} | {name: 0 for name in broken}


def judge(rows: int, broken: Mapping[str, int]) -> None:
    """Raise for an empty table, and for rules that rows break."""
    if not rows:
        raise DataValidationError("The table is not valid: DataFrame is empty.")
    wrong = {name: n for name, n in broken.items() if n}
    if wrong:
        raise DataFormattingError(f"Rules broken, with the number of rows: {wrong}")
