"""CSV and JSON files, file names, and writing tables."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from devdata_spark import schemas, scratch
from devdata_spark.errors import DataExtractionError
from devdata_spark.functions import text
from devdata_spark.operators import columns, joins

# Added by `row_order=True`: the file of a row, and its number in that file.
FILE, ROW = "_file", "_row"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | None = None,
    *,
    partitions: str | None = None,
    pattern: str | None = None,
    header: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    row_order: bool = False,
    markers: bool | Sequence[str] = True,
) -> DataFrame:
    """CSV files, every cell as text.

    Missing markers become NULL in all columns, in the given ones, or in none.

    `schema` is the DDL of the expected text columns, `partitions` that of the
    columns that folder names give. A file whose header differs from the schema
    fails the job; without it the first header gives the names. `pattern` is a
    glob on file names.
    """
    require_files(spark, path, pattern)
    reader = _options(spark.read, pattern).options(
        header=header, encoding=encoding, multiLine=multi_line,
        quote='"', escape='"', enforceSchema=not header,
    )
    if schema:
        reader = reader.schema(f"{schema}, {partitions}" if partitions else schema)
    df = _load(reader.format("csv"), path)
    if row_order:
        df = with_row_order(df)
    cells = markers
    if isinstance(markers, bool):
        added = schemas.names(partitions) if partitions else []
        cells = [n for n in df.columns if markers and n not in [*added, FILE, ROW]]
    return columns.clean(df, **{n: text.missing_to_null for n in cells})


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str,
    *,
    pattern: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """JSON records with a declared schema, one per line or one document per file."""
    require_files(spark, path, pattern)
    reader = _options(spark.read, pattern).schema(schema).option("multiLine", multi_line)
    # a reply that is not JSON must stop the job, not turn into NULLs
    return _load(reader.option("mode", "FAILFAST").format("json"), path)


def read_lines(
    spark: SparkSession, path: str | Sequence[str], *, pattern: str | None = None
) -> DataFrame:
    """The lines of text files as a column `value`."""
    require_files(spark, path, pattern)
    return _load(_options(spark.read, pattern).format("text"), path)


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], *, pattern: str | None = None
) -> DataFrame:
    """Parquet files, schema from the files."""
    require_files(spark, path, pattern)
    return _load(_options(spark.read, pattern).format("parquet"), path)


def with_row_order(df: DataFrame) -> DataFrame:
    """Add the file of each row and its number in that file, from 0, after a file read.

    A scan numbers the rows of each split; the table is written with that number once, so
    both the counts and the rows come from one reading. Rows are then counted per split,
    and the sum of the splits before it (a table of one row for each split) is added. The
    numbers do not depend on how a scan is cut into splits or dealt out.
    """
    scanned = df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_number"),
    )
    kept = scratch.materialise(scanned, "rows")
    splits = kept.groupBy(FILE, "_block").agg(
        F.min("_number").alias("_first"), F.count("*").alias("_rows")
    )
    before = Window.partitionBy(FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        FILE, "_block",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    numbered = joins.attach(kept, offsets, [FILE, "_block"], validate=False)
    return numbered.withColumn(ROW, F.col("_number") + F.col("_offset")).drop(
        "_block", "_number", "_offset"
    )


def list_files(
    spark: SparkSession, path: str | Sequence[str], pattern: str | None = None
) -> DataFrame:
    """`path`, `name` and `length` of the files, without reading them."""
    listing = _load(_options(spark.read, pattern).format("binaryFile"), path)
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def names_between(files: DataFrame, prefix: str, suffix: str = "") -> DataFrame:
    """Files whose `name` starts with `prefix` and ends with `suffix`."""
    name = F.col("name")
    return files.where(name.startswith(prefix) & name.endswith(suffix))


def require_files(
    spark: SparkSession, path: str | Sequence[str], pattern: str | None = None
) -> None:
    """Raise unless the path exists and has a file that fits the pattern."""
    if list_files(spark, path, pattern).isEmpty():
        which = f" ({pattern})" if pattern else ""
        raise DataExtractionError(f"No files found at {path}{which}")


def write_table(
    df: DataFrame,
    path: str,
    *,
    format: str = "parquet",
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Write a table; an existing one is only replaced with `overwrite`.

    Before a partitioned write rows are gathered by partition, so that a task
    does not leave a small file in every folder; adaptive execution splits a
    partition that is too large for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(format).mode("overwrite" if overwrite else "errorifexists")
    try:
        writer.options(**options).partitionBy(*partition_by).save(path)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" in str(e):
            raise FileExistsError(
                f"{path} already exists. Set overwrite=True to replace it."
            ) from e
        raise


def _options(reader: DataFrameReader, pattern: str | None) -> DataFrameReader:
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _load(reader: DataFrameReader, path: str | Sequence[str]) -> DataFrame:
    try:
        return reader.load(path if isinstance(path, str) else list(path))
    except AnalysisException as e:
        raise DataExtractionError(f"Cannot read {path}: {e}") from e
