"""Members of zip archives, through the data source of `zipped`.

Only the end of an archive is read to know its members, and only the byte ranges of
members that are asked for. Paths are opened by Arrow: local and shared folders, S3, GCS,
Azure and HDFS.
"""

import json
import weakref
from collections.abc import Sequence

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark.errors import DataExtractionError
from devdata_spark.sources import files, zipped

ARCHIVE, MEMBER = "archive", "member"

# Executors get the code of the data source with the job and need no package.
register_pickle_by_value(zipped)
_known: weakref.WeakSet = weakref.WeakSet()


def members(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.zip") -> DataFrame:
    """`archive`, `member`, `packed_size`, `size`; an archive without members has a NULL one."""
    return _load(spark, path, "list", pattern=pattern)


def require_one_member(
    spark: SparkSession, path: str | Sequence[str], pattern: str = "*.zip"
) -> None:
    """Raise unless every archive has exactly one member."""
    counts = members(spark, path, pattern).groupBy(ARCHIVE).agg(F.count(MEMBER).alias("members"))
    wrong = counts.where("members <> 1").first()
    if wrong is not None:
        found = "Multiple files" if wrong.members else "No files"
        raise DataExtractionError(f"{found} found in the zipfile {wrong.archive}")


def csv_rows(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    *,
    prefix: str = "",
    suffix: str = "",
    encoding: str = "utf8",
    optional: Sequence[str] = (),
) -> DataFrame:
    """The rows of CSV members: `archive`, `member`, then `columns` as text.

    Members are those whose name starts and ends as given. One whose header lacks a column
    stops the job, as a landed CSV file with a wrong header does; only `optional` ones are
    NULL where they are absent. Other columns of a member are skipped.
    """
    wanted = {"columns": json.dumps(list(columns)), "optional": json.dumps(list(optional))}
    return _load(spark, path, "csv", prefix=prefix, suffix=suffix, encoding=encoding, **wanted)


def member_text(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    prefix: str = "",
    suffix: str = "",
    encoding: str = "utf-8",
) -> DataFrame:
    """Whole text members, such as a readme: `archive`, `member`, `text`."""
    return _load(spark, path, "text", prefix=prefix, suffix=suffix, encoding=encoding)


def _load(spark: SparkSession, path: str | Sequence[str], kind: str, **options) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    files.require_files(spark, paths, options.get("pattern", "*.zip"))
    if spark not in _known:
        spark.dataSource.register(zipped.ZipMembers)
        _known.add(spark)
    reader = spark.read.format("zip_members").options(paths=json.dumps(paths), **options)
    return reader.option("as", kind).load()
