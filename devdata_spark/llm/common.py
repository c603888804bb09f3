"""What several corpus operators share: native match positions, clean inputs, checkpoints."""

import ctypes
import gc
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application.

    Functions of operators are then found there by name, so a Python worker keeps what it
    has compiled or remembered from one task to the next.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "devdata_spark_source.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names.

    Only a local session without that setting gets a temporary one; a cluster session
    stops, since a folder of one machine would not do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="shared-")
    return _local_folders[application]


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows kept in the shared folder, with their lineage cut."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


# Rows of a few numbers that one task can well take: some 10 MB.
NARROW_ROWS = 100_000


def gathered(df: DataFrame) -> DataFrame:
    """Checkpointed rows of a few numbers, in no more partitions than their count needs.

    What later shuffles them then writes a file for each of these, not for each of the
    many that a large shuffle left.
    """
    kept = checkpointed(df)
    partitions = kept._jdf.rdd().getNumPartitions()
    needed = 8 + kept.count() // NARROW_ROWS if partitions > 16 else partitions
    return kept.coalesce(needed) if needed < partitions else kept


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: smaller than a checkpoint."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Spark's setting by which an execution deletes its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """As `written`; `release` deletes the table when another has taken its place.

    The shuffle files of the write go as soon as it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table_ = spark.read.schema(df.schema).parquet(path)
    table_.kept_at = path
    return table_


def release(*tables: DataFrame) -> None:
    """Delete kept tables that nothing reads any more."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.kept_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more.

    Spark does so when the driver collects its garbage, which may be long after.
    """
    gc.collect()
    spark._jvm.System.gc()


def join_kept(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """As `join_small`, with a table that is kept already."""
    if small.count() <= SENT_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


_memos: dict[str, Callable[[], bool]] = {}


def memo(owner: str, forget: Callable[[], bool]) -> None:
    """Name what a module remembers in a Python worker from task to task.

    `forget` empties it and tells whether there was something.
    """
    _memos[owner] = forget


def claim(owner: str) -> None:
    """Called in tasks: what functions of other owners remember in this worker goes."""
    if any([forget() for other, forget in _memos.items() if other != owner]):
        gc.collect()
        trim()


def trim() -> None:
    """Give memory that a worker has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def match_spans(text: Column, pattern: Column | str, measure=F.length) -> Column:
    """Places of all leftmost, non-overlapping matches: array<struct<start,end,found>>.

    Offsets are sums of `measure` over what precedes: code points by default. Spark has
    no function for positions, so they come from the pieces between the matches.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    zero = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,found:string>>").alias("spans"),
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + measure(pair["piece"])
        end = start + measure(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(
            end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")
        )

    pairs = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)),
        found,
        lambda piece, match: F.struct(piece.alias("piece"), match.alias("found")),
    )
    return F.aggregate(pairs, zero, step)["spans"]


# Up to so many rows of a few numbers (16 MB) are sent to every task.
SENT_ROWS = 500_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a table with one that is likely small: counted first, then sent or shuffled.

    `small` is checkpointed, so it is made once, and, beyond `SENT_ROWS`, both sides are
    shuffled for the join alone, which lets Spark split skewed partitions.
    """
    small = gathered(small)
    if small.count() <= SENT_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)
