"""Keeping results: in the session, or as dated snapshots on shared storage.

A snapshot root has a folder for each write, under a name of its own, and a log of numbered
entries. An entry is made after its data is complete, under the next free number and only
if that number is still free, so writers never touch each other's data, and readers take
the newest complete entry. Entries name their data and their time in epoch seconds.
"""

import json
import time
import uuid
from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark.operators import latest

# Fixed value: a kept result is reused for 48 hours.
TTL_SECONDS = 48 * 60 * 60

_DIGITS = 12


def keep(df: DataFrame) -> DataFrame:
    """Keep a table for reuse in this session; lost blocks are computed again."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(df: DataFrame) -> DataFrame:
    """Drop a table kept with `keep`."""
    return df.unpersist()


def write(df: DataFrame, root: str, now: int | None = None) -> int:
    """Write a snapshot, dated now, and return its number in the log.

    A write that was cut short has no entry and is never read.
    """
    folder = uuid.uuid4().hex
    df.write.parquet(f"{root}/data/{folder}")
    at = int(time.time()) if now is None else now
    return _Log(df.sparkSession, root).append({"folder": folder, "at": at})


def read(
    spark: SparkSession, root: str, *, ttl: int = TTL_SECONDS, now: int | None = None
) -> DataFrame | None:
    """The newest snapshot if it is younger than `ttl` seconds, else None."""
    oldest = (int(time.time()) if now is None else now) - ttl
    newest = next(_Log(spark, root).entries(), None)
    if newest is None or newest["folder"] is None or newest["at"] < oldest:
        return None
    return spark.read.parquet(f"{root}/data/{newest['folder']}")


def reuse(
    spark: SparkSession,
    root: str,
    build: Callable[[], DataFrame],
    *,
    ttl: int = TTL_SECONDS,
    now: int | None = None,
) -> DataFrame:
    """The newest fresh snapshot; without one, build the table and write it first.

    Of several writers that find none each writes its own, and the last entry counts.
    """
    kept = read(spark, root, ttl=ttl, now=now)
    if kept is None:
        write(build(), root, now)
        kept = read(spark, root, ttl=ttl, now=now)
    return kept


def clear(spark: SparkSession, root: str, now: int | None = None) -> None:
    """Forget all snapshots and delete their data.

    An entry without data comes first, so that no reader takes a snapshot that is about to
    go; a write that is complete after it counts again.
    """
    at = int(time.time()) if now is None else now
    log = _Log(spark, root)
    _remove(log, log.append({"folder": None, "at": at}))


def remove_expired(
    spark: SparkSession, root: str, *, ttl: int = TTL_SECONDS, now: int | None = None
) -> None:
    """Delete snapshots older than `ttl` seconds, but for the newest one of all.

    Data without an entry, of writes that were cut short, goes as well once it is that old.
    """
    oldest = (int(time.time()) if now is None else now) - ttl
    log = _Log(spark, root)
    entries = list(log.entries())
    for entry in entries[1:]:
        if entry["at"] < oldest:
            log.delete(entry)
    known = {entry["folder"] for entry in entries}
    for name, modified in log.folders():
        if name not in known and modified < oldest:
            log.delete_folder(name)


def fresh_rows(df: DataFrame, keys: list[str], at: str, *, ttl: int = TTL_SECONDS) -> DataFrame:
    """Of a table of dated rows, the newest row per key within `ttl` of the newest.

    The newest time is looked up first, so that the age limit reaches the scan.
    """
    newest = df.agg(F.max(at)).first()[0]
    limit = F.lit(newest) - F.expr(f"INTERVAL {int(ttl)} SECOND")
    return latest.newest_per_key(df.where(F.col(at) >= limit), keys, [at])


def _remove(log: "_Log", before: int) -> None:
    for entry in list(log.entries()):
        if entry["number"] < before:
            log.delete(entry)


class _Log:
    """The numbered entries of a root, through Hadoop's file systems, from the driver.

    Expired entries are deleted, so the log has as many as there are snapshots.
    """

    def __init__(self, spark: SparkSession, root: str):
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path, self._utils = hadoop.Path, spark._jvm.org.apache.commons.io.IOUtils
        self._log, self._data = self._path(f"{root}/log"), self._path(f"{root}/data")
        self._files = self._log.getFileSystem(spark._jsc.hadoopConfiguration())

    def append(self, entry: dict) -> int:
        """Make the entry of the next free number; another writer's entry stays."""
        text = json.dumps(entry | {"writer": uuid.uuid4().hex})
        self._files.mkdirs(self._log)
        number = max(self._numbers(), default=0)
        while True:
            number += 1
            path = self._of(number)
            try:
                out = self._files.create(path, False)
            except Py4JJavaError as e:
                if "AlreadyExists" in e.java_exception.getClass().getName():
                    continue
                raise
            try:
                out.write(bytearray(text.encode()))
            finally:
                out.close()
            # a store that does not refuse a second entry keeps one of the two
            if self._text(path) == text:
                return number

    def entries(self) -> Iterator[dict]:
        """Complete entries, the newest first."""
        for number in sorted(self._numbers(), reverse=True):
            try:
                entry = json.loads(self._text(self._of(number)))
            except (ValueError, Py4JJavaError):
                continue  # not complete yet, or deleted meanwhile
            yield entry | {"number": number}

    def folders(self) -> Iterator[tuple[str, float]]:
        """Data folders and the time in seconds at which they were last changed."""
        if self._files.exists(self._data):
            for status in self._files.listStatus(self._data):
                yield status.getPath().getName(), status.getModificationTime() / 1000

    def delete(self, entry: dict) -> None:
        self._files.delete(self._of(entry["number"]), False)
        if entry["folder"] is not None:
            self.delete_folder(entry["folder"])

    def delete_folder(self, name: str) -> None:
        self._files.delete(self._path(self._data, name), True)

    def _of(self, number: int):
        return self._path(self._log, f"{number:0{_DIGITS}}.json")

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._log):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._log)]
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _text(self, path) -> str:
        stream = self._files.open(path)
        try:
            return self._utils.toString(stream, "UTF-8")
        finally:
            stream.close()
