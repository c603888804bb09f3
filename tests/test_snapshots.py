from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from devdata_spark import DataFormattingError, DataValidationError, scratch, snapshots
from devdata_spark.sources import gated


def numbers(root):
    return sorted(p.name for p in (root / "log").iterdir() if p.name.endswith(".json") and p.name[0] != ".")


def test_snapshot_is_reused_until_it_is_too_old(spark, tmp_path):
    root, built = str(tmp_path / "s"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert snapshots.read(spark, root) is None
    assert snapshots.reuse(spark, root, build, now=1_000).count() == 1
    assert snapshots.reuse(spark, root, build, now=1_000 + snapshots.TTL_SECONDS).count() == 1
    assert snapshots.reuse(spark, root, build, now=1_001 + snapshots.TTL_SECONDS).count() == 2
    snapshots.clear(spark, root)
    assert snapshots.read(spark, root, now=1_000) is None
    assert list((tmp_path / "s" / "data").iterdir()) == []
    assert snapshots.reuse(spark, root, build, now=2_000).count() == 3


def test_interrupted_snapshot_is_not_read(spark, tmp_path):
    root = tmp_path / "s"
    snapshots.write(spark.range(1), str(root), now=1_000)
    spark.range(5).write.parquet(f"{root}/data/unfinished")  # no entry
    (root / "log" / "000000000002.json").write_text('{"folder": "unfin')  # not complete
    assert snapshots.read(spark, str(root), now=2_000).count() == 1
    assert snapshots.write(spark.range(3), str(root), now=2_000) == 3
    assert snapshots.read(spark, str(root), now=2_000).count() == 3


def test_writers_in_one_second_keep_their_own_data(spark, tmp_path):
    root = tmp_path / "s"
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda n: snapshots.write(spark.range(n), str(root), now=1_000), range(1, 5)))
    assert sorted(found) == [1, 2, 3, 4]
    assert numbers(root) == [f"{n:012}.json" for n in (1, 2, 3, 4)]
    rows = sorted(spark.read.parquet(str(f)).count() for f in (root / "data").iterdir())
    assert rows == [1, 2, 3, 4]
    newest = found.index(4) + 1  # the one that got the last number
    assert snapshots.read(spark, str(root), now=1_000).count() == newest


def test_expired_snapshots_are_removed(spark, tmp_path):
    root = tmp_path / "s"
    for at in (1_000, 2_000, 9_000):
        snapshots.write(spark.range(at), str(root), now=at)
    spark.range(5).write.parquet(f"{root}/data/unfinished")  # changed just now: stays
    snapshots.remove_expired(spark, str(root), ttl=7_500, now=9_000)
    assert numbers(root) == ["000000000002.json", "000000000003.json"]
    assert len(list((root / "data").iterdir())) == 3
    snapshots.remove_expired(spark, str(root), ttl=10, now=10**11)  # all are old, the newest stays
    assert numbers(root) == ["000000000003.json"]
    assert len(list((root / "data").iterdir())) == 1
    assert snapshots.read(spark, str(root), now=9_000).count() == 9_000


def test_kept_tables_can_be_released(spark):
    df = snapshots.keep(spark.range(10))
    assert df.storageLevel.useMemory and df.count() == 10
    assert not snapshots.release(df).storageLevel.useMemory


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark) == configured
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")

    class Unset:
        """A cluster session without the setting."""

        class sparkContext:
            master = "yarn"

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Unset)


# --- gated writes ------------------------------------------------------------


def jobs_of(spark, run):
    """How many jobs a call runs."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def test_a_table_is_written_and_checked_in_one_job(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    path, found = str(tmp_path / "t"), {}

    def run():
        found.update(
            gated.write_checked(
                df, path, required=["id"], schema="id BIGINT, v BIGINT", not_null=["id"],
                rules={"even": F.col("v") % 2 == 0},
            )
        )

    assert jobs_of(spark, run) == 1
    assert found == {"rows": 100, "NULL in id": 0, "even": 0}
    assert spark.read.parquet(path).count() == 100
    with pytest.raises(FileExistsError):
        gated.write_checked(df, path)
    assert gated.write_checked(df.limit(3), path, overwrite=True) == {"rows": 3}
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize(
    ("arguments", "error", "message"),
    [
        ({"not_null": ["v"]}, DataFormattingError, "'NULL in v': 2"),
        ({"rules": {"small": "id < 7"}}, DataFormattingError, "'small': 3"),
        ({"rules": {"known": "v >= 0"}}, DataFormattingError, "'known': 2"),
        ({"required": ["w"]}, DataValidationError, "Missing columns: \\['w'\\]"),
        ({"schema": "id STRING"}, DataValidationError, "expected string"),
    ],
)
def test_a_broken_rule_leaves_no_table(spark, tmp_path, arguments, error, message):
    df = spark.range(10).withColumn("v", F.when(F.col("id") > 1, F.col("id")))
    if "rules" in arguments:
        arguments = {"rules": {name: F.expr(rule) for name, rule in arguments["rules"].items()}}
    with pytest.raises(error, match=message):
        gated.write_checked(df, str(tmp_path / "t"), **arguments)
    assert list(tmp_path.iterdir()) == []


def test_an_empty_table_is_not_written_and_an_old_one_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    gated.write_checked(spark.range(4), path)
    with pytest.raises(DataValidationError, match="empty"):
        gated.write_checked(spark.range(0), path, overwrite=True)
    assert spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
