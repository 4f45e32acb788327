"""Published tables: a failed write leaves the last version readable."""

import pytest
from pyspark.sql import functions as F

from cohortlens.sources import versions
from cohortlens.sources.versions import current, expire, fingerprint, log, publish, read_published, read_version


def rows(spark, n):
    return spark.range(n).withColumn("person_id", F.col("id") % 7)


def test_a_failed_write_leaves_the_last_version(spark, scratch):
    path = f"{scratch}/table"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    first = publish(rows(spark, 10), path, recipe="a")
    held = read_published(spark, path)
    broken = rows(spark, 1000).withColumn("id", F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert current(spark, path) == first and read_published(spark, path).count() == 10
    second = publish(rows(spark, 20), path, recipe="b")
    assert (second.number, second.recipe) == (2, "b") and read_published(spark, path).count() == 20
    assert held.count() == 10  # a reader of the first version isn't disturbed
    assert log(spark, path) == [first, second]


def test_a_driver_lost_before_the_line_changes_nothing(spark, scratch, monkeypatch):
    path = f"{scratch}/table"
    publish(rows(spark, 5), path)
    monkeypatch.setattr(versions, "asdict", lambda v: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish(rows(spark, 6), path)
    monkeypatch.undo()
    assert read_published(spark, path).count() == 5
    assert publish(rows(spark, 7), path).number == 2


def test_old_versions_expire(spark, scratch):
    path = f"{scratch}/table"
    folders = [publish(rows(spark, n), path, bucket_by="person_id" if n == 2 else None, buckets=2).folder for n in (1, 2, 3, 4)]
    assert expire(spark, path, keep=2) == folders[:2] and expire(spark, path, keep=2) == []
    assert read_published(spark, path).count() == 4
    assert spark.read.parquet(folders[2]).count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(folders[0]).count()
    with pytest.raises(ValueError):
        expire(spark, path, keep=0)


def test_bucketed_tables_join_without_exchange_in_any_session(spark, scratch):
    a = publish(rows(spark, 100), f"{scratch}/a", bucket_by="person_id", buckets=3)
    b = publish(rows(spark, 50).withColumnRenamed("id", "other"), f"{scratch}/b", bucket_by="person_id", buckets=3)
    for v in (a, b):  # as in a session that knows neither
        spark.sql(f"DROP TABLE {v.name}")
    left, right = read_version(spark, a), read_published(spark, f"{scratch}/b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "person_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == rows(spark, 100).join(rows(spark, 50).drop("id"), "person_id").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    with pytest.raises(ValueError):
        publish(left, f"{scratch}/c", bucket_by="person_id", partition_by=["id"])


def test_fingerprint_sees_replaced_files(spark, scratch):
    import os

    rows(spark, 10).coalesce(1).write.parquet(f"{scratch}/t")
    before = fingerprint(spark.read.parquet(f"{scratch}/t"))
    assert before == fingerprint(spark.read.parquet(f"{scratch}/t").where("id > 3"))
    file = next(f"{scratch}/t/{x}" for x in os.listdir(f"{scratch}/t") if x.endswith(".parquet"))
    os.utime(file, (1_000_000, 1_000_000))
    touched = fingerprint(spark.read.parquet(f"{scratch}/t"))
    assert touched != before
    assert fingerprint(spark.range(3)).startswith("plan")
