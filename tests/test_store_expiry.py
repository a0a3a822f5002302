"""Stores and policies: expiry by the layout on disk, default policies, stores without notes, whole measurements dropped."""

from __future__ import annotations

import glob
import os

import pytest
from helpers import plan_text
from pyspark.sql import functions as F

from sparkseries.model import SeriesError, with_roles
from sparkseries.operators.retention import expired_shard_groups, keep_retained, policies, resolve_policy, shard_durations
from sparkseries.sources.layout import (
    POINT_PARTITIONS,
    SHARD,
    drop_expired,
    drop_measurement,
    drop_measurement_partitions,
    expired_groups,
    merge_into_store,
    placed_points,
    read_measurement,
    read_points,
    write_measurement,
    write_points,
)

DAY = 86_400 * 10**9


@pytest.fixture
def days(lines):
    """One point on each of some days; time 0 would be a missing time."""
    return lambda *on: lines(*(f"m,host=a v={d} {d * DAY + 1}" for d in on))


def rules(spark, **durations):
    return policies(spark, [{"db": "d", "name": n, "duration": v} for n, v in durations.items()])


def found(df):
    return sorted(r["time_ns"] // DAY for r in df.collect())


def test_a_group_expires_by_the_duration_it_was_written_with(spark, days, tmp_path):
    path = str(tmp_path / "store")
    write_points(days(1, 96, 100), path, db="d", rp="p", shard_duration="30d")
    rule = policies(spark, [{"db": "d", "name": "p", "duration": "10d", "shard_group_duration": "1d"}])
    # day 96 is four days old: its group of 30 days stays, whatever the policy says now
    assert [r["shard_group"] for r in expired_groups(spark, path, rule, 100 * DAY).collect()] == [0]
    assert found(read_points(spark, path, "d", "p", policies=rule, as_of=100 * DAY)) == [96, 100]
    assert drop_expired(spark, path, rule, 100 * DAY) == 1
    assert drop_expired(spark, path, rule, 100 * DAY) == 0
    assert found(read_points(spark, path, "d", "p")) == [96, 100]


@pytest.mark.parametrize("as_of, left", [(130, [60, 89, 90, 119]), (99, [0, 29, 30, 59, 60, 89, 90, 119]), (100, [30, 59, 60, 89, 90, 119]), (129, [30, 59, 60, 89, 90, 119])])
def test_only_groups_that_ended_before_the_cutoff_go(spark, days, tmp_path, as_of, left):
    path = str(tmp_path / "store")
    write_points(days(0, 29, 30, 59, 60, 89, 90, 119), path, db="d", rp="p", shard_duration="30d")
    drop_expired(spark, path, rules(spark, p="70d"), as_of * DAY)
    assert found(read_points(spark, path, "d", "p")) == left


def test_expiry_keeps_other_policies_and_files(spark, days, lines, tmp_path):
    path = str(tmp_path / "store")
    own = policies(spark, [{"db": "d", "name": "short", "duration": "3d", "shard_group_duration": "1d"}, {"db": "d", "name": "ever"}])
    write_points(days(1, 2, 9), path, db="d", rp="short", policies=own)
    write_points(days(1, 2, 9), path, db="d", rp="ever", policies=own)
    write_points(lines(f"odd\\ name=1\\,x,host=a v=1 {DAY}"), path, db="d/e", rp="short", policies=own)
    before = set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    assert drop_expired(spark, path, own, 10 * DAY) == 2
    gone = before - set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    assert len(gone) == 2 and all("rp=short" in f and "db=d/" in f for f in gone)
    other = policies(spark, [{"db": "d/e", "name": "short", "duration": "1d"}])
    assert drop_expired(spark, path, other, 100 * DAY) == 1  # names are escaped in folders
    assert read_points(spark, path, "d/e", "short").count() == 0
    assert found(read_points(spark, path, "d", "ever")) == [1, 2, 9] and found(read_points(spark, path, "d", "short")) == [9]


def test_a_read_as_of_a_time_prunes_partitions(spark, days, tmp_path):
    path = str(tmp_path / "store")
    write_points(days(*range(0, 60, 5)), path, db="d", rp="p")
    kept = read_points(spark, path, "d", "p", policies=rules(spark, p="10d"), as_of=55 * DAY)
    assert found(kept) == [45, 50, 55]
    plan = plan_text(kept)
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "isnotnull(shard_group" in filters
    assert found(read_points(spark, path, "d", "p", start=50 * DAY, policies=rules(spark, p="10d"), as_of=55 * DAY)) == [50, 55]
    assert found(read_points(spark, path, "d", "p", policies=rules(spark, q="10d"), as_of=55 * DAY)) == list(range(0, 60, 5))
    with pytest.raises(SeriesError):
        read_points(spark, path, "d", "p", as_of=55 * DAY)


def test_negative_times_expire_too(spark, days, tmp_path):
    path = str(tmp_path / "store")
    write_points(days(0, 12, 23).withColumn("time_ns", F.col("time_ns") - 20 * DAY), path, db="d", rp="p")
    assert sorted(r["shard_group"] for r in expired_groups(spark, path, rules(spark, p="5d"), 5 * DAY).collect()) == [-3, -2]


def test_an_empty_policy_is_the_default_on_reading(spark, days, tmp_path):
    path = str(tmp_path / "store")
    first = policies(spark, [{"db": "d", "name": "main", "duration": "10d", "is_default": True}])
    write_points(days(1, 2), path, db="d", policies=first)
    assert found(read_points(spark, path, "d")) == found(read_points(spark, path, "d", "main")) == [1, 2]
    write_points(days(3), path, db="d")  # the noted default holds for later writes
    merge_into_store(days(4), path, db="d")
    assert found(read_points(spark, path, "d")) == [1, 2, 3, 4]
    assert found(read_points(spark, path, "d", "autogen")) == []
    other = policies(spark, [{"db": "d", "name": "late", "is_default": True}])
    assert found(read_points(spark, path, "d", policies=other)) == []
    write_points(days(5), path, db="e")
    assert found(read_points(spark, path, "e")) == found(read_points(spark, path, "e", "autogen")) == [5]


def test_a_store_without_notes_is_read_whole_and_not_mixed(spark, days, tmp_path):
    path = str(tmp_path / "store")
    placed_points(days(1, 8, 15), db="d", shard_duration="1d").write.partitionBy(*POINT_PARTITIONS).parquet(path)
    assert found(read_points(spark, path, "d", end=9 * DAY)) == [1, 8]
    assert found(read_points(spark, path, "d", start=8 * DAY)) == [8, 15]
    with pytest.raises(SeriesError, match="no notes"):
        write_points(days(9), path, db="d")
    with pytest.raises(SeriesError, match="no notes"):
        expired_groups(spark, path, rules(spark, autogen="1d"), 99 * DAY)
    write_points(days(9), path, db="d", shard_duration="1d")
    assert found(read_points(spark, path, "d", start=8 * DAY, end=15 * DAY)) == [8, 9]


def test_notes_come_before_the_first_rows(spark, days, tmp_path):
    path = str(tmp_path / "store")
    broken = days(1).withColumn("seq", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        write_points(broken, path, db="d", shard_duration="1d")
    assert os.path.isdir(f"{path}/_notes")
    with pytest.raises(SeriesError, match="shard duration"):
        write_points(days(1), path, db="d", shard_duration="2d")
    write_points(days(1), path, db="d", shard_duration="3d", mode="overwrite")
    assert found(read_points(spark, path, "d", start=0, end=2 * DAY)) == [1]


def test_of_several_shard_durations_the_shortest_counts(spark):
    rows = [{"db": "d", "name": "p", "shard_group_duration": x} for x in ("10d", "2d", "36h")]
    assert shard_durations(policies(spark, rows)) == {("d", "p"): "36h"}
    groups = spark.createDataFrame([("d", "p", 0), ("d", "p", 1), ("d", None, 0), (None, "p", 0)], "db string, rp string, shard_group bigint")
    rule = policies(spark, [{"db": "d", "name": "p", "duration": "1d"}])
    gone = expired_shard_groups(groups, rule, 3 * DAY, shard_duration="7d", own_durations={("d", "p"): "2d"})
    assert [(r["db"], r["rp"], r["shard_group"]) for r in gone.collect()] == [("d", "p", 0)]


def test_many_policies_do_not_shuffle_the_rows(spark):
    rows = [{"db": f"db{i}", "name": "p", "duration": f"{1 + i % 9}d"} for i in range(3_000)]
    points = spark.range(20_000).selectExpr("concat('db', id % 4000) AS db", "'p' AS rp", "id AS k", f"(id % 12) * {DAY} AS time_ns")
    kept = keep_retained(points, policies(spark, rows), 12 * DAY)
    want = sum(1 for i in range(20_000) if i % 4000 >= 3_000 or (i % 12) * DAY >= 12 * DAY - (1 + i % 4000 % 9) * DAY)
    assert kept.count() == want
    plan = plan_text(kept)
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan
    resolved = resolve_policy(points.withColumn("rp", F.lit("")), policies(spark, [{"db": "db1", "name": "own", "is_default": True}]))
    assert resolved.where("rp = 'own'").count() == 5


def test_dropping_a_measurement_of_a_store(spark, lines, tmp_path):
    path = str(tmp_path / "store")
    rule = policies(spark, [{"db": "d", "name": "main", "is_default": True}])
    write_points(lines(f"cpu,t=a v=1 {DAY}", f"cpu,t=a v=1 {20 * DAY}", f"mem,t=a v=1 {DAY}"), path, db="d", policies=rule)
    assert drop_measurement(spark, path, "d", "", "cpu")
    assert not drop_measurement(spark, path, "d", "", "cpu") and not drop_measurement(spark, path, "d", "autogen", "mem")
    assert [r["measurement"] for r in read_points(spark, path, "d").collect()] == ["mem"]
    with pytest.raises(SeriesError):
        drop_measurement(spark, path, "d", "", "")


def test_partitions_of_a_table_are_dropped_together(spark, days):
    spark.sql("DROP TABLE IF EXISTS many_groups")
    placed = placed_points(days(*range(12)), db="d", shard_duration="1d")
    placed.write.partitionBy(*POINT_PARTITIONS).saveAsTable("many_groups")
    try:
        assert drop_measurement_partitions(spark, "many_groups", "d", "", "m", together=5) == 12
        assert spark.table("many_groups").count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS many_groups")


def test_ranges_are_noted_and_prune(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(4_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', lpad(id % 60, 2, '0')) END AS tag", "concat('s', id % 4) AS other", "id AS f", "id AS time")
    table = with_roles(df, time="time", tags=["tag", "other"], fields=["f"])
    write_measurement(table, path, tags=["tag", "other"], fields={"f": "INT64"}, time="time", shard_keys=["tag", "other"], shard_type="RANGE", shards=10)
    folders = len(glob.glob(f"{path}/shard=*"))
    assert folders == 10
    for keys in ({"tag": "t22"}, {"tag": "hot"}, {"tag": "hot", "other": "s1"}, {"other": "s2"}, {"tag": "absent"}, {"tag": "hot", "f": 9}):
        got = read_measurement(spark, path, **keys)
        want = [r["f"] for r in df.collect() if all(r[k] == v for k, v in keys.items())]
        assert sorted(r["f"] for r in got.collect()) == want
        assert SHARD not in got.columns
    one = read_measurement(spark, path, tag="t22").select(F.input_file_name().alias("f")).distinct().count()
    assert one <= 2
    plan = plan_text(read_measurement(spark, path, tag="t22"))
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "shard" in filters
