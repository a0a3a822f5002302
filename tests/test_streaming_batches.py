"""Batches bounded by points, routes and outcomes of the streaming ingest."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from sparkseries.model import SeriesError
from sparkseries.streaming.ingest import current_points, ingested_points, line_stream, outcomes, routed_stream, start_ingest, with_parts, write_batch


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def run(stream, tmp_path, **options):
    query = start_ingest(stream, str(tmp_path / "store"), str(tmp_path / "state"), interval=None, **options)
    query.awaitTermination()
    assert query.exception() is None
    return str(tmp_path / "store")


def told(spark, store):
    return sorted(
        (r["batch"], r["db"], r["rp"], r["part"], r["rows"], r["rejected"]) for r in outcomes(spark, store).collect()
    )


def test_parts_hold_at_most_the_given_number_of_points(spark, tmp_path):
    put(tmp_path / "in", "1", *(f"m,t=a v={i} {i}" for i in range(23)), "bad line", "m,t=a")
    put(tmp_path / "in", "2", *(f"m,t=b v={i} {i}" for i in range(4)))
    store = run(line_stream(spark, str(tmp_path / "in"), db="d"), tmp_path, batch_points=10)
    points = ingested_points(spark, store)
    sizes = sorted((r["batch"], r["part"], r["count"]) for r in points.groupBy("batch", "part").count().collect())
    assert sizes == [(0, 0, 10), (0, 1, 10), (0, 2, 7)]
    assert told(spark, store) == [(0, "d", "autogen", 0, 10, 2), (0, "d", "autogen", 1, 10, 0), (0, "d", "autogen", 2, 7, 0)]
    assert current_points(spark, store).count() == 27 and not os.path.exists(f"{store}/_staged/batch=0")


def test_small_parts_make_no_small_files(spark, tmp_path):
    week = 7 * 86_400 * 10**9
    put(tmp_path / "in", "1", *(f"m,t=a v={i} {i % 3 * week + i}" for i in range(240)))
    store = run(line_stream(spark, str(tmp_path / "in"), db="d"), tmp_path, batch_points=2)
    points = ingested_points(spark, store)
    assert points.count() == 240 and points.where("part < 0 OR part > 119").count() == 0
    assert {r["count"] for r in points.groupBy("batch", "db", "rp", "part").count().collect()} == {2}
    assert [r[4] for r in told(spark, store)] == [2] * 120
    files = [f for _, _, names in os.walk(f"{store}/points/batch=0") for f in names if f.endswith(".parquet")]
    assert 3 <= len(files) <= 12


def test_parts_follow_the_order_of_lines_and_count_by_scope(spark):
    rows = [("d", "x" if i % 3 else "y", i // 40, i, None if i % 7 else "bad") for i in range(200)]
    judged = spark.createDataFrame(rows, "db string, rp string, __task int, seq bigint, error string").repartition(5)
    parts = {r["seq"]: r["part"] for r in with_parts(judged, 8).where("error IS NULL").collect()}
    for scope in ("x", "y"):
        good = [seq for _, rp, _, seq, error in rows if rp == scope and error is None]
        assert [parts[seq] for seq in good] == [n // 8 for n in range(len(good))]


def test_a_file_is_at_least_a_batch_of_bytes(spark, tmp_path):
    for n in range(3):
        put(tmp_path / "in", str(n), *(f"m,t=a v={i} {100 * n + i}" for i in range(50)))
    store = run(line_stream(spark, str(tmp_path / "in"), db="d", batch_bytes=10), tmp_path, batch_points=30)
    assert [(b, part, rows) for b, _, _, part, rows, _ in told(spark, store)] == [(b, p, 30 - 10 * p) for b in range(3) for p in range(2)]
    for options in ({"batch_bytes": 0}, {"batch_files": 0}):
        with pytest.raises(SeriesError):
            line_stream(spark, str(tmp_path / "in"), db="d", **options)
    with pytest.raises(SeriesError):
        start_ingest(None, "x", "y", batch_points=0)


def test_routes_are_one_query_with_one_commit(spark, tmp_path):
    routes = {("a", ""): str(tmp_path / "a"), ("a", "week"): str(tmp_path / "w"), ("b", "day"): str(tmp_path / "b")}
    for n, folder in enumerate(routes.values()):
        put(folder, "1", *(f"m,t=a v={i} {i}" for i in range(n + 1)))
    store = run(routed_stream(spark, routes), tmp_path)
    assert told(spark, store) == [(0, "a", "autogen", 0, 1, 0), (0, "a", "week", 0, 2, 0), (0, "b", "day", 0, 3, 0)]
    assert len(os.listdir(f"{tmp_path}/state/commits")) >= 1
    put(tmp_path / "w", "2", "m,t=z v=1 9", "broken")
    run(routed_stream(spark, routes), tmp_path)
    assert told(spark, store)[3:] == [(1, "a", "week", 0, 1, 1)]
    assert ingested_points(spark, store).where("rp = 'week'").count() == 3
    with pytest.raises(SeriesError):
        routed_stream(spark, {})


def test_a_batch_of_rejects_has_an_outcome(spark, tmp_path):
    put(tmp_path / "in", "1", "bad", "also bad")
    store = run(line_stream(spark, str(tmp_path / "in"), db="d"), tmp_path, batch_points=5)
    (row,) = outcomes(spark, store).collect()
    assert (row["rows"], row["rejected"], row["part"]) == (0, 2, 0) and row["error"]
    assert spark.read.parquet(f"{store}/rejects").count() == 2


def test_a_repeated_batch_replaces_the_outcome_of_a_failure(spark, tmp_path):
    store = str(tmp_path / "store")
    lines = spark.createDataFrame([(f"m,t=a v={i} {i}", "d", "p" if i % 2 else "") for i in range(9)], "value string, db string, rp string")
    with pytest.raises(Exception, match="[Cc]odec|compression"):
        write_batch(lines, 4, store, compression="nonesuch")
    failed = outcomes(spark, store).collect()
    assert {(r["db"], r["rp"], r["rows"], r["batch"]) for r in failed} == {("d", "p", 0, 4), ("d", "autogen", 0, 4)}
    assert all(r["error"] for r in failed)
    for _ in range(2):
        write_batch(lines, 4, store, batch_points=3)
        assert told(spark, store) == [(4, "d", "autogen", 0, 3, 0), (4, "d", "autogen", 1, 2, 0), (4, "d", "p", 0, 3, 0), (4, "d", "p", 1, 1, 0)]
        assert ingested_points(spark, store).count() == 9
        assert {r["error"] for r in outcomes(spark, store).collect()} == {""}


def test_lines_that_cannot_be_read_are_recorded_without_names(spark, tmp_path):
    store = str(tmp_path / "store")
    lines = spark.createDataFrame([("m f=1 1", "d", "")], "value string, db string, rp string")
    gone = lines.withColumn("db", F.raise_error(F.lit("source lost")).cast("string"))
    with pytest.raises(Exception, match="source lost"):
        write_batch(gone, 1, store)
    (row,) = outcomes(spark, store).collect()
    assert row["db"] is None and "source lost" in row["error"]
