"""Micro-batch ingest of line protocol with Structured Streaming.

A stream of lines is parsed, routed by (db, rp) and written batch by batch.
Everything of a batch goes below a folder of its own that a retry overwrites,
so a batch that runs again after a lost driver leaves no second copy:

    <path>/points/batch=<n>/db=../rp=../measurement=../shard_group=../
    <path>/rejects/batch=<n>/
    <path>/outcomes/batch=<n>/

A part holds at most a given number of points of one (db, rp), in the order in
which they came; it is a column of the points, so small parts make no small
files.  Outcomes are written last: a batch that has them is complete.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkseries.functions.timefns import time_bucket
from sparkseries.model import DEFAULT_POLICY, SeriesError, col
from sparkseries.operators.quality import REASONS, merge_points, reject_reasons
from sparkseries.operators.retention import DEFAULT_SHARD_GROUP
from sparkseries.sources.layout import POINT_PARTITIONS, STORED_POINTS, placed_points, write_points
from sparkseries.sources.lineproto import REASON, parse_lines
from sparkseries.sources.notes import read_notes, write_notes

BATCH = "batch"
PART = "part"
_TASK = "__task"
OUTCOMES = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("rp", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField(PART, T.LongType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


def line_stream(
    spark: SparkSession, path: str, *, db: str, rp: str = "", batch_files: int = 1_000, batch_bytes: int | None = None
) -> DataFrame:
    """A stream of text lines for one (db, rp).

    ``batch_files`` bounds the files of a micro-batch, or ``batch_bytes`` their
    size; a micro-batch takes one file at least.
    """
    if batch_files <= 0 or (batch_bytes is not None and batch_bytes <= 0):
        raise SeriesError("batch size must be positive")
    if not db:
        raise SeriesError("empty database name")
    bound = ("maxFilesPerTrigger", batch_files) if batch_bytes is None else ("maxBytesPerTrigger", batch_bytes)
    lines = spark.readStream.option(*bound).text(path)
    return lines.select("value", F.lit(db).alias("db"), F.lit(rp).alias("rp"))


def routed_stream(
    spark: SparkSession, routes: Mapping[tuple[str, str], str], *, batch_files: int = 1_000, batch_bytes: int | None = None
) -> DataFrame:
    """One stream of the lines of several (db, rp), each from its own folder.

    A query over it commits what all of them had at a time as one micro-batch;
    the bounds hold for each folder.
    """
    if not routes:
        raise SeriesError("no routes")
    streams = [
        line_stream(spark, path, db=db, rp=rp, batch_files=batch_files, batch_bytes=batch_bytes) for (db, rp), path in sorted(routes.items())
    ]
    return reduce(DataFrame.unionByName, streams)


def with_parts(judged: DataFrame, batch_points: int) -> DataFrame:
    """``part``: lines without ``error`` of each (db, rp) in runs of ``batch_points``, by ``__task`` and then ``seq``.

    A row's number is its rank among the lines of its task plus the good lines
    of the tasks before, so no task sees more than one task's lines of one
    (db, rp).
    """
    good = F.col("error").isNull().cast("bigint")
    keys = ["db", "rp", _TASK]
    before = Window.partitionBy("db", "rp").orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    counts = judged.groupBy(*keys).agg(F.sum(good).alias("n"))
    totals = counts.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("__before") + F.coalesce(F.sum(good).over(inside), F.lit(0))
    return judged.join(totals, keys).withColumn(PART, F.floor(rank / F.lit(batch_points))).drop("__before")


def write_batch(
    lines: DataFrame,
    batch_id: int,
    path: str,
    *,
    batch_points: int | None = None,
    precision: str = "ns",
    shard_duration: str = DEFAULT_SHARD_GROUP,
    compression: str = "zstd",
) -> None:
    """Write one batch of ``value, db, rp`` lines: its points, its rejects and its outcomes.

    Points go in parts of at most ``batch_points`` of one (db, rp); without it
    all points of a (db, rp) are one part.  There is one outcome for each part;
    the first of a (db, rp) also counts its rejected lines and names their
    faults.  Judged lines are kept below the store until the batch is written.
    A batch that runs again replaces all that it wrote before, the outcome of a
    failure too.
    """
    spark = lines.sparkSession
    staged = f"{path}/_staged/{BATCH}={batch_id}"
    try:
        judged = _judged(lines, staged, precision)
        good = judged.where(F.col("error").isNull())
        if batch_points is None:
            parted = good.withColumn(PART, F.lit(0).cast("bigint"))
        else:
            parted = with_parts(good, batch_points)
        placed_points(parted.drop("error", "value"), shard_duration=shard_duration, keep=[PART]).write.mode("overwrite").option(
            "compression", compression
        ).partitionBy(*POINT_PARTITIONS).parquet(f"{path}/points/{BATCH}={batch_id}")
        bad = judged.where(F.col("error").isNotNull()).select("value", "db", "rp", "error")
        bad.write.mode("overwrite").parquet(f"{path}/rejects/{BATCH}={batch_id}")
        _write_outcomes(judged, batch_points, f"{path}/outcomes/{BATCH}={batch_id}")
    except Exception as problem:
        _record_failure(lines, batch_id, path, problem)
        raise
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _judged(lines: DataFrame, folder: str, precision: str) -> DataFrame:
    """Parsed lines with ``error``, written once so that all outputs of the batch see the same rows."""
    routed = lines.withColumn("rp", F.coalesce(F.nullif("rp", F.lit("")), F.lit(DEFAULT_POLICY)))
    if "seq" not in routed.columns:
        routed = routed.withColumn("seq", F.monotonically_increasing_id())  # later lines win
    parsed = reject_reasons(parse_lines(routed.withColumn(_TASK, F.spark_partition_id()), precision=precision))
    wrong = F.when(F.col(REASON).isNotNull(), F.col(REASON)).when(F.size(REASONS) > 0, F.concat_ws("; ", REASONS))
    judged = parsed.withColumn("error", wrong).drop(REASON, REASONS)
    judged.write.mode("overwrite").parquet(folder)
    return lines.sparkSession.read.schema(judged.schema).parquet(folder)


def _write_outcomes(judged: DataFrame, batch_points: int | None, folder: str) -> None:
    totals = judged.groupBy("db", "rp").agg(
        F.count_if(F.col("error").isNull()).alias("good"),
        F.count_if(F.col("error").isNotNull()).alias("bad"),
        F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("faults"),
    )
    most = F.lit(batch_points) if batch_points else F.greatest("good", F.lit(1))
    last = F.floor(F.greatest(F.col("good") - 1, F.lit(0)) / most)
    parts = totals.withColumn(PART, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    first = F.col(PART) == 0
    outcome = parts.select(
        "db",
        "rp",
        F.least(most, F.col("good") - F.col(PART) * most).cast("bigint").alias("rows"),
        F.when(first, F.col("bad")).otherwise(0).cast("bigint").alias("rejected"),
        F.when(first, F.col("faults")).otherwise("").alias("error"),
        PART,
    )
    outcome.coalesce(1).write.mode("overwrite").parquet(folder)


def _record_failure(lines: DataFrame, batch_id: int, path: str, problem: Exception) -> None:
    """One outcome with the error for each (db, rp) of the batch; without names where the lines themselves cannot be read."""
    spark = lines.sparkSession
    schema = T.StructType([f for f in OUTCOMES.fields if f.name != BATCH])
    text = f"{type(problem).__name__}: {problem}"
    folder = f"{path}/outcomes/{BATCH}={batch_id}"
    rp = F.coalesce(F.nullif("rp", F.lit("")), F.lit(DEFAULT_POLICY))
    zero = F.lit(0).cast("bigint")
    scopes = lines.select("db", rp.alias("rp")).distinct()
    failed = scopes.select("db", "rp", zero.alias("rows"), zero.alias("rejected"), F.lit(text).alias("error"), zero.alias(PART))
    try:
        failed.coalesce(1).write.mode("overwrite").parquet(folder)
    except Exception:
        spark.createDataFrame([(None, None, 0, 0, text, 0)], schema).write.mode("overwrite").parquet(folder)


def start_ingest(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = "10 seconds",
    batch_points: int | None = None,
    precision: str = "ns",
    shard_duration: str = DEFAULT_SHARD_GROUP,
    compression: str = "zstd",
) -> StreamingQuery:
    """Start the ingest of a stream of ``value, db, rp``.

    ``interval`` is the longest wait for a batch; with None all available data
    is taken and the query ends.  One query serves every (db, rp), with parts of
    at most ``batch_points`` points.
    """
    if batch_points is not None and batch_points <= 0:
        raise SeriesError("batch size must be positive")
    if interval is not None and not re.search("[1-9]", interval):
        raise SeriesError("batch interval must be positive")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(
            batch,
            batch_id,
            path,
            batch_points=batch_points,
            precision=precision,
            shard_duration=shard_duration,
            compression=compression,
        )

    write_notes(lines.sparkSession, f"{path}/points", {"shard_duration": shard_duration})
    writer = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def ingested_points(spark: SparkSession, path: str) -> DataFrame:
    """All points written so far, with their batch and part."""
    schema = T.StructType([*STORED_POINTS.fields, T.StructField(PART, T.LongType()), T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{path}/points").parquet(f"{path}/points")


def current_points(spark: SparkSession, path: str) -> DataFrame:
    """One row per series and time: of every field the value that came last, by batch and line."""
    points = ingested_points(spark, path).drop(PART).withColumn("__seq", F.coalesce("seq", F.lit(0)))
    return merge_points(points, [BATCH, "__seq"], newest="seq")


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """(db, rp, rows, rejected, error, part, batch) of every part of every batch, once however often the batch ran."""
    return spark.read.schema(OUTCOMES).option("basePath", f"{path}/outcomes").parquet(f"{path}/outcomes")


def compact_points(spark: SparkSession, path: str, target: str) -> None:
    """Write the current points of all batches as one point store without batch folders."""
    duration = read_notes(spark, f"{path}/points").get("shard_duration", DEFAULT_SHARD_GROUP)
    write_points(current_points(spark, path), target, shard_duration=duration, mode="errorifexists")


def count_by_bucket(stream: DataFrame, time: str, duration: str, tags: list[str], late: str) -> DataFrame:
    """Running counts per tag set and time bucket, with a bound on how late rows may come."""
    timed = stream.withWatermark(time, late)
    return timed.groupBy(*(col(t) for t in tags), time_bucket(timed, time, duration).alias("time")).agg(
        F.count(F.lit(1)).alias("n")
    )
