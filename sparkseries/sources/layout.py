"""Where points and measurement tables are stored and how they are read back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import islice
from time import time_ns as clock_ns
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.timefns import parse_instant
from sparkseries.model import (
    DEFAULT_POLICY,
    FIELDS_TYPE,
    TAGS_TYPE,
    TIME_NS,
    SeriesError,
    check_declared,
    col,
    duration_ns,
    require_name,
)
from sparkseries.operators.points import with_default_time
from sparkseries.operators.quality import merge_points, split_rejects
from sparkseries.operators.retention import (
    DEFAULT_SHARD_GROUP,
    default_policies,
    expired_shard_groups,
    policy_cutoffs,
    resolve_policy,
    shard_durations,
    with_policy_shard_group,
)
from sparkseries.plans.query import in_scope
from sparkseries.session import scratch_folder
from sparkseries.sources.notes import read_notes, write_notes

POINT_PARTITIONS = ("db", "rp", "measurement", "shard_group")
SHARD = "shard"
#: given on reading, so that no file is opened for its schema and names of digits stay text
STORED_POINTS = T.StructType(
    [
        T.StructField("tags", TAGS_TYPE),
        T.StructField("fields", FIELDS_TYPE),
        T.StructField(TIME_NS, T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("db", T.StringType()),
        T.StructField("rp", T.StringType()),
        T.StructField("measurement", T.StringType()),
        T.StructField("shard_group", T.LongType()),
    ]
)
COMPRESSIONS = ("none", "gzip", "zstd", "snappy")


def write_points(
    points: DataFrame,
    path: str,
    *,
    db: str | None = None,
    rp: str | None = None,
    policies: DataFrame | None = None,
    shard_duration: str | None = None,
    compression: str = "zstd",
    mode: str = "append",
) -> None:
    """Append points below ``db/rp/measurement/shard_group``.

    A policy's own shard group duration counts for its points, ``shard_duration``
    for all others.  Durations are fixed by the first write that uses them and
    stored beside the data; a later write that names another one is refused.
    Rows without such notes are appended to only if they lie in shard groups of
    the durations named here.  Default policies are noted too, the last write's.

    Points without measurement or fields are skipped, and a missing time
    becomes the time of the write.  ``db`` and ``rp`` fill
    the columns of that name; an empty policy becomes the default one.  The
    rebalance gives each partition few files and splits a hot partition over
    many tasks.
    """
    if compression not in COMPRESSIONS:
        raise SeriesError(f"unknown compression {compression!r}")
    spark = points.sparkSession
    facts = _facts_of_store(spark, path, shard_duration, policies, renew=mode == "overwrite")
    placed = placed_points(
        points, db=db, rp=rp, policies=policies, shard_duration=facts.duration, own_durations=facts.own, default_policies=facts.defaults
    )
    if mode == "append":
        if not facts.noted and (stored := _stored_points(spark, path)) is not None:
            _require_shard_groups(stored, facts.own, facts.duration)
        facts.note(spark, path)  # before the data, so that a store with rows has notes
    placed.write.mode(mode).option("compression", compression).partitionBy(*POINT_PARTITIONS).parquet(path)
    if mode != "append":
        facts.note(spark, path)


@dataclass
class StoreFacts:
    """What a store's notes say: shard durations for all and by (db, rp), and default policies by database."""

    duration: str
    own: dict[tuple[str, str], str]
    defaults: dict[str, str]
    noted: bool

    def note(self, spark: SparkSession, path: str) -> None:
        own = [[*k, d] for k, d in sorted(self.own.items())]
        write_notes(spark, path, {"shard_duration": self.duration, "own_durations": own, "default_policies": self.defaults})

    def policy(self, db: str, rp: str) -> str:
        """The policy that a name means; an empty one is the database's default."""
        return rp or self.defaults.get(db) or DEFAULT_POLICY

    def shard_ns(self, db: str, rp: str) -> int:
        return duration_ns(self.own.get((db, rp), self.duration))


def _facts_of_store(
    spark: SparkSession, path: str, wanted: str | None = None, policies: DataFrame | None = None, renew: bool = False
) -> StoreFacts:
    """The notes of a store together with what a write names; another duration than the noted one is refused."""
    notes = {} if renew else read_notes(spark, path)
    stored = notes.get("shard_duration")
    own = {(db, rp): d for db, rp, d in notes.get("own_durations", [])}
    for key, named in [(None, wanted), *shard_durations(policies).items()]:
        before = stored if key is None else own.get(key) or stored
        if before and named and duration_ns(before) != duration_ns(named):
            raise SeriesError(f"the store has shard duration {before}, not {named}")
        if key is not None:
            own[key] = named
    defaults = {**notes.get("default_policies", {}), **default_policies(policies)}
    return StoreFacts(stored or wanted or DEFAULT_SHARD_GROUP, own, defaults, bool(notes))


def placed_points(
    points: DataFrame,
    *,
    db: str | None = None,
    rp: str | None = None,
    policies: DataFrame | None = None,
    shard_duration: str = DEFAULT_SHARD_GROUP,
    own_durations: Mapping[tuple[str, str], str] | None = None,
    default_policies: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Good points with all partition columns and those in ``keep``, laid out for writing.

    An empty policy becomes the database's default one in ``policies``, else in
    ``default_policies``, else ``autogen``.
    """
    if db is not None:
        points = points.withColumn("db", F.lit(require_name(db, "database name")))
    elif "db" not in points.columns:
        raise SeriesError("empty database name")
    if rp is not None:
        points = points.withColumn("rp", F.lit(rp))
    elif "rp" not in points.columns:
        points = points.withColumn("rp", F.lit(""))
    good, _ = split_rejects(points)
    if "seq" not in good.columns:
        good = good.withColumn("seq", F.lit(None).cast("bigint"))
    timed = good.withColumn(TIME_NS, with_default_time(F.col(TIME_NS)))
    if default_policies and policies is None:
        rows = [(db_, name, True) for db_, name in default_policies.items()]
        policies = points.sparkSession.createDataFrame(rows, "db string, name string, is_default boolean")
    grouped = with_policy_shard_group(resolve_policy(timed, policies), own_durations or {}, shard_duration)
    placed = grouped.select(*keep, *STORED_POINTS.names)
    return placed.hint("rebalance", *POINT_PARTITIONS).sortWithinPartitions(*POINT_PARTITIONS, TIME_NS)


def read_points(
    spark: SparkSession,
    path: str,
    db: str,
    rp: str = "",
    measurement: str | None = None,
    start: Any = None,
    end: Any = None,
    *,
    policies: DataFrame | None = None,
    as_of: Any = None,
) -> DataFrame:
    """Points of one database and policy in ``[start, end)``.

    An empty policy is the database's default one, by ``policies`` or else by the
    store's notes.  With ``as_of`` the policy's duration in ``policies`` bounds
    the range too, so expired points are not read.

    The time range is given twice, on the shard group (partitions that are not
    read) and on the time (row groups that are not read).  A store without notes
    is read without the first.
    """
    require_name(db, "database name")
    facts = _facts_of_store(spark, path)
    rp = rp or default_policies(policies).get(db) or facts.policy(db, rp)
    points = in_scope(spark.read.schema(STORED_POINTS).parquet(path), db, rp)
    if measurement:
        points = points.where(F.col("measurement") == measurement)
    starts = [parse_instant(start)] if start is not None else []
    if as_of is not None:
        if policies is None:
            raise SeriesError("as_of needs the policies")
        own = policies.where((F.col("db") == db) & (F.col("name") == rp))
        starts += [r["value"] for r in policy_cutoffs(own, as_of).collect()]
    size = facts.shard_ns(db, rp) if facts.noted else None
    if starts:
        ns = max(starts)
        points = points.where(F.col(TIME_NS) >= ns)
        points = points.where(F.col("shard_group") >= ns // size) if size else points
    if end is not None:
        ns = parse_instant(end)
        points = points.where(F.col(TIME_NS) < ns)
        points = points.where(F.col("shard_group") <= (ns - 1) // size) if size else points
    return points


def expired_groups(spark: SparkSession, path: str, policies: DataFrame, as_of: Any) -> DataFrame:
    """``(db, rp, measurement, shard_group)`` of a store whose every point is older than its policy keeps at ``as_of``.

    Group ends follow from the durations in the store's notes; a store without
    notes is refused.  Only partition values are read.
    """
    facts = _facts_of_store(spark, path)
    if not facts.noted:
        raise SeriesError("the store has no notes of its shard durations")
    groups = spark.read.schema(STORED_POINTS).parquet(path).select(*POINT_PARTITIONS).distinct()
    return expired_shard_groups(groups, policies, as_of, shard_duration=facts.duration, own_durations=facts.own)


def drop_expired(spark: SparkSession, path: str, policies: DataFrame, as_of: Any) -> int:
    """Delete the folders of expired shard groups and return their number.

    No file is read or rewritten.  Points of a group that has not expired as a
    whole stay; ``read_points`` with ``as_of`` leaves them out.  Deleting again
    after a failure goes on with what is left.
    """
    found, folder = expired_groups(spark, path, policies, as_of), scratch_folder(spark, "expired")
    found.write.parquet(folder)  # before any folder goes
    dropped = 0
    for group in spark.read.schema(found.schema).parquet(folder).toLocalIterator():
        dropped += _delete_folder(spark, path, {name: group[name] for name in POINT_PARTITIONS})
    _delete_folder(spark, folder)
    return dropped


def drop_measurement(spark: SparkSession, path: str, db: str, rp: str, measurement: str) -> bool:
    """Delete a measurement's folder, which holds all its shard groups; an unknown one changes nothing.

    An empty policy is the database's default one by the store's notes.
    """
    require_name(db, "database name")
    require_name(measurement, "measurement")
    return _delete_folder(spark, path, {"db": db, "rp": _facts_of_store(spark, path).policy(db, rp), "measurement": measurement})


def _delete_folder(spark: SparkSession, path: str, partition: Mapping[str, Any] | None = None) -> bool:
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = [f"{name}={escaped(str(value))}" for name, value in (partition or {}).items()]
    folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _stored_points(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a store, with or without notes; nothing where there is no folder."""
    try:
        return spark.read.schema(STORED_POINTS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _require_shard_groups(stored: DataFrame, own: Mapping[tuple[str, str], str], duration: str) -> None:
    """Refuse a store without notes whose rows lie in shard groups of other durations."""
    now = stored.withColumn("__was", F.col("shard_group"))
    if not with_policy_shard_group(now, own, duration).where(~F.col("shard_group").eqNullSafe(F.col("__was"))).isEmpty():
        raise SeriesError(f"the store has no notes and does not have shard duration {duration}; name its own")


def merge_into_store(
    points: DataFrame,
    path: str,
    *,
    db: str,
    rp: str = "",
    policies: DataFrame | None = None,
    shard_duration: str | None = None,
    compression: str = "zstd",
) -> None:
    """Merge a batch into a point store: per series and time the batch's field values win.

    Only the shard groups that the batch touches are read and written again.
    The batch is written to the scratch folder first, so every step sees the
    same rows.  ``seq`` orders the rows of a batch; rows without it come first.
    The newest ``seq`` of a point stays.  Running the same batch twice changes
    nothing, and the first merge makes the store.  A store with rows but
    without notes is merged into like others if its rows lie in the shard groups
    of the durations named here, and refused if not.  One writer per path; readers
    should wait while the partitions are replaced.
    """
    spark = points.sparkSession
    facts = _facts_of_store(spark, path, shard_duration, policies)
    laid_out = {"shard_duration": facts.duration, "own_durations": facts.own}
    # One time for all rows without one.
    points = points.withColumn(TIME_NS, with_default_time(F.col(TIME_NS), F.lit(clock_ns()).cast("bigint")))
    folder = scratch_folder(spark, "merge")
    placed_points(points, db=db, rp=rp, policies=policies, default_policies=facts.defaults, **laid_out).write.parquet(folder)
    batch = spark.read.schema(STORED_POINTS).parquet(folder)
    aged = batch.withColumn("__age", F.lit(1))
    stored = _stored_points(spark, path)
    if stored is not None:
        stored = stored.where(F.col("db") == db)
        if not facts.noted:
            _require_shard_groups(stored, facts.own, facts.duration)
        # The batch's range of shard groups prunes partitions before the join looks at any.
        ends = batch.agg(F.min("shard_group").alias("lo"), F.max("shard_group").alias("hi")).first()
        stored = stored.where(F.col("shard_group").between(F.lit(ends["lo"]), F.lit(ends["hi"])))
        affected = stored.join(batch.select(*POINT_PARTITIONS).distinct(), list(POINT_PARTITIONS), "left_semi")
        aged = affected.select(*STORED_POINTS.names).withColumn("__age", F.lit(0)).unionByName(aged)
    ordered = aged.withColumn("__seq", F.coalesce("seq", F.lit(0)))
    merged = merge_points(ordered, ["__age", "__seq"], newest="seq")
    facts.note(spark, path)
    placed_points(merged, **laid_out).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("compression", compression).partitionBy(*POINT_PARTITIONS).parquet(path)


def write_measurement(
    df: DataFrame,
    path: str,
    *,
    tags: Sequence[str],
    fields: Mapping[str, str],
    time: str,
    shard_keys: Sequence[str] = (),
    shard_type: str = "HASH",
    shards: int = 64,
    primary_key: Sequence[str] = (),
    sort_keys: Sequence[str] = (),
    index_list: Sequence[str] | None = None,
    compression: str = "zstd",
    mode: str = "errorifexists",
) -> None:
    """Write a measurement table whose declared schema and layout are checked first.

    ``HASH`` puts rows with equal shard keys below one ``shard`` folder; a hot
    key fills several files there.  ``RANGE`` cuts the order of the shard keys,
    the primary key, the sort keys and the time into ranges, so a hot key is
    cut by time; each range is one ``shard`` folder, and its first and last
    shard keys are noted for readers.  Files are sorted by primary and sort
    keys, which lets readers skip row groups.
    """
    check_declared(df.schema, tags, fields)
    if shard_type not in ("HASH", "RANGE"):
        raise SeriesError(f"unknown shard type {shard_type!r}")
    if index_list is not None:
        if not index_list:
            raise SeriesError("empty index list")
        wrong = [f for f in index_list if fields.get(f) != "STRING"]
        if wrong:
            raise SeriesError(f"{wrong} cannot have a text index")
    unknown = [k for k in (*shard_keys, *primary_key, *sort_keys) if k not in df.columns]
    if unknown:
        raise SeriesError(f"no column {unknown[0]!r}")
    order = list(dict.fromkeys([*primary_key, *sort_keys, time]))
    table = df.select(*(col(t) for t in tags), *(col(f) for f in fields), col(time))
    partitions: list[str] = []
    if shard_keys and shard_type == "HASH":
        table = table.withColumn(SHARD, F.pmod(F.xxhash64(*(col(k) for k in shard_keys)), F.lit(shards)).cast("int"))
        table = table.hint("rebalance", SHARD).sortWithinPartitions(SHARD, *(col(k) for k in order))
        partitions = [SHARD]
    elif shard_keys:
        ranges = list(dict.fromkeys([*shard_keys, *order]))
        table = table.repartitionByRange(shards, *(col(k) for k in ranges)).withColumn(SHARD, F.spark_partition_id())
        table = table.sortWithinPartitions(SHARD, *(col(k) for k in order))
        partitions = [SHARD]
    else:
        table = table.hint("rebalance").sortWithinPartitions(*(col(k) for k in order))
    writer = table.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    hashed = shard_type == "HASH"
    notes = {"shard_keys": list(shard_keys) if hashed else [], "shards": shards}
    kinds = {k: table.schema[k].dataType.simpleString() for k in notes["shard_keys"]}
    spark = df.sparkSession
    if shard_keys and not hashed:
        notes["ranges"] = _noted_ranges(spark.read.schema(table.schema).parquet(path), shard_keys)
        notes["range_kinds"] = [[k, table.schema[k].dataType.simpleString()] for k in shard_keys]
    write_notes(spark, path, {**notes, "kinds": kinds})


def _noted_ranges(stored: DataFrame, shard_keys: Sequence[str]) -> list[str]:
    """For each shard a JSON text with its least and greatest value of every shard key."""
    ends = [f(col(k)).alias(f"{name}{i}") for i, k in enumerate(shard_keys) for name, f in (("lo", F.min), ("hi", F.max))]
    rows = stored.groupBy(SHARD).agg(*ends)
    return [r[0] for r in rows.select(F.to_json(F.struct(SHARD, *rows.columns[1:]))).collect()]


def _shards_with(spark: SparkSession, ranges: Sequence[str], kinds: Mapping[str, str], values: Mapping[str, Any]) -> list[int]:
    """Shards whose noted ranges of shard keys hold the given values."""
    fields = [f"{name}{i} {kind}" for i, kind in enumerate(kinds.values()) for name in ("lo", "hi")]
    texts = spark.createDataFrame([(r,) for r in ranges], "value string")
    rows = texts.select(F.from_json("value", f"{SHARD} int, {', '.join(fields)}").alias("r")).select("r.*")
    for i, (key, kind) in enumerate(kinds.items()):
        if key in values:
            rows = rows.where(F.lit(values[key]).cast(kind).between(F.col(f"lo{i}"), F.col(f"hi{i}")))
    return [r[SHARD] for r in rows.select(SHARD).collect()]


def shard_of(values: Mapping[str, Any], kinds: Mapping[str, str], shards: int = 64) -> Column:
    """The shard number of known key values, as a constant for pruning; ``kinds`` are the key columns' types in order."""
    return F.pmod(F.xxhash64(*(F.lit(values[k]).cast(kind) for k, kind in kinds.items())), F.lit(shards)).cast("int")


def read_measurement(spark: SparkSession, path: str, **keys: Any) -> DataFrame:
    """Rows of a measurement table, of one combination of key values if given.

    Values of all shard keys leave one shard folder to read; of a table cut in
    ranges, values of any shard key leave the ranges that may hold them.
    """
    notes = read_notes(spark, path)
    table = spark.read.parquet(path)
    for name, value in keys.items():
        table = table.where(col(name) == F.lit(value))
    kinds = {k: notes["kinds"][k] for k in notes.get("shard_keys", [])}
    if kinds and all(k in keys for k in kinds):
        table = table.where(F.col(SHARD) == shard_of(keys, kinds, notes["shards"]))
    ranged = dict(notes.get("range_kinds", []))
    if any(k in keys for k in ranged):
        table = table.where(F.col(SHARD).isin(_shards_with(spark, notes["ranges"], ranged, keys)))
    return table.drop(SHARD)


def without_measurement(points: DataFrame, db: str, rp: str, measurement: str) -> DataFrame:
    """Points without one measurement of one database and policy; an unknown name changes nothing."""
    require_name(db, "database name")
    require_name(measurement, "measurement")
    gone = (F.col("db") == db) & (F.col("rp") == (rp or DEFAULT_POLICY)) & (F.col("measurement") == measurement)
    return points.where(~F.coalesce(gone, F.lit(False)))


def drop_measurement_partitions(spark: SparkSession, table: str, db: str, rp: str, measurement: str, together: int = 1_000) -> int:
    """Drop a measurement's partitions of a catalog table partitioned by ``db, rp, measurement, ...``.

    Only partition metadata is listed and dropped, ``together`` partitions in one
    statement; returns the number of partitions dropped.
    """
    require_name(db, "database name")
    require_name(measurement, "measurement")
    scope = {"db": db, "rp": rp or DEFAULT_POLICY, "measurement": measurement}
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_partition_spec(scope)})").toLocalIterator()
    dropped = 0
    while rows := list(islice(found, together)):
        specs = [{**dict(part.split("=", 1) for part in row[0].split("/")), **scope} for row in rows]
        parts = ", ".join(f"PARTITION ({_partition_spec(spec)})" for spec in specs)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        dropped += len(rows)
    return dropped


def _partition_spec(values: Mapping[str, str]) -> str:
    return ", ".join(f"{k} = '{_sql_text(v)}'" for k, v in values.items())


def _sql_text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
