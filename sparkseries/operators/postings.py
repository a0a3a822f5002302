"""Posting lists of a text index: gaps between row ids in blocks, with new rows merged as generations.

A generation holds the rows of one batch below a folder of its own.  The notes
beside the folders name the generations that count and what they index, so a
batch that is merged again replaces itself, and a table with other rows than
the indexed ones is noticed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.model import SeriesError, col
from sparkseries.operators.textindex import BUCKET, query_tokens, text_index
from sparkseries.sources.notes import read_notes, write_notes

#: row ids of a block; no posting list is longer
BLOCK_IDS = 1 << 16


def postings(df: DataFrame, row_id: str, fields: Sequence[str]) -> DataFrame:
    """``(token, field, block, gaps)``: in each block of row ids those whose text holds the token.

    The first gap counts from the block's first id, each other from the id
    before.  A token that every text holds has one row a block, so its rows lie
    in many tasks.
    """
    if not isinstance(df.schema[row_id].dataType, T.IntegralType):
        raise SeriesError(f"row id {row_id!r} is not a whole number")
    index = text_index(df.where(col(row_id).isNotNull()), row_id, fields)
    size = F.lit(BLOCK_IDS).cast("bigint")
    inside = F.pmod(F.col("row_id").cast("bigint"), size)
    placed = index.select("token", "field", F.call_function("div", F.col("row_id") - inside, size).alias("block"), inside.cast("int").alias("at"))
    lists = placed.groupBy("token", "field", "block").agg(F.array_sort(F.collect_set("at")).alias("at"))
    return lists.select("token", "field", "block", _gaps(F.col("at")).alias("gaps"))


def _gaps(ids: Column) -> Column:
    return F.transform(ids, lambda x, i: F.when(i == 0, x).otherwise(x - F.get(ids, i - 1)))


def _rows_of(lists: DataFrame) -> DataFrame:
    """``(token, field, block, at)``: the ids inside the block, running totals over the gaps of one list."""
    spread = lists.withColumn("list", F.monotonically_increasing_id()).select("token", "field", "block", "list", F.posexplode("gaps").alias("n", "gap"))
    upto = Window.partitionBy("token", "field", "block", "list").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return spread.select("token", "field", "block", F.sum("gap").over(upto).cast("int").alias("at"))


def index_version(df: DataFrame, row_id: str, fields: Sequence[str]) -> list[int]:
    """Number of rows and a sum over hashes of ids and texts; it tells tables of other rows or texts apart."""
    texts = [F.concat(col(f).isNull().cast("string"), F.coalesce(col(f), F.lit(""))) for f in fields]
    row = df.where(col(row_id).isNotNull()).agg(F.count(F.lit(1)), F.sum(F.xxhash64(col(row_id).cast("bigint"), *texts).cast("decimal(38,0)")))
    count, total = row.first()
    return [count, int(total or 0)]


def merge_postings(
    df: DataFrame, path: str, row_id: str, fields: Sequence[str], *, buckets: int = 256, compression: str = "zstd"
) -> None:
    """Add the texts of new rows to the index at ``path``, or make it.

    Only the new rows are read.  Rows of ids that the index has must not come
    again with other texts; ``is_current`` shows it.  One writer per path.
    """
    spark, fields = df.sparkSession, list(fields)
    notes = read_notes(spark, path) or {"buckets": buckets, "fields": fields, "generations": {}}
    if notes["fields"] != fields:
        raise SeriesError(f"the index is over {notes['fields']}, not {fields}")
    version = index_version(df, row_id, fields)
    name = f"g{version[0]}_{version[1] & ((1 << 64) - 1):016x}"
    _write(postings(df, row_id, fields), f"{path}/{name}", notes["buckets"], compression)
    notes["generations"][name] = version
    write_notes(spark, path, notes)


def _write(lists: DataFrame, folder: str, buckets: int, compression: str) -> None:
    bucketed = lists.withColumn(BUCKET, F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int"))
    spread = bucketed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "token", "field", "block")
    spread.write.mode("overwrite").option("compression", compression).partitionBy(BUCKET).parquet(folder)


_STORED = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("gaps", T.ArrayType(T.IntegerType())),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)


def _notes(spark: SparkSession, path: str) -> dict:
    notes = read_notes(spark, path)
    if not notes:
        raise SeriesError(f"no text index at {path}")
    return notes


def read_postings(spark: SparkSession, path: str, tokens: str | Sequence[str] | None = None) -> DataFrame:
    """``(token, field, block, gaps)`` of all generations, of some tokens only their buckets."""
    notes = _notes(spark, path)
    found = None
    for name in notes["generations"]:  # each folder has its own partitions
        part = spark.read.schema(_STORED).parquet(f"{path}/{name}")
        found = part if found is None else found.union(part)
    if tokens is not None:
        wanted = query_tokens(tokens)
        bucket = [F.pmod(F.xxhash64(F.lit(t)), F.lit(notes["buckets"])).cast("int") for t in wanted]
        found = found.where(F.col(BUCKET).isin(*bucket) & F.col("token").isin(*wanted))
    return found.drop(BUCKET)


def lookup_postings(spark: SparkSession, path: str, words: str | Sequence[str]) -> DataFrame:
    """``row_id`` of the rows with a field that holds all words; only the lists of these words are read and spread."""
    wanted = query_tokens(words)
    hits = _rows_of(read_postings(spark, path, wanted)).groupBy("field", "block", "at")
    whole = hits.agg(F.size(F.collect_set("token")).alias("n")).where(F.col("n") == len(wanted))
    return whole.select((F.col("block") * BLOCK_IDS + F.col("at")).alias("row_id")).distinct()


def is_current(df: DataFrame, path: str, row_id: str) -> bool:
    """Whether the index holds just the rows of ``df`` with their present texts."""
    notes = _notes(df.sparkSession, path)
    totals = [sum(v[i] for v in notes["generations"].values()) for i in (0, 1)]
    return index_version(df, row_id, notes["fields"]) == totals


def compact_postings(spark: SparkSession, path: str, *, compression: str = "zstd") -> None:
    """Write all generations as one; readers of the old ones must have ended."""
    notes = _notes(spark, path)
    if len(notes["generations"]) < 2:
        return
    rows = _rows_of(read_postings(spark, path))
    whole = rows.groupBy("token", "field", "block").agg(F.array_sort(F.collect_set("at")).alias("at"))
    version = [sum(v[i] for v in notes["generations"].values()) for i in (0, 1)]
    name = f"c{version[0]}_{version[1] & ((1 << 64) - 1):016x}"
    _write(whole.select("token", "field", "block", _gaps(F.col("at")).alias("gaps")), f"{path}/{name}", notes["buckets"], compression)
    old = [g for g in notes["generations"] if g != name]
    write_notes(spark, path, {**notes, "generations": {name: version}})
    for generation in old:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{generation}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
