"""Helpers that the operators share: intermediate tables and whole-text input."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.session import scratch_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there.

    Lineage ends at the files, so a lost executor costs no more than the tasks
    it was running.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no later step reads."""
    spark = df.sparkSession
    roots = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for root in roots:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def raw_text(column: str) -> Column:
    """The text as bytes, empty for null; bytes need no valid encoding."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text in blocks of about ``size`` bytes, so that no text of any length becomes one list."""
    start, end = 0, len(data)
    while start < end:
        stop = min(end, start + size)
        while stop < end and data[stop] not in b" \t\n\v\f\r":
            stop += 1
        yield data[start:stop].split()
        start = stop


def give_back_memory() -> None:
    """Return freed memory to the system; a worker that waits for its next task then holds little beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
