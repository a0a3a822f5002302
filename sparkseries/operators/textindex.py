"""Full-text index over string fields: build, store, look up."""

from __future__ import annotations

import operator
import unicodedata
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.model import SeriesError, col
from sparkseries.sources.notes import read_notes, write_notes

BUCKET = "token_bucket"
_SEPARATORS = r"[^\p{L}\p{N}]+"


def tokens_of(text: Column) -> Column:
    """Distinct lower-case words of letters and digits of any script."""
    return F.filter(F.array_distinct(F.split(F.lower(text), _SEPARATORS)), lambda t: F.length(t) > 0)


def text_index(df: DataFrame, row_id: str, fields: Sequence[str]) -> DataFrame:
    """(token, field, row id), one row per distinct word of each text."""
    if not fields:
        raise SeriesError("empty index list")
    for name in fields:
        if not isinstance(df.schema[name].dataType, T.StringType):
            raise SeriesError(f"field {name!r} is not a string")
    entries = F.concat(*(_entries(name) for name in fields))
    return df.select(F.inline(entries), col(row_id).alias("row_id")).select("token", "field", "row_id")


def _entries(field: str) -> Column:
    words = F.coalesce(tokens_of(col(field)), F.array().cast("array<string>"))
    return F.transform(words, lambda t: F.struct(t.alias("token"), F.lit(field).alias("field")))


def write_text_index(index: DataFrame, path: str, *, buckets: int = 256, compression: str = "zstd") -> None:
    """Store an index by token bucket.

    The rebalance splits the bucket of a word that occurs in every text over
    many tasks and files; each file is sorted by token.  The number of buckets
    is stored beside the index.
    """
    bucketed = index.withColumn(BUCKET, F.pmod(F.xxhash64("token"), F.lit(buckets)))
    spread = bucketed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "token")
    spread.write.option("compression", compression).option("parquet.bloom.filter.enabled#token", "true").partitionBy(
        BUCKET
    ).parquet(path)
    write_notes(index.sparkSession, path, {"buckets": buckets})


def read_text_index(spark: SparkSession, path: str, tokens: str | Sequence[str]) -> DataFrame:
    """The index rows of some tokens; only their buckets are read."""
    wanted = query_tokens(tokens)
    buckets = read_notes(spark, path)["buckets"]
    bucket = [F.pmod(F.xxhash64(F.lit(t)), F.lit(buckets)) for t in wanted]
    index = spark.read.parquet(path)
    return index.where(F.col(BUCKET).isin(*bucket) & F.col("token").isin(*wanted)).drop(BUCKET)


def query_tokens(words: str | Sequence[str]) -> list[str]:
    """Distinct search words, cut as the index cuts texts."""
    texts = [words] if isinstance(words, str) else list(words)
    found = dict.fromkeys(t for w in texts for t in _words(w.lower()) if t)
    if not found:
        raise SeriesError("no word to search for")
    return list(found)


def _words(text: str) -> list[str]:
    return "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in text).split(" ")


def lookup(index: DataFrame, words: str | Sequence[str]) -> DataFrame:
    """Row ids with a field that holds all words."""
    wanted = query_tokens(words)
    # A set per row id holds search words only, so it is as long as the query at most.
    hits = index.where(F.col("token").isin(*wanted)).groupBy("row_id", "field")
    complete = hits.agg(F.collect_set("token").alias("seen")).where(F.size("seen") == len(wanted))
    return complete.select("row_id").distinct()


def search(df: DataFrame, index: DataFrame, row_id: str, words: str | Sequence[str]) -> DataFrame:
    """Rows of the table whose indexed text holds all words."""
    found = lookup(index, words)
    return df.join(found, df[row_id] == found["row_id"], "left_semi")


def search_texts(df: DataFrame, fields: Sequence[str], words: str | Sequence[str]) -> DataFrame:
    """Rows with a field that holds all words, found by reading the texts; no index and no shuffle.

    A plain substring test drops most texts before they are cut into words.
    """
    wanted = query_tokens(words)
    if not fields:
        raise SeriesError("no field to search")
    found = []
    for name in fields:
        text = F.lower(col(name))
        likely = reduce(operator.and_, [text.contains(w) for w in wanted])
        exact = F.size(F.array_intersect(tokens_of(col(name)), F.array(*(F.lit(w) for w in wanted)))) == len(wanted)
        found.append(F.coalesce(likely & exact, F.lit(False)))
    return df.where(reduce(operator.or_, found))
