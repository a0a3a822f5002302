"""Result documents: JSON in, flat rows out; and rows in, series documents out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.timefns import epoch_ns, floor_div, to_precision
from sparkseries.model import SeriesError, col
from sparkseries.plans.paging import RANK, with_rank

_SERIES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("values", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)
DOCUMENT = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType([T.StructField("series", T.ArrayType(_SERIES)), T.StructField("error", T.StringType())])
            ),
        ),
        T.StructField("error", T.StringType()),
    ]
)


def parse_documents(df: DataFrame, text: str = "value") -> DataFrame:
    """Add ``document`` (null for text that is no JSON object) and ``error`` (null when there is none)."""
    # A generator of one row keeps filters on the document above the parsing.
    document = F.explode(F.array(F.from_json(col(text), DOCUMENT))).alias("document")
    parsed = df.select(*(col(c) for c in df.columns), document)
    return parsed.withColumn("error", document_error(F.col("document")))


def document_error(document: Column) -> Column:
    """The top error of a document, else the first error of its results."""
    named = F.filter(document["results"]["error"], lambda e: F.length(e) > 0)
    return F.coalesce(F.nullif(document["error"], F.lit("")), F.get(named, F.lit(0)))


def document_rows(df: DataFrame, text: str = "value", *, fail: bool = False) -> DataFrame:
    """One row per value row: ``result_no, series_no, row_no, name, tags, values`` (column to text).

    Documents with an error give no rows.  With ``fail`` one job looks for
    errors and texts that are no documents first, and the first one found is
    raised.
    """
    parsed = parse_documents(df, text)
    if fail:
        problem = F.when(F.col("document").isNull(), "not a result document").otherwise(F.col("error"))
        found = parsed.select(problem.alias("problem")).where(F.col("problem").isNotNull()).limit(1).collect()
        if found:
            raise SeriesError(found[0]["problem"])
    parsed = parsed.where(F.col("error").isNull())
    kept = [col(c) for c in df.columns if c != text]
    results = parsed.select(*kept, F.posexplode("document.results").alias("result_no", "__result"))
    series = results.select(*kept, "result_no", F.posexplode("__result.series").alias("series_no", "__series"))
    rows = series.select(
        *kept, "result_no", "series_no",
        F.col("__series.name").alias("name"),
        F.coalesce("__series.tags", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("tags"),
        F.col("__series.columns").alias("columns"),
        F.posexplode("__series.values").alias("row_no", "__row"),
    )
    return rows.withColumn("values", F.map_from_arrays("columns", "__row")).drop("columns", "__row")


def series_documents(
    df: DataFrame,
    name: str,
    *,
    time: str,
    tags: Sequence[str] = (),
    columns: Sequence[str] = (),
    ties: Sequence[str] = (),
    precision: str = "rfc3339",
    chunk_rows: int = 10_000,
) -> DataFrame:
    """JSON series documents with the values of one tag set in time order.

    Gives the tags, ``chunk`` (from 0), ``row_count`` and ``document``.  A
    series longer than ``chunk_rows`` is spread over several documents, so that
    no row of the result grows with the data.
    """
    if chunk_rows <= 0:
        raise SeriesError("chunk_rows must be positive")
    if not columns:
        raise SeriesError("no columns")
    ranked = with_rank(df, time=time, ties=ties, series=tags)
    stamp = to_precision(epoch_ns(df, time), precision)
    values = F.to_json(F.array(*(v.cast("variant") for v in [stamp, *(col(c) for c in columns)])))
    keyed = ranked.select(
        *(col(t).cast("string").alias(t) for t in tags),
        floor_div((F.col(RANK) - 1).cast("bigint"), chunk_rows).alias("chunk"),
        F.struct(F.col(RANK).alias("n"), values.alias("v")).alias("row"),
    )
    # At most chunk_rows rows meet in one group.
    chunks = keyed.groupBy(*(col(t) for t in tags), "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    tag_map = F.map_filter(
        F.map_from_arrays(F.array(*(F.lit(t) for t in tags)), F.array(*(col(t) for t in tags))), lambda k, v: v.isNotNull()
    ) if tags else None
    header = [F.lit(name).alias("name"), *([tag_map.alias("tags")] if tags else []),
              F.array(*(F.lit(c) for c in ["time", *columns])).alias("columns")]
    body = F.array_join(F.transform("rows", lambda r: r["v"]), ",")
    head = F.to_json(F.struct(*header))
    document = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"values":['), body, F.lit("]}"))
    return chunks.select(*(col(t) for t in tags), "chunk", F.size("rows").cast("bigint").alias("row_count"), document.alias("document"))


def result_documents(series: DataFrame, document: str = "document") -> DataFrame:
    """Wrap each series document as a result document."""
    wrapped = F.concat(F.lit('{"results":[{"series":['), col(document), F.lit("]}]}"))
    return series.withColumn(document, wrapped)
