"""Jobs on request and statement logs: metric rollups, statement classes, affected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.functions.values import let
from sparkseries.model import SeriesError, col
from sparkseries.session import scratch_folder

# Rank errors of the published latency quantiles.
QUANTILE_ERRORS = {0.5: 0.05, 0.9: 0.01, 0.99: 0.001}
# Statement keywords by class.
QUERY_WORDS = ("SELECT", "SHOW", "EXPLAIN", "DESCRIBE", "DESC", "WITH")
COMMAND_WORDS = ("CREATE", "DROP", "ALTER", "UPDATE", "DELETE")
INSERT_WORD = "INSERT"

#: values up to which a bracket is ranked as a list; a larger one is narrowed first
_SMALL_GROUP = 20_000
_ACCURACY = 10_000
_PARTS = 100  # a bracket is cut into so many parts when it is narrowed


def quantile_name(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


def _levels(log: DataFrame, kind: str, database: str, latency: str) -> DataFrame:
    total = F.struct(F.lit(True).alias("is_total"), F.lit(None).cast("string").alias("database"))
    single = F.struct(F.lit(False).alias("is_total"), col(database).cast("string").alias("database"))
    return log.select(
        col(kind).alias("kind"), col(latency).cast("double").alias("latency"), F.inline(F.array(total, single))
    )


def metric_rollup(
    log: DataFrame,
    *,
    kind: str = "kind",
    database: str = "database",
    latency: str = "latency",
    quantiles: Sequence[float] = tuple(QUANTILE_ERRORS),
    approximate: bool = False,
) -> DataFrame:
    """Requests, latency sum and latency quantiles per kind, in total and per database.

    The default is exact with linear interpolation.  ``approximate`` reads the
    log once and keeps the rank error of each quantile below 0.0001.
    """
    if not quantiles or not all(0 <= q <= 1 for q in quantiles):
        raise SeriesError("quantiles must lie between 0 and 1")
    rows = _levels(log, kind, database, latency)
    keys = ["kind", "is_total", "database"]
    if approximate:
        picked = F.percentile_approx("latency", [float(q) for q in quantiles], _ACCURACY)
        result = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("requests"), F.sum("latency").alias("latency_sum"), picked.alias("__q")
        )
        named = [F.get("__q", F.lit(i)).alias(quantile_name(q)) for i, q in enumerate(quantiles)]
        return result.select(*keys, "requests", "latency_sum", *named)
    return _exact_rollup(rows, keys, quantiles)


def _exact_rollup(rows: DataFrame, keys: list[str], quantiles: Sequence[float]) -> DataFrame:
    """Exact quantiles without bringing a group into one task.

    A first pass brackets the wanted ranks of each quantile by approximate
    quantiles.  A bracket of more than ``_SMALL_GROUP`` values is narrowed by
    passes that count what lies below it, at its ends and inside; each pass
    leaves about a fiftieth of it.  The last pass counts the values below a
    bracket and, per distinct value, those inside it, so a hot value is one
    row.  Group statistics are a written table: Spark broadcasts it by its size.
    """
    margin = 3.0 / _ACCURACY
    probes = [p for q in quantiles for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count("latency").alias("n"),
        F.sum("latency").alias("latency_sum"),
        F.min("latency").alias("lo"),
        F.max("latency").alias("hi"),
        F.percentile_approx("latency", probes, _ACCURACY).alias("probes"),
    )
    small = F.col("n") <= max(_SMALL_GROUP, _ACCURACY)  # fewer ranks than the margins need
    brackets = []
    for i, q in enumerate(quantiles):
        position = F.lit(float(q)) * (F.col("n") - 1)
        brackets.append(
            F.struct(
                F.lit(i).alias("i"),
                F.floor(position).alias("a"),
                F.ceil(position).alias("b"),
                F.when(small, F.col("lo")).otherwise(F.get("probes", F.lit(2 * i))).alias("lo"),
                F.when(small, F.col("hi")).otherwise(F.get("probes", F.lit(2 * i + 1))).alias("hi"),
                F.when(small, F.col("n")).otherwise(F.ceil(F.col("n") * (2 * margin + 2.0 / _ACCURACY))).alias("size"),
            )
        )
    stats = stats.select(*(F.col(k).alias(f"__{k}") for k in keys), "requests", "n", "latency_sum", F.array(*brackets).alias("brackets"))
    stats = _written(stats)
    while (stats.agg(F.max(F.array_max(F.transform("brackets", lambda b: b["size"])))).first()[0] or 0) > _SMALL_GROUP:
        stats = _written(_narrowed(rows, stats, keys))
    group = [*(f"__{k}" for k in keys), "requests", "n", "latency_sum"]
    counted = _hits(rows, stats, keys, group).groupBy(*group, F.col("hit.i").alias("i"), F.col("hit.v").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    # the values below a bracket have a null value and come first
    lists = counted.groupBy(*group, "i").agg(F.array_sort(F.collect_list(F.struct("v", "c"))).alias("values"))
    picks = []
    for i, q in enumerate(quantiles):
        position = F.lit(float(q)) * (F.col("n") - 1)
        a, b = (_ranked(F.col("values"), r) for r in (F.floor(position), F.ceil(position)))
        missed = F.raise_error(F.lit("a quantile fell outside its bracket")).cast("double")
        exact = F.when(a.isNull() | b.isNull(), missed).otherwise(a + (b - a) * (position - F.floor(position)))
        picks.append(F.max(F.when((F.col("i") == i) & (F.col("n") > 0), exact)).alias(quantile_name(q)))
    picked = lists.groupBy(*group).agg(*picks)
    return picked.select(*(F.col(f"__{k}").alias(k) for k in keys), "requests", "latency_sum", *(quantile_name(q) for q in quantiles))


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared scratch folder, whose size Spark knows."""
    path = scratch_folder(df.sparkSession, "rollup")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hits(rows: DataFrame, stats: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """``hit`` (i, v) of each row and bracket: the value inside it, null for one below; rows outside all leave one empty hit."""
    joined = rows.join(stats, [rows[k].eqNullSafe(stats[f"__{k}"]) for k in keys])
    value = F.col("latency")
    hits = F.filter(
        F.transform(
            "brackets",
            lambda b: F.when(value < b["lo"], F.struct(b["i"].alias("i"), F.lit(None).cast("double").alias("v"))).when(
                value <= b["hi"], F.struct(b["i"].alias("i"), value.alias("v"))
            ),
        ),
        lambda hit: hit.isNotNull(),
    )
    return joined.select(*group, F.explode_outer(hits).alias("hit"))


def _ranked(values: Column, rank: Column) -> Column:
    """The value of a rank, from the sorted list of values and their counts."""
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(None).cast("double").alias("v"))
    return F.aggregate(
        values,
        start,
        lambda s, x: F.struct(
            (s["upto"] + x["c"]).alias("upto"), F.when((s["upto"] <= rank) & (rank < s["upto"] + x["c"]), x["v"]).otherwise(s["v"]).alias("v")
        ),
    )["v"]


def _narrowed(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """``stats`` with smaller brackets that hold the same ranks.

    Of a bracket the values at its ends are counted apart, so a hot value leaves
    it in one pass; what is between them is cut by approximate quantiles whose
    rank error is allowed for.
    """
    group = [f"__{k}" for k in keys]
    bounds = stats.select(*group, F.inline("brackets")).select(*group, *(F.col(c).alias(f"b_{c}") for c in ("i", "a", "b", "lo", "hi", "size")))
    grid = [j / _PARTS for j in range(_PARTS + 1)]
    hits = _hits(rows, stats, keys, [*group, "brackets"])
    v = F.col("hit.v")
    own = F.get("brackets", F.col("hit.i"))  # brackets lie in the order of i
    named = [F.col(g).alias(f"x{g}") for g in group]
    same = [F.col(g).eqNullSafe(F.col(f"x{g}")) for g in group]
    seen = hits.where(F.col("hit.i").isNotNull()).groupBy(*named, F.col("hit.i").alias("i")).agg(
        F.count_if(v.isNull()).alias("below"),
        F.count(v).alias("inside"),
        F.count_if(v == own["lo"]).alias("at_lo"),
        F.count_if(v == own["hi"]).alias("at_hi"),
        F.min(F.when(v > own["lo"], v)).alias("next"),
        F.max(F.when(v < own["hi"], v)).alias("last"),
        F.percentile_approx(v, grid, _ACCURACY).alias("cuts"),
    )
    both = bounds.join(seen, [*same, F.col("b_i") == F.col("i")], "left").drop(*(f"x{g}" for g in group))
    a, b, inside = F.col("b_a") - F.col("below"), F.col("b_b") - F.col("below"), F.col("inside")
    slack = 2.0 / _ACCURACY
    low_cut = F.get("cuts", F.floor((a / inside - slack) * _PARTS).cast("int"))
    high_cut = F.get("cuts", F.ceil(((b + 1) / inside + slack) * _PARTS).cast("int"))
    in_low, in_high = F.col("at_lo"), inside - F.col("at_hi")

    def bracket(lo: Column, hi: Column, size: Column) -> Column:
        return F.struct(F.col("b_i").alias("i"), F.col("b_a").alias("a"), F.col("b_b").alias("b"), lo.alias("lo"), hi.alias("hi"), size.cast("bigint").alias("size"))

    lo, hi, few = F.col("b_lo"), F.col("b_hi"), F.lit(2)
    between = bracket(F.greatest("next", low_cut), F.least("last", high_cut), F.ceil(inside * (3.0 / _PARTS)))
    smaller = (
        F.when(inside.isNull() | (F.col("b_size") <= _SMALL_GROUP), bracket(lo, hi, F.col("b_size")))
        .when(inside <= _SMALL_GROUP, bracket(lo, hi, inside))
        .when(b < in_low, bracket(lo, lo, few))
        .when(a >= in_high, bracket(hi, hi, few))
        .when(a < in_low, bracket(lo, F.col("next"), few))
        .when(b >= in_high, bracket(F.col("last"), hi, few))
        .otherwise(between)
    )
    lists = both.groupBy(*named).agg(F.array_sort(F.collect_list(smaller)).alias("brackets"))
    return stats.drop("brackets").join(lists, same).select(*stats.columns)


# --------------------------------------------------------------------------
# statements


def clean_statement(text: Column) -> Column:
    """Text without comments: all from the first ``--`` on, even inside quotes, and every closed ``/* */``."""
    head = F.regexp_replace(text, r"(?s)--.*+$", "")
    return F.trim(F.regexp_replace(head, r"(?s)/\*(?:/|.*?\*/)", " "))


def statement_class(text: Column) -> Column:
    """``Query``, ``Command``, ``Insert`` or ``Unknown`` by the first word after comments."""
    word = F.upper(F.regexp_extract(clean_statement(text), r"^\s*(\S+)", 1))
    return let(
        word,
        lambda w: F.when(w.isin(*QUERY_WORDS), "Query")
        .when(w.isin(*COMMAND_WORDS), "Command")
        .when(w == INSERT_WORD, "Insert")
        .otherwise("Unknown"),
    )


def affected_rows(text: Column, statement: Column) -> Column:
    """0 for queries, 1 for commands, and the number of point lines for inserts; null when unknown."""
    body = F.regexp_extract(text, r"(?is)^\s*insert(.*+)$", 1)
    lines = F.size(F.filter(F.split(body, "\n"), lambda line: F.length(F.trim(F.regexp_replace(line, r"\s+", " "))) > 0))
    return (
        F.when(statement == "Query", F.lit(0))
        .when(statement == "Command", F.lit(1))
        .when(statement == "Insert", lines)
        .cast("bigint")
    )


def classify_statements(log: DataFrame, text: str = "command") -> DataFrame:
    """Add ``class`` and ``affected_rows`` to a statement log."""
    classed = log.withColumn("class", statement_class(col(text)))
    return classed.withColumn("affected_rows", affected_rows(col(text), F.col("class")))


def statement_counts(log: DataFrame, text: str = "command") -> DataFrame:
    """(class, n, affected_rows) of a statement log."""
    return (
        classify_statements(log, text)
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("affected_rows"), F.lit(0)).alias("affected_rows"))
    )
