"""Approximate nearest neighbours: a permutation index over pivots, posted in inverted files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from sparkseries.llm.common import forget, stored
from sparkseries.llm.vectors import cells, compact, matrix, met, one_array, packed, parts, sides, usable


def permutation_prefix(unit: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the ``length`` nearest pivots of each unit vector, nearest first."""
    near = unit @ pivots.T
    if length < near.shape[1]:
        some = np.argpartition(-near, length - 1, axis=1)[:, :length]
    else:
        some = np.broadcast_to(np.arange(near.shape[1]), near.shape)
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    # by the largest component first, so that no square overflows
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def inverted_files(prefixes: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pivot the rows that have it in their prefix, and its place there: starts, rows, places."""
    rows, length = prefixes.shape
    flat = prefixes.ravel()
    order = np.argsort(flat, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=n_pivots))])
    return starts, order // length, (order % length).astype(np.int32)


def savings(index: dict, length: int) -> np.ndarray:
    """The files of a shard as one line for each pivot: ``length`` less the place where a row has it, 0 where it has not."""
    starts = index["starts"]
    lines = np.zeros((len(starts) - 1, len(index["ids"])), np.min_scalar_type(length))
    lines[np.repeat(np.arange(len(lines)), np.diff(starts)), index["rows"]] = length - index["places"]
    return lines


def footrule(index: dict, prefix: np.ndarray) -> np.ndarray:
    """Footrule distance of one prefix to all rows of a shard, from the posts of its pivots alone.

    A pivot absent from a prefix stands at place ``length``; the sum over both
    prefixes is ``length * (length + 1)`` less what shared pivots save: twice the
    lesser of what the two places leave to ``length``.
    """
    length = len(prefix)
    lines = index["lines"] if "lines" in index else savings(index, length)
    own = (length - np.arange(length)).astype(lines.dtype)
    saved = np.minimum(lines[prefix], own[:, None]).sum(axis=0, dtype=np.min_scalar_type(length * (length + 1)))
    return length * (length + 1) - 2 * saved.astype(np.int32)


def _index_of(pivots: dict[int, np.ndarray], prefix: int):
    def build(rows: pa.Table) -> dict:
        points = matrix(rows["vector"], np.float64)
        near = pivots[points.shape[1]]
        perms = permutation_prefix(unit_rows(points), near, min(prefix, len(near)))
        members = one_array(rows["members"])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(members).to_numpy())])
        return {"points": compact(points), "perms": compact(perms), "pivots": len(near), "members": members.flatten().to_numpy(), "ends": ends}

    return build


def _posted(shard: dict) -> dict:
    """A shard with its inverted files, which are made again in each task from the lists, a tenth of their size."""
    points = shard["points"].astype(np.float64)
    starts, rows, places = inverted_files(shard["perms"], shard["pivots"])
    posts = {"ids": shard["members"][shard["ends"][:-1]], "starts": starts, "rows": rows, "places": places}
    lines = savings(posts, shard["perms"].shape[1])
    return {**posts, "lines": lines, "points": points, "lengths": lengths(points), "members": shard["members"], "ends": shard["ends"]}


def _block_of(pivots: dict[int, np.ndarray], prefix: int):
    def build(rows: pa.Table) -> dict:
        points = matrix(rows["vector"], np.float64)
        near = pivots[points.shape[1]]
        perms = permutation_prefix(unit_rows(points), near, min(prefix, len(near)))
        return {"ids": rows["id"].to_numpy(), "points": compact(points), "perms": compact(perms)}

    return build


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def cosine(q: np.ndarray, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows of known lengths, in double precision."""
    return (x @ q) / (length * np.sqrt((q * q).sum()))


def _searched(k: int, share: float, least: int, close: float):
    def run(batches):
        for blocks, shards in met(batches):
            best: list[list[list]] = [[[] for _ in block["ids"]] for block in blocks]
            for index in map(_posted, shards):
                n = len(index["ids"])
                reranked = min(n, max(least, int(np.ceil(share * n))))
                members, ends = index["members"], index["ends"]
                for block, held in zip(blocks, best):
                    for at, (q, perm) in enumerate(zip(block["points"], block["perms"])):
                        far = footrule(index, perm)
                        edge = np.partition(far, reranked - 1)[reranked - 1]
                        some = np.flatnonzero(far <= max(edge, close * len(perm) * (len(perm) + 1)))
                        scores = cosine(q.astype(np.float64), index["points"].take(some, axis=0), index["lengths"][some])
                        if len(held[at]) == k:
                            top = np.flatnonzero(scores >= -held[at][-1][0])
                            some, scores = some[top], scores[top]
                        if len(some) > k:
                            top = np.flatnonzero(scores >= np.partition(scores, len(some) - k)[len(some) - k])
                            some, scores = some[top], scores[top]
                        ids = [(-s, v) for s, i in zip(scores.tolist(), some.tolist()) for v in members[ends[i] : ends[i + 1]].tolist()]
                        if ids:
                            held[at] = sorted(held[at] + ids)[:k]
            for block, held in zip(blocks, best):
                found = [(query, v, -s) for query, own in zip(block["ids"].tolist(), held) for s, v in own]
                columns = zip(*found) if found else ([], [], [])
                arrays = [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["class", "vec_id", "score"])

    return run


def spread(unit: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the rows, each the one farthest from those before it; a dense group gives few of them."""
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def choose_pivots(classes: DataFrame, n: int, sample: int) -> dict[int, np.ndarray]:
    """``n`` pivots of each length, spread out over ``sample`` distinct vectors of the smallest hashes."""
    first = Window.partitionBy(F.size("vector")).orderBy(F.xxhash64(F.col("vector").cast("array<double>")), "id")
    rows = classes.withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample)
    by: dict[int, list] = {}
    for row in rows.orderBy("place").select("vector").collect():
        by.setdefault(len(row.vector), []).append(row.vector)
    return {dim: spread(unit_rows(np.array(x, np.float64)), n) for dim, x in by.items()}


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = 256,
    sample: int = 2048,
    prefix: int = 64,
    share: float = 0.25,
    least: int = 256,
    close: float = 0.3,
    shard_rows: int = 4096,
    block_rows: int = 256,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: about the ``k`` nearest rows by cosine to every query row.

    Each vector is the list of its ``prefix`` nearest of ``pivots`` pivots,
    which are spread out over a ``sample`` of distinct vectors; that sample is
    all that the index is fitted on, and every row is posted.  In each shard the
    lists are posted in one inverted file per pivot.  A query reads the files
    of its own pivots, ranks the rows by footrule distance, and the nearest
    ``share`` of the shard (at least ``least`` rows, all ties included) is
    scored by exact cosine in double precision on the original vectors; so is
    every row within ``close`` of the largest footrule distance, so that a
    dense group is scored whole, however large it is.  Queries are the rows for
    which the column ``is_query`` holds; candidates are all rows but those of
    the query's own id.  Ties go to the smaller id; fewer candidates give fewer
    rows.  Vectors that are null, empty or zero, or hold a null or non-finite
    component, and rows without an id, take no part.  Vectors meet those of
    equal length only.  A repeated row counts once.  Other columns are not
    read, whatever their names.  An empty table gives an empty result.

    Scale: equal vectors are one class, found by an aggregate; a class carries
    its ``k + 1`` smallest ids, which is all that any result can name, and is
    searched once for all its queries.  So a vector that a third of all rows
    share is one row of one shard.  Classes are dealt to shards by hash.  Bands
    of queries and columns of shards meet in cells, one task each, so neither a
    copy for each pair nor a table sent to the driver grows with the pairs.
    """
    fine = usable(F.col(vector_col)) & F.col(id_col).isNotNull()
    given = vectors.select(vector_col).schema[0].dataType
    kind = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    rows = vectors.where(fine).select(
        F.col(id_col).cast("long").alias("id"), F.transform(F.col(vector_col), lambda v: v.cast(kind)).alias("vector"), is_query.alias("asked")
    )
    rows = rows.where(F.exists("vector", lambda v: v != 0))
    few = Window.partitionBy("vector").orderBy("id")
    distinct = rows.select("id", "vector").distinct()
    members = distinct.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    classes = stored(
        members.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("members")), "ann-classes"
    )
    asked = stored(
        rows.where("asked").select(F.col("id").alias("query_id"), "vector").distinct().join(classes.select("vector", F.col("id").alias("class")), "vector").select("query_id", "class"),
        "ann-queries",
    )
    chosen = choose_pivots(classes, pivots, sample)
    queries = asked.select(F.col("class").alias("id")).distinct().join(classes, "id").select("id", "vector")
    n, longest = classes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    n_asked = asked.select("class").distinct().count()
    shards = parts(n, shard_rows)
    index = packed(classes, shards, _index_of(chosen, prefix))
    wanted = packed(queries, parts(n_asked, block_rows), _block_of(chosen, prefix), salt=1)
    forget(classes)
    dealt = cells(wanted, index, *sides(n, n_asked, longest, shards))
    found = dealt.mapInArrow(_searched(k + 1, share, least, close), "class long, vec_id long, score double")
    by_class = Window.partitionBy("class").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= k + 1).drop("place")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        asked.join(best, "class")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
