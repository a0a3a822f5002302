"""Searches of vector tables in cells: one row per shard of vectors, one per block of queries."""

from __future__ import annotations

import pickle
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.common import stored


def usable(vector: Column) -> Column:
    """Neither null nor empty, and no component null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def one_array(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole


def matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    lists = one_array(column)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(lists), -1)


def compact(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds each of them."""
    if x.dtype.kind == "i":
        fits = (t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= x.min(initial=0) and x.max(initial=0) <= np.iinfo(t).max)
        return x.astype(next(fits, x.dtype))
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return single if (single == x).all() else x


def parts(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def packed(df: DataFrame, parts_: int, build, salt: int = 0) -> DataFrame:
    """``(dim, part, body)``: rows of equally long vectors dealt by the hash of ``id`` and built into one binary each.

    A part has a bounded number of rows whatever the table holds, because ids
    are unique here and their hash is even.
    """

    def run(rows: pa.Table) -> pa.Table:
        body = pickle.dumps(build(rows), protocol=5)
        return pa.table({"dim": rows["dim"][:1], "part": rows["part"][:1], "body": pa.array([body], pa.binary())})

    dealt = df.withColumn("dim", F.size("vector")).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts_)).cast("int")
    )
    return stored(dealt.groupBy("dim", "part").applyInArrow(run, "dim int, part int, body binary"), "vector-parts")


def opened(batches):
    """``(queries, shard)`` of each row, unpacked; a shard that several rows on end use is unpacked once."""
    for batch in batches:
        last, shard = None, None
        for queries, body in zip(batch.column("queries"), batch.column("shard")):
            raw = body.as_buffer()
            if last is None or not raw.equals(last):
                last, shard = raw, pickle.loads(raw)
            yield pickle.loads(queries.as_buffer()), shard


def sides(rows: int, asked: int, longest: int, shard_parts: int, values: int = 1 << 22) -> tuple[int, int]:
    """Numbers of bands of query blocks and of columns of shards.

    A band has about ``values`` components, which a task holds at once.  There
    are as many columns as make the copies of queries weigh what the copies of
    shards do, so both together stay near twice the vectors for each band.
    """
    bands = parts(asked * longest, values)
    return bands, min(shard_parts, max(1, bands * rows // max(1, asked)))


def cells(blocks: DataFrame, shards: DataFrame, bands: int, columns: int) -> DataFrame:
    """``(dim, band, column, sharded, part, body)``: each band of query blocks, then the shards of each column, in a task.

    Bodies go straight to the task of their cell: a join might take a table of
    many copies for a small one and send it whole to the driver.
    """
    other = {"band": F.explode(F.sequence(F.lit(0), F.lit(bands - 1))), "column": F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))}
    band, column = (F.col("part") % n for n in (bands, columns))
    asked = blocks.select("dim", band.alias("band"), other["column"].alias("column"), F.lit(False).alias("sharded"), "part", "body")
    there = shards.select("dim", other["band"].alias("band"), column.alias("column"), F.lit(True).alias("sharded"), "part", "body")
    cell = F.pmod(F.col("dim") + F.col("band") * columns + F.col("column"), F.lit(bands * columns)).cast("int")
    dealt = asked.union(there).repartitionById(bands * columns, cell)
    return dealt.sortWithinPartitions("dim", "band", "column", "sharded", "part")


def met(batches):
    """``(blocks, shards)`` of each cell: its query blocks, unpacked, and an iterator that unpacks one shard after the other."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("dim", "band", "column", "sharded")), batch.column("body")))
    for _, cell in groupby(rows, key=lambda row: row[:3]):
        blocks, first = [], []
        for *_, sharded, body in cell:
            if sharded:
                first.append(body)
                break
            blocks.append(pickle.loads(body.as_buffer()))
        if blocks:
            yield blocks, (pickle.loads(body.as_buffer()) for body in chain(first, (row[-1] for row in cell)))


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row: highest score first, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
