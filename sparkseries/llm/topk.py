"""Exact top-k inner products: a ball tree per shard, searched by branch and bound."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.common import stored
from sparkseries.llm.vectors import best_rows, cells, compact, matrix, met, opened, packed, parts, sides, usable

_NONE = -(1 << 62)
#: a type of float holds all whole numbers below its bound
_EXACT = ((np.float32, float(1 << 24)), (np.float64, float(1 << 53)))


def ball_tree(ids: np.ndarray, points: np.ndarray, leaf: int) -> dict:
    """Nodes in preorder: centre, radius, row range, and the number of the node after the subtree.

    A node splits at the median along the line between two far points.  The
    rows of a leaf are sorted by id.
    """
    place = np.empty(len(ids), np.int64)
    nodes: list[list] = []

    def grow(rows: np.ndarray, start: int) -> None:
        x = points[rows].astype(np.float64)
        centre = x.mean(axis=0)
        apart = np.sqrt(((x - centre) ** 2).sum(axis=1))
        node = [centre, apart.max(), start, start + len(rows), 0]
        nodes.append(node)
        if len(rows) > leaf and node[1] > 0:
            far = x[apart.argmax()]
            line = x[((x - far) ** 2).sum(axis=1).argmax()] - far
            side = np.argsort(x @ line, kind="stable")
            half = len(rows) // 2
            grow(rows[side[:half]], start)
            grow(rows[side[half:]], start + half)
        else:
            place[start : start + len(rows)] = rows[np.argsort(ids[rows], kind="stable")]
        node[4] = len(nodes)

    grow(np.arange(len(ids)), 0)
    centre, radius, start, stop, after = (np.array(x) for x in zip(*nodes))
    return {"ids": ids[place], "points": points[place], "centre": centre, "radius": radius, "start": start, "stop": stop, "after": after}


def largest_number(x: np.ndarray) -> float:
    return max(float(x.max(initial=0)), -float(x.min(initial=0)))


def search_tree(tree: dict, ids: np.ndarray, points: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``k`` scores and ids in the tree for a block of queries, a query's own id left out.

    ``floor`` holds scores that each query's k-th best is known to reach.  A
    node's bound is the query times its centre plus the query's length times
    its radius; nodes are visited from the highest bound down, and a query
    skips a node whose bound lies below its k-th score so far.  Missing places
    hold the smallest number.
    """
    q = points.astype(np.float64)
    length = np.sqrt((q * q).sum(axis=1))
    bounds = q @ tree["centre"].T + length[:, None] * tree["radius"]
    slack = 1e-9 * (1.0 + length[:, None] * (np.sqrt((tree["centre"] ** 2).sum(axis=1)) + tree["radius"]))
    bounds += slack
    # a child cannot hold more than its parent's bound allows
    leaves, path = [], []
    for node in range(len(tree["radius"])):
        while path and path[-1][0] <= node:
            path.pop()
        bound = bounds[:, node] if not path else np.minimum(bounds[:, node], path[-1][1])
        if tree["after"][node] == node + 1:
            leaves.append((node, bound))
        path.append((tree["after"][node], bound))
    leaves.sort(key=lambda x: -x[1].mean())
    largest = largest_number(tree["points"]) * largest_number(points) * max(1, points.shape[1])
    kind = next((kind for kind, bound in _EXACT if largest < bound), np.int64)
    stored_points, asked = tree["points"].astype(kind), points.astype(kind)
    scores = np.full((len(ids), k), _NONE)
    found = np.full((len(ids), k), np.iinfo(np.int64).max)
    known = floor.copy()
    for node, bound in leaves:
        active = np.flatnonzero(bound >= known)
        if not len(active):
            continue
        rows = slice(tree["start"][node], tree["stop"][node])
        new = (asked[active] if len(active) < len(asked) else asked) @ stored_points[rows].T
        better = new.max(axis=1) >= known[active]
        active, new = active[better], new[better].astype(np.int64)
        if len(active):
            there = np.broadcast_to(tree["ids"][rows], new.shape)
            new = np.where(there == ids[active, None], _NONE, new)
            scores[active], found[active] = best_rows(
                np.concatenate([scores[active], new], axis=1), np.concatenate([found[active], there], axis=1), k
            )
            known[active] = np.maximum(known[active], scores[active, -1])
    return scores, found


def _tree_of(leaf: int):
    def build(rows: pa.Table) -> dict:
        tree = ball_tree(rows["id"].to_numpy(), matrix(rows["vector"], np.int64), leaf)
        return {**tree, "points": compact(tree["points"])}

    return build


def _block_of(rows: pa.Table) -> dict:
    ids = rows["id"].to_numpy()
    return {"ids": ids, "points": compact(matrix(rows["vector"], np.int64)), "floor": np.full(len(ids), _NONE)}


def _seeded(k: int):
    """Each block with the k-th scores of one shard as its floors."""

    def run(batches):
        for batch in batches:
            bodies = []
            for block, tree in opened([batch]):
                scores, _ = search_tree(tree, block["ids"], block["points"], block["floor"], k)
                bodies.append(pickle.dumps({**block, "floor": scores[:, -1]}, protocol=5))
            yield pa.RecordBatch.from_arrays(
                [batch.column("dim"), batch.column("block"), pa.array(bodies, pa.binary())], names=["dim", "part", "body"]
            )

    return run


def _searched(k: int):
    def run(batches):
        for blocks, trees in met(batches):
            best = [np.full((len(block["ids"]), k), _NONE) for block in blocks]
            whose = [np.full(scores.shape, np.iinfo(np.int64).max) for scores in best]
            for tree in trees:
                for block, scores, found in zip(blocks, best, whose):
                    new, there = search_tree(tree, block["ids"], block["points"], block["floor"], k)
                    more = np.flatnonzero(new[:, 0] > _NONE)
                    if len(more):
                        scores[more], found[more] = best_rows(
                            np.concatenate([scores[more], new[more]], axis=1), np.concatenate([found[more], there[more]], axis=1), k
                        )
                        block["floor"] = np.maximum(block["floor"], scores[:, -1])
            for block, scores, found in zip(blocks, best, whose):
                row, column = np.nonzero(scores > _NONE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["ids"][row]), pa.array(found[row, column]), pa.array(scores[row, column])],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    shard_rows: int = 4096,
    block_rows: int = 1024,
    leaf: int = 64,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner products of every query row.

    Components become ``floor(scale * x)`` in double precision.  Queries are the
    rows for which the column ``is_query`` holds; candidates are all rows but
    those of the query's own id.  Ties go to the smaller id; fewer candidates
    give fewer rows.  Vectors that are null or empty or hold a null or
    non-finite component, and rows without an id, take no part.  Vectors meet
    those of equal length only.  A repeated row counts once.  Other columns are
    not read, whatever their names.  An empty table gives an empty result.

    Scale: rows are dealt to shards by the hash of their id, so no value is hot.
    Each shard becomes one row with its tree, each block of queries one row.
    Blocks first search one shard; the k-th scores found there are the floors
    with which all others prune.  Then bands of blocks and columns of shards
    meet in cells, one task each, where the floors rise from shard to shard; so
    neither a copy for each pair nor a table sent to the driver grows with the
    pairs.
    """
    x = F.transform(F.col(vector_col), lambda v: F.floor(v.cast("double") * scale))
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = stored(rows.select(F.col(id_col).cast("long").alias("id"), x.alias("vector"), is_query.alias("asked")).distinct(), "topk-vectors")
    asked = rows.where("asked")
    n, n_asked, longest = rows.agg(F.count("*"), F.count_if("asked"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    shards, blocks = parts(n, shard_rows), parts(n_asked, block_rows)
    trees = packed(rows, shards, _tree_of(leaf))
    queries = packed(asked, blocks, _block_of, salt=1)
    home = queries.withColumnRenamed("part", "block").withColumn("part", F.col("block") % shards)
    first = trees.where(F.col("part") < blocks).withColumnRenamed("body", "shard").hint("merge")
    seeds = home.withColumnRenamed("body", "queries").join(first, ["dim", "part"], "left")
    seeded = stored(
        seeds.where("shard IS NOT NULL").select("dim", "block", "queries", "shard").mapInArrow(_seeded(k), "dim int, part int, body binary")
        .union(seeds.where("shard IS NULL").select("dim", F.col("block").alias("part"), F.col("queries").alias("body"))),
        "topk-seeds",
    )
    found = cells(seeded, trees, *sides(n, n_asked, longest, shards)).mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
