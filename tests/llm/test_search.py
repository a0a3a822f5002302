from __future__ import annotations

import math
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sparkseries.llm.ann import footrule, inverted_files, nearest
from sparkseries.llm.topk import ball_tree, search_tree, top_k
from sparkseries.llm.vectors import cells, compact, met, sides

NAN, INF = float("nan"), float("inf")


def is_query():
    return F.col("vec_id") % 5 == 0


def vectors(seed, n=300, dim=8, hot=60):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=dim))]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(hot)]  # one very common vector
    rows += [rows[3], rows[5]]  # repeated rows
    rows += [(2000, None), (2005, []), (2010, [NAN] * dim), (2015, [INF] + [0.0] * (dim - 1)), (2020, [None] * dim), (None, rows[1][1])]
    rows += [(2025, [0.0] * dim), (2030, [1.0, 2.0]), (2035, [2.0, 1.0])]
    return rows


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k, score):
    own = {(i, tuple(v)) for i, v in rows if i is not None and usable(v)}
    out = []
    for q, a in own:
        if q % 5 == 0:
            found = sorted(((-score(a, b), i) for i, b in own if i != q and len(a) == len(b)))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(found)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, vector string")


def whole(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


@pytest.mark.parametrize("shard_rows,block_rows,leaf", [(4096, 1024, 64), (40, 9, 4)])
def test_top_k_is_exact(spark, shard_rows, block_rows, leaf):
    rows = vectors(1)
    got = top_k(table(spark, rows), is_query(), 5, shard_rows=shard_rows, block_rows=block_rows, leaf=leaf)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, whole)


def test_search_skips_nodes_below_the_known_score():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-5, 5, (400, 3)) + c for c in ([300, 0, 0], [-300, 0, 0], [0, 300, 0])])
    tree = ball_tree(np.arange(1200), points, 16)
    assert (np.sqrt(((tree["points"][tree["start"][3] : tree["stop"][3]] - tree["centre"][3]) ** 2).sum(1)) <= tree["radius"][3] + 1e-9).all()
    asked = np.array([[1, 0, 0]])
    scores, _ = search_tree(tree, np.array([-1]), asked, np.array([10**9]), 5)
    assert (scores < 0).all()  # nothing reaches the floor, so nothing was looked at
    scores, ids = search_tree(tree, np.array([-1]), asked, np.array([-(10**9)]), 5)
    assert scores[0].tolist() == sorted((points @ asked[0]).tolist(), reverse=True)[:5]


def test_footrule_from_posts():
    rng = random.Random(5)
    prefixes = np.array([rng.sample(range(12), 5) for _ in range(30)])
    starts, rows, places = inverted_files(prefixes, 12)
    far = footrule({"ids": np.arange(30), "starts": starts, "rows": rows, "places": places}, prefixes[7])
    for i, p in enumerate(prefixes.tolist()):
        q = prefixes[7].tolist()
        assert far[i] == sum(abs((p.index(x) if x in p else 5) - (q.index(x) if x in q else 5)) for x in set(p) | set(q))


def cosine(a, b):
    if not any(a) or not any(b):
        return -9.0
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


@pytest.mark.parametrize("hot", [0, 150])
def test_nearest_recall_and_scores(spark, hot):
    rows = vectors(2, n=600, hot=hot)
    got = {}
    for r in nearest(table(spark, rows), is_query(), 5, shard_rows=200, block_rows=16, pivots=32, prefix=16, least=60).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    vector = {i: v for i, v in rows}
    want = {}
    for q, rank, i, s in brute([(i, v) for i, v in rows if v is None or any(x != 0 for x in v)], 5, cosine):
        want.setdefault(q, []).append((rank, i, s))
    assert got.keys() == want.keys()
    hits = total = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert all(abs(s - cosine(vector[q], vector[i])) < 1e-12 for _, i, s in found)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(found, found[1:]))
        worst = min(s for _, _, s in want[q])
        hits += sum(s >= worst - 1e-9 for _, _, s in found)
        total += len(want[q])
    assert hits >= 0.95 * total


def test_empty_tables(spark):
    assert top_k(table(spark, []), is_query()).count() == 0
    assert nearest(table(spark, []), is_query()).count() == 0


def broadcast(df):
    """What a plan sends to the driver and from there to all tasks: a text for each broadcast."""
    out, inside = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            out[-1] += line
        else:
            inside = None
            if "BroadcastExchange" in line:
                inside = depth
                out.append(line)
    return out


def test_nearest_sends_no_copies_of_query_blocks_to_the_driver(spark):
    # 60 queries for 36 shards: a small table whose copies are many times its size
    found = nearest(table(spark, vectors(6)), is_query(), 5, shard_rows=10, block_rows=20)
    assert not [x for x in broadcast(found) if "body" in x or "explode" in x.lower()]


def test_top_k_sends_no_query_block_or_shard_to_the_driver(spark):
    found = top_k(table(spark, vectors(7)), is_query(), 5, shard_rows=10, block_rows=20)
    assert not [x for x in broadcast(found) if "body" in x or "explode" in x.lower()]


@pytest.mark.parametrize("size", [1, 2**14, 2**29])
def test_search_is_exact_for_numbers_of_each_type(size):
    rng = np.random.default_rng(8)
    points = rng.integers(-size, size + 1, (200, 4))
    points[0] = -size
    for p in (points, compact(points)):
        scores, _ = search_tree(ball_tree(np.arange(200), p, 16), np.full(9, -1), p[:9], np.full(9, -(1 << 62)), 3)
        assert scores.tolist() == [sorted((points @ q).tolist(), reverse=True)[:3] for q in points[:9]]


def test_each_block_meets_each_shard_once(spark):
    def bodies(parts):
        return spark.createDataFrame([(d, p, bytearray(pickle.dumps((d, p)))) for d, n in parts for p in range(n)], "dim int, part int, body binary")

    def run(batches):
        for blocks, shards in met(batches):
            pairs = [(b[0], b[1], s[0], s[1]) for s in shards for b in blocks]
            if pairs:  # vectors of a length may be asked for where none are stored
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in zip(*pairs)], names=["d", "b", "e", "s"])

    blocks, shards = bodies([(2, 5), (3, 1), (4, 2)]), bodies([(2, 7), (3, 2), (5, 3)])
    for bands, columns in ((1, 1), (2, 3), (7, 7)):
        pairs = cells(blocks, shards, bands, columns).mapInArrow(run, "d int, b int, e int, s int").collect()
        assert sorted(map(tuple, pairs)) == sorted([(2, b, 2, s) for b in range(5) for s in range(7)] + [(3, 0, 3, s) for s in range(2)])


def test_copies_of_queries_follow_the_size_of_the_vectors():
    # a fiftieth of the rows are queries; rows moved for each row of the table
    for rows in (10**4, 10**6, 10**7):
        bands, columns = sides(rows, rows // 50, 64, -(-rows // 4096))
        assert bands + columns / 50 <= 2 * bands and bands == -(-rows // 50 * 64 // 2**22)
    assert sides(0, 0, 0, 1) == (1, 1)


def test_compact_keeps_each_number():
    for x in ([0, 255], [-128, 127], [-129, 5], [2**40, -1], [2**62, 2**63 - 1], []):
        assert compact(np.array(x, np.int64)).astype(np.int64).tolist() == x
    assert compact(np.array([0.5, -3.0])).dtype == np.float32
    assert compact(np.array([0.1, 1e300])).tolist() == [0.1, 1e300]
