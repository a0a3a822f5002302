"""Balanced shards by minimax contiguous partition over ordered groups of equal texts.

The smallest capacity is found by binary search on the driver, over sums of key
ranges; Spark sums finer ranges only where a cut may fall.  The driver never
holds more than a fixed number of sums.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.common import raw_text, stored

_FIRST, _STEP = 3, 2  # hexadecimal digits of the first key ranges, and how many more a finer range has
_FINER = 64  # ranges that are divided in a round
_BUCKETS = 4096  # parts of a shard that number their rows by themselves


def greedy(ends: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Positions up to which each shard is filled, cutting only at ``ends``; the last is the total if ``capacity`` is enough."""
    at, out = 0, []
    for _ in range(shards):
        i = int(np.searchsorted(ends, at + capacity, side="right")) - 1
        at = max(at, int(ends[i])) if i >= 0 else at
        out.append(at)
    return out


def smallest(low: int, high: int, enough) -> int:
    """The smallest capacity from ``low`` to ``high`` that is enough."""
    return bisect_left(range(low, high), True, key=enough) + low


class Ranges:
    """Sums of bytes over key ranges in order; ``single`` marks ranges that hold one group and cannot be cut."""

    def __init__(self, rows: list[tuple[str, int, int]], shards: int):
        rows = sorted(rows)
        self.keys = [r[0] for r in rows]
        self.ends = np.cumsum([r[1] for r in rows], dtype=np.int64)
        self.single = np.array([r[2] == 1 for r in rows], bool)
        self.rows, self.shards, self.total = rows, shards, int(self.ends[-1])

    def divided(self, capacity: int) -> list[int]:
        """Greedy positions if all but single groups could be cut anywhere; no true cut lies further on."""
        at, out = 0, []
        for _ in range(self.shards):
            to = min(at + capacity, self.total)
            i = int(np.searchsorted(self.ends, to, side="right"))
            before = int(self.ends[i - 1]) if i else 0
            at = max(at, before) if i < len(self.ends) and self.single[i] else to
            out.append(at)
        return out

    def solve(self) -> tuple[int, list[int]]:
        """The smallest capacity with cuts between ranges, and the ranges that must be divided before it is known to be the smallest."""
        least = -(-self.total // self.shards)
        high = smallest(least, self.total, lambda c: greedy(self.ends, c, self.shards)[-1] == self.total)
        low = smallest(least, high, lambda c: self.divided(c)[-1] == self.total)
        starts = np.r_[0, self.ends[:-1]]
        open_ = np.zeros(len(self.ends), bool)
        for first, last in zip(greedy(self.ends, low, self.shards), self.divided(high)):
            open_ |= (starts < last) & (self.ends > first) & ~self.single
        # the largest first: one that exceeds the capacity hides where later cuts fall
        found = np.flatnonzero(open_)
        sizes = self.ends - starts
        return high, found[np.argsort(-sizes[found], kind="stable")][:_FINER].tolist()

    def cuts(self, capacity: int) -> list[str]:
        """The first key of every shard but the first, all within ``capacity`` and as even as it allows.

        From a start that the rest can be reached from, a shard ends as near as
        can be to an equal part of what is left, but no later than ``capacity``
        permits and no earlier than the shards after it need.
        """
        ends = np.r_[0, self.ends]
        need = [self.total]
        for _ in range(self.shards - 1):  # earliest start from which the shards after it hold the rest
            need.append(int(ends[np.searchsorted(ends, need[-1] - capacity, side="left")]))
        at, out = 0, []
        for left in range(self.shards - 1, 0, -1):
            furthest = int(ends[np.searchsorted(ends, at + capacity, side="right") - 1])
            wish = at + (self.total - at) / (left + 1)
            i = int(np.searchsorted(ends, wish))
            near = min((int(ends[j]) for j in (i - 1, i) if 0 <= j < len(ends)), key=lambda e: abs(e - wish))
            at = min(max(near, need[left]), furthest)
            out.append(at)
        return [self.keys[int(np.searchsorted(self.ends, at, side="right"))] for at in out if at < self.total]


def large_groups(sizes: list[tuple[str, int]], total: int, shards: int) -> list[str]:
    """Keys, largest first, of groups that exceed an equal part of what the larger ones leave; each has a shard of its own."""
    out: list[str] = []
    for key, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if shards == len(out) or size * (shards - len(out)) <= total:
            break
        out.append(key)
        total -= size
    return out


def _range_sums(groups: DataFrame, digits: int) -> list[tuple[str, int, int]]:
    sums = groups.groupBy(F.substring("key", 1, digits).alias("range")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    return [(r["range"], r.bytes, r.n) for r in sums.collect()]


def cut_keys(groups: DataFrame, shards: int) -> list[str]:
    """First keys of all shards but the first, for ``groups`` (key, bytes) in the order of their hexadecimal keys."""
    rows = _range_sums(groups, _FIRST)
    if not rows or shards < 2:
        return []
    while True:
        ranges = Ranges(rows, shards)
        capacity, open_ = ranges.solve()
        if not open_:
            return ranges.cuts(capacity)
        rows = [r for i, r in enumerate(ranges.rows) if i not in set(open_)]
        for digits in {len(ranges.keys[i]) for i in open_}:
            names = [ranges.keys[i] for i in open_ if len(ranges.keys[i]) == digits]
            rows += _range_sums(groups.where(F.substring("key", 1, digits).isin(names)), digits + _STEP)


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    ``size`` is the number of the text's UTF-8 bytes plus 1; a null text counts
    as empty.  Equal texts form a group and share a shard.  Groups lie in the
    order of their texts' SHA-256, and shards are contiguous in it.  The largest
    shard is as small as any contiguous partition allows (``law`` is ``bytes``);
    within that capacity the cuts lie as near to equal parts as groups permit.
    A group larger than an equal part of the whole takes a shard of its own
    first, and the rest is divided among the other shards, so that one group of
    copies leaves no shard empty.  ``slot`` numbers the rows of a shard from 0
    without gaps.  ``grown_shard`` is null under this law.

    Repeated rows and rows without an id are rows like others.  With fewer
    groups than shards some shards stay empty.  Other columns of ``docs`` are
    not read, whatever their names.  An empty table gives an empty result.

    Scale: texts are read once and hashed; only hashes, ids and sizes are
    shuffled, and equal rows are counted before they are.  The driver gets sums
    of at most 4096 key ranges, then of 64 times 256 finer ones a round, and at
    most ``shards`` groups.  Slots are a rank inside one of 4096 parts of a shard,
    dealt by id and not by text, plus a running total over parts: no task holds
    a shard or a group of copies.
    """
    text = raw_text(text_col)
    rows = docs.select(F.col(id_col).alias("id"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.sha2(text, 256).alias("key"))
    rows = stored(rows.groupBy("id", "size", "crc", "key").agg(F.count("*").alias("copies")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    largest = groups.orderBy(F.desc("bytes"), "key").limit(shards).collect()
    own = large_groups([(r.key, r.bytes) for r in largest], total, shards)
    rest = groups.where(~F.col("key").isin(own)) if own else groups
    place = sum(((F.col("key") >= cut).cast("int") for cut in cut_keys(rest, shards - len(own))), F.lit(len(own)))
    for i, key in enumerate(own):
        place = F.when(F.col("key") == key, F.lit(i)).otherwise(place)
    part = F.pmod(F.xxhash64("id", "key"), F.lit(_BUCKETS)).cast("int")
    placed = rows.select("*", place.alias("shard"), part.alias("part"))
    # at most shards * _BUCKETS rows
    counts = placed.groupBy("shard", "part").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy("id", "key").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("rank", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    spread = ranked.join(F.broadcast(offsets), ["shard", "part"]).select("*", copy)
    return spread.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("rank") + F.col("copy")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
