from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from sparkseries.llm.sharding import Ranges, large_groups, shard


def least_capacity(sizes, shards):
    """The smallest largest part of a contiguous partition, by the full recurrence."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = [0] + [10**18] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(1, len(ends))]
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_the_smallest_and_cuts_keep_it(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 50, 400]) * rng.randrange(1, 9) for _ in range(rng.randrange(1, 60))]
    for shards in (1, 2, 5, 16):
        ranges = Ranges([(f"{i:04x}", s, 1) for i, s in enumerate(sizes)], shards)
        capacity, open_ = ranges.solve()
        assert not open_ and capacity == least_capacity(sizes, shards)
        cuts = [int(k, 16) for k in ranges.cuts(capacity)]
        parts = [sum(sizes[a:b]) for a, b in zip([0, *cuts], [*cuts, len(sizes)])]
        assert max(parts) <= capacity and len(parts) <= shards and cuts == sorted(cuts)


@pytest.mark.parametrize("seed", range(4))
def test_ranges_are_divided_until_the_capacity_is_exact(seed):
    rng = random.Random(seed)
    groups = {f"{rng.randrange(16**6):06x}": rng.choice([1, 9, 90, 2000]) for _ in range(3000)}

    def sums(digits, within=None):
        out = defaultdict(lambda: [0, 0])
        for key, size in groups.items():
            if within is None or key[: len(within)] == within:
                out[key[:digits]][0] += size
                out[key[:digits]][1] += 1
        return [(k, *v) for k, v in out.items()]

    rows = sums(1)
    while True:
        ranges = Ranges(rows, 7)
        capacity, open_ = ranges.solve()
        if not open_:
            break
        rows = [r for i, r in enumerate(ranges.rows) if i not in open_] + [r for i in open_ for r in sums(len(ranges.keys[i]) + 1, ranges.keys[i])]
    exact = Ranges([(k, s, 1) for k, s in groups.items()], 7)
    assert exact.solve() == (capacity, [])
    assert len(ranges.keys) < len(groups) / 2


def test_large_groups_have_shards_of_their_own():
    assert large_groups([("a", 15), ("b", 100), ("c", 20)], 160, 4) == ["b"]
    assert large_groups([("a", 5), ("b", 100), ("c", 40)], 160, 5) == ["b", "c"]
    assert large_groups([("a", 5)], 5, 1) == []


def checked(got, rows, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes", None) for d, t in rows
    )
    slots, bytes_, places = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        bytes_[r.shard] += r["size"]
        places[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values()) and set(slots) <= set(range(shards))
    return bytes_


def test_sharding(documents):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(300) + str(i)) for i in range(400)] + [(1000 + i, "copy") for i in range(90)]
    rows += [(2000, None), (2001, ""), (None, "no id"), (5, "again"), (5, "again")]
    sizes = checked(shard(documents(rows).repartition(3), 8).collect(), rows, 8)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 600


def test_one_group_larger_than_a_part_leaves_no_shard_empty(documents):
    rows = [(i, f"text {i} " + "y" * 40) for i in range(200)] + [(1000 + i, "hot copy " * 20) for i in range(100)]
    sizes = checked(shard(documents(rows), 6).collect(), rows, 6)
    assert sorted(sizes) == list(range(6)) and sizes[0] == 100 * 181
    assert max(sizes[i] for i in range(1, 6)) - min(sizes[i] for i in range(1, 6)) < 200


def test_few_groups_and_empty_tables(documents):
    rows = [(1, "a"), (2, "b"), (3, "a")]
    checked(shard(documents(rows)).collect(), rows, 16)
    assert shard(documents([])).count() == 0
