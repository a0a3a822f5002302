"""The near-duplicate stage: SimHash links first, rare shingles where buckets stay mixed, no pair for each two of a group."""

from __future__ import annotations

import random
import tracemalloc
from itertools import combinations

import pyarrow as pa
import pytest

from sparkseries.llm import neardup
from sparkseries.llm.simhash import fingerprint

WORDS = [f"w{i}" for i in range(5000)]


def edited(rng, base, edits):
    copy = base[:]
    for at in rng.sample(range(len(base)), edits):
        copy[at] = rng.choice(WORDS)
    return " ".join(copy)


def shingles(text, k=5):
    words = text.lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def components(rows):
    """Smallest id of each row's component, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if shared / (len(sets[i]) + len(sets[j]) - shared) >= 0.8:
            group[max(find(i), find(j))] = min(find(i), find(j))
    return {d: rows[find(i)][0] for i, (d, _) in enumerate(rows)}


@pytest.fixture
def tried(monkeypatch):
    """Pairs of names that each step compares, in the order of the steps."""
    steps = []
    compare = neardup.similar

    def similar(pairs, sets, similarity):
        steps.append({frozenset(map(bytes, r)) for r in pairs.select("u", "v").collect()})
        return compare(pairs, sets, similarity)

    monkeypatch.setattr(neardup, "similar", similar)
    return steps


def test_a_large_group_is_no_pair_for_each_two(documents, tried):
    rng = random.Random(11)
    base = [rng.choice(WORDS) for _ in range(150)]
    texts = [edited(rng, base, edits) for edits in (0, 1, 1, 2, 2, 3, 3, 4, 5, 6, 8, 10) for _ in range(20)]
    template = [rng.choice(WORDS) for _ in range(120)]
    texts += [" ".join(template + [rng.choice(WORDS) for _ in range(34)]) for _ in range(200)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in neardup.similar_documents(documents(rows)).collect()}
    assert got == components(rows)
    assert len(set(got.values())) > 200
    assert len(set().union(*tried)) < 10 * len(rows)  # all pairs of the two groups are 48,580


def test_fingerprints_name_the_first_pairs(documents, tried):
    rng = random.Random(12)
    rows = [(0, None), (1, "one word"), (2, "One  Word")]
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([40, 400]))]
        rows += [(len(rows) + i, edited(rng, base, edits)) for i, edits in enumerate((0, 0, 1, 1, 2, 4))]
    prints = {}
    for _, text in rows[1:]:
        data = text.encode()
        name, fp, _ = neardup.signature(data, 5)
        assert fp == fingerprint(data, 5)
        prints[name] = fp
    near = {frozenset((a, b)) for a, b in combinations(prints, 2) if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 3}
    got = {r.doc_id: r.component_id for r in neardup.similar_documents(documents(rows)).collect()}
    assert got == {0: 0} | components(rows[1:])
    assert tried[0] and tried[0] <= near
    assert not any(tried[0] & later for later in tried[1:])


def test_a_batch_is_read_in_slices():
    rng = random.Random(13)
    texts = [" ".join(rng.choices(WORDS, k=20)).encode() + b" " * 20_000 for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array(texts, pa.binary())], names=["id", "text"])
    signed = [neardup.signature(t, 5)[0] for t in texts]
    del texts
    for run, source, name in ((neardup._signed(5), batch, "name"), (neardup._listed(5), batch.select(["text"]), "name")):
        tracemalloc.start()
        got = [n for part in run(iter([source])) for n in part.column(name).to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got == signed
        assert peak < 12e6  # all texts of the batch are 40 MB


def test_rare_shingles_are_shuffled_as_numbers(spark):
    numbered = spark.createDataFrame([(b"a", 7), (b"b", 8)], "name binary, no long")
    sets = spark.createDataFrame([(b"a", [1, 2]), (b"b", [2]), (b"c", [3])], "name binary, shingles array<long>")
    items = neardup.rare_items(numbered, sets)
    assert items.dtypes == [("no", "bigint"), ("n", "int"), ("s", "bigint")]
    assert sorted(map(tuple, items.collect())) == [(7, 2, 1), (7, 2, 2), (8, 1, 2)]


def test_names_that_share_a_bucket_are_found_without_a_sort(documents, monkeypatch):
    plans = {}
    store = neardup.stored

    def stored(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(neardup, "stored", stored)
    rng = random.Random(14)
    base = [rng.choice(WORDS) for _ in range(60)]
    rows = [(i, edited(rng, base, i)) for i in range(3)]
    assert {r.doc_id: r.component_id for r in neardup.similar_documents(documents(rows)).collect()} == components(rows)
    assert "SortAggregate" not in plans["neardup-shared"]
