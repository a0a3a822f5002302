"""Posting lists: against plain sets, merged generations, stale tables."""

from __future__ import annotations

import random
import re

import pytest
from helpers import plan_text
from pyspark.sql import functions as F

from sparkseries.model import SeriesError
from sparkseries.operators.postings import BLOCK_IDS, compact_postings, index_version, is_current, lookup_postings, merge_postings, postings, read_postings

WORDS = ["fox", "dog", "über", "the", "q1", "x"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    ids = rng.sample(range(-BLOCK_IDS, 5 * BLOCK_IDS), 300)
    text = lambda: rng.choice([None, "", " ", *[" ".join(rng.choice(WORDS).upper() for _ in range(rng.randrange(1, 9))) + "!"] * 9])
    return [(i, text(), "the end" if i % 5 == 0 else None) for i in ids]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, body string, title string")


def brute(rows, words):
    found = lambda t: set(re.split(r"[\W_]+", (t or "").lower()))
    return sorted(i for i, *texts in rows if any(set(words) <= found(t) for t in texts))


def looked_up(spark, path, words):
    return sorted(r[0] for r in lookup_postings(spark, path, words).collect())


def test_lists_are_gaps_in_blocks(spark, rows):
    lists = postings(frame(spark, rows), "id", ["body", "title"]).collect()
    keys = [(r["token"], r["field"], r["block"]) for r in lists]
    assert len(keys) == len(set(keys))
    for r in lists:
        at, ids = 0, []
        for gap in r["gaps"]:
            at += gap
            ids.append(r["block"] * BLOCK_IDS + at)
        column = 1 if r["field"] == "body" else 2
        assert ids == [i for i in brute([(x[0], x[column]) for x in rows], [r["token"]]) if i // BLOCK_IDS == r["block"]]


def test_generations_answer_as_one(spark, rows, tmp_path):
    path = str(tmp_path / "index")
    parts = [rows[:100], rows[100:250], rows[250:]]
    for n, part in enumerate(parts):
        merge_postings(frame(spark, part), path, "id", ["body", "title"], buckets=8)
        seen = [r for p in parts[: n + 1] for r in p]
        assert is_current(frame(spark, seen), path, "id")
        for words in (["fox"], ["the", "end"], ["fox", "dog", "über"], ["absent"], ["fox", "absent"], ["FOX-dog"]):
            assert looked_up(spark, path, words) == brute(seen, [w for t in words for w in t.lower().split("-")])
    merge_postings(frame(spark, parts[1]), path, "id", ["body", "title"])  # a batch that runs again
    assert is_current(frame(spark, rows), path, "id") and looked_up(spark, path, ["fox"]) == brute(rows, ["fox"])
    before = read_postings(spark, path).count()
    compact_postings(spark, path)
    compact_postings(spark, path)
    assert read_postings(spark, path).count() < before
    assert is_current(frame(spark, rows), path, "id") and looked_up(spark, path, ["fox", "dog"]) == brute(rows, ["fox", "dog"])
    assert "token_bucket" in plan_text(lookup_postings(spark, path, "fox")).split("PartitionFilters")[1]


def test_a_stale_index_is_noticed(spark, rows, tmp_path):
    path = str(tmp_path / "index")
    merge_postings(frame(spark, rows[:50]), path, "id", ["body"])
    assert is_current(frame(spark, rows[:50]).repartition(7), path, "id")
    assert not is_current(frame(spark, rows[:51]), path, "id")
    changed = [(rows[0][0], "other words", None), *rows[1:50]]
    assert not is_current(frame(spark, changed), path, "id")
    same = frame(spark, [(1, None, None)]), frame(spark, [(1, "", None)])
    assert index_version(same[0], "id", ["body"]) != index_version(same[1], "id", ["body"])


def test_wrong_uses(spark, rows, tmp_path):
    path = str(tmp_path / "index")
    with pytest.raises(SeriesError, match="no text index"):
        lookup_postings(spark, path, "fox")
    with pytest.raises(SeriesError, match="whole number"):
        postings(frame(spark, rows), "body", ["title"])
    merge_postings(frame(spark, [(None, "fox", None), (1, "fox", None)]), path, "id", ["body"])
    assert looked_up(spark, path, "fox") == [1]
    with pytest.raises(SeriesError, match="over"):
        merge_postings(frame(spark, rows), path, "id", ["title"])
    merge_postings(frame(spark, rows).where(F.lit(False)), path, "id", ["body"])
    assert looked_up(spark, path, "fox") == [1]
