from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
import xxhash
from llm_brute import repeated_lines, simhash, without_repeats
from sparkseries.llm import suffix
from sparkseries.llm.components import components
from sparkseries.llm.linededup import deduplicate_lines, keep_bitmaps
from sparkseries.llm.simhash import block_masks, fingerprint, near_duplicates
from sparkseries.llm.suffix import remove_repeats

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
EDGE = [(None, "lonely text with no id at all"), (7, None), (8, ""), (9, ""), (10, "two words"), (10, "two words"), (11, "Two  WORDS\n"), (12, "ÄÖ ß 漢字 text")]


def texts(seed, n, words=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(words)) for _ in range(n)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    for i in range(n):
        copy = base[i].split()
        copy[rng.randrange(len(copy))] = "changed"
        rows.append((50 + i, " ".join(copy)))
    return rows + [(500 + i, base[0]) for i in range(20)] + EDGE


def test_hash_is_xxh64_of_spark(spark):
    from pyspark.sql import functions as F

    text = "to be or"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(text, 42)


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One two", "a b c", "a b c d " * 9, "x\x1cy z q w", "É é A a"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) % (1 << 64) == simhash(text.encode())


def test_fingerprint_of_long_text_in_blocks(monkeypatch):
    from sparkseries.llm import simhash as module

    rng = random.Random(2)
    text = " ".join(rng.choice(WORDS) for _ in range(4000)).encode()
    plain = module.word_blocks
    monkeypatch.setattr(module, "word_blocks", lambda data: plain(data, 37))
    assert fingerprint(text) % (1 << 64) == simhash(text)


def test_near_duplicates_against_all_pairs(documents):
    rows = texts(1, 25)
    got = near_duplicates(documents(rows)).collect()
    prints = [simhash((t or "").encode()) for _, t in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((d, f"{p:016x}") for (d, _), p in zip(rows, prints))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = Counter((d, least.get(find(i))) for i, (d, _) in enumerate(rows))
    assert Counter((r.doc_id, r.component_id) for r in got) == want


def test_masks_leave_no_pair_out():
    rng = random.Random(3)
    masks = block_masks(3, 6)
    for _ in range(500):
        x = 0
        for b in rng.sample(range(64), 3):
            x |= 1 << b
        assert any(x & m % (1 << 64) == 0 for m in masks)


def test_components_of_chain_ring_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(999 - i, 200) for i in range(30)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {v for k, v in got.items() if k <= 40} == {0} and len(got) == 41 + 7 + 31
    assert {v for k, v in got.items() if 100 <= k < 107} == {100} and {v for k, v in got.items() if k >= 200} == {200}


def lined(seed):
    rng = random.Random(seed)
    shared = [f"  A shared line of some length {i} \t" for i in range(6)] + ["short line", "ümläut " * 3, "é" * 19, "É" * 20]
    rows = []
    for d in range(40):
        own = [f"own line number {d} {i} and more" for i in range(rng.randrange(4))]
        lines = own + rng.choices(shared, k=rng.randrange(5)) + [rng.choice(shared).upper()]
        rng.shuffle(lines)
        rows.append((rng.choice([d, 100 - d]), "\n".join(lines)))
    return rows + EDGE + [rows[0], (rows[0][0], "A shared line of some length 0\nother")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(documents, seed):
    rows = lined(seed)
    got = deduplicate_lines(documents(rows)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept)) for r in got) == Counter(repeated_lines(rows, 20, 3))


def test_hot_line_over_many_partitions(spark, documents):
    """A line of every document, cut over partitions smaller than its run, keeps its one place."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = [(i, f"the very same line everywhere\nline of document number {i}") for i in range(500)]
        got = deduplicate_lines(documents(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.doc_id for r in got if r.n_dropped == 0} == {499}


def test_bitmaps_hold_no_text(documents):
    maps = keep_bitmaps(documents([(i, "x\n" + "a line of twenty letters") for i in range(3)])).collect()
    assert sorted(m.id for m in maps) == [0, 1] and set(maps[0].asDict()) == {"id", "text_hash", "keep"}


def strings(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(400))) for _ in range(30)]
    rows = [(rng.randrange(60), t) for t in base]
    for _ in range(30):
        a, b = rng.choice(base), rng.choice(base)
        at = rng.randrange(len(a) + 1)
        rows.append((rng.randrange(90), b[: rng.randrange(len(b) + 1)] + a[at : at + rng.randrange(40, 90)] + "z" * rng.randrange(70)))
    return rows + EDGE + [(91, "ab" * 300), (92, "ab" * 300), rows[3], (None, rows[4][1])]


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 20), (2, 700), (3, 5000)])
def test_strings_against_brute_force(documents, seed, chunk):
    rows = strings(seed)
    got = remove_repeats(documents(rows), chunk_bytes=chunk, range_bytes=4000, carry=("text",)).collect()
    want = without_repeats([(d, (t or "").encode()) for d, t in rows], 50)
    assert Counter((r.doc_id, r.row.text, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == Counter(
        (d, t, *w) for (d, t), w in zip(rows, want)
    )


def test_strings_of_documents_that_share_nothing(documents):
    rows = [(i, f"{i} " * 60) for i in range(3)] + [(5, "short")]
    got = remove_repeats(documents(rows), chunk_bytes=100).collect()
    assert {(r.doc_id, r.n_removed, r.n_spans) for r in got} == {(0, 0, 0), (1, 0, 0), (2, 0, 0), (5, 0, 0)}


def test_ranges_of_names_are_equally_full():
    rng = random.Random(8)
    texts = [rng.randbytes(2000) for _ in range(200)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts, pa.binary())], names=["id", "text"])
    chunk = suffix.Chunk(suffix._chunk(0, [rows]).column("body")[0].as_py(), 50, 24)
    first = suffix._advance(chunk, [], 30, 1)
    sizes = [content["n"] for _, content in first]
    assert len(sizes) == 30 and max(sizes) < 1.3 * sum(sizes) / 30
    again = suffix._advance(chunk, [{"round": 1, "range": r, "bits": b"\1" * content["n"]} for r, content in first], 30, 2)
    sizes = [len(content["name"]) for _, content in again]
    assert len(sizes) == 30 and max(sizes) < 1.3 * sum(sizes) / 30


def test_empty_tables(documents):
    empty = documents([])
    assert near_duplicates(empty).count() == 0
    assert deduplicate_lines(empty).count() == 0
    assert remove_repeats(empty).count() == 0
