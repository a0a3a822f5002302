from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from sparkseries.llm.collocation import _PLAIN, collocations, parse, words_of

LETTERS = ["the", "The", "of", "red", "fish", "é", "一", "a", "b", "c"]
MARKS = [" ", " ", " ", " ", "\t", "  ", ", ", ". ", "\n", "!", "\x0b", ";"]


def pieces_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[\x20\x09]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def brute(rows, least, top=2000, covered=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces_of(text):
            n[lang or "und"] += len(ws)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, own in f.items():
        kept = {p: a for p, a in own.items() if a >= least}
        rows = []
        for p, a in kept.items():
            if len(p) < 2:
                continue
            if any(len(q) > len(p) and 100 * kept[q] >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q in kept):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (own[p[:c]] * own[p[c:]]), c, own[p[:c]], own[p[c:]]) for c in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def some_rows(seed, n, longest=40):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(LETTERS) + rng.choice(MARKS) for _ in range(rng.randrange(longest)))
    return [(rng.choice(["en", "fr", None]), text()) for _ in range(n)]


@pytest.fixture
def texts(spark):
    """A table of (lang, text) with columns whose names clash with inner ones."""

    def build(rows):
        return spark.createDataFrame([(lang, t, "x", 1, 2.0, "y") for lang, t in rows], "lang string, text string, phrase string, n int, freq double, chunk string")

    return build


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("distance", [2, 32])
def test_against_brute_force(texts, distance):
    rows = some_rows(1, 60) + [("en", None), ("en", ""), ("fr", " . ,")] + [("en", "the red fish of the red fish. the red fish")] * 9
    rows += [(None, "a b c a b c " * 60)]
    assert result(collocations(texts(rows).repartition(3), least=4, distance=distance, size=200)) == brute(rows, 4)


def test_a_report_keeps_the_first_of_each_language(texts):
    rows = some_rows(2, 60)
    assert result(collocations(texts(rows), least=3, top=5)) == brute(rows, 3, top=5)


def test_nearly_covered_phrases_can_be_dropped_too(texts):
    rows = some_rows(3, 60)
    assert result(collocations(texts(rows), least=3, covered=60)) == brute(rows, 3, covered=60)


def test_empty_table_and_rare_phrases(texts):
    assert collocations(texts([])).count() == 0
    assert collocations(texts([("en", "one fish two fish")])).count() == 0


def test_chunks_hold_every_gram_once_and_are_prefix_free():
    for _, text in some_rows(4, 40, 300):
        data = (text or "").encode().translate(_PLAIN)
        chunks, own = parse(*words_of(data), 4, 3)
        counted, want = Counter(), Counter()
        for chunk, n in zip(chunks.to_pylist(), own):
            ws = chunk.split()
            assert n in (len(ws), len(ws) - 4)
            counted.update(tuple(ws[i : i + k]) for k in range(1, 6) for i in range(n) if i + k <= len(ws))
        for ws in pieces_of(text):
            ws = [w.encode() for w in ws]
            want.update(tuple(ws[i : i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
        assert counted == want
        inner = {tuple(c.split()) for c, n in zip(chunks.to_pylist(), own) if n < len(c.split())}
        assert not any(q != p and q[: len(p)] == p for p in inner for q in inner)


def test_word_hashes_depend_on_the_words_alone():
    words, piece, hashes = words_of(b"fish a\nfish  b fish")
    assert words.to_pylist() == [b"fish", b"a", b"fish", b"b", b"fish"] and piece.tolist() == [0, 0, 1, 1, 1]
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3
    empty = parse(*words_of(b" \n "), 4, 3)
    assert len(empty[0]) == 0 and isinstance(words, pa.Array) and not np.any(empty[1])
