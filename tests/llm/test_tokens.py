from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from sparkseries.llm.bpe import encoder, transcode  # noqa: E402
from sparkseries.llm.packing import Plan, combinations, least_squares, pack, tokenizer  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "B", " ", "\n", "'s", "é", "ß", "1", "٣", "漢", " ", " ", "\x1c", "\x85", "🙂", "  ", "the", " th", "ll", "<|endoftext|>", "\t", "!", "-", "'", "aa", "ǅ", "ª", "²", "\x00", "é"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def some_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_encoder_agrees_with_the_library():
    exact, words = encoder(PATH)
    for text in some_texts(1, 3000):
        want = library_ids(text)
        assert exact.encode(text) == want
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want
        assert exact.decode(want).decode() == LIBRARY.decode(want, skip_special_tokens=False)


def test_compatible_pairs_are_their_own_encoding():
    exact, _ = encoder(PATH)
    rng = random.Random(2)
    tokens = [t for t in exact.bytes_of if t not in exact.special.values()]
    for _ in range(2000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        merged = exact.piece(exact.bytes_of[a] + exact.bytes_of[b])
        assert exact.compatible(a, b) == (merged == [a, b])


def test_transcode(documents):
    rows = [(i, t) for i, t in enumerate(some_texts(3, 80))] + [(None, "no id"), (5, None), (6, ""), (7, "x" * 5000), (7, "x" * 5000)]
    got = transcode(documents(rows), PATH).collect()
    want = Counter((d, np.array(library_ids(t), "<u4").tobytes(), (t or "").encode()) for d, t in rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert transcode(documents([]), PATH).count() == 0


def checked(got, rows, window):
    """Every id lies in one piece, every sequence is gapless; returns the padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == {d for d, _ in rows}
    for doc, text in rows:
        ids = np.array([*library_ids(text), 0], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert sequences.keys() == set(range(len(sequences)))
    return padding


@pytest.mark.parametrize("window", [16, 64])
def test_packing(documents, window):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["one", "fish", "blue", "xyzzy"]) for _ in range(rng.randrange(90)))) for i in range(120)]
    rows += [(1000 + i, "red fish") for i in range(60)] + [(2000, None), (2001, "")]
    got = pack(documents(rows), PATH, window=window, step=8).collect()
    assert checked(got, rows, window) < window


def test_new_words_of_letters_go_past_the_split(monkeypatch):
    words = tokenizer(PATH)
    words.known.clear()
    rng, sent, whole = random.Random(6), [], words.whole
    letters = [c for c in map(chr, range(0x180)) if c.isalpha()] + ["\u0250", "ж", "ʰ", "İ", "ǅ"]
    texts = ["".join(rng.choice(letters) if rng.random() < 0.8 else rng.choice(" \n,.'") for _ in range(50)) for _ in range(2000)]
    monkeypatch.setattr(words, "whole", lambda text: sent.append(text) or whole(text))
    for text in [*texts, "plain words of letters, über élan.", *some_texts(7, 500)]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library_ids(text)
    sent.clear()
    words.known.clear()
    words.encode("plain words of letters, über élan.")
    assert sent == ["\nplain"]


def test_packing_of_repeated_rows_and_empty_tables(documents):
    got = pack(documents([(1, "one fish"), (1, "one fish"), (None, "two")]), PATH, window=16, step=4).collect()
    assert sum(r.length for r in got) == 3 + 3 + 2
    assert pack(documents([]), PATH).count() == 0


def test_least_squares_meets_a_histogram_that_combinations_can_fill():
    columns = combinations(32, 8)
    assert all(sum(c) == 32 or len(c) == 1 for c in columns)
    wanted = np.zeros(33, np.int64)
    wanted[[3, 29]] = 100
    wanted[[5, 27]] = 40
    x = least_squares(columns, wanted)
    used = np.zeros(33)
    for c, n in zip(columns, x):
        for length in c:
            used[length] += n
    assert (x >= 0).all() and np.abs(used - wanted).max() < 2
    plan = Plan({3: 100, 29: 100, 5: 40, 27: 40}, 32, 8)
    assert plan.used.sum() >= 270
