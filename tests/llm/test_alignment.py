from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from sentencepiece import SentencePieceProcessor  # noqa: E402
from sparkseries.llm.alignment import align_tokenizers, aligner, sections  # noqa: E402
from sparkseries.llm.bpe import byte_alphabet  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
PARTS = ["a", "B ", " ", "\n", "'s", "é", "1", "漢", "\x1c", "\x85", "🙂", "  ", "the", " th", "<|endoftext|>", "\t", "!", "ª", "\x00", "<s>", "<0x41>", "ﬁ", " ▁", " of the", "ing,"]


def tokens(text):
    """(id, end) of the tokens of both sides, or nothing."""
    letters = byte_alphabet()
    whole = (" " + text).encode()
    a = [(t, bytes(letters[c] for c in A.id_to_token(t))) for t in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(t, bytes([int(B.id_to_piece(t)[3:-1], 16)]) if B.is_byte(t) else B.id_to_piece(t).replace("▁", " ").encode()) for t in B.encode(text)]
    if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
        return [], []
    out = []
    for side in (a, b):
        end, found = 0, []
        for t, data in side:
            end += len(data)
            found.append((t, end))
        out.append(found)
    return out


def brute(rows):
    facts, holders = [], Counter()
    for doc, text in rows:
        a, b = tokens(text or "")
        groups, start = [], 0
        for end in sorted({e for _, e in a} & {e for _, e in b}):
            groups.append("|".join(",".join(str(t) for t, e in side if start < e <= end) for side in (a, b)))
            start = end
        spans = [[(t, e0, e) for (t, e), e0 in zip(side, [0, *(e for _, e in side)])] for side in (a, b)]
        links = [(x, y) for x, s, e in spans[0] for y, s2, e2 in spans[1] if s < e2 and s2 < e]
        holders.update(set(links))
        facts.append((doc, len(a), len(b), groups, links))
    best = Counter()
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    return Counter(
        (doc, a, b, len(g), len(k), sum(holders[p] == best[p[0]] for p in k), sum(holders[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for doc, a, b, g, k in facts
    )


def result(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def some_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_against_brute_force(documents):
    rows = list(enumerate(some_texts(1, 300)))
    rows += [(900, None), (901, ""), (902, "▁"), (903, "x" * 3000), (904, " lead"), (905, "trail "), (None, "no id"), (906, "the same"), (906, "the same")]
    assert result(align_tokenizers(documents(rows).repartition(3), A_PATH, B_PATH)) == brute(rows)


def test_sections_blocks_and_parcels_do_not_change_the_result(documents):
    rows = [(i, " ".join(some_texts(i, 12))) for i in range(40)] + [(50, "one fish two fish " * 700)]
    assert result(align_tokenizers(documents(rows), A_PATH, B_PATH, size=50, most=60)) == brute(rows)


def test_sections_join_to_the_text():
    for text in some_texts(5, 300):
        assert " ".join(sections(text, 7)) == text


def test_a_full_lexicon_is_emptied():
    model = aligner(A_PATH, B_PATH)
    model.lexicon.most, most = 3, model.lexicon.most
    texts = [t for t in some_texts(6, 60) if t and "▁" not in t]
    try:
        counts = [model.align([t])[1].tolist()[0][:2] for t in texts]
    finally:
        model.lexicon.most = most
    assert counts == [[len(side) for side in tokens(t)] for t in texts]


def test_empty_table_and_text_ids(spark, documents):
    assert align_tokenizers(documents([]), A_PATH, B_PATH).count() == 0
    named = spark.createDataFrame([("p", "a b"), ("q", None)], "`block` string, text string")
    got = align_tokenizers(named, A_PATH, B_PATH, id_col="block")
    assert sorted((r.block, r.n_a) for r in got.collect()) == [("p", 2), ("q", 0)]
