from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F
from sparkseries.llm.chat import maximal_conversations
from sparkseries.llm.quality import features, fit, quality
from sparkseries.llm.toxicity import fit as toxicity_fit
from sparkseries.llm.toxicity import score_documents, toxicity, unlike, words_of

SYLLABLES = "ba de ko lu mi na po ra se ti vo zu".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def toxic_table(spark, documents):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = prose(rng, 40).split()
        if toxic:
            words.insert(rng.randrange(40), rng.choice(["wretch", "snivelling", "grubby"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    odd = [(1000, "ba de w.r.e.t.c.h ko"), (1001, "w r e t c h"), (1002, ""), (1003, None), (None, "grubby"), (1004, "GRUBBY!"), (1004, "GRUBBY!"), (1005, "q" * 100_000)]
    labels += [(None, 1, 1), (0, 1, None), (7777, 0, 1)]
    return documents(rows + odd), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_and_spaced_words(spark, documents):
    docs, labels = toxic_table(spark, documents)
    got = toxicity(docs, labels, F.col("doc_id") % 3 != 1, carry=("doc_id", "score", "row")).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.row.score == 0.5 and r.row.row == "r" for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 3 == 1]
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 4 == 0) for r in held]) > 0.97
    score = {r.doc_id: r.score for r in got}
    assert min(score[1000], score[1001], score[1004], score[None]) >= 0.7
    assert max(score[1002], score[1003], score[1005]) < 0.7


def test_toxicity_without_labels_or_rows(spark, documents):
    docs, labels = toxic_table(spark, documents)
    assert {r.score for r in toxicity(docs, labels.where("toxic = 0"), F.lit(True)).collect()} == {0.0}
    assert toxicity(documents([]), labels, F.lit(True)).count() == 0


def test_spaced_letters_become_a_word():
    assert "wretch" in words_of("you w r e t c h there")


def quality_table(spark, documents):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        good = i % 5 != 0
        text = prose(rng, 60)
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split())))
        if i % 2:
            labels.append((i, int(good), 0))
    return documents([*rows, (1000, ""), (1001, None), (None, prose(rng, 30)), (1002, "x" * 200_000), (1, rows[1][1])]), spark.createDataFrame(
        [*labels, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int"
    )


def test_quality_learns_from_positives_and_unlabelled_text(spark, documents):
    docs, labels = quality_table(spark, documents)
    got = quality(docs, labels, F.col("doc_id") % 5 != 1).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    right = [(r.score >= 0.3) == (r.doc_id % 5 != 0) for r in got if r.doc_id is not None and r.doc_id < 400]
    assert np.mean(right) > 0.97


def test_quality_without_positives_or_rows(spark, documents):
    docs, labels = quality_table(spark, documents)
    assert {r.score for r in quality(docs, labels.where("quality = 0"), F.lit(True)).collect()} == {0.5}
    assert quality(documents([]), labels, F.lit(True)).count() == 0


def test_risk_on_negatives_stays_non_negative(spark, documents):
    rng = np.random.default_rng(3)
    rows = [([float(v) for v in rng.normal(2.0 * (i % 10 != 0), 0.3, 16)], bool(i % 3 == 0 and i % 10)) for i in range(600)]
    model = fit(spark.createDataFrame(rows, "x array<double>, trusted boolean"), 0.9)
    x, trusted = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    loss = np.logaddexp(0, model.design(x) @ model.weights)
    assert loss.mean() - 0.9 * loss[trusted].mean() >= 0
    assert (model.probability(x) > 0.5).mean() > 0.8


def test_features_of_blocks_and_nothing():
    assert np.isfinite(features(b"")).all()
    long = b"some words here and there " * 200_000
    assert np.allclose(features(long)[1:8], features(long[: 26 * 1000])[1:8], atol=0.01)


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, rendered string")


def test_snapshots_collapse(spark):
    base = [("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", None)]
    rows = [(5, t, *x) for t, x in enumerate(base)]
    rows += [(2, t, *x) for t, x in enumerate(base[:2])]  # a snapshot
    rows += [(9, 10 + t, *x) for t, x in enumerate(base)]  # a copy with other numbers
    rows += [(3, t, *x) for t, x in enumerate([base[0], ("assistant", "no")])]  # same start, other end
    rows += [(4, t, *x) for t, x in enumerate([base[1], base[0]])]  # same turns in another order
    rows += [(5, 1, "assistant", "yes")]  # a repeated row
    rows += [(None, 0, "user", "hi"), (6, None, None, None), (7, 0, "user", "h"), (7, 1, "i", "")]
    got = {r.conv_id: r for r in maximal_conversations(chats(spark, rows)).collect()}
    assert got.keys() == {5, 3, 4, 6, 7}
    assert (got[5].n_turns, got[5].copies) == (4, 2)
    assert got[3].rendered == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nno<|im_end|>\n"
    assert got[6].rendered == "<|im_start|>\n<|im_end|>\n"
    assert maximal_conversations(chats(spark, [])).count() == 0


def test_no_python_in_chat_plan(spark):
    plan = maximal_conversations(chats(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def labelled_words(seed=1, n=600, toxic_every=4, insults=("wretch", "snivelling", "grubby")):
    """Distinct words of toxic and of clean documents."""
    rng = random.Random(seed)
    toxic, clean = [], []
    for i in range(n):
        words = set(prose(rng, 40).split())
        if i % toxic_every == 0:
            toxic.append(sorted(words | {insults[i // toxic_every % len(insults)]}))
        else:
            clean.append(sorted(words))
    return toxic, clean


def test_toxicity_reads_unspaced_texts_to_the_end(spark, documents):
    model = toxicity_fit(*labelled_words())
    texts = [(0, "q" * 120_000)] + [(n, "q" * n + "snivelling" + "q" * 1000) for n in (100, 5_000, 65_530, 100_000)]
    score = {r.doc_id: r.score for r in score_documents(documents(texts), model).collect()}
    assert score[0] < 0.7
    assert min(score[100], score[5_000], score[65_530], score[100_000]) >= 0.7


def test_only_near_copies_leave_the_training_sample():
    common = sorted(f"c{i}" for i in range(20))
    own = [sorted(common + [f"d{n}x{i}" for i in range(20)]) for n in range(200)]
    assert unlike(own) == own
    copies = [words[:-1] for words in own[:50]]
    kept = unlike(own + copies)
    assert kept[:200] == own and len(kept) < 225


def test_a_rare_insult_is_learned_beside_frequent_ones():
    toxic, clean = labelled_words(n=800)
    for i in range(4):  # in 4 of 200 toxic documents, with no other insult
        toxic[i] = sorted(set(toxic[i]) - {"wretch", "snivelling", "grubby"} | {"dunderhead"})
    model = toxicity_fit(toxic, clean)
    odds = [model.probability(v) for v in model.units(["dunderhead", "dunder.head", "grubby", "bakolumi"])]
    assert min(odds[0], odds[2]) >= 0.7 > odds[3]


def test_few_labels_teach_an_insult():
    toxic, clean = labelled_words(seed=2, n=54, toxic_every=9, insults=("moron",))
    assert len(toxic) == 6
    toxic = [[w for w in words if w != "moron" or i < 4] for i, words in enumerate(toxic)]
    model = toxicity_fit(toxic, clean)
    assert model.table is not None and model.units(["moron"])[0] > max(model.units(sorted({w for x in clean for w in x})))
