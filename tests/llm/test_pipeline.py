from __future__ import annotations

import random
from collections import Counter

import __spark_entry__ as registry
import oracle
import pytest
from llm_brute import repeated_lines, without_repeats

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from test_tokens import checked  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, keep string, row int"


@pytest.mark.parametrize("name", ["op3_line_dedup", "op6_chat_format", "op8_suffix_dedup", "op9_topk"])
def test_queries_agree_with_sql(spark, name):
    con = oracle.connect(FOLDER)
    assert oracle.differences(registry.queries()[name](spark, FOLDER), con, registry.oracle_sql()[name]) == []


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    shared = [prose(12) for _ in range(3)]
    passage = prose(30)
    rows = []
    for i in range(120):
        text = prose(50)
        if i % 4 == 0:
            text += "\n" + rng.choice(shared)
        if i % 7 == 0:
            text = text[:40] + passage + text[40:]
        if i % 6 == 5:
            text += " blockhead"
        rows.append((i, text))
    rows += [(200 + i, rows[1][1]) for i in range(10)]  # copies
    return rows + [(300, None), (301, ""), (None, "no id at all"), (302, "é" * 40), (303, rows[2][1]), (303, rows[2][1])]


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus(1)
    folder = str(tmp_path / "sf")
    labels = [(i, 1, int(i % 6 == 5)) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), "k", 1) for d, t in rows], COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "suffix_dedup", "packing"]
    kept = stages["toxicity"](spark, docs, folder)
    assert kept.columns == docs.columns
    assert Counter(pairs(kept)) == Counter((d, t) for d, t in rows if "blockhead" not in (t or ""))

    before = pairs(kept)
    lined = stages["line_dedup"](spark, kept, folder)
    assert lined.columns == docs.columns
    want = repeated_lines(before, 20, 3)
    assert Counter(pairs(lined)) == Counter((d, text.decode()) for d, _, _, text in want)
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    before = pairs(lined)
    near = stages["simhash"](spark, lined, folder)
    linked = [(i, j) for i, (_, a) in enumerate(before) for j, (_, b) in enumerate(before[:i]) if jaccard(a or "", b or "") >= 0.8]
    group = list(range(len(before)))
    for _ in before:
        for i, j in linked:
            group[i] = group[j] = min(group[i], group[j])
    least = {}
    for (d, _), g in zip(before, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    assert Counter(pairs(near)) == Counter((d, t) for (d, t), g in zip(before, group) if d is None or least[g] == d)

    before = pairs(near)
    cut = stages["suffix_dedup"](spark, near, folder)
    want = without_repeats([(d, (t or "").encode()) for d, t in before], 50)
    assert Counter(pairs(cut)) == Counter((d, w[3].decode()) for (d, _), w in zip(before, want))
    assert sum(w[1] for w in want) > 0

    final = pairs(cut)
    unique = [(d, t) for d, t in final if d != 303]
    pieces = stages["packing"](spark, cut.where("doc_id IS NULL OR doc_id <> 303"), folder)
    assert checked(pieces.collect(), unique, 1024) < 1024
    assert corpus_pipeline.run(spark, folder).agg({"length": "sum"}).first()[0] > 0


def test_stages_on_an_empty_table(spark, tmp_path):
    folder = str(tmp_path / "empty")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def jaccard(a, b, k=5):
    sets = []
    for text in (a, b):
        words = text.lower().split()
        sets.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_with_edited_words_leave_one_document(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for i in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([60, 120, 400]))]
        rows.append((len(rows), " ".join(base)))
        for edits in (1, 1, 2, 3, 6):
            copy = base[:]
            for at in rng.sample(range(len(base)), edits):
                copy[at] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    chain = [rng.choice(words) for _ in range(200)]  # each link is near, the ends are not
    for i in range(30):
        chain[i * 6] = rng.choice(words)
        rows.append((len(rows), " ".join(chain)))
    rows += [(900, "Three  short words"), (901, "three short words"), (902, "three short"), (None, rows[0][1]), (903, None), (904, " ")]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if find(i) != find(j) and jaccard(a or "", rows[j][1] or "") >= 0.8:
                group[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = Counter((d, t) for i, (d, t) in enumerate(rows) if d is None or least[find(i)] == d)
    docs = spark.createDataFrame([(d, t, "en", "s", 1, "k", 1) for d, t in rows], COLUMNS)
    kept = dict(corpus_pipeline.STAGES)["simhash"](spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want
    assert len(want) < len(rows) - 100
