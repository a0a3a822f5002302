"""Toxicity: a support vector machine over gapped character subsequences, with Nyström landmarks.

Insults are looked for in *units*: the letters and digits of one word, and runs
of single letters that a writer has spaced out.  The kernel of two units counts
their common subsequences of three characters, each weighted by how far it is
stretched, so an insult with characters put between its own keeps most of its
value.  A document is as toxic as its most toxic unit.
"""

from __future__ import annotations

import pickle
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.llm.common import raw_text

_LETTERS = 64
_WIDTH = 20  # characters of a unit, with the mark of its start
_SPAN = 8  # characters that a subsequence may stretch over
_DECAY = 0.6
_FIT_CHARS = 4096  # of a word, in the rows that the machine is trained on
_SPACED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_TRIPLES = np.array([(i, i + a, i + b) for i in range(_WIDTH) for b in range(2, _SPAN) for a in range(1, b) if i + b < _WIDTH])
_WEIGHTS = _DECAY ** (_TRIPLES[:, 2] - _TRIPLES[:, 0] - 2.0)


def words_of(text: str) -> list[str]:
    """Words in lower case, then spaced-out letters put together."""
    text = text.lower()
    return text.split() + ["".join(run.split()) for run in _SPACED.findall(text)]


def _letter(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 95
    return 28 + (ord(c) * 40503 >> 4) % 36


class _Letters(dict):
    def __missing__(self, c: str) -> int:
        self[c] = _letter(c) if c.isalnum() else 0
        return self[c]


_CODES = _Letters()


def window_blocks(words: list[str], most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units as rows of letter codes, and the word of each, about ``most`` rows at a time; every word is read to its end.

    Long words give overlapping rows.  0 fills up, 1 marks the start.
    """
    rows, owners = [], []
    step = _WIDTH // 2
    for n, word in enumerate(words):
        left, least = b"\1", 1
        for at in range(0, max(1, len(word)), most):
            codes = left + bytes(filter(None, map(_CODES.__getitem__, word[at : at + most])))
            # only the end of the word is filled up
            end = max(least, len(codes) - step) if at + most >= len(word) else max(0, len(codes) - _WIDTH + 1)
            starts = range(0, end, step)
            for start in starts:
                rows.append(codes[start : start + _WIDTH].ljust(_WIDTH, b"\0"))
                owners.append(n)
            left = codes[step * len(starts) :]
            least = 0 if starts else least
            if len(rows) >= most:
                yield np.frombuffer(b"".join(rows), np.uint8).reshape(-1, _WIDTH), np.array(owners, np.int64)
                rows, owners = [], []
    yield np.frombuffer(b"".join(rows), np.uint8).reshape(-1, _WIDTH), np.array(owners, np.int64)


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All rows of ``window_blocks`` at once."""
    rows, owners = zip(*window_blocks(words))
    return np.concatenate(rows), np.concatenate(owners)


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all short subsequences of each row (0 where it meets the fill), and the root of their squared weights."""
    wide = rows.astype(np.int32)
    a, b, c = (wide[:, _TRIPLES[:, i]] for i in range(3))
    codes = np.where(c > 0, (a * _LETTERS + b) * _LETTERS + c, 0)
    return codes, np.sqrt((codes > 0) @ (_WEIGHTS**2) + 1e-9)


class Landmarks:
    """Scaled weights of the landmarks' subsequences, so that a kernel value is a sum of lookups."""

    def __init__(self, rows: np.ndarray):
        codes, size = subsequences(rows)
        known = np.unique(codes)
        self.known = known[known > 0]
        self.place = np.zeros(_LETTERS**3, np.int32)
        self.place[self.known] = np.arange(1, len(self.known) + 1)
        self.weights = np.zeros((len(self.known) + 1, len(rows)), np.float32)
        for column, (own, root) in enumerate(zip(codes, size)):
            np.add.at(self.weights[:, column], self.place[own], _WEIGHTS / root)
        self.weights[0] = 0

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """Kernel values of rows with all landmarks."""
        out = []
        for at in range(0, len(rows), 1024):
            codes, size = subsequences(rows[at : at + 1024])
            sums = np.zeros((len(codes), self.weights.shape[1]), np.float32)
            for i, w in enumerate(_WEIGHTS):
                sums += self.weights[self.place[codes[:, i]]] * np.float32(w)
            out.append(sums / size[:, None].astype(np.float32))
        return np.concatenate(out)

    def table(self, factors: np.ndarray) -> np.ndarray:
        """One weight for every subsequence: the landmarks' weights times their factors."""
        out = np.zeros(_LETTERS**3, np.float32)
        out[self.known] = (self.weights @ factors)[1:]
        return out


def scores_of(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of subsequence weights of rows, scaled like the kernel."""
    out = [np.zeros(0)]
    for at in range(0, len(rows), 2048):
        codes, size = subsequences(rows[at : at + 2048])
        out.append((table[codes] @ _WEIGHTS) / size)
    return np.concatenate(out)


def hinge_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) that minimise the weighted squared hinge loss plus ``ridge`` times their squares, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = ridge * 1e-3
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        g = keep * w - x[on].T @ (weight[on] * y[on] * slack[on])
        h = (x[on] * weight[on, None]).T @ x[on] + np.diag(keep)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def grams(word: str) -> set[str]:
    unit = "^" + "".join(c for c in word if c.isalnum())
    return {unit[i : i + n] for n in (4, 5, 6) for i in range(len(unit) - n + 1)}


def unlike(docs: list[list[str]], similarity: float = 0.8) -> list[list[str]]:
    """The documents without near copies of kept earlier ones.

    Two pairs of smallest word hashes name candidates; a document is dropped
    only if its set of words has that Jaccard similarity with one of them.
    """
    seen: dict[tuple, list[set[str]]] = {}
    out = []
    for words in docs:
        own = set(words)
        least = [min((zlib.crc32(w.encode(), salt) for w in own), default=0) for salt in range(1, 5)]
        keys = ((0, *least[:2]), (1, *least[2:]))
        near = (other for key in keys for other in seen.get(key, ()))
        if any(len(own & other) >= similarity * len(own | other) for other in near):
            continue
        out.append(words)
        for key in keys:
            seen.setdefault(key, []).append(own)
    return out


def evidence_needed(evidence: dict[str, float], most: dict[str, float], chance: float) -> float:
    """The smallest evidence at which no more than ``chance`` of the grams that reach it are expected by chance.

    A gram reaches evidence t by chance with probability ``exp(-t)`` at most;
    those that could not reach it at all (``most``) are no trials.
    """
    found = np.sort(np.array(list(evidence.values())))[::-1]
    able = np.sort(np.array(list(most.values())))
    if not len(found):
        return np.inf
    trials = len(able) - np.searchsorted(able, found - 1e-9)
    enough = np.flatnonzero(trials * np.exp(-found) <= chance * np.arange(1, len(found) + 1))
    return float(found[enough[-1]]) if len(enough) else np.inf


def witnesses(toxic: list[list[str]], clean: list[list[str]], chance: float) -> set[str]:
    """Words of toxic documents that account for their label.

    A word counts by its gram of 4 to 6 characters with the largest likelihood
    ratio between the documents of both kinds; each toxic document names the
    words that come near its best one.  How large a ratio must be follows from
    the sample (``evidence_needed``).  Documents that named a word are set
    aside, and the others are compared with the clean ones again, until none
    names a word: so insults that few toxic documents hold are not measured
    against the frequent ones.
    """
    toxic, clean = unlike(toxic), unlike(clean)
    bad: Counter = Counter()
    for words in toxic:
        bad.update({g for w in words for g in grams(w[:64])})
    # one document is no evidence
    bad = Counter({g: n for g, n in bad.items() if n > 1})
    own: dict[str, tuple[str, ...]] = {}

    def known(word: str) -> tuple[str, ...]:
        if word not in own:
            own[word] = tuple(g for g in grams(word[:64]) if g in bad)
        return own[word]

    good: Counter = Counter()
    for words in clean:
        good.update({g for w in words for g in known(w)})
    out: set[str] = set()
    while toxic:
        share = len(toxic) / (len(toxic) + len(clean))
        ratio: dict[str, float] = {}
        most: dict[str, float] = {}
        for g, n in bad.items():
            m = good[g]
            most[g] = (n + m) * np.log(1 / share)
            if n >= 3 * (m + 1) or (n > 1 and not m):
                ratio[g] = n * np.log(n / (share * (n + m))) + (m * np.log(m / ((1 - share) * (n + m))) if m else 0.0)
        least = evidence_needed(ratio, most, chance)
        rest = []
        for words in toxic:
            best = {w: max((ratio.get(g, 0.0) for g in known(w)), default=0.0) for w in words}
            top = max(best.values(), default=0.0)
            if top >= least:
                out |= {w for w, v in best.items() if v >= max(least, 0.5 * top)}
                bad.subtract({g for w in words for g in known(w)})
            else:
                rest.append(words)
        if len(rest) == len(toxic):
            break
        toxic = rest
        bad = Counter({g: n for g, n in bad.items() if n > 0})
    return out


class Model:
    """Weights of subsequences, and the line from the largest unit score of a document to its log odds."""

    def __init__(self, table: np.ndarray | None, bias: float = 0.0, slope: float = 1.0, shift: float = 0.0):
        self.table, self.bias, self.slope, self.shift = table, bias, slope, shift

    def units(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), -np.inf)
        for rows, owners in window_blocks(words):
            np.maximum.at(out, owners, scores_of(rows, self.table) + self.bias)
        return out

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60))))


def stretched(word: str, rng: np.random.Generator) -> str:
    """The word with a letter put between two of its own."""
    at = int(rng.integers(1, max(2, len(word))))
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def fit(toxic: list[list[str]], clean: list[list[str]], landmarks: int = 192, chance: float = 0.01, seed: int = 5) -> Model:
    """A model from the words of labelled documents.

    Without a document of either kind, or without a word that tells them apart,
    the model finds nothing toxic.
    """
    if not toxic or not clean:
        return Model(None)
    often = Counter(w for words in clean for w in words)
    seen = Counter(w for words in toxic for w in words)
    found = sorted((w for w in witnesses(toxic, clean, chance) if seen[w] >= 3 * often[w]), key=lambda w: (-seen[w], w))
    if not found:
        return Model(None)
    rng = np.random.default_rng(seed)
    clean_words = sorted(w for w, n in often.items() if w not in set(found))
    hard: list[str] = []
    for _ in range(4):
        # insults as found, and with a letter put in; the latter weigh less
        altered = [stretched(w, rng) for w in found for _ in range(3)]
        negative = list(rng.choice(clean_words, min(3000, len(clean_words)), replace=False)) + hard
        words = found + altered + negative
        rows, owners = windows([w[:_FIT_CHARS] for w in words])
        y = np.where(owners < len(found) + len(altered), 1.0, -1.0)
        # of a long insult only the first window stands for it
        use = np.concatenate([[True], owners[1:] != owners[:-1]]) | (y < 0)
        rows, owners, y = rows[use], owners[use], y[use]
        times = np.array([min(20.0, seen[w]) for w in found] + [0.1 * min(20.0, seen[w]) for w in found for _ in range(3)] + [1.0] * len(negative))
        third = landmarks // 3
        chosen = np.concatenate(
            [
                np.flatnonzero(y > 0)[:third],  # the most frequent insults
                rng.permutation(np.flatnonzero((y < 0) & (owners < len(words) - len(hard))))[:third],
                rng.permutation(np.flatnonzero(owners >= len(words) - len(hard)))[:third],
            ]
        )
        marks = Landmarks(rows[np.unique(chosen)])
        values, vectors = np.linalg.eigh(marks.kernel(rows[np.unique(chosen)]))
        good = values > 1e-6 * values[-1]
        whiten = vectors[:, good] / np.sqrt(values[good])
        w = hinge_fit(marks.kernel(rows) @ whiten, y, times[owners], ridge=0.1)
        model = Model(marks.table(whiten @ w[:-1]), float(w[-1]))
        near = model.units(clean_words)
        hard = sorted(set(hard) | {clean_words[i] for i in np.argsort(-near)[:1000] if near[i] > -1})
    margin = np.array([model.units(words).max(initial=-1.0) for words in toxic + clean])
    y = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    x = np.stack([margin, np.ones(len(margin))], 1)
    line = np.array([4.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -60, 60)))
        pull = np.array([0.5, 0.1]) * (line - [4.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([0.5, 0.1]), x.T @ (p - y) + pull)
        line = line - np.clip(step, -2, 2)
    model.slope, model.shift = max(0.5, float(line[0])), float(line[1])
    return model


def labelled_words(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str, each: int, most_words: int
) -> DataFrame:
    """``(id, label, words)``: at most ``each`` toxic and four times as many clean training documents, in order of a hash.

    Of a document at most ``most_words`` distinct words are used for fitting.
    """
    own = labels.where(train & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"))
    own = own.groupBy("id").agg(F.max("label").cast("int").alias("label"))
    order = F.xxhash64("id")
    chosen = own.where("label = 1").orderBy(order).limit(each).union(own.where("label = 0").orderBy(order).limit(4 * each))

    def run(batches):
        for batch in batches:
            words = [sorted(set(words_of(t.decode("utf-8", "replace"))), key=lambda w: zlib.crc32(w.encode()))[:most_words] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.string()))], names=["id", "label", "words"]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("id"), raw_text(text_col).alias("text"))
    # at most 5 * each ids, so the broadcast has a fixed bound
    return texts.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(run, "id long, label int, words array<string>")


def fitted(sample: DataFrame, landmarks: int, chance: float) -> Model:
    """The model of a sample of fixed size, fitted in one task."""

    def run(batches):
        rows = []
        for batch in batches:
            rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
        rows.sort()
        toxic, clean = ([[sys.intern(w) for w in words] for _, label, words in rows if label == kind] for kind in (1, 0))
        model = fit(toxic, clean, landmarks=landmarks, chance=chance)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model, protocol=5)], pa.binary())], names=["model"])

    return pickle.loads(sample.repartition(1).mapInArrow(run, "model binary").first().model)


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), most: int = 400_000
) -> DataFrame:
    """``(id_col, score)`` of every whole text, from 0 to 1, and ``row`` if columns are carried.  See ``toxicity``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        known: dict[str, float] = {}
        judge = shared.value
        for batch in batches:
            out = []
            for data in batch.column(1).to_pylist():
                if judge.table is None:
                    out.append(0.0)
                    continue
                words = words_of(data.decode("utf-8", "replace"))
                if new := [w for w in set(words) if w not in known]:
                    if len(known) > most:
                        known.clear()
                        new = list(set(words))
                    known.update(zip(new, judge.units(new).tolist()))
                out.append(judge.probability(max(map(known.__getitem__, words), default=-1.0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.float64()), *batch.columns[2:]], names=["id", "score", *batch.schema.names[2:]]
            )

    row = [F.struct(*carry).alias("row")] if carry else []
    source = docs.select(F.col(id_col).alias("id"), raw_text(text_col).alias("text"), *row)
    fields = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), *source.schema.fields[2:]]
    scored = source.mapInArrow(run, T.StructType(fields))
    return scored.select(F.col("id").alias(id_col), "score", *(["row"] if carry else []))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    each: int = 500,
    most_words: int = 4000,
    landmarks: int = 192,
    carry: tuple[str, ...] = (),
    chance: float = 0.01,
) -> DataFrame:
    """``(id_col, score)``: how likely ``label_col`` is 1, for every row of ``docs`` by its whole text.

    The model is fitted on labels for which the column ``train`` holds: at most
    ``each`` toxic and ``4 * each`` clean documents, ``most_words`` distinct
    words of each, and of a word its first 4,096 characters (64 to find insults
    in).  Near copies among them, of a word-set similarity of 0.8 or more, count
    once where insults are chosen.  Of the grams whose evidence names
    insults, a share of ``chance`` may be expected by accident, so the evidence
    needed follows from the sample; too few labels for any find nothing toxic.
    Scores read every word to its end.  Words that account for a toxic label stand against words of
    clean documents; hard ones are mined from all words of the sample.  Labels
    that are null are not used; of several labels of one id the largest counts.
    Without usable labels of both kinds every score is 0.  Null and empty texts
    score as a document without words.  Repeated rows and rows without an id
    are scored like others.  Columns in ``carry`` come back in a struct ``row``;
    others are not read, whatever their names.  An empty table gives an empty
    result.

    Scale: one pass over the texts without a shuffle; the model is a table of
    fixed size.
    """
    model = fitted(labelled_words(docs, labels, train, id_col, text_col, label_col, each, most_words), landmarks, chance)
    return score_documents(docs, model, id_col, text_col, carry)
