"""Quality by positive-unlabelled learning: non-negative unbiased risk over trusted positives and all web text."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.common import raw_text, stored, word_blocks

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b"!#$%&*|<>{}[]\\^~_=+@/"
_STOPS = b".,;:?'\"()-"
NAMES = (
    "words", "word_length", "long_words", "upper", "digits", "marks", "stops", "lines", "distinct", "repeats",
    "marked_words", "upper_words", "top_word", "bars", "few_words", "other_bytes",
)


def _block(words: list[bytes]) -> np.ndarray:
    """Sums over a block of words; ``features`` turns them into shares."""
    n = len(words)
    counts = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    joined = b"".join(words)
    size = len(joined)

    def share(of: bytes) -> int:
        return size - len(joined.translate(None, of))

    marked = sum(w[-1] in _MARKS for w in words)
    upper = sum(len(w) > 1 and w.isupper() for w in words)
    classes = [share(c) for c in (_UPPER, _LOWER, _DIGITS, _MARKS, _STOPS)]
    return np.array(
        [n, size, sum(len(w) > 20 for w in words), classes[0], classes[2], classes[3], classes[4], len(counts), repeats, marked, upper,
         max(counts.values(), default=0), joined.count(b"|"), size - sum(classes)], np.float64,
    )


def features(data: bytes) -> np.ndarray:
    """Shape of a text in shares that do not depend on its language; blocks of a long text are summed up."""
    total = np.zeros(14)
    for words in word_blocks(data):
        if words:
            total += _block(words)
    n, size = max(1.0, total[0]), max(1.0, total[1])
    return np.array(
        [np.log1p(total[0]), min(30.0, size / n), total[2] / n, total[3] / size, total[4] / size, total[5] / size, total[6] / size,
         (data.count(b"\n") + 1) / n, total[7] / n, total[8] / n, total[9] / n, total[10] / n, total[11] / n, total[12] / n,
         float(total[0] < 20), total[13] / size]
    )


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["id", "x"])

    return docs.select(F.col(id_col).alias("id"), raw_text(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def _summed(rows: DataFrame, sums, size: int) -> np.ndarray:
    """``size`` sums over all rows; each task adds up its own, Spark adds up the tasks."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                total += sums(x, batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    parts = rows.select("x", "trusted").mapInArrow(run, "i int, v double")
    out = np.zeros(size)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out


class Model:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z**2 / 6, np.ones((len(z), 1))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -40, 40)))


def class_prior(labels: DataFrame, label_col: str) -> float:
    """Share of label 1, with one more label of each kind."""
    row = labels.agg(F.sum((F.col(label_col) == 1).cast("long")).alias("one"), F.count(label_col).alias("all")).first()
    return ((row.one or 0) + 1) / (row.all + 2)


def fit(rows: DataFrame, prior: float, ridge: float = 1e-3, rounds: int = 14) -> Model:
    """Weights that minimise the non-negative unbiased risk over *all* rows (``x``, ``trusted``).

    With the logistic loss the risk is ``-prior * mean(f)`` over the trusted
    rows plus ``mean(log(1 + exp(f)))`` over all rows.  Its second part less the
    trusted rows' share estimates the risk on negatives and must not fall below
    zero; a Newton step that would take it there is shortened.  Each round is
    one pass that returns sums of fixed size.
    """
    d = len(NAMES)
    first = _summed(rows, lambda x, t: np.concatenate([[len(x), t.sum()], x.sum(0), (x**2).sum(0)]), 2 + 2 * d)
    n, trusted = first[0], first[1]
    if not n or not trusted:
        return Model(np.zeros(d), np.ones(d), np.zeros(2 * d + 1))
    mean = first[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(first[2 + d :] / n - mean**2, 1e-12)) + 1e-9
    m = 2 * d + 1
    w, step = np.zeros(m), np.zeros(m)
    safe = w  # the last weights found to keep the risk on negatives from falling below zero
    for _ in range(rounds):
        model = Model(mean, scale, w)

        def sums(x: np.ndarray, t: np.ndarray, model: Model = model) -> np.ndarray:
            z = model.design(x)
            f = z @ model.weights
            p = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
            loss = np.logaddexp(0, f)
            h = (z * (p * (1 - p))[:, None]).T @ z
            return np.concatenate([[loss.sum(), loss[t].sum()], z[t].sum(0), z.T @ p, h.ravel()])

        s = _summed(rows, sums, 2 + 2 * m + m * m)
        negative = s[0] / n - prior * s[1] / trusted
        if negative < 0:
            step = step / 2
            w = safe + step
            continue
        safe = w
        keep = np.full(m, ridge)
        keep[-1] = 1e-6
        gradient = -prior * s[2 : 2 + m] / trusted + s[2 + m : 2 + 2 * m] / n + keep * w
        step = -np.linalg.solve(s[2 + 2 * m :].reshape(m, m) / n + np.diag(keep), gradient)
        step *= min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-3:
            break
        w = w + step
    return Model(mean, scale, safe)


def quality(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """``(id_col, score)``: how likely ``label_col`` is 1, for every row of ``docs`` by its whole text.

    Trusted positives are the documents with label 1 for which the column
    ``train`` holds; every row of ``docs`` is unlabelled text.  The class prior
    is the share of label 1 among those labels.  Null labels are not used; of
    several labels of one id the largest counts.  Null and empty texts are
    texts without words.  Without a trusted positive every score is 0.5.
    Repeated rows and rows without an id are scored like others.  Other columns
    are not read, whatever their names.  An empty table gives an empty result.

    Scale: one pass over the texts gives a table of a few numbers a row; the
    risk is summed over all of it, and only sums of fixed size reach the driver.
    """
    own = labels.where(train & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    own = own.groupBy("id").agg(F.max("label").alias("label"))
    table = stored(feature_table(docs, id_col, text_col), "quality-features")
    trusted = own.where("label = 1").select("id", F.lit(True).alias("marked"))
    rows = stored(table.join(trusted, "id", "left").select("id", "x", F.coalesce("marked", F.lit(False)).alias("trusted")), "quality-rows")
    model = fit(rows, class_prior(own, "label"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(x))], names=[id_col, "score"])

    return rows.select("id", "x").mapInArrow(run, f"`{id_col}` {kind}, score double")
