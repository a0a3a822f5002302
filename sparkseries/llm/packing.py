"""Packing of tokenised documents into fixed windows by non-negative least squares over length combinations."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.bpe import Words, byte_alphabet, token_sizes
from sparkseries.llm.common import give_back_memory, raw_text, stored

_TOKENIZERS: dict[str, Words] = {}


def tokenizer(path: str) -> Words:
    """Word-by-word encoding by the tokenizers library, loaded once in each Python worker."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        special = {token.content for token in made.get_added_tokens_decoder().values()}
        sizes = token_sizes({i: t.encode() if t in special else t for t, i in made.get_vocab().items()})
        whole = lambda text: made.encode_batch_fast([text], add_special_tokens=False)[0].ids
        _TOKENIZERS[path] = Words(whole, sizes, 1_000_000, None if any(t.isalpha() for t in special) else _alone(made))
    return _TOKENIZERS[path]


def _alone(made):
    """The ids of a word of letters with a space before it, by the library's model without the split."""
    letters = {b: c for c, b in byte_alphabet().items()}
    space, tokenize = letters[32], made.model.tokenize
    made.model._resize_cache(0)  # words are remembered here

    def ids(word: str) -> list[int]:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
        return [token.id for token in tokenize(space + shown)]

    return ids


def combinations(window: int, step: int) -> list[tuple[int, ...]]:
    """Shallow multisets of lengths that leave no padding.

    One length that is a power of two; two lengths that fill the window; three
    that fill it, two of them equal or all but one multiples of ``step``.
    """
    singles = [(1 << i,) for i in range(window.bit_length()) if 1 << i <= window]
    pairs = [(a, window - a) for a in range(1, window // 2 + 1)]
    twins = [(a, a, window - 2 * a) for a in range(1, (window - 1) // 2 + 1)]
    coarse = [
        (a, b, window - a - b)
        for a in range(step, window, step)
        for b in range(a + step, window - a, step)
        if b < window - a - b
    ]
    return singles + pairs + twins + coarse


def least_squares(columns: list[tuple[int, ...]], wanted: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Repeat counts ``x >= 0`` of the combinations that bring the used lengths near ``wanted``, by coordinate descent.

    Minimises the sum over lengths of (used - wanted) squared; each step solves
    one combination's count exactly and keeps it non-negative.
    """
    x = np.zeros(len(columns))
    left = wanted.astype(np.float64).copy()
    parts = [np.unique(c, return_counts=True) for c in columns]
    usable = [j for j, (lengths, _) in enumerate(parts) if (wanted[lengths] > 0).all()]
    for _ in range(rounds):
        moved = 0.0
        for j in usable:
            lengths, times = parts[j]
            new = max(0.0, x[j] + float(left[lengths] @ times) / float(times @ times))
            if new != x[j]:
                left[lengths] -= times * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved < 0.5:
            break
    return x


class Plan:
    """Where the piece of a given length and rank goes; its size depends on the window alone."""

    def __init__(self, histogram: dict[int, int], window: int, step: int):
        self.window = window
        left = np.zeros(window + 1, np.int64)
        for length, n in histogram.items():
            left[length] = n
        columns = combinations(window, step)
        solved = least_squares(columns, left)
        slots: list[list[tuple[int, int, int]]] = [[] for _ in range(window + 1)]  # first rank, first sequence, offset
        used = np.zeros(window + 1, np.int64)
        sequences = 0
        for j in np.argsort(-solved, kind="stable"):
            lengths, times = np.unique(columns[j], return_counts=True)
            count = int(min(np.floor(solved[j] + 0.5), (left[lengths] // times).min()))
            if count <= 0:
                continue
            offset = 0
            for length in columns[j]:
                slots[length].append((int(used[length]), sequences, offset))
                used[length] += count
                left[length] -= count
                offset += length
            sequences += count
        self.slots = [np.array(s, np.int64).reshape(-1, 3) for s in slots]
        self.used, self.sequences = used, sequences
        #: residual pieces lie end to end, longest first
        tokens = left * np.arange(window + 1)
        self.begin = tokens[::-1].cumsum()[::-1] - tokens

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """``(from, length, sequence, offset)`` of the parts of a piece."""
        if rank < self.used[length]:
            slots = self.slots[length]
            first, sequence, offset = slots[np.searchsorted(slots[:, 0], rank, side="right") - 1].tolist()
            return [(0, length, sequence + rank - first, offset)]
        at = int(self.begin[length]) + (rank - int(self.used[length])) * length
        out, done = [], 0
        while done < length:
            offset = (at + done) % self.window
            n = min(length - done, self.window - offset)
            out.append((done, n, self.sequences + (at + done) // self.window, offset))
            done += n
        return out


def _slices(batches, rows: int = 1_000):
    """Batches in parts, so that few texts lie in memory with all their ids."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _pieces(path: str, window: int, end_id: int):
    """Documents' ids cut at window lengths; what is left over keeps its ids."""

    def run(batches):
        words, part = tokenizer(path), TaskContext.get().partitionId()
        ranks = [0] * (window + 1)
        end = np.array([end_id], "<u4").tobytes()
        for batch in _slices(batches):
            rows, out = [], [[] for _ in range(6)]
            for row, data in enumerate(batch.column(1).to_pylist()):
                ids = words.encode(data.decode("utf-8", "replace")) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    own = ids[4 * start : 4 * (start + window)]
                    n = len(own) // 4
                    rows.append(row)
                    for column, value in zip(out, (start, n, zlib.crc32(own), total, ranks[n], own if n < window else None)):
                        column.append(value)
                    ranks[n] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), pa.array([part] * len(rows), pa.int32()), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["id", "part", "start", "length", "crc", "total", "rank", "ids"],
            )
        give_back_memory()

    return run


def _placed(plan: Plan):
    def run(batches):
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in ("start", "length", "crc", "rank", "ids")]
            rows, out = [], [[] for _ in range(5)]
            for row, (start, length, crc, rank, ids) in enumerate(zip(*values)):
                for at, n, sequence, offset in plan.place(length, rank):
                    rows.append(row)
                    own = crc if n == length else zlib.crc32(ids[4 * at : 4 * (at + n)])
                    for column, value in zip(out, (start + at, n, own, sequence, offset)):
                        column.append(value)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("total").take(at), *(pa.array(c, pa.int64()) for c in out)],
                names=["id", "doc_tokens", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 1024,
    end_id: int = 0,
    step: int = 64,
) -> DataFrame:
    """``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece.

    A document is its ids by the tokenizers library, without special tokens
    added, then ``end_id``; ``vocabulary`` is the path of its file on every
    worker.  Null counts as empty, and an empty text is one piece of one id.
    Each id lies in exactly one piece, each sequence is filled without gaps
    from 0, and at most one sequence is neither full nor a power of two long.
    Repeated rows and rows without an id are documents of their own.  Other
    columns of ``docs`` are not read, whatever their names.  An empty table
    gives an empty result.

    Documents are cut at window lengths.  The lengths of what is left are
    counted; non-negative least squares over shallow length combinations gives
    how often each is used; counts are rounded within what there is; the pieces
    that remain are laid end to end and cut where a sequence is full.

    Scale: texts are tokenised once.  The driver sees one count for each length
    up to the window.  A piece's rank among those of its length is the rank in
    its task plus a running total over tasks, so a length that a third of all
    pieces share is never gathered.
    """
    source = docs.select(F.col(id_col).alias("id"), raw_text(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = stored(
        source.mapInArrow(_pieces(vocabulary, window, end_id), f"id {kind}, part int, start long, length int, crc long, total long, rank long, ids binary"),
        "pieces",
    )
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, window, step)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(totals, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.select("id", "start", "length", "crc", "total", "rank", "ids").mapInArrow(
        _placed(plan), f"id {kind}, doc_tokens long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
