"""SimHash near-duplicates: pigeonhole blocks, a join on them, exact Hamming distance."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.common import raw_text, stored, word_blocks
from sparkseries.llm.components import components

_SEED = 42
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACE = (np.arange(8, dtype=np.uint16) * 256)[None, :]


def bit_counts(values: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit."""
    places = values.view(np.uint8).reshape(-1, 8) + _PLACE
    return (np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel()


def majority(ones: np.ndarray, total: int) -> int:
    """The bits that more than half of ``total`` values have, as a signed number."""
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint(data: bytes, words_per_shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number.

    A bit is 1 where more than half of the shingles' XXH64 values have it.
    """
    k = words_per_shingle
    ones, total, carry = np.zeros(64, np.int64), 0, []
    data = data.lower()
    for block in word_blocks(data):
        words = carry + block
        if len(words) >= k:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
            values = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(_SEED)), np.uint64)
            ones += bit_counts(values)
            total += len(values)
        carry = words[max(0, len(words) - k + 1) :]
    if not total:
        if not carry:
            return 0
        total = 1
        ones = bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(carry), _SEED)], np.uint64))
    return majority(ones, total)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """``(id, fp)`` of every row; the whole text is read, null counts as empty."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t, words_per_shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=["id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), raw_text(text_col).alias("text"))
    return source.mapInArrow(run, "id long, fp long")


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of all choices of ``blocks - distance`` blocks of the 64 bits, as signed numbers.

    At most ``distance`` blocks can hold a differing bit, so two fingerprints
    within ``distance`` agree under at least one mask.
    """
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    single = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(single, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close_pairs(fps: DataFrame, distance: int = 3, blocks: int = 6) -> DataFrame:
    """``(u, v)``, u < v: all pairs of distinct fingerprints (column ``fp``) within ``distance`` bits.

    A pair comes once, from the first mask under which it agrees.  Copies were
    merged into one fingerprint before, so a hot text is one row here.
    """
    masks = block_masks(distance, blocks)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]))
    posts = fps.select("fp", keys.alias("k")).select("fp", "k.i", "k.key")
    a, b = posts.alias("a"), posts.alias("b")
    apart = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    close = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.i") == F.col("b.i"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(apart) <= distance)
        & (first == F.col("a.i"))
    )
    return a.join(b, close).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = 3,
    blocks: int = 6,
    words_per_shingle: int = 3,
) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` of every row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits.  ``component_id`` is the
    smallest id that links of at most ``distance`` bits reach, the row itself
    included.  Null and empty texts have fingerprint zero and link like others.
    A row without an id takes part; it gets the smallest id of its component,
    or null where no row of it has one.  Repeated rows repeat in the result.
    Other columns of ``docs`` are not read, whatever their names.  An empty
    table gives an empty result.

    Scale: texts are read once and never shuffled.  Links and components run on
    distinct fingerprints, which are aggregated before the shuffle.  A bucket is
    a join key, never a collected group, and adaptive execution splits hot ones.
    """
    fps = stored(fingerprints(docs, id_col, text_col, words_per_shingle), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("least"))
    linked = components(close_pairs(distinct.select("fp"), distance, blocks))
    rooted = distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(names, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
