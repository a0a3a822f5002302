"""Phrases by prefix-free parsing: n-grams are counted once in each distinct chunk, weighted by how often the parse holds it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.llm.common import raw_text, stored

_PUNCTUATION = b".,;:!?\n\v\f\r"
#: A-Z in lower case, piece ends as line breaks, tabs as spaces
_PLAIN = bytes(10 if b in _PUNCTUATION else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MULTIPLIER = 0x9E3779B97F4A7C15
_BITS = 26  # log2 of the size of the table that rules grams out
_MASK = (1 << 64) - 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words that begin at each word but the last ``n - 1``."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        out = out * np.uint64(_MULTIPLIER) + h[i : i + len(out)]
    return _mixed(out)


def words_of(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of a plain text, the number of the piece that each lies in, and a hash of each."""
    codes = np.frombuffer(data, np.uint8)
    letter = (codes != 32) & (codes != 10)
    edges = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    letters, sizes = codes[letter], ends - starts
    offsets = np.r_[0, np.cumsum(sizes)]
    words = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters)])
    place = (np.arange(len(letters)) - np.repeat(offsets[:-1], sizes)) & 63
    powers = np.array([pow(_MULTIPLIER, i + 1, 1 << 64) for i in range(64)], np.uint64)
    hashes = np.add.reduceat(powers[place] * letters, offsets[:-1]) if len(sizes) else np.zeros(0, np.uint64)
    return words, np.cumsum(codes == 10)[starts], _mixed(hashes)


def parse(words: pa.Array, piece: np.ndarray, hashes: np.ndarray, overlap: int, distance: int) -> tuple[pa.Array, np.ndarray]:
    """Chunks of the pieces, and the number of words of each that begin n-grams counted in it.

    A trigger is a run of ``overlap`` words whose hash is divisible by
    ``distance``.  A chunk goes from the start of its piece or of a trigger to
    the end of the next trigger or of the piece; so it ends in the first trigger
    after its start, and no chunk is a proper prefix of another that does.
    N-grams of up to ``overlap + 1`` words belong to the chunk that they begin
    in, before its last trigger.
    """
    n = len(words)
    new = np.diff(piece, prepend=-1) != 0
    piece_end = np.r_[np.flatnonzero(new)[1:], n][np.cumsum(new) - 1]
    trigger = np.zeros(n, bool)
    trigger[: max(0, n - overlap + 1)] = _rolling(hashes, overlap) % np.uint64(distance) == 0
    at = np.arange(n)
    trigger &= at + overlap <= piece_end
    starts = np.flatnonzero(new | trigger)
    following = np.r_[starts[1:], n]
    last = following == piece_end[starts]
    # the next start may be the next piece's; a trigger's words go along with the chunk before it
    stops = np.where(last, following, following + overlap)
    sizes = stops - starts
    taken = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), words.take(pa.array(taken)))
    return pc.binary_join(lists, b" "), following - starts


def _stretches(data: bytes, size: int) -> Iterator[bytes]:
    """A plain text in stretches of about ``size`` bytes that end at a piece's end; a longer piece is one stretch."""
    start = 0
    while len(data) - start > size and (stop := data.find(b"\n", start + size)) >= 0:
        yield data[start:stop]
        start = stop + 1
    yield data[start:]


def _chunks(overlap: int, distance: int, size: int):
    """Chunks of the texts with how often they occur in a stretch of the task."""

    def counted(lang: str, parts: list[bytes]) -> pa.RecordBatch:
        chunks, own = parse(*words_of(b"\n".join(parts)), overlap, distance)
        found = pa.table({"chunk": chunks, "own": own}).group_by(["chunk", "own"], use_threads=False).aggregate([([], "count_all")])
        columns = [pa.array([lang] * found.num_rows, pa.string()), found["chunk"].combine_chunks(), found["own"].combine_chunks(), found["count_all"].combine_chunks()]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=["lang", "chunk", "own", "freq"])

    def run(batches):
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, int] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _stretches(data.translate(_PLAIN), size):
                    waiting.setdefault(lang, []).append(part)
                    held[lang] = held.get(lang, 0) + len(part)
                    if held[lang] >= size:
                        yield counted(lang, waiting.pop(lang))
                        held[lang] = 0
            if sum(held.values()) >= 4 * size:  # many languages
                yield from (counted(*x) for x in waiting.items())
                waiting, held = {}, {}
        yield from (counted(*x) for x in waiting.items())

    return run


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)


def _gathered(batches, rows: int) -> Iterator[pa.Table]:
    """Batches put together, in tables of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _by_lang(part: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    for lang in part["lang"].unique().to_pylist():
        yield lang, part.filter(pc.equal(part["lang"], lang))


def grams(n: int, chunks: pa.Array, own: np.ndarray, freq: np.ndarray, lang: str, shorter: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    """Phrases of ``n`` words and how often they occur in the weighted chunks.

    ``shorter`` is the bit table of the frequent phrases of ``n - 1`` words; a
    phrase is left out only if the table shows that one of its two parts is rare.
    """
    lists = pc.split_pattern(chunks, b" ")
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    words = lists.flatten().dictionary_encode()
    index = words.indices.to_numpy().astype(np.int64)
    chunk = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    begins = (inside < own[chunk]) & (inside + n <= sizes[chunk])
    if shorter is not None:
        hashes = _word_hashes(lang, words.dictionary.to_pylist())[index]
        place = _places(_rolling(hashes, n - 1))
        known = np.zeros(len(index) + 1, bool)
        known[: len(place)] = (shorter[place >> 3] >> (place & 7).astype(np.uint8)) & 1
        begins &= known[:-1] & known[1:]
    starts = np.flatnonzero(begins)
    key = index[starts]
    for i in range(1, n):
        key = np.unique(key, return_inverse=True)[1] * np.int64(len(words.dictionary)) + index[starts + i]
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    counts = np.add.reduceat(freq[chunk[starts]][order], first) if len(first) else np.zeros(0, np.int64)
    at = starts[order][first]
    parts = [words.dictionary.take(pa.array(index[at + i])) for i in range(n)]
    return (pc.binary_join_element_wise(*parts, b" ") if n > 1 else parts[0]), counts


def _grams(n: int, shorter, rows: int = 200_000, held: int = 400_000):
    """``(lang, phrase, n)`` of a task's chunks, put together before they leave it."""

    def run(batches):
        partial: list[pa.Table] = []
        for part in _gathered(batches, rows):
            for lang, own in _by_lang(part):
                own = own.combine_chunks()
                chunks = own["chunk"].combine_chunks().cast(pa.binary())
                phrases, counts = grams(n, chunks, own["own"].to_numpy(), own["freq"].to_numpy(), lang, None if shorter is None else shorter.value)
                partial.append(pa.table({"lang": pa.array([lang] * len(phrases), pa.string()), "phrase": phrases, "n": counts}))
            if sum(t.num_rows for t in partial) > held:
                yield from merged(partial)
                partial = []
        yield from merged(partial)

    def merged(partial: list[pa.Table]):
        if partial:
            whole = pa.concat_tables(partial).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
            yield from whole.rename_columns(["lang", "phrase", "n"]).cast(pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])).to_batches(50_000)

    return run


def _phrase_places(n: int):
    """The place of each phrase of ``n`` words in the bit table."""

    def run(batches):
        for batch in batches:
            for lang, own in _by_lang(pa.Table.from_batches([batch])):
                words = pc.split_pattern(own["phrase"].combine_chunks().cast(pa.binary()), b" ").flatten().to_pylist()
                place = _places(_rolling(_word_hashes(lang, words), n)[::n])
                yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])

    return run


def _bit_table(frequent: DataFrame, n: int) -> np.ndarray:
    """Bits of frequent phrases, of a size that does not depend on their number."""
    places = frequent.select("lang", "phrase").mapInArrow(_phrase_places(n), "place long")
    pages = places.groupBy(F.bitmap_bucket_number("place").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    table = np.zeros(1 << (_BITS - 3), np.uint8)
    for page in pages.collect():  # at most 2 ** (_BITS - 15) pages of 4096 bytes
        # bucket 1 begins at place 1; place 0 alone lies in bucket 0
        bits = np.flatnonzero(np.unpackbits(np.frombuffer(page.bits, np.uint8), bitorder="little"))
        place = bits + (page.page - 1) * 32768 + 1 if page.page else bits * 0
        np.bitwise_or.at(table, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    return table


def frequent_grams(docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int, distance: int, size: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, k, f)`` of all phrases of up to ``longest`` words that occur ``least`` times, and ``(lang, n)``: the number of words."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), raw_text(text_col).alias("text"))
    parsed = source.mapInArrow(_chunks(longest - 1, distance, size), "lang string, chunk binary, own long, freq long")
    chunks = stored(parsed.groupBy("lang", "chunk", "own").agg(F.sum("freq").alias("freq")), "phrase-chunks")
    words = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    levels, shorter = [], None
    for n in range(1, longest + 1):
        counted = chunks.select("lang", "chunk", "own", "freq").mapInArrow(_grams(n, shorter), "lang string, phrase binary, n long")
        level = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        level = stored(level.select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(n).alias("k"), "f"), f"phrases-{n}")
        levels.append(level)
        if shorter is not None:
            shorter.unpersist()
        if n < longest:
            shorter = spark.sparkContext.broadcast(_bit_table(level, n))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.union(level)
    return whole, words


def _scores(scale: int):
    """Scores in whole numbers of any size."""

    def run(batches):
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in ("a", "n", "l", "r")]
            score = [scale * a * n // (left * right) for a, n, left, right in zip(*values)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.int64())], names=[*batch.schema.names, "score"])

    return run


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    longest: int = 5,
    covered: int = 100,
    top: int = 2000,
    scale: int = 1000,
    distance: int = 32,
    size: int = 1 << 22,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language by association.

    A-Z are lower-cased; a text splits at ``[.,;:!?\\n\\v\\f\\r]`` into pieces and
    these at spaces and tabs into words.  A phrase is 2 to ``longest`` words of
    a piece; ``a`` is how often it occurs, overlaps included, and at least
    ``least``; ``n`` is the number of words of the language.  A cut into two
    parts that occur ``l`` and ``r`` times gives ``floor(scale * a * n / (l *
    r))``; the lowest score counts, of equal ones the first cut.  A phrase is
    dropped if a longer one holds it in a row and occurs at least ``covered``
    hundredths as often.  Order: score and ``a`` falling, then the phrase in the
    order of its UTF-8 bytes.

    Null languages are ``und``; null and empty texts have no words; repeated
    rows count each time; ids and other columns are not read, whatever their
    names.  An empty table gives an empty result.  A text is worked in stretches
    of about ``size`` bytes that end with a piece; a single longer piece is one
    stretch.

    Scale: texts are parsed once into content-cut chunks, and equal chunks
    become one row with a frequency, in the task first and then by a shuffle; a
    passage that a third of all documents hold is counted once.  Grams are
    counted by their number of words, one pass each over the chunks.  A gram is
    shuffled only if a bit table does not rule out that both of its shorter
    parts are frequent.  The table has 2**26 bits at any size of the input:
    where it fills up, more grams are shuffled and the result is the same.  The
    best of a language are cut in 64 slices before one task orders them.
    """
    found, words = frequent_grams(docs, text_col, lang_col, least, longest, distance, size)
    parts = F.split("phrase", " ")
    candidates = found.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "k", parts.alias("parts"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("parts", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"),
    )
    left = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    joined = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(words, "lang").select("lang", "phrase", "a", "cut", "l", "r", "n")
    scored = joined.mapInArrow(_scores(scale), "lang string, phrase string, a long, cut int, l long, r long, n long, score long")
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    inner = F.expr(
        "flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> array_join(slice(parts, i, s), ' '))))"
    )
    longer = candidates.where("k > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    stays = lowest.join(longer, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < covered * F.col("a")))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    sliced = stays.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
