"""Repeated lines: hashes in range partitions, sorted by document, streamed once.

The decisions are compressed keep bitmaps, one per document, so no line of text
is ever shuffled to find them; ``deduplicate_lines`` cuts the texts by them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.llm.common import raw_text, stored

_BLANK = b" \t\n\v\f\r"
_POSTS = "h1 long, h2 long, id long, text_hash long, lines binary"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without outer white space, A-Z lower-cased; None if it is shorter than ``min_chars`` code points."""
    key = line.strip(_BLANK)
    if len(key) < min_chars:
        return None
    if not key.isascii() and sum(b & 0xC0 != 0x80 for b in key) < min_chars:
        return None
    return key.lower()


def _posts(min_chars: int):
    """One row per document and distinct key: a 128-bit hash, the document and the key's line numbers."""

    def run(batches):
        for batch in batches:
            hashes, rows, lines = [], [], []
            for row, data in enumerate(batch.column(2).to_pylist()):
                found: dict[bytes, list[int]] = {}
                for n, line in enumerate(data.split(b"\n")):
                    if (key := line_key(line, min_chars)) is not None:
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(n)
                hashes += found
                rows += [row] * len(found)
                lines += [np.array(at, "<i4").tobytes() for at in found.values()]
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column(0).take(at), batch.column(1).take(at), pa.array(lines, pa.binary())],
                names=["h1", "h2", "id", "text_hash", "lines"],
            )

    return run


def _stream(min_docs: int):
    """Streams a partition sorted by hash and falling id; yields rows that lose their lines, and undecided ones.

    The first id of a run of equal hashes keeps its lines.  Rows of a run inside
    the partition are decided at once.  The first and the last run may go on in
    a neighbouring partition; their rows leave as ``edge``, with the run's
    number of ids in this partition on its first row.
    """

    def rows(part: pa.Table, edge: bool, n):
        return part.append_column("edge", pa.array(np.full(part.num_rows, edge))).append_column("n", pa.array(n)).to_batches()

    def columns(part: pa.Table):
        return [part.column(i).to_numpy() for i in range(3)]

    def as_edge(run: list[pa.Table]):
        part = pa.concat_tables(run)
        ids, n = part.column(2).to_numpy(), np.zeros(part.num_rows, np.int64)
        n[0] = 1 + np.count_nonzero(ids[1:] != ids[:-1])
        return rows(part, True, n)

    def decided(part: pa.Table):
        h1, h2, ids = columns(part)
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        group = np.cumsum(new) - 1
        docs = np.bincount(group, weights=new | np.r_[True, ids[1:] != ids[:-1]])
        drop = (docs[group] >= min_docs) & (ids != ids[new][group])
        part = part.filter(pa.array(drop))
        return rows(part, False, np.zeros(part.num_rows, np.int64))

    def run(batches):
        pending: list[pa.Table] = []  # the rows so far of the run that is still open
        first = True
        for batch in batches:
            part = pa.Table.from_batches([batch])
            if not part.num_rows:
                continue
            h1, h2, _ = columns(part)
            key = [pending[-1].column(i)[-1].as_py() for i in range(2)] if pending else [h1[0], h2[0]]
            new = np.r_[[key[0] != h1[0] or key[1] != h2[0]], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            starts = np.flatnonzero(new)
            if not len(starts):
                pending.append(part)
                continue
            ended = [*pending, part.slice(0, starts[0])]
            yield from as_edge(ended) if first else decided(pa.concat_tables(ended))
            first = False
            if starts[-1] > starts[0]:
                yield from decided(part.slice(starts[0], starts[-1] - starts[0]))
            pending = [part.slice(starts[-1])]
        if pending:
            yield from as_edge(pending)

    return run


def _bitmap(lines: list[bytes]) -> bytes:
    at = np.unique(np.frombuffer(b"".join(lines), "<i4"))
    keep = np.ones((at[-1] // 8 + 1) * 8, np.uint8)
    keep[at] = 0
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def _bitmaps(batches):
    for batch in batches:
        maps = [_bitmap(lines) for lines in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(maps, pa.binary())], names=["id", "text_hash", "keep"]
        )


def _numbered(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    text = raw_text(text_col)
    row = [F.struct(*carry).alias("row")] if carry else []
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"), *row)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``(id, text_hash, keep)``: for each document that loses lines a compressed bitmap of the lines it keeps.

    Bit ``i`` of the zlib-compressed ``keep`` (lowest bit first) is 1 if line
    ``i`` stays; lines beyond the bitmap stay.  ``text_hash`` is ``xxhash64`` of the text's bytes;
    it tells rows of one id with different texts apart, each of which is judged
    by itself and counts for that id.  Rows without an id neither count nor
    lose lines.  See ``deduplicate_lines`` for the rule.

    Scale: only hashes are shuffled, one row per document and key.  Ranges are
    cut over (hash, id), so a line that a third of all documents hold lies in
    many partitions; what is known about the at most two runs at the ends of
    each partition is gathered by a partial aggregate.
    """
    source = _numbered(docs, id_col, text_col).where("id IS NOT NULL")
    posts = stored(source.mapInArrow(_posts(min_chars), _POSTS), "line-posts")
    order = [F.col("h1"), F.col("h2"), F.col("id").desc()]
    runs = (
        posts.repartitionByRange(*order)
        .sortWithinPartitions(*order, "text_hash")
        .mapInArrow(_stream(min_docs), _POSTS + ", edge boolean, n long")
    )
    runs = stored(runs, "line-runs")
    # at most two hashes for each partition of the stream
    edges = runs.where("edge").groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("id").alias("last"))
    edges = edges.where(F.col("docs") >= min_docs).select("h1", "h2", "last")
    settled = runs.where("edge").join(F.broadcast(edges), ["h1", "h2"]).where("id <> last")
    drops = runs.where("NOT edge").select("id", "text_hash", "lines").union(settled.select("id", "text_hash", "lines"))
    return (
        drops.groupBy("id", "text_hash")
        .agg(F.collect_list("lines").alias("lines"))
        .mapInArrow(_bitmaps, "id long, text_hash long, keep binary")
    )


def _cut(batches):
    for batch in batches:
        texts, counts, dropped = [], [], []
        for data, keep in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            n = data.count(b"\n") + 1
            lost = 0
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
                lines = data.split(b"\n")
                kept = [x for x, bit in zip(lines, bits) if bit] + lines[len(bits) :]
                data = b"\n".join(kept)
                lost = n - len(kept)
            texts.append(data)
            counts.append(n)
            dropped.append(lost)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.binary()), *batch.columns[3:]],
            names=["id", "n_lines", "n_dropped", "kept", *batch.schema.names[3:]],
        )


def deduplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``(id_col, n_lines, n_dropped, kept)``: every text without the lines that other documents repeat.

    Lines end at ``\\n``; a null or empty text is one empty line.  A line's key
    is the line without outer white space, A-Z lower-cased.  A key of at least
    ``min_chars`` code points that at least ``min_docs`` documents (distinct
    ids) hold loses its lines everywhere but in the document of the largest id;
    that document keeps all of them.  ``kept`` is binary: the other lines joined
    by ``\\n``.  Repeated rows repeat in the result; rows without an id keep all
    lines.  Columns in ``carry`` come back in a struct ``row``; others are not
    read, whatever their names.  An empty table gives an empty result.
    """
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    numbered = _numbered(docs, id_col, text_col, carry)
    joined = numbered.join(maps, ["id", "text_hash"], "left").select("id", "text", "keep", *(["row"] if carry else []))
    fields = [T.StructField("id", T.LongType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    cut = joined.mapInArrow(_cut, T.StructType([*fields, T.StructField("kept", T.BinaryType()), *joined.schema.fields[3:]]))
    return cut.select(F.col("id").alias(id_col), "n_lines", "n_dropped", "kept", *(["row"] if carry else []))


def digest(rows: DataFrame, kept: str = "kept") -> DataFrame:
    """``kept`` replaced by its SHA-256 as lowercase hex."""
    return rows.withColumn("kept_sha256", F.sha2(F.col(kept), 256)).drop(kept)
