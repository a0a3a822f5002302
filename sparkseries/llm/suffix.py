"""Repeated byte strings across documents: prefix doubling over content names, spread over Spark.

A position's rank among all strings of a length is replaced by a name that
equal strings share, so the ranks at growing lengths are formed where the text
is, and Spark only brings equal names together to see which are unique.  Three
rounds grow the length, each on what the round before left: strings of 24 bytes
at chosen positions, the whole context of a position, and single strings of the
threshold's length.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.llm.common import forget, give_back_memory, raw_text, stored
from sparkseries.session import scratch_folder

_BLOCK = 1 << 15
_U64 = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out, x = np.empty(n, _U64), 1
    for i in range(n):
        out[i] = x
        x = x * base % (1 << 64)
    return out


class Names:
    """64-bit names of all strings of a given length: polynomial sums over random byte values, then mixed."""

    def __init__(self, seed: int, base: int, longest: int):
        self.values = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=_U64)
        self.up = _powers(base, _BLOCK + longest)
        self.down = _powers(pow(base, -1, 1 << 64), _BLOCK + longest)

    def of(self, text: np.ndarray, length: int) -> np.ndarray:
        """Names of ``text[i : i + length]``; zero where the text ends before."""
        out = np.zeros(len(text), _U64)
        for at in range(0, len(text) - length + 1, _BLOCK):
            part = self.values[text[at : at + _BLOCK + length - 1]]
            sums = np.zeros(len(part) + 1, _U64)
            np.cumsum(part * self.up[: len(part)], out=sums[1:])
            n = len(part) - length + 1
            out[at : at + n] = _mixed((sums[length:] - sums[:n]) * self.down[:n])
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U64(32))
    x *= _U64(0xD6E8FEB86659FD93)
    x ^= x >> _U64(32)
    x *= _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


_NAMES = Names(7, 0x9E3779B97F4A7C15, 4096)
_OTHER = Names(11, 0xC2B2AE3D27D4EB4F, 4096)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if step < width else x


def anchors(names: np.ndarray, width: int) -> np.ndarray:
    """For each start the position of the smallest of the ``width`` names from there on, the leftmost of equals.

    The choice depends on those names alone, so equal strings choose the same place.
    """
    out = np.full(len(names), -1, np.int32)
    for at in range(0, len(names) - width + 1, _BLOCK):
        part = names[at : at + _BLOCK + width - 1]
        placed = (part & _U64(0xFFFFFFFFFFFF0000)) | np.arange(len(part), dtype=_U64)
        least = _sliding_min(placed, width)
        out[at : at + len(least)] = (least & _U64(0xFFFF)).astype(np.int32) + at
    return out


def _new(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows begin a new key."""
    changed = np.zeros(max(0, len(keys[0]) - 1), bool)
    for k in keys:
        changed |= k[1:] != k[:-1]
    return np.concatenate([np.ones(min(1, len(keys[0])), bool), changed])


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each row, ``count`` numbers each."""
    ends = np.cumsum(count, dtype=first.dtype)
    return np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0, dtype=first.dtype)


class Chunk:
    """Some documents, sorted by id, and what each round knows about them.

    ``runs`` are the longest stretches of string starts that chose the same
    anchor.  All of this is a function of the chunk and of the replies so far,
    so any task can form it again.
    """

    def __init__(self, body: bytes, length: int, gram: int):
        data = pickle.loads(zstandard.decompress(body))
        self.length, self.gram = length, gram
        self.row_ids, self.rest = data["ids"], data["rest"]
        self.text = np.frombuffer(data["text"], np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum(data["lens"])]).astype(np.int64)
        if not len(self.row_ids):
            return
        known = data["known"]
        lens = np.diff(self.bounds)
        n = np.where(known, np.maximum(0, lens - length + 1), 0)
        starts = _spread(self.bounds[:-1].astype(np.int32), n.astype(np.int32))
        doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
        names = _NAMES.of(self.text, gram)
        anchor = anchors(names, length - gram + 1)[starts]
        new = np.flatnonzero(_new(anchor, doc))
        self.first = starts[new].astype(np.int64)
        self.count = np.diff(np.concatenate([new, [len(starts)]]))
        self.anchor = anchor[new].astype(np.int64)
        # the smallest of several names lies near zero; mixed once more, names fill all ranges alike
        self.name = _mixed(names[self.anchor])
        self.id = self.row_ids[doc[new]]

    # round 1: the names of the anchors, 48 bits each

    def short(self):
        keys, where = np.unique(self.name >> _U64(16), return_inverse=True)
        low = np.full(len(keys), np.iinfo(np.int64).max)
        high = np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, where, self.id)
        np.maximum.at(high, where, self.id)
        return keys, low < high, where

    # round 2: anchor and whole context of the runs that are left

    def contexts(self, repeated: np.ndarray, where: np.ndarray):
        left = np.flatnonzero(repeated[where])
        strings = self.strings = _NAMES.of(self.text, self.length)
        first, count = self.first[left], self.count[left]
        whole = _mixed(
            strings[first] * _U64(3) + strings[first + count - 1] * _U64(5) + (count * 4096 + self.anchor[left] - first).astype(_U64)
        )
        order = np.lexsort((whole, self.name[left]))
        left, whole = left[order], whole[order]
        new = _new(self.name[left], whole)
        return left, np.cumsum(new) - 1, left[new], whole[new]

    # round 3: the strings of runs whose anchor stands in several contexts

    def singles(self, reps: np.ndarray):
        starts = _spread(self.first[reps], self.count[reps])
        run = np.repeat(reps, self.count[reps])
        a, b = self.strings[starts], _OTHER.of(self.text, self.length)[starts] >> _U64(48)
        order = np.lexsort((self.id[run], b, a))
        new = _new(a[order], b[order])
        return starts, run, order, np.cumsum(new) - 1, order[new], a[order][new], b[order][new].astype(np.uint16)


def _range_of(name: np.ndarray, ranges: int) -> np.ndarray:
    return ((name >> _U64(32)) * _U64(ranges)) >> _U64(32)


def _parcels(sorted_names: np.ndarray, ranges: int):
    """Slices of the sorted names that fall into each range."""
    at = np.searchsorted(_range_of(sorted_names, ranges), np.arange(ranges + 1, dtype=_U64))
    return [(r, slice(at[r], at[r + 1])) for r in range(ranges) if at[r] < at[r + 1]]


def _ids_packed(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _ids_unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def _advance(chunk: Chunk, replies: list[dict], ranges: int, round_: int):
    """Parcels ``(range, content)`` of a round, or after round 3 the removed bytes as a mask.

    A chunk that asked nothing in a round has no reply to it.
    """
    by_round: dict[int, dict[int, bytes]] = {}
    for reply in replies:
        by_round.setdefault(reply["round"], {})[reply["range"]] = reply["bits"]

    def bits(of: int, names: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names), np.uint8)
        for r, part in _parcels(names, ranges):
            out[part] = np.frombuffer(by_round[of][r], np.uint8)[: part.stop - part.start]
        return out

    keys, several, where = chunk.short()
    if round_ == 1:
        return [
            (r, {"keys": keys[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), "several": np.packbits(several[part]).tobytes(), "n": part.stop - part.start})
            for r, part in _parcels(keys << _U64(16), ranges)
        ]
    left, group, lead, whole = chunk.contexts(bits(1, keys << _U64(16)) > 0, where)
    if round_ == 2:
        names = chunk.name[lead]
        return [
            (r, {"name": names[part].tobytes(), "whole": whole[part].tobytes(), "ids": _ids_packed(chunk.id[lead[part]])})
            for r, part in _parcels(names, ranges)
        ]
    said = bits(2, chunk.name[lead])
    smaller, asked = (said & 1) > 0, (said & 2) > 0
    gone = smaller[group] | (chunk.id[left] > chunk.id[lead[group]])
    starts, run, order, single, first, a, b = chunk.singles(lead[asked])
    if round_ == 3:
        return [
            (r, {"a": a[part].tobytes(), "b": b[part].tobytes(), "ids": _ids_packed(chunk.id[run[first[part]]])})
            for r, part in _parcels(a, ranges)
        ]
    found = np.zeros(len(starts), bool)
    known = bits(3, a) > 0
    found[order] = known[single] | (chunk.id[run[order]] > chunk.id[run[first[single]]])
    # other runs of the same context in the same document share what its first run found
    place = np.zeros(len(lead), np.int64)
    place[asked] = np.concatenate([[0], np.cumsum(chunk.count[lead[asked]])])[:-1]
    alike = asked[group] & ~gone
    index = _spread(place[group[alike]], chunk.count[left[alike]])
    each = _spread(chunk.first[left[alike]], chunk.count[left[alike]])
    hits = each[found[index]]
    edges = np.zeros(len(chunk.text) + 1, np.int32)
    np.add.at(edges, np.concatenate([chunk.first[left[gone]], hits]), 1)
    np.add.at(edges, np.concatenate([chunk.first[left[gone]] + chunk.count[left[gone]] - 1, hits]) + chunk.length, -1)
    return np.cumsum(edges[:-1]) > 0


def _split(values: np.ndarray, sizes: list[int]) -> list[bytes]:
    return [x.tobytes() for x in np.split(values.astype(np.uint8), np.cumsum(sizes)[:-1])]


def _judged(round_: int, contents: list[dict]) -> list[bytes]:
    """Replies to the parcels of one range, one byte for each name."""
    if round_ == 1:
        sizes = [c["n"] for c in contents]
        raw = np.zeros((sum(sizes), 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(c["keys"] for c in contents), np.uint8).reshape(-1, 6)
        keys = raw.view("<u8").ravel()
        several = np.concatenate([np.unpackbits(np.frombuffer(c["several"], np.uint8))[: c["n"]] for c in contents])
        order = np.argsort(keys, kind="stable")
        new = np.flatnonzero(_new(keys[order]))
        repeated = (np.diff(np.concatenate([new, [len(keys)]])) > 1) | (np.maximum.reduceat(several[order], new) > 0)
        out = np.empty(len(keys), np.uint8)
        out[order] = np.repeat(repeated, np.diff(np.concatenate([new, [len(keys)]])))
        return _split(out, sizes)
    ids = [_ids_unpacked(c["ids"]) for c in contents]
    sizes, ids = [len(x) for x in ids], np.concatenate(ids)
    if round_ == 2:
        major, minor = (np.frombuffer(b"".join(c[k] for c in contents), _U64) for k in ("name", "whole"))
    else:
        major = np.frombuffer(b"".join(c["a"] for c in contents), _U64)
        minor = np.frombuffer(b"".join(c["b"] for c in contents), np.uint16)
    order = np.lexsort((ids, minor, major))
    new = _new(major[order], minor[order])
    least = ids[order][new][np.cumsum(new) - 1]
    said = (ids[order] > least).astype(np.uint8)
    if round_ == 2:
        anchor = np.cumsum(_new(major[order])) - 1
        contexts = np.bincount(anchor[new])[anchor]
        said |= ((said == 0) & (contexts > 1)).astype(np.uint8) << 1
    out = np.empty(len(ids), np.uint8)
    out[order] = said
    return _split(out, sizes)


def _chunks(size: int):
    """Documents packed into chunks of about ``size`` bytes of text."""

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        weight = 0
        for batch in batches:
            lens = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            group = (weight + np.cumsum(lens)) // size
            for g in np.unique(group):
                rows = np.flatnonzero(group == g)
                held.append(batch.slice(rows[0], len(rows)))
                weight += int(lens[rows].sum())
                if weight >= size:
                    yield _chunk((task << 32) + n, held)
                    held, weight, n = [], 0, n + 1
        if held:
            yield _chunk((task << 32) + n, held)

    return run


def _chunk(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks()
    rows = rows.take(pc.sort_indices(rows, [("id", "ascending")]))
    texts = rows.column("text").to_pylist()
    sink = pa.BufferOutputStream()
    rest = rows.drop_columns(["id", "text"])
    with pa.ipc.new_stream(sink, rest.schema) as writer:
        writer.write_table(rest)
    body = {
        "ids": rows.column("id").fill_null(0).to_numpy(),
        "known": rows.column("id").is_valid().to_numpy(),
        "lens": np.array([len(t) for t in texts], np.int64),
        "text": b"".join(texts),
        "rest": sink.getvalue().to_pybytes(),
    }
    packed = zstandard.compress(pickle.dumps(body, protocol=5), 3)
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed], pa.binary())], names=["chunk", "body"])


def _asked(length: int, gram: int, ranges: int, round_: int):
    def run(batches):
        for batch in batches:
            replies = batch.column("replies") if "replies" in batch.schema.names else None
            for i in range(batch.num_rows):
                chunk = Chunk(batch.column("body")[i].as_py(), length, gram)
                parcels = _advance(chunk, (replies[i].as_py() or []) if replies is not None else [], ranges, round_)
                for r, content in parcels:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r], pa.int32()), batch.column("chunk").slice(i, 1), pa.array([pickle.dumps(content, protocol=5)], pa.binary())],
                        names=["range", "chunk", "content"],
                    )
                del chunk, parcels
                give_back_memory()

    return run


def _answered(round_: int):
    def run(rows: pa.Table) -> pa.Table:
        said = _judged(round_, [pickle.loads(c.as_buffer()) for c in rows["content"]])
        give_back_memory()
        return pa.table(
            {
                "chunk": rows["chunk"],
                "round": pa.array([round_] * len(said), pa.int32()),
                "range": rows["range"],
                "bits": pa.array(said, pa.binary()),
            }
        )

    return run


def _finished(length: int, gram: int, ranges: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.column("body")[i].as_py(), length, gram)
                gone = _advance(chunk, batch.column("replies")[i].as_py() or [], ranges, 4)
                before = np.concatenate([[False], gone[:-1]])[: len(gone)]
                before[chunk.bounds[chunk.bounds < len(gone)]] = False
                starts = np.flatnonzero(gone & ~before)
                removed = np.concatenate([[0], np.cumsum(gone)])[chunk.bounds]
                spans = np.searchsorted(starts, chunk.bounds)
                kept = chunk.text[~gone].tobytes()
                cut = chunk.bounds - removed
                rest = pa.ipc.open_stream(chunk.rest).read_all().combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rest.columns),
                        pa.array(np.diff(chunk.bounds)),
                        pa.array(np.diff(removed)),
                        pa.array(np.diff(spans)),
                        pa.array([kept[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                    ],
                    names=[*rest.column_names, "n_bytes", "n_removed", "n_spans", "kept"],
                )
                del chunk, gone, before, removed, kept, rest
                give_back_memory()

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    gram: int = 24,
    carry: tuple[str, ...] = (),
    chunk_bytes: int = 1 << 20,
    range_bytes: int = 16 << 20,
) -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept)``: every text without strings that an earlier document has.

    A text is its UTF-8 bytes; null counts as empty.  Every byte covered by a
    string of ``length`` bytes that also starts in a document of smaller id is
    removed; all strings are judged on the input.  ``n_spans`` counts the
    longest removed stretches; ``kept`` is binary.  Rows of one id are one
    document and never judged against each other, repeated rows repeat in the
    result, and rows without an id are kept whole and judge no others.  Columns
    in ``carry`` come back in a struct ``row``; others are not read, whatever their names.  An
    empty table gives an empty result.

    Every string of ``length`` bytes chooses an anchor, the smallest of the
    names of its grams, so equal strings have equal anchors at equal places.
    Round 1 keeps anchors whose name more than one document has.  Round 2
    compares the whole context of the string starts that share an anchor: those
    of a known context in a smaller document are gone at once, and an anchor of
    a single context is settled.  Round 3 compares, for one run of each context
    that is left, its strings by 80-bit names.

    Scale: texts are stored once in compressed chunks, bucketed by chunk, and
    never shuffled.  A round shuffles names, packed by range of names, and one
    reply byte for each.  Ranges are equally full, each with the names of about
    ``range_bytes`` of text, and a task holds one at a time.  A chunk sends a name once, so a passage that a third
    of all documents share costs one entry for each chunk.
    """
    spark = docs.sparkSession
    carried = [F.struct(*carry).alias("row")] if carry else []
    source = docs.select(F.col(id_col).cast("long").alias("id"), raw_text(text_col).alias("text"), *carried, F.col(id_col).alias("own_id"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"chunks_{uuid.uuid4().hex}", scratch_folder(spark, "chunks")
    chunked = source.mapInArrow(_chunks(chunk_bytes), "chunk long, body binary")
    chunked.write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(name)
    try:
        chunks = spark.table(name)
        size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
        ranges = max(1, -(-size // range_bytes))
        replies: list[DataFrame] = []

        def with_replies() -> DataFrame:
            told = replies[0]
            for more in replies[1:]:
                told = told.union(more)
            told = told.groupBy("chunk").agg(F.collect_list(F.struct("round", "range", "bits")).alias("replies"))
            return chunks.join(told.hint("shuffle_hash"), "chunk", "left")

        for round_ in (1, 2, 3):
            asked = (with_replies() if replies else chunks).mapInArrow(_asked(length, gram, ranges, round_), "range int, chunk long, content binary")
            answered = asked.groupBy("range").applyInArrow(_answered(round_), "chunk long, round int, range int, bits binary")
            replies.append(stored(answered, f"replies-{round_}"))
        fields = list(source.schema.fields[2:])
        fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        fields.append(T.StructField("kept", T.BinaryType()))
        result = stored(with_replies().mapInArrow(_finished(length, gram, ranges), T.StructType(fields)), "repeats")
        for table in (*replies, chunks):
            forget(table)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return result.select(F.col("own_id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept", *(["row"] if carry else []))
