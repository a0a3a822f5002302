"""Alignment of two tokenizers over the same bytes, as Arrow columns inside tasks.

Token lists are flattened with their parent indices, byte ends are segmented
cumulative sums, and a hash join on (document, end) finds where both tokenizers
end a token.  Links are counted by ``Table.group_by`` in each task; Spark merges
the counts and brings them back to the documents.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.bpe import _SPACE, byte_alphabet
from sparkseries.llm.common import raw_text, stored

#: a space between two characters that are no white space; both tokenizers end a token before it
_SAFE = regex.compile(rf"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")
_SHIFT = 20  # bits of a pair's code that hold the second id
_FACTS = ("n_a", "n_b", "n_groups", "n_links")


def sections(text: str, size: int) -> Iterator[str]:
    """The text cut at safe spaces into stretches of about ``size`` characters; the spaces are left out."""
    start = 0
    while len(text) - start > size and (found := _SAFE.search(text, start + size)):
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


class Tokens:
    """One tokenizer: ids of a text that begins with a space, and the bytes of each id."""

    def __init__(self, encode: Callable[[str], list[int]], token_bytes: list[bytes]):
        self.encode = encode
        self.bytes = pa.array(token_bytes, pa.binary())
        self.sizes = np.array([len(b) for b in token_bytes], np.int64)

    def lists(self, segments: list[str]) -> pa.ListArray:
        """Ids of each segment with a space before it; null where their bytes differ from it."""
        shown = " " + " ".join(segments)
        text = shown.encode()
        ids = np.array(self.encode(shown), np.int32)
        run, wanted = np.cumsum(self.sizes[ids]), np.cumsum(pc.binary_length(pa.array(segments, pa.string())).to_numpy() + 1)
        if len(ids) and run[-1] == len(text) and self.bytes.take(pa.array(ids)).buffers()[2].slice(0, len(text)).equals(pa.py_buffer(text)):
            ends = np.searchsorted(run, wanted) + 1
            if np.array_equal(run[ends - 1], wanted):
                return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids))
        if len(segments) == 1:
            return pa.array([None], pa.list_(pa.int32()))
        half = len(segments) // 2
        return pa.concat_arrays([self.lists(segments[:half]), self.lists(segments[half:])])


def byte_level(path: str) -> Tokens:
    """A byte-level vocabulary of the tokenizers library; strings of special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    made.encode_special_tokens = True
    letters = byte_alphabet()
    special = {token.content for token in made.get_added_tokens_decoder().values()}
    names = {i: t for t, i in made.get_vocab().items()}
    known = [names.get(i, "") for i in range(max(names) + 1)]
    return Tokens(
        lambda text: made.encode_batch_fast([text], add_special_tokens=False)[0].ids,
        [t.encode() if t in special else bytes(letters[c] for c in t) for t in known],
    )


def word_pieces(path: str) -> Tokens:
    """A sentencepiece model that puts a space before each text."""
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_file=path)
    pieces = [made.id_to_piece(i) for i in range(made.get_piece_size())]
    return Tokens(
        lambda text: made.encode(text[1:], num_threads=1),
        [bytes([int(p[3:-1], 16)]) if made.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)],
    )


class Lexicon:
    """Segments that a worker has met and their ids by both tokenizers; emptied beyond fixed numbers of segments or characters."""

    def __init__(self, a: Tokens, b: Tokens, most: int = 700_000, most_chars: int = 1 << 24):
        self.tokens = a, b
        self.most, self.most_chars = most, most_chars
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.lists = [pa.array([], pa.list_(pa.int32()))] * 2

    def _learn(self, segments: list[str]) -> None:
        parts: list[list] = [[have] for have in self.lists]
        for at in range(0, len(segments), 5_000):
            part = segments[at : at + 5_000]
            self.rows.update(zip(part, range(len(self.lists[0]) + at, len(self.lists[0]) + at + len(part))))
            self.chars += sum(map(len, part))
            for own, tokens in zip(parts, self.tokens):
                own.append(tokens.lists(part))
        self.lists = [pa.concat_arrays(own) for own in parts]

    def segments_of(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """Rows in ``lists`` of the segments between safe spaces of the texts, and the text that each belongs to."""
        if len(self.lists[0]) > self.most or self.chars > self.most_chars:
            self.clear()
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        owner = pc.list_parent_indices(lists).to_numpy()
        words = lists.flatten().dictionary_encode()
        names = words.dictionary.to_pylist()
        new = [w for w in names if w not in self.rows]
        odd = {w for w in new if not w or w[0].isspace() or w[-1].isspace()}
        if odd:  # white space beside a single space belongs to one segment with what stands on both sides
            at = np.fromiter((w in odd for w in names), bool, len(names))[words.indices]
            again = np.unique(owner[at])
            parts = [_SAFE.split(texts[i]) for i in again]
            keep = ~np.isin(owner, again)
            owner = np.r_[owner[keep], np.repeat(again, [len(p) for p in parts])]
            order = np.argsort(owner, kind="stable")
            rest = words.filter(pa.array(keep)).cast(pa.string())
            owner, words = owner[order], pa.concat_arrays([rest, pa.array([w for p in parts for w in p], pa.string())]).take(pa.array(order)).dictionary_encode()
            names = words.dictionary.to_pylist()
            new = [w for w in names if w not in self.rows]
        self._learn(new)
        rows = np.fromiter(map(self.rows.__getitem__, names), np.int32, len(names))[words.indices]
        for w in new:
            if w[:1].isspace() or w[-1:].isspace() or not w:
                del self.rows[w]  # a later text may hold it between spaces, where it is no segment
        return pa.array(rows), pa.array(owner)


def _side(tokens: Tokens, lists: pa.ListArray, owner: pa.Array, n: int):
    """Ids, their text, their byte end in it, and the running total of bytes over all texts."""
    ids = lists.flatten()
    doc = owner.take(pc.list_parent_indices(lists)).to_numpy()
    total = pc.cumulative_sum(pa.array(tokens.sizes[ids])).to_numpy()
    before = np.r_[0, total][np.searchsorted(doc, np.arange(n))]
    return ids.to_numpy(), doc, total - before[doc], total


class Aligner:
    """Groups and links of texts under two tokenizers."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b, self.lexicon = a, b, Lexicon(a, b)
        shown = [f"{mark}{i}" for mark, t in ((";", a), (",", a), ("|", b), (",", b)) for i in range(len(t.sizes))]
        self.shown = pa.array(shown, pa.binary())
        self.begin = np.cumsum([0, len(a.sizes), len(a.sizes), len(b.sizes)])

    def align(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[memoryview], pa.Table]:
        """Of texts that are not empty: whether each has tokens, its four counts, its groups as text after a ``;``,
        and a table (doc, pair, n) of its links."""
        rows, owner = self.lexicon.segments_of(texts)
        lists = [have.take(rows) for have in self.lexicon.lists]
        whole = np.ones(len(texts), bool)
        lost = pc.or_(lists[0].is_null(), lists[1].is_null())
        if pc.any(lost).as_py():
            whole[owner.filter(lost).to_numpy()] = False
            keep = pa.array(whole).take(owner)
            lists, owner = [x.filter(keep) for x in lists], owner.filter(keep)
        n = len(texts)
        a, a_doc, a_end, a_total = _side(self.a, lists[0], owner, n)
        b, b_doc, b_end, b_total = _side(self.b, lists[1], owner, n)
        sides = [pa.table({"doc": d, "end": e, f"at_{s}": np.arange(len(e))}) for s, d, e in (("a", a_doc, a_end), ("b", b_doc, b_end))]
        both = sides[0].join(sides[1], ["doc", "end"], join_type="inner", use_threads=False)
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[both["at_a"].to_numpy()] = True
        b_last[both["at_b"].to_numpy()] = True
        # a token is linked where it ends, with the other side's token there; shared ends count once
        inner = ~b_last
        pair = np.r_[
            (a.astype(np.int64) << _SHIFT) | b[np.searchsorted(b_total, a_total)],
            (a[np.searchsorted(a_total, b_total[inner])].astype(np.int64) << _SHIFT) | b[inner],
        ]
        links = pa.table({"doc": np.r_[a_doc, b_doc[inner]], "pair": pair})
        links = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "n"])
        counts = np.stack([np.bincount(x, minlength=n) for x in (a_doc, b_doc, a_doc[a_last], np.r_[a_doc, b_doc[inner]])], 1)
        return whole, counts, self._groups(a, b, a_last, b_last, counts), links

    def _groups(self, a, b, a_last, b_last, counts) -> list[memoryview]:
        """Groups of each text: the tokens of both sides in order of group and side, each with the mark before it."""
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        n = int(a_last.sum())
        a_upto, b_upto = np.cumsum(np.bincount(a_group, minlength=n)), np.cumsum(np.bincount(b_group, minlength=n))
        order = np.empty(len(a) + len(b), np.int32)
        a_new, b_new = np.r_[True, a_last[:-1]][: len(a)], np.r_[True, b_last[:-1]][: len(b)]
        order[np.arange(len(a)) + np.r_[0, b_upto][a_group]] = a + np.where(a_new, self.begin[0], self.begin[1])
        order[np.arange(len(b)) + a_upto[b_group]] = b + np.where(b_new, self.begin[2], self.begin[3])
        text = self.shown.take(pa.array(order))
        offsets = np.frombuffer(text.buffers()[1], np.int32)[: len(order) + 1]
        data = memoryview(text.buffers()[2] or b"")
        ends = offsets[np.r_[0, np.cumsum(counts[:, 0] + counts[:, 1])]].tolist()
        return [data[x:y] for x, y in zip(ends, ends[1:])]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """Both tokenizers, loaded once in each Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(byte_level(a_path), word_pieces(b_path))
    return _ALIGNERS[a_path, b_path]


class _Document:
    """What is known of one document after some of its sections."""

    def __init__(self, key):
        self.key, self.counts, self.hash = key, np.zeros(4, np.int64), None
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.whole = True

    def add(self, whole: bool, counts, groups: memoryview, pairs, times) -> None:
        self.whole &= whole
        if self.hash is None:
            self.hash = hashlib.sha256()
            groups = groups[1:]
        self.hash.update(groups)
        self.counts += counts
        self.pairs.append(pairs)
        self.times.append(times)
        if len(self.pairs) > 64:
            self._merge()

    def _merge(self) -> None:
        pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, at, np.concatenate(self.times))
        self.pairs, self.times = [pairs], [times]

    def finish(self) -> tuple:
        """Key, four counts, hash of the groups, pairs and how often each is linked."""
        if self.hash is None or not self.whole:
            return self.key, [0] * 4, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.pairs) > 1:
            self._merge()
        return self.key, self.counts.tolist(), self.hash.hexdigest(), self.pairs[0], self.times[0]


def _finished(model: Aligner, docs: Iterator[tuple[object, str]], size: int) -> Iterator[tuple]:
    """Finished documents in order; sections of many short ones are aligned together, a long one section by section."""
    waiting: list[tuple[_Document, str]] = []
    begun: list[_Document] = []

    def work() -> Iterator[tuple]:
        nonlocal begun
        if waiting:
            whole, counts, groups, links = model.align([s for _, s in waiting])
            doc = links["doc"].to_numpy()
            order = np.argsort(doc, kind="stable")
            pairs, times = links["pair"].to_numpy()[order], links["n"].to_numpy()[order]
            ends = np.searchsorted(doc[order], np.arange(len(waiting) + 1))
            for i, (document, _) in enumerate(waiting):
                document.add(bool(whole[i]), counts[i], groups[i], pairs[ends[i] : ends[i + 1]], times[ends[i] : ends[i + 1]])
            waiting.clear()
        yield from (d.finish() for d in begun[:-1])
        begun = begun[-1:]

    held = 0
    for key, text in docs:
        begun.append(_Document(key))
        for section in sections(text, size) if text else ():
            waiting.append((begun[-1], section))
            held += len(section)
            if held >= size:
                yield from work()
                held = 0
    yield from work()
    yield from (d.finish() for d in begun)


class _Parcels:
    """Documents as compressed rows: distinct pairs, and each document's places among them with their numbers of links.

    A block is what one task holds of the pair counts; it ends at ``most``
    distinct pairs or documents.
    """

    def __init__(self, kind: pa.DataType, most: int):
        self.kind, self.most, self.blocks = kind, most, 0
        self.begin_block()

    def begin_block(self) -> None:
        self.block = f"{TaskContext.get().partitionId()}-{self.blocks}"
        self.blocks += 1
        self.rows = 0
        self.partial: list[pa.Table] = []

    def parcel(self, docs: list[tuple]) -> pa.RecordBatch:
        pairs, times = (np.concatenate([d[i] for d in docs]) for i in (3, 4))
        sizes = np.array([len(d[3]) for d in docs])
        codes, at, holders = np.unique(pairs, return_inverse=True, return_counts=True)
        rank = np.empty(len(codes), np.int64)
        by_count = np.argsort(-holders, kind="stable")
        rank[by_count] = np.arange(len(codes))
        # places rise within a document, and the next document starts again: differences are small
        doc, place = np.repeat(np.arange(len(docs)), sizes), rank[at]
        order = np.lexsort((place, doc))
        steps = np.diff(place[order], prepend=0).astype("<i4")
        self.rows += len(docs)
        self.partial.append(pa.table({"pair": codes, "docs": holders}))
        packed = [zstandard.compress(x.tobytes(), 3) for x in (codes[by_count], steps, times[order].astype("<i4"))]
        return self._batch(
            [[d[0] for d in docs]], pa.list_(self.kind), [[d[1] for d in docs]], [[d[2] for d in docs]], [sizes.tolist()], *[[p] for p in packed], [None], [None]
        )

    def _batch(self, ids, kind, *columns) -> pa.RecordBatch:
        kinds = [pa.list_(pa.list_(pa.int64())), pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2]
        arrays = [pa.array([self.block]), pa.array(ids, kind), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "ids", "facts", "hashes", "sizes", "codes", "steps", "times", "pairs", "docs"])

    def merge(self) -> pa.Table:
        counts = pa.concat_tables(self.partial).group_by("pair", use_threads=False).aggregate([("docs", "sum")])
        self.partial = [counts.rename_columns(["pair", "docs"])]
        return self.partial[0]

    def end_block(self) -> Iterator[pa.RecordBatch]:
        if self.partial:
            counts = self.merge()
            for at in range(0, counts.num_rows, 50_000):
                part = counts.slice(at, 50_000)
                yield self._batch([None], pa.list_(self.kind), *[[None]] * 6, [part["pair"].to_pylist()], [part["docs"].to_pylist()])
        self.begin_block()

    def full(self) -> bool:
        if sum(t.num_rows for t in self.partial) > self.most:
            self.merge()
        return self.rows >= self.most or sum(t.num_rows for t in self.partial) > self.most


def _parcels(a_path: str, b_path: str, size: int, most: int):
    def run(batches):
        def rows():
            for batch in batches:
                kinds.append(batch.column(0).type)
                yield from zip(batch.column(0).to_pylist(), (d.decode("utf-8", "replace") for d in batch.column(1).to_pylist()))

        kinds: list[pa.DataType] = []
        maker, docs, entries = None, [], 0
        for doc in _finished(aligner(a_path, b_path), rows(), size):
            maker = maker or _Parcels(kinds[0], most)
            docs.append(doc)
            entries += len(doc[3])
            if entries >= 400_000 or len(docs) >= 4_000:
                yield maker.parcel(docs)
                docs, entries = [], 0
                if maker.full():
                    yield from maker.end_block()
        if docs:
            yield maker.parcel(docs)
        if maker:
            yield from maker.end_block()

    return run


def _sums(id_col: str):
    """Documents of a block with the sums of their links' counts; gets the block's parcels and its pairs' counts."""

    def run(parcels: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(pairs := counts["pair"].to_numpy())
        pairs = pairs[order]
        value = np.stack([counts["best"].cast(pa.int64()).to_numpy(), counts["n"].to_numpy()], 1)[order]
        out = []
        for r in parcels.select(["ids", "facts", "hashes", "sizes", "codes", "steps", "times"]).to_batches(1):
            for i in range(r.num_rows):
                sizes = r["sizes"][i].values.to_numpy()
                codes, steps, times = (np.frombuffer(zstandard.decompress(r[c][i].as_py()), t) for c, t in (("codes", "<i8"), ("steps", "<i4"), ("times", "<i4")))
                own = value[np.searchsorted(pairs, codes)][np.cumsum(steps)] * times[:, None].astype(np.int64)
                ends = np.r_[0, np.cumsum(sizes)]
                sums = np.diff(np.r_[np.zeros((1, 2), np.int64), np.cumsum(own, 0)][ends], axis=0)
                facts = r["facts"][i].values.flatten().to_numpy().reshape(-1, 4)
                out.append(
                    pa.table(
                        [r["ids"][i].values, *(pa.array(facts[:, c]) for c in range(4)), pa.array(sums[:, 0]), pa.array(sums[:, 1]), r["hashes"][i].values],
                        names=[id_col, *_FACTS, "n_best", "count_sum", "groups_sha256"],
                    )
                )
        return pa.concat_tables(out)

    return run


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1 << 21, most: int = 1_000_000
) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every whole text.

    ``a_path`` is a byte-level BPE file of the tokenizers library, ``b_path`` a
    sentencepiece model that begins texts with a space; both must lie at the
    same place on every worker.  The text after a space is encoded by both,
    strings of special tokens as plain text.  Byte offsets where both end a
    token cut the tokens into groups.  A link is a pair of tokens, one of each
    side, whose bytes overlap.  The count of a pair of ids is the number of
    documents that hold it linked.  ``n_best`` are a document's links whose
    count is the highest of their A id, ties included; ``count_sum`` is the sum
    of the counts over its links.  ``groups_sha256`` hashes the groups in order,
    ``a1,a2|b1;a3|b2,b3``.

    A text that is null, empty or not what its tokens' bytes spell (one that
    holds U+2581) has no tokens: zeros and an empty hash.  Repeated rows and rows
    without an id are documents of their own, counted one by one.  Other columns
    of ``docs`` are not read, whatever their names.  An empty table gives an
    empty result.  A long text is worked in sections of about ``size``
    characters, cut at a single space between other characters, where both
    tokenizers end a token; only a text without any such space is one section.

    Scale: texts are encoded once and never shuffled.  A task counts its own
    links, at most ``most`` distinct pairs or documents at a time; these partial
    counts and compressed lists of each document's pairs are all that is
    shuffled.  A pair occurs once in a block however often its documents hold
    it, so no key gets more than one row of a block.  The highest counts of A
    ids are broadcast: one number for each entry of the vocabulary.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col), raw_text(text_col))
    schema = f"block string, ids array<{kind}>, facts array<array<long>>, hashes array<string>, sizes array<int>, codes binary, steps binary, times binary, pairs array<long>, docs array<long>"
    work = stored(source.mapInArrow(_parcels(a_path, b_path, size, most), schema), "alignment-parcels")
    partial = work.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("block", "x.pairs", "x.docs")
    counts = stored(partial.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n")), "alignment-counts")
    first = F.shiftright("pair", _SHIFT)
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    judged = counts.join(F.broadcast(highest), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    known = partial.select(F.col("block").alias("of_block"), F.col("pairs").alias("pair")).join(judged, "pair")
    parcels = work.where("pairs IS NULL").drop("pairs", "docs")
    result = f"`{id_col}` {kind}, {', '.join(f'{f} long' for f in _FACTS)}, n_best long, count_sum long, groups_sha256 string"
    return parcels.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_sums(id_col), result)
