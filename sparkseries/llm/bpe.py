"""Exact byte-pair encoding by a dynamic programme over prefixes, and decoding."""

from __future__ import annotations

import json
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.common import raw_text

_SPACE = r"\t-\r \x85\xa0  -     　"
#: fixed values: the byte-level split of the vocabulary file
_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
_OUTER_SPACE = regex.compile(rf"\A[{_SPACE}]|[{_SPACE}]\Z")
#: up to here letters are the same in every version of Unicode
_LATIN_END = "\u0250"
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of bytes for a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_alphabet()
        vocabulary = data["model"]["vocab"]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = special
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if t not in special}
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.rank.setdefault((a, b), rank)
            parts.setdefault(whole, (a, b, rank))
        self.right_edge = {t: self._edge(t, parts, 1) for t in self.bytes_of}
        self.left_edge = {t: self._edge(t, parts, 0) for t in self.bytes_of}
        self.automaton = ahocorasick.Automaton()
        for t, b in self.bytes_of.items():
            if len(b) == 1 or t in parts:
                self.automaton.add_word(b.decode("latin-1"), (len(b), t))
        self.automaton.make_automaton()
        self.split = regex.compile(_SPLIT)
        self.fits: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _edge(token: int, parts: dict, side: int) -> list[tuple[int, int]]:
        """The token and the parts along one of its edges, each with the rank at which it is absorbed."""
        out, absorbed = [], _NEVER
        while True:
            out.append((token, absorbed))
            if token not in parts:
                return out
            absorbed = parts[token][2]
            token = parts[token][side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two tokens' bytes encode to just these two.

        They do unless some part on the right edge of ``a`` merges with one on
        the left edge of ``b`` before either is absorbed into its own token; of
        equal ranks the merge further left comes first.
        """
        known = self.fits.get((a, b))
        if known is None:
            rank = self.rank
            known = not any(
                (m := rank.get((x, y))) is not None and m < x_end and m <= y_end
                for x, x_end in self.right_edge[a]
                for y, y_end in self.left_edge[b]
            )
            if len(self.fits) > 400_000:
                self.fits.clear()
            self.fits[a, b] = known
        return known

    def piece(self, data: bytes) -> list[int]:
        """Ids of a piece that no merge may leave.

        The encoding of each prefix ends in one token.  It is the match ending
        there whose start is the piece's start or a prefix whose last token is
        compatible with it; the ids follow the tokens back from the end.
        """
        last: list[int] = [-1] * (len(data) + 1)
        size: list[int] = [0] * (len(data) + 1)
        for end, (n, token) in self.automaton.iter(data.decode("latin-1")):
            at = end + 1
            if last[at] < 0 and (n == at or self.compatible(last[at - n], token)):
                last[at], size[at] = token, n
        out, at = [], len(data)
        while at:
            out.append(last[at])
            at -= size[at]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of a text without cached words."""
        out: list[int] = []
        for i, part in enumerate(self.special_split.split(text) if self.special_split else [text]):
            if i % 2:
                out.append(self.special[part])
            else:
                for piece in self.split.findall(part):
                    out += self.piece(piece.encode())
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").encode()


class Words:
    """Encodes texts word by word, remembering words.

    The split never joins what stands before a single space or line break to
    what follows, if neither is white space: a space goes to the word after it,
    a line break stands alone.  So a text is the sum of its words, each with
    the space or break before it, and a word that ends in a comma or full stop
    after letters is the sum of those letters and the mark.  Texts with other
    white space at a space or break go to ``whole``, the encoder itself.  New
    words are encoded in one text and told apart by ``sizes``, the number of
    bytes of each token.  ``alone`` gives the ids of a space and Latin letters
    after it, which the split keeps in one piece; without it they are encoded
    like others.
    """

    def __init__(self, whole, sizes: np.ndarray, most: int = 700_000, alone=None):
        self.whole, self.sizes, self.most, self.alone = whole, sizes, most, alone
        #: ids of each word; empty for one that cannot stand alone
        self.known: dict[str, bytes] = {}
        self.marks = {mark: _packed(whole(mark)) for mark in ".,"}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        words = text.replace("\n", " \n").split(" ")
        words[0] = "\n" + words[0]  # the first word as one after a line break, whose own token is left out again
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > self.most:
                self.known.clear()
                found = [None] * len(words)
            new = [i for i, ids in enumerate(found) if ids is None]
            self._learn({words[i] for i in new})
            for i in new:
                found[i] = self.known[words[i]]
        return b"".join(found)[4:] if all(found) else _packed(self.whole(text))

    def _learn(self, words: set[str]) -> None:
        known, alone = self.known, self.alone
        stems = {w: w[:-1] for w in words if w[-1:] in self.marks and w[:-1].isalpha()}
        wanted = [w for w in {*(words - stems.keys()), *stems.values()} if w not in known]
        plain = []
        for w in wanted:
            if alone and w.isalpha() and (w.isascii() or max(w) < _LATIN_END):
                known[w] = _packed(alone(w))
                continue
            own = w[1:] if w[:1] == "\n" else w
            if own.isalnum() or (own and not _OUTER_SPACE.search(own)):
                plain.append(w)
            else:
                known[w] = b""
        for at in range(0, len(plain), 5_000):
            part = plain[at : at + 5_000]
            shown = [w if w[0] == "\n" else " " + w for w in part]
            ids = np.array(self.whole("".join(shown)), "<u4")
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w.encode()) for w in shown])) + 1
            packed, stops = ids.tobytes(), (4 * ends).tolist()
            known.update(zip(part, (packed[a:b] for a, b in zip([0, *stops], stops))))
        for w, stem in stems.items():
            known[w] = known[stem] + self.marks[w[-1]]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def token_sizes(tokens: dict[int, bytes | str]) -> np.ndarray:
    """Number of bytes (or of letters that stand for bytes) of each token."""
    out = np.zeros(max(tokens) + 1, np.int64)
    for token, data in tokens.items():
        out[token] = len(data)
    return out


_ENCODERS: dict[str, tuple[Encoder, Words]] = {}


def encoder(path: str) -> tuple[Encoder, Words]:
    """The encoder of a vocabulary file, loaded once in each Python worker."""
    if path not in _ENCODERS:
        made = Encoder(path)
        _ENCODERS[path] = made, Words(made.encode, token_sizes(made.bytes_of))
    return _ENCODERS[path]


def transcode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids, decoded)``: the ids of every whole text, and the text that they decode to.

    ``ids`` is binary, little-endian unsigned 32-bit; ``decoded`` is UTF-8.
    ``vocabulary`` is the path of a byte-level BPE file on every worker.  Null
    counts as empty, an empty text has no ids, strings of special tokens become
    their ids, and bytes that are no UTF-8 are read as U+FFFD.  Rows without an
    id and repeated rows stay as they are.  Other columns of ``docs`` are not
    read, whatever their names.  An empty table gives an empty result.

    Scale: one pass without a shuffle.  Words are remembered in each Python
    worker up to a fixed number and encoded again after that.
    """

    def run(batches):
        exact, words = encoder(vocabulary)
        for batch in batches:
            ids, decoded = [], []
            for data in batch.column(1).to_pylist():
                packed = words.encode(data.decode("utf-8", "replace"))
                ids.append(packed)
                decoded.append(exact.decode(np.frombuffer(packed, "<u4").tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                names=[id_col, "n_tokens", "ids", "decoded"],
            )

    source = docs.select(F.col(id_col), raw_text(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary, decoded binary")
