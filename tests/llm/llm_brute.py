"""Plain versions of the operators' rules, for small inputs."""

from __future__ import annotations

import re

import xxhash


def without_repeats(docs: list[tuple[int | None, bytes]], length: int) -> list[tuple[int, int, int, bytes]]:
    """Bytes, removed bytes, removed stretches and kept bytes of each document."""
    least: dict[bytes, int] = {}
    for doc, text in docs:
        if doc is not None:
            for i in range(len(text) - length + 1):
                s = text[i : i + length]
                least[s] = min(doc, least.get(s, doc))
    out = []
    for doc, text in docs:
        gone = [False] * len(text)
        if doc is not None:
            for i in range(len(text) - length + 1):
                if least[text[i : i + length]] < doc:
                    gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g)))
    return out


def simhash(text: bytes) -> int:
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))) if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def repeated_lines(docs: list[tuple[int | None, str | None]], min_chars: int, min_docs: int) -> list[tuple]:
    def key(line: str) -> str:
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders: dict[str, set[int]] = {}
    for doc, text in docs:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(h := holders.get(key(x), set())) < min_docs or max(h) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept).encode()))
    return out
