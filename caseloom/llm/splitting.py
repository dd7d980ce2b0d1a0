"""Oversized texts cut at natural boundaries, with overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from caseloom.llm.tokens import VOCABULARY, encoding

LIMIT = 512
OVERLAP = 64
CHUNK_CHARS = 4_000_000  # characters of pieces handed on together
# Strength of a cut by what stands before it; the strongest that matches counts.
STRENGTHS = (
    (6, re.compile(r"\n[ \t]*\n\s*")),  # paragraph
    (5, re.compile(r"\n(?=[ \t]*(?:#+ |[-*•] |\d+[.)] ))")),  # before a heading or list item
    (4, re.compile(r"\n\s*")),  # line
    (3, re.compile(r"[.!?…]['\")\]]*\s+")),  # sentence
    (2, re.compile(r"[;:,]\s+")),  # clause
    (1, re.compile(r"\s+")),  # word
)


class RangeMax:
    """Sparse table: the rightmost position of the greatest value in any range, in two look-ups."""

    def __init__(self, values: np.ndarray):
        self.v = values
        n = len(values)
        self.t = [np.arange(n)]
        width = 1
        while 2 * width <= n:
            a, b = self.t[-1][: n - 2 * width + 1], self.t[-1][width: n - width + 1]
            self.t.append(np.where(values[b] >= values[a], b, a))
            width *= 2

    def rightmost(self, lo: int, hi: int) -> int:
        """Of positions lo..hi (both included) the last one that holds the greatest value."""
        j = int(hi - lo + 1).bit_length() - 1
        a, b = self.t[j][lo], self.t[j][hi - (1 << j) + 1]
        return int(b if self.v[b] >= self.v[a] else a)


def boundary_strengths(text: str, at: np.ndarray) -> np.ndarray:
    """Strength of a cut at each character position of ``at``; 0 inside a word."""
    s = np.zeros(len(text) + 1, dtype=np.int8)
    for strength, pattern in reversed(STRENGTHS):
        for m in pattern.finditer(text):
            s[m.end()] = max(s[m.end()], strength)
            if strength == 1:
                s[m.start()] = max(s[m.start()], 1)
    return s[at]


def token_starts(text: str, path: str) -> np.ndarray:
    """Character position at which each token starts (a token inside a character starts with it), and the end."""
    enc = encoding(path)
    sizes = np.fromiter((len(b) for b in enc.decode_tokens_bytes(enc.encode_ordinary(text))), dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    if len(text) == ends[-1]:  # one byte a character
        return ends
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
    inside = np.concatenate([(raw & 0xC0) == 0x80, [False]])
    return np.where(inside[ends], first[ends] - 1, first[ends])


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, path: str = VOCABULARY) -> list[tuple[int, int, int]]:
    """``(start, end, n_tokens)`` in characters of the pieces of a text.

    A text of at most ``limit`` tokens is one piece. Otherwise each piece ends
    at the strongest boundary of its permissible window (from half the limit up
    to the limit), ties to the right, and the next begins ``overlap`` tokens
    before that end, moved right to the nearest start of a word if there is one.
    """
    starts = token_starts(text, path)
    n = len(starts) - 1
    if n <= limit:
        return [(0, len(text), n)]
    index = RangeMax(boundary_strengths(text, starts))
    enc = encoding(path)
    word = index.v > 0
    out: list[tuple[int, int, int]] = []
    i = 0
    while True:
        if n - i <= limit:
            out.append((int(starts[i]), len(text), len(enc.encode_ordinary(text[starts[i]:]))))
            if out[-1][2] <= limit:
                return out
            out.pop()
        hi = min(i + limit, n - 1)
        while True:
            j = index.rightmost(max(i + 1, i + max(overlap + 1, (hi - i) // 2)) if hi - i > overlap + 1 else i + 1, hi)
            while j > i + 1 and starts[j] == starts[j - 1]:
                j -= 1  # never inside a character
            got = len(enc.encode_ordinary(text[starts[i]:starts[j]]))
            # A cut inside a word can change the tokens next to it: then look a little to the left.
            if got <= limit or hi <= i + 1:
                break
            hi -= max(1, got - limit)
        out.append((int(starts[i]), int(starts[j]), got))
        back = max(j - overlap, i + 1)
        step = np.flatnonzero(word[back:j])
        i = back + int(step[0]) if len(step) and overlap else (back if overlap else j)


def split_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, path: str = VOCABULARY) -> DataFrame:
    """``(key, piece, start, end, n_tokens, text)``: every text as pieces of at most ``limit`` tokens.

    Boundary strengths (paragraph, heading or list item, line, sentence, clause,
    word) at all token starts are indexed in a sparse table for range maxima;
    each piece asks for the strongest cut of its window. Texts are read whole,
    one at a time, and pieces are handed on as they come; memory follows the longest text, not the batch. Null and
    empty texts have one empty piece; text without any boundary is cut at the
    limit between characters. Pieces joined without their overlaps give back the
    text exactly. Needs 0 <= overlap < limit / 2. No shuffle.
    """
    if not 0 <= overlap < limit / 2:
        raise ValueError("overlap must be at least 0 and under half the limit")
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, "piece", "start", "end", "n_tokens", "text"]
        for b in batches:
            rows, held = [], 0
            for k, t in zip(b[key], b[text]):
                t = t or ""
                for i, (s, e, c) in enumerate(split_text(t, limit, overlap, path)):
                    rows.append((k, i, s, e, c, t[s:e]))
                    held += e - s
                    if held > CHUNK_CHARS:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, piece int, start int, `end` int, n_tokens int, text string")


