"""Evaluation texts leaking into training text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
MIN_RUN = 15
BLOCK_WORDS = 2_000_000  # words of held-out texts that one pass over the corpus looks for
CHUNK_WORDS = 400_000  # words hashed together in a worker
SIEVE = 1 << 22

# Measuring units that stand for one another in a template.
UNITS = ("ng", "mg", "g", "kg", "ml", "l", "mcg", "ug", "cm", "mm", "m", "km", "lb", "lbs", "oz", "percent", "hours", "hrs", "doses", "dosis", "tablets", "years", "años", "days", "minutes")
WORD = r"[\p{L}\p{N}\p{M}]+"
POSSESSIVE = r"['’]s(?![\p{L}\p{N}\p{M}_])"
PLAIN, NUMBER, NAME, UNIT = range(4)
_ASCII_WORD = re.compile("[A-Za-z0-9]+")
_ASCII_POSSESSIVE = re.compile("'s(?![A-Za-z0-9_])")


def split_words(text: str) -> list[str]:
    """The words of a text as they stand; a possessive ``'s`` belongs to none."""
    if text.isascii():
        return _ASCII_WORD.findall(_ASCII_POSSESSIVE.sub(" ", text))
    import regex

    return regex.findall(WORD, regex.sub(POSSESSIVE, " ", text))


class Codes(dict):
    """Numbers each written word on first sight and keeps ``(code, literal, slot, kind)`` of it.

    ``code`` is a hash of the lower-cased word. ``slot`` stands for the word in a
    template: one value for all numbers, one for all units, one for all names
    (words with a capital and small letters after it), the code otherwise.
    ``literal`` is the same with names left as they are.
    """

    def __init__(self):
        super().__init__()
        self.facts: list[tuple[int, int, int, int]] = []
        self.table = np.zeros((0, 4), dtype=np.uint64)

    def __missing__(self, w: str) -> int:
        import xxhash

        low = w.lower()
        code = xxhash.xxh64_intdigest(low)
        kind = NUMBER if w.isnumeric() else UNIT if low in UNITS else NAME if len(w) > 1 and w[0] != low[0] and w[1:] == low[1:] else PLAIN
        self.facts.append((code, code if kind in (PLAIN, NAME) else kind, code if kind == PLAIN else kind, kind))
        self[w] = n = len(self.facts) - 1
        return n

    def numbers(self, text: str) -> np.ndarray:
        """The numbers of a text's words."""
        ws = split_words(text)
        return np.fromiter(map(self.__getitem__, ws), dtype=np.int64, count=len(ws))

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        """What is kept of words by number, one row each."""
        if len(self.table) < len(self.facts):
            new = np.array(self.facts[len(self.table) :], dtype=np.uint64)
            self.table = np.concatenate([self.table, new])
        return self.table[numbers]


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` successive values (64 bits, wrapping)."""
    n = len(values) - k + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = (h ^ values[j : j + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def _windows(codes: Codes, texts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, text, position)`` of all windows of several texts, each once literally and once as a template."""
    size = np.array([len(x) for x in texts], dtype=np.int64)
    every = codes.rows(np.concatenate(texts) if texts else np.zeros(0, dtype=np.int64))
    text = np.repeat(np.arange(len(texts)), size)
    start = np.cumsum(size) - size
    whole = np.flatnonzero(text[: len(text) - k + 1] == text[k - 1 :]) if len(text) >= k else np.zeros(0, dtype=np.int64)
    both = np.concatenate([window_hashes(every[:, c], k)[whole] for c in (1, 2)])
    at = np.concatenate([whole, whole])
    return both, text[at], at - start[text[at]]


class Alignment:
    """Runs of an item in a document, word by word.

    Words agree if they are equal without case. Where both texts have a slot of
    one kind (a run of numbers, of names, or a unit) with different words, the
    slots agree if they are consistent: within the run an item's value always
    stands for one value of the document and the other way round. Any other
    differing word is an edit (altered, left out or added): the next two words
    must then be equal, so edits are single and apart. A value that was refilled
    with several words and then stands unchanged ends the run. A run covers at least
    ``MIN_RUN`` words of the item and no more of them in refilled slots than
    otherwise.
    """

    def __init__(self, item: np.ndarray, doc: np.ndarray):
        self.a, self.ka = item[:, 0].tolist(), item[:, 3].tolist()
        self.b, self.kb = doc[:, 0].tolist(), doc[:, 3].tolist()

    def _slot(self, codes: list, kinds: list, i: int, step: int, kind: int) -> tuple[tuple, int]:
        """The slot that starts at ``i`` in one direction: its words and the position behind it."""
        j = i
        while 0 <= j < len(codes) and kinds[j] == kind and (kind != UNIT or j == i):
            j += step
        return tuple(codes[i:j] if step > 0 else codes[j + 1 : i + 1]), j

    def run(self, i: int, j: int, seen: set) -> tuple[int, int]:
        """``(words of the item covered, of these in refilled slots)`` of the run through equal words at ``i`` and ``j``."""
        a, b, ka, kb = self.a, self.b, self.ka, self.kb
        n, m = len(a), len(b)
        there: dict = {}
        back: dict = {}
        refilled = 0
        ends = []
        for step in (-1, 1):
            x, y = (i, j) if step > 0 else (i - 1, j - 1)
            last = x - step
            while 0 <= x < n and 0 <= y < m:
                k = ka[x]
                if a[x] == b[y]:
                    one = (a[x],)
                    if k and max(len(there.setdefault((k, one), one)), len(back.setdefault((k, one), one))) > 1:
                        break  # the same value was refilled with several words before
                    seen.add((x, y))
                    last = x
                    x, y = x + step, y + step
                    continue
                if k and k == kb[y]:
                    (va, xe), (vb, ye) = self._slot(a, ka, x, step, k), self._slot(b, kb, y, step, k)
                    if there.setdefault((k, va), vb) == vb and back.setdefault((k, vb), va) == va:
                        refilled += len(va)
                        last = xe - step
                        x, y = xe, ye
                        continue
                for da, db in ((1, 1), (1, 0), (0, 1)):
                    c, d = x + da * step, y + db * step
                    if 0 <= c < n and 0 <= c + step < n and 0 <= d < m and 0 <= d + step < m and a[c] == b[d] and a[c + step] == b[d + step]:
                        x, y = c, d
                        break
                else:
                    break
            ends.append(last)
        return ends[1] - ends[0] + 1, refilled


def _longest(al: Alignment, seeds: Iterable[tuple[int, int]], k: int) -> int:
    """Words covered by the longest run through equal words of the shared windows that start at ``seeds``."""
    best = 0
    seen: set = set()
    for x, y in seeds:
        for i, j in zip(range(x, x + k), range(y, y + k)):
            if (i, j) not in seen and al.a[i] == al.b[j]:
                seen.add((i, j))
                covered, refilled = al.run(i, j, seen)
                if 2 * refilled <= covered:
                    best = max(best, covered)
    return best


def longest_run(item: str, doc: str, k: int = WINDOW) -> int:
    """Item words covered by the longest run of two texts that share a window of ``k`` words; 0 without one."""
    codes = Codes()
    a, b = codes.numbers(item), codes.numbers(doc)
    (ha, _, pa), (hb, _, pb) = _windows(codes, [a], k), _windows(codes, [b], k)
    return _longest(Alignment(codes.rows(a), codes.rows(b)), sorted({(int(x), int(y)) for h, x in zip(ha, pa) for y in pb[hb == h]}), k)


class ItemTable:
    """The held-out texts of one block with all their windows, sorted by hash."""

    def __init__(self, keys: list, texts: list[str], k: int):
        self.codes, self.keys, self.k = Codes(), keys, k
        self.words = [self.codes.numbers(t) for t in texts]
        h, t, p = _windows(self.codes, self.words, k)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.pos = h[order], t[order], p[order]
        self.sieve = np.zeros(SIEVE, dtype=bool)  # which low bits occur: most windows of a corpus stop here
        self.sieve[h & np.uint64(SIEVE - 1)] = True

    def matches(self, codes: Codes, docs: list[np.ndarray], min_run: int) -> Iterator[tuple[int, int, int]]:
        """``(document, item, run)`` of all documents that repeat at least ``min_run`` words of an item."""
        h, doc, pos = _windows(codes, docs, self.k)
        hit = np.flatnonzero(self.sieve[h & np.uint64(SIEVE - 1)])
        lo = np.searchsorted(self.hash, h[hit], "left")
        n = np.searchsorted(self.hash, h[hit], "right") - lo
        which = np.repeat(hit, n)
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(which))
        seeds = np.stack([doc[which], self.item[at], self.pos[at], pos[which]], axis=1)
        seeds = seeds[np.lexsort(seeds.T[::-1])]
        ends = np.flatnonzero(np.any(seeds[1:, :2] != seeds[:-1, :2], axis=1)) + 1
        for part in np.split(seeds, ends) if len(seeds) else ():
            d, t = int(part[0, 0]), int(part[0, 1])
            run = _longest(Alignment(self.codes.rows(self.words[t]), codes.rows(docs[d])), part[:, 2:].tolist(), self.k)
            if run >= min_run:
                yield d, t, run


def _blocks(items: DataFrame, key: str, text: str, block_words: int) -> Iterator[tuple[list, list[str]]]:
    """Held-out texts in blocks of at most ``block_words`` words (a longer text alone), fetched one partition at a time."""
    keys, texts, held = [], [], 0
    for r in items.select(key, text).toLocalIterator():
        n = len(r[text]) // 2 + 1  # no text has more words
        if keys and held + n > block_words:
            yield keys, texts
            keys, texts, held = [], [], 0
        keys.append(r[key])
        texts.append(r[text])
        held += n
    if keys:
        yield keys, texts


def leaked_passages(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", k: int = WINDOW, min_run: int = MIN_RUN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, run)``: documents that repeat at least ``min_run`` words in a row of an item.

    Words are compared without case, punctuation and spacing; single words here
    and there may be altered, left out or added. All windows of ``k`` words of a
    document are hashed, once with numbers and units as typed placeholders and
    once with names too, and probe a hash table of the items' windows. Each pair
    that shares a window is aligned from there (see ``Alignment``): slots may be
    refilled, with one word or several, if they are so consistently. ``run`` is
    the number of item words covered.

    Whether a word is a placeholder depends on the word alone, so results don't
    depend on the number of items or documents. A run has no seed only if each of
    its windows holds an altered word that is neither number, unit nor name.

    Null and empty texts and texts under ``k`` words match nothing; repeated
    documents are each reported, repeated items too. Documents are read whole.

    Plan: one scan of the corpus for each block of held-out texts, without a
    shuffle; only rows that leak leave the worker. A block is bounded by
    ``block_words``, and so is what is sent to the workers. A held-out set of
    any size costs more passes, never a larger one.
    """
    kinds = dict(docs.dtypes)[doc_key], dict(items.dtypes)[item_key]
    schema = f"`{doc_key}` {kinds[0]}, `{item_key}` {kinds[1]}, run int"
    spark = docs.sparkSession

    def search(held) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            table = ItemTable(*held.value, k)
            codes = Codes()

            def found(keys: list, texts: list[np.ndarray]) -> pd.DataFrame:
                got = [(keys[d], table.keys[t], r) for d, t, r in table.matches(codes, texts, min_run)]
                return pd.DataFrame({doc_key: [g[0] for g in got], item_key: [g[1] for g in got], "run": [g[2] for g in got]})

            for b in batches:
                keys, texts, n = [], [], 0
                for key, t in zip(b[doc_key].tolist(), b[text]):
                    keys.append(key)
                    texts.append(codes.numbers(t))
                    n += len(texts[-1])
                    if n > CHUNK_WORDS:
                        yield found(keys, texts)
                        keys, texts, n = [], [], 0
                        if len(codes) > CHUNK_WORDS:  # numbers of words hold within a chunk only
                            codes = Codes()
                if keys:
                    yield found(keys, texts)

        return docs.select(doc_key, text).filter(F.col(text).isNotNull()).mapInPandas(run, schema)

    out = spark.createDataFrame([], schema)
    for n, (keys, texts) in enumerate(_blocks(items.filter(F.col(text).isNotNull()), item_key, text, block_words)):
        part = search(spark.sparkContext.broadcast((keys, texts)))
        out = part if n == 0 else out.unionByName(part)
    return out
