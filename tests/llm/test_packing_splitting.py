import os
import random

import numpy as np
import pytest

from caseloom.llm.packing import harmonic_pack, pack_documents, packing_report, split_oversized
from caseloom.llm.splitting import RangeMax, split_documents, split_text
from caseloom.llm.tokens import VOCABULARY, encoding

from ..conftest import rows

tokenizer = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")


def count_tokens(text, path):
    return len(encoding(path).encode_ordinary(text)) if text else 0


def test_harmonic_pack(spark):
    rng = random.Random(2)
    sizes = [rng.choice([1, 3, 10, 33, 50, 51, 70, 99, 100, 250, 0]) for _ in range(3000)] + [None]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens int")
    got = harmonic_pack(df, capacity=100, classes=10, cell_docs=1000).collect()
    by_bin, by_doc = {}, {}
    for r in got:
        by_bin.setdefault(r["bin"], []).append((r["offset"], r["size"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["size"]))
    assert all(sum(s for _, s in b) <= 100 for b in by_bin.values())
    for b in by_bin.values():  # places in a bin don't overlap
        at = 0
        for o, s in sorted(b):
            assert o >= at
            at = o + s
    for i, s in enumerate(sizes):  # each item whole, or cut without loss if too large
        parts = sorted(by_doc[i])
        assert sum(x for _, x in parts) == (s or 0) and (len(parts) == 1 or s > 100)
    least = -(-sum(s or 0 for s in sizes) // 100)
    assert len(by_bin) <= 1.25 * least + 10
    again = harmonic_pack(df.repartition(7), capacity=100, classes=10, cell_docs=1000)
    assert rows(again) == sorted((tuple(r) for r in got), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert harmonic_pack(df.limit(0), capacity=100).count() == 0


def test_split_oversized(spark):
    df = spark.createDataFrame([(1, 250), (2, 100), (3, 0)], "k long, n int")
    assert rows(split_oversized(df, "k", "n", 100)) == [(1, 0, 0, 100), (1, 1, 100, 100), (1, 2, 200, 50), (2, 0, 0, 100), (3, 0, 0, 0)]


def test_range_max():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 5, 200)
    t = RangeMax(v)
    for _ in range(500):
        a, b = sorted(rng.integers(0, 200, 2))
        assert t.rightmost(a, b) == max(i for i in range(a, b + 1) if v[i] == v[a : b + 1].max())


def _text(rng, n):
    words = ["alpha", "beta", "niño", "東京", "🙂", "x" * 30, "12.5", "naïve"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", ", ", "\n", "\n\n", "\n- "]) for _ in range(n))


@tokenizer
def test_split_text_round_trip():
    rng = random.Random(4)
    texts = [_text(rng, n) for n in (0, 3, 200, 900)] + ["a" * 5000, "🙂" * 800, "word " * 3000, "\n" * 3000, ""]
    for t in texts:
        for limit, overlap in ((64, 0), (64, 16), (512, 64)):
            pieces = split_text(t, limit, overlap)
            assert pieces[0][0] == 0 and pieces[-1][1] == len(t)
            whole, end = "", 0
            for s, e, n in pieces:
                assert s <= end and n <= limit and n == count_tokens(t[s:e], VOCABULARY)
                whole, end = whole + t[end:e], max(end, e)
            assert whole == t
            assert all(b[0] > a[0] and b[1] > a[1] for a, b in zip(pieces, pieces[1:]))


@tokenizer
def test_cuts_prefer_natural_boundaries():
    para = " ".join(["word"] * 80) + ".\n\n"
    pieces = split_text(para * 6, 100, 10)
    assert all((para * 6)[:e].endswith("\n\n") for _, e, _ in pieces)


@tokenizer
def test_documents(spark):
    df = spark.createDataFrame([(1, "one two three. " * 100), (2, None), (3, ""), (4, "short")], "doc_id long, text string")
    got = split_documents(df, limit=64, overlap=8).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4} and max(r["n_tokens"] for r in got) <= 64
    with pytest.raises(ValueError):
        split_documents(df, limit=64, overlap=32)
    packed = pack_documents(df, capacity=128)
    r = packing_report(packed, 128).first()
    assert r["fullest"] <= 128 and r["tokens"] == sum(count_tokens(t, VOCABULARY) for t in ("one two three. " * 100, "short"))
