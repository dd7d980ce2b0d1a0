"""Token counts of a public tokenizer, in batches."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("CASELOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the published pre-token pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoding(path: str):
    """The tokenizer of a rank file, loaded once in each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str = "text", path: str = VOCABULARY, out: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of each whole text (0 for null and empty ones)."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for s in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in s], dtype="int64")

    return df.withColumn(out, count(F.col(text)))
