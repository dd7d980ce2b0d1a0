"""Words that were broken into pieces put together again, with a vocabulary counted over the whole table."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PARTS = 6
MIN_FREQ = 2


def vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(word, n)`` over all cells, letters and digits only, upper case."""
    words = F.explode(F.split(F.upper(F.concat_ws(" ", *columns)), r"\s+"))
    return df.select(words.alias("w")).select(F.regexp_replace("w", "[^A-Z0-9]", "").alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def _core(token: str) -> tuple[str, str]:
    m = re.match(r"^(.*?)([.,;:)]*)$", token, re.S)
    return re.sub(r"[^A-Z0-9]", "", m[1].upper()), m[2]


def repair_text(text: str | None, counts: dict[str, int], lexicon: set[str], max_parts: int = MAX_PARTS, min_freq: int = MIN_FREQ) -> str | None:
    """Pieces joined where the whole is a known word and the pieces aren't: longest first, best score wins.

    A whole scores ``10 ln(frequency + 1) + length + 20`` if it is in the lexicon.
    """
    if not text:
        return text
    tokens, out, i = text.split(), [], 0
    while i < len(tokens):
        best = None
        for k in range(min(max_parts, len(tokens) - i), 1, -1):
            parts = tokens[i : i + k]
            cores = [_core(t)[0] for t in parts]
            if any(_core(t)[1] for t in parts[:-1]) or not all(cores):
                continue
            whole = "".join(cores)
            freq, listed = counts.get(whole, 0), whole in lexicon
            broken = any(counts.get(c, 0) < min_freq and c not in lexicon for c in cores)
            if (listed or freq >= min_freq) and broken:
                score = 10 * math.log(freq + 1) + len(whole) + 20 * listed
                if best is None or score > best[0]:
                    best = (score, k, "".join(parts))
        if best:
            out.append(best[2])
            i += best[1]
        else:
            out.append(tokens[i])
            i += 1
    return re.sub(r"\s+([,;:.)])", r"\1", " ".join(out))


def _candidates(text: Column, max_parts: int) -> Column:
    """The words of a text and all joins of up to ``max_parts`` neighbours, letters and digits only."""
    cores = F.transform(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda t: F.regexp_replace(F.upper(F.regexp_replace(t, r"[.,;:)]*$", "")), "[^A-Z0-9]", ""))

    def joins(k: int) -> Column:
        return F.when(F.size(cores) >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.size(cores) - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(cores, i, k), ""))).otherwise(F.array().cast("array<string>"))

    joined = [joins(k) for k in range(1, max_parts + 1)]
    return F.array_distinct(F.concat(*joined))


def repair_columns(df: DataFrame, columns: list[str], lexicon: Iterable[str] = (), max_parts: int = MAX_PARTS, min_freq: int = MIN_FREQ) -> DataFrame:
    """The frame with broken words of the given columns repaired.

    The vocabulary is counted over all rows and joined with the words that each
    distinct text could hold, so nothing grows on the driver or in a worker but
    the words of one text. Nulls stay null; texts of one word stay as they are.
    The greedy merge is sequential, hence Python in Arrow batches, over distinct
    texts; only texts that change are joined back to the rows.
    """
    known = {re.sub(r"[^A-Z0-9]", "", w.upper()) for w in lexicon}
    frequent = vocabulary(df, columns).filter(F.col("n") >= min_freq)
    texts = df.select(F.explode(F.array(*columns)).alias("_text")).filter(F.trim("_text").rlike(r"\S\s+\S")).distinct()
    words = texts.select("_text", F.explode(_candidates(F.col("_text"), max_parts)).alias("word")).filter("word <> ''")
    counted = words.join(frequent, "word").groupBy("_text").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("_counts"))
    counted = texts.join(counted, "_text", "left")

    @F.pandas_udf("string")
    def fix(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for ts, cs in batches:
            yield pd.Series([repair_text(t, dict(c) if c is not None else {}, known, max_parts, min_freq) for t, c in zip(ts, cs)], dtype=object)

    changed = counted.select("_text", fix("_text", "_counts").alias("_fixed")).filter("_fixed <> _text")
    out = df
    for c in columns:
        out = out.join(changed.select(F.col("_text").alias(c), F.col("_fixed").alias(f"_fixed_{c}")), c, "left").withColumn(c, F.coalesce(F.col(f"_fixed_{c}"), F.col(c)))
    return out.select(*df.columns)
