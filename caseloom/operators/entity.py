"""Merging duplicate records by completeness, and filling gaps from history."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import col


def completeness(columns: Iterable[str]) -> Column:
    """Number of non-null cells."""
    return reduce(add, [col(c).isNotNull().cast("int") for c in columns])


def merge_records(df: DataFrame, keys: list[str], order: str, tie: str = "last", count: list[str] | None = None, maxima: Iterable[str] = (), prefer: Iterable[Column] = ()) -> DataFrame:
    """One row a key: each column's first non-null value in order of completeness.

    Rows are ranked by their number of non-null cells (of ``count``, by default
    all columns but ``order``), most first; ties go to the row that is greater
    by the criteria ``prefer`` (null is least), then to the first or the last row
    by ``order``, which must be unique and within +-2^62. ``maxima`` columns take their maximum
    instead. Rows with null keys merge with each other. A value survives though
    its row may not: columns of the result can come from different rows.

    One aggregation with partial combine and a single shuffle on the keys; no
    window, no row is collected.
    """
    cols = [c for c in df.columns if c not in keys and c != order]
    sign = 1 if tie == "first" else -1
    # Fixed-width text: one comparison in generated code, however many columns are merged.
    full = F.lpad((F.lit(999_999) - completeness(count or [c for c in df.columns if c != order])).cast("string"), 6, "0")
    place = F.lpad((sign * col(order).cast("long") + F.lit(1 << 62)).cast("string"), 19, "0")
    wish = [F.struct(p.isNull().alias("none"), (-p.cast("double")).alias("v")).alias(f"p{i}") for i, p in enumerate(prefer)]
    rank = F.struct(full.alias("full"), *wish, place.alias("place")) if wish else F.concat(full, place)
    d = df.withColumn("_rank", rank)
    aggs = [F.max(col(c)).alias(c) if c in set(maxima) else F.min_by(col(c), F.when(col(c).isNotNull(), F.col("_rank"))).alias(c) for c in cols]
    return d.groupBy(*[col(k) for k in keys]).agg(*aggs).select(*[col(c) for c in df.columns if c != order])


def merge_cases(df: DataFrame, key: str, flags: list[str], order: str) -> DataFrame:
    """Flags by maximum, all else by completeness; flags never make a row more complete than another."""
    others = [c for c in df.columns if c not in flags and c != order]
    return merge_records(df, [key], order, "last", count=others, maxima=flags)


def backfill(current: DataFrame, history: DataFrame, key: str, order: str) -> DataFrame:
    """Nulls of the current rows filled from history, for columns both have; nothing is overwritten.

    History is merged to one row a key first (ties: last), so no current row is
    repeated. Null keys match null keys.
    """
    shared = [c for c in current.columns if c in history.columns and c != key and c != order]
    h = merge_records(history.select(key, *[col(c) for c in shared], order), [key], order, "last")
    h = h.select(col(key).alias("_hk"), *[col(c).alias(f"_h{i}") for i, c in enumerate(shared)])
    j = current.join(h, col(key).eqNullSafe(F.col("_hk")), "left")
    fill = {c: F.coalesce(col(c), F.col(f"_h{i}")) for i, c in enumerate(shared)}
    return j.select(*[fill[c].alias(c) if c in fill else col(c) for c in current.columns])


def best_row(df: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """The row of each key that is greatest by a list of criteria (give a unique one last)."""
    whole = F.struct(*[col(c) for c in df.columns])
    g = df.groupBy(*[col(k) for k in keys]).agg(F.max_by(whole, F.struct(*[b.alias(f"c{i}") for i, b in enumerate(by)])).alias("_r"))
    return g.select("_r.*")


def coalesce_aliases(df: DataFrame, aliases: dict[str, tuple[str, ...]], blank_aware: bool = False, drop: bool = True) -> DataFrame:
    """Each canonical column as the first non-null (or non-blank) of its aliases that the frame has."""
    used: set[str] = set()
    out = {}
    for canon, names in aliases.items():
        have = [n for n in dict.fromkeys(names) if n in df.columns]
        if have:
            used |= set(have)
            out[canon] = F.coalesce(*[F.when(F.trim(col(n)) != "", col(n)) if blank_aware else col(n) for n in have])
    rest = [c for c in df.columns if c not in out and not (drop and c in used)]
    return df.select(*[col(c) for c in rest], *[v.alias(k) for k, v in out.items()])


def first_alias(df: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Each canonical column from the first alias present in the file; no fallback by row."""
    have = {c: next((n for n in names if n in df.columns), None) for c, names in aliases.items()}
    return df.select(*[col(n).alias(c) for c, n in have.items() if n])
