"""Field repairs for rows read off scanned pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Race labels as they are printed.
PRINTED_RACES = ("Hispanic/Latino", "Hispanic/Latina", "Pacific Islander", "American Indian", "Middle Eastern", "Unknown/Other", "Caucasian", "White", "Black", "Asian", "Unknown")


def _any(labels: tuple[str, ...]) -> str:
    return "|".join(sorted(labels, key=len, reverse=True))


def peel_trailing_race(c: Column, labels: tuple[str, ...] = PRINTED_RACES) -> Column:
    """``struct(rest, race)`` of text that ends in one or more race labels; race is null if it ends in none."""
    one = _any(labels)
    p = rf"(?i)^(.*?)\s*\b((?:{one})(?:\s*,\s*(?:{one}))*)\s*$"
    hit = c.rlike(p)
    return F.struct(F.when(hit, F.regexp_extract(c, p, 1)).otherwise(c).alias("rest"), F.when(hit, F.regexp_extract(c, p, 2)).alias("race"))


def split_gender_race(gender: Column, race: Column) -> Column:
    """``struct(gender, race)``: what stands behind Male or Female in the gender cell belongs to the race cell, before its text."""
    p = r"(?i)^\s*(male|female|unknown)\b\s*(.*)$"
    spill = F.when(gender.rlike(p), F.nullif(F.trim(F.regexp_extract(gender, p, 2)), F.lit("")))
    return F.struct(F.when(gender.rlike(p), F.initcap(F.regexp_extract(gender, p, 1))).otherwise(gender).alias("gender"), F.nullif(F.concat_ws(" ", spill, race), F.lit("")).alias("race"))


def earliest_label(c: Column, labels: tuple[str, ...] = PRINTED_RACES) -> Column:
    """The label that stands first in a text; of labels at one place the longest; null if none does."""
    at = F.array(*[F.when(F.locate(x.lower(), F.lower(c)) > 0, F.struct(F.locate(x.lower(), F.lower(c)).alias("at"), F.lit(-len(x)).alias("n"), F.lit(x).alias("label"))) for x in labels])
    return F.array_min(F.filter(at, lambda x: x.isNotNull()))["label"]


def without_headers(c: Column, headers: tuple[str, ...]) -> Column:
    """Text without printed column headers, single blanks."""
    quoted = "|".join(r"\s+".join(h.split()) for h in sorted(headers, key=len, reverse=True))
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"(?i)\b(?:{quoted})\b", " "), r"\s+", " "))


def split_city_suffix(c: Column, cities: list[str], most: int = 4) -> Column:
    """``struct(rest, city)``: the longest known city (up to ``most`` words) at the end of a text."""
    known = F.array(*[F.lit(x.upper()) for x in cities])
    words = F.split(F.trim(F.upper(c)), r"\s+")
    tails = F.transform(F.sequence(F.least(F.lit(most), F.size(words)), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.size(words) - n + 1, n), " "))
    city = F.get(F.filter(tails, lambda t: F.array_contains(known, t)), F.lit(0))
    rest = F.trim(F.substring(F.trim(c), F.lit(1), F.length(F.trim(c)) - F.length(city)))
    return F.struct(F.when(city.isNotNull(), rest).otherwise(c).alias("rest"), city.alias("city"))


def forward_fill(df: DataFrame, columns: list[str], by: list[str], order: str) -> DataFrame:
    """Nulls filled from the last known value above, within a page or another bounded group."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def zip_from_city(df: DataFrame, zip_code: str, city: str) -> DataFrame:
    """Missing codes found at the end of the city text, which loses them."""
    p = r"^(.*?)[\s,]*(\d{5})(?:-\d{4})?\s*$"
    hit = F.col(city).rlike(p)
    return df.withColumns({zip_code: F.coalesce(F.col(zip_code), F.when(hit, F.regexp_extract(city, p, 2))), city: F.when(hit, F.regexp_extract(city, p, 1)).otherwise(F.col(city))})


def page_kind(c: Column, kinds: dict[str, str]) -> Column:
    """The first kind whose marker text a page contains; null if none."""
    return F.coalesce(*[F.when(F.contains(c, F.lit(marker)), F.lit(k)) for k, marker in kinds.items()])


def merge_page_kinds(rows: DataFrame, key: str, kind: str, page: str, text: str, kinds: list[str]) -> DataFrame:
    """One row a case: for each kind of page its texts in page order (a case's pages are few)."""
    aggs = [F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(kind) == k, F.struct(F.col(page).alias("p"), F.col(text).alias("t"))))), lambda x: x["t"]), " ").alias(k) for k in kinds]
    return rows.groupBy(key).agg(*aggs)


def header_key(name: str) -> str:
    """A header without case and anything but letters and digits."""
    return "".join(ch for ch in name.lower() if ch.isalnum())
