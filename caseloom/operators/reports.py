"""Counts, grids, rollups and series for reporting."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.text import col


def rollup_with_all(df: DataFrame, fixed: list[str], rolled: str, aggs: list[Column]) -> DataFrame:
    """Groups by ``fixed`` and ``rolled`` plus groups by ``fixed`` alone, in which ``rolled`` reads ``All``."""
    d = df.select("*", F.explode(F.array(col(rolled).cast("string"), F.lit("All"))).alias("_rolled"))
    return d.groupBy(*fixed, "_rolled").agg(*aggs).withColumnRenamed("_rolled", rolled if rolled not in fixed else f"{rolled}_")


def rolling_mean(df: DataFrame, keys: list[str], order: str, value: str, rows: int = 12) -> DataFrame:
    """Mean of the last ``rows`` rows of each series (rows, not months: gaps aren't filled)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn("rolling", F.round(F.avg(col(value)).over(w), 6))


def complete_grid(counts: DataFrame, axes: list[str], value: str, fill: int = 0) -> DataFrame:
    """Every combination of the axes' distinct values, with ``fill`` where there was none.

    The product of dimension values is the result itself; axes are dimensions,
    reduced to distinct values first.
    """
    grid = reduce(DataFrame.crossJoin, [counts.select(a).distinct().filter(F.col(a).isNotNull()) for a in axes])
    return grid.join(counts, axes, "left").withColumn(value, F.coalesce(F.col(value), F.lit(fill)))


def category_counts(df: DataFrame, keys: list[str], column: str, values: list[str], prefix: str) -> DataFrame:
    """One count column for each listed value of a category."""
    return df.groupBy(*keys).agg(*[F.sum((col(column) == v).cast("int")).cast("long").alias(prefix + v.replace(" ", "_")) for v in values])


def cooccurrence(df: DataFrame, flags: list[str], sizes: Iterable[int] = (2, 3, 4, 5), top: int = 20) -> DataFrame:
    """The most frequent combinations of flags (top-k report): rows shrink to distinct flag patterns first."""
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.coalesce(col(f).cast("int"), F.lit(0)), i) for i, f in enumerate(flags)])
    patterns = df.groupBy(bits.alias("_b")).count()
    combos = [(sum(1 << flags.index(f) for f in c), " + ".join(c), len(c)) for k in sizes for c in combinations(flags, k)]
    arr = F.array(*[F.when(F.col("_b").bitwiseAND(F.lit(m)) == m, F.struct(F.lit(n).alias("combination"), F.lit(k).alias("size"))) for m, n, k in combos])
    g = patterns.select("count", F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("_c")).groupBy("_c.combination", "_c.size").agg(F.sum("count").alias("n"))
    return g.orderBy(F.desc("n"), "combination").limit(top)


def small_cells(df: DataFrame, keys: list[str], least: int = 5) -> DataFrame:
    """``(cells, rows, small_cells, rows_in_small)``: how much falls into cells under ``least`` rows."""
    g = df.groupBy(*keys).count()
    small = F.col("count") < least
    return g.agg(F.count("*").alias("cells"), F.sum("count").alias("rows"), F.sum(small.cast("long")).alias("small_cells"), F.sum(F.when(small, F.col("count")).otherwise(0)).alias("rows_in_small"))


def novel_contribution(df: DataFrame, group: str, case: str, source: str, arrived: str | None = None) -> DataFrame:
    """``(group, source, n_cases, n_new)``: cases of each source, and those no earlier source has in the group.

    Earlier by the column ``arrived`` (one value a source), then by name; by name alone without it.
    """
    one = df.select(group, case, source, *([arrived] if arrived else [])).distinct()
    first = one.groupBy(group, case).agg(F.min_by(source, F.struct(arrived, source) if arrived else F.struct(source)).alias("_first"))
    return one.join(first, [group, case]).groupBy(group, source).agg(F.count("*").alias("n_cases"), F.sum((F.col(source) == F.col("_first")).cast("long")).alias("n_new"))


def coverage(df: DataFrame, group: str, source: str, least: int = 3) -> DataFrame:
    """Groups that at least ``least`` sources cover, with the sources (a bounded dimension) listed in order."""
    g = df.select(group, source).distinct().groupBy(group).agg(F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"), F.count("*").alias("n_sources"))
    return g.filter(F.col("n_sources") >= least)


def ensure_columns(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """The frame with the columns it lacks added as constants."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def union_first_wins(frames: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """One row a key: of several frames the earlier one's, within a frame the first by ``order``."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)])
    cols = [c for c in whole.columns if c != "_frame"]
    return whole.groupBy(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*[col(c) for c in cols]), F.struct("_frame", col(order))).alias("_r")).select("_r.*")


def column_totals(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """``(label, before, after, delta)``: sums of flag columns of two frames, nulls as 0."""
    def total(df: DataFrame, name: str) -> DataFrame:
        g = df.agg(*[F.coalesce(F.sum(col(c).cast("long")), F.lit(0)).alias(f"_{i}") for i, c in enumerate(columns)])
        return g.select(F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"_{i}").alias(name)) for i, c in enumerate(columns)])).alias("_x")).select("_x.*")

    return total(before, "before").join(total(after, "after"), "label").withColumn("delta", F.col("after") - F.col("before"))


def small_cell_shares(df: DataFrame, year: str, area: str, least: int = 5) -> DataFrame:
    """``(year, cells, rows, small_cells, cell_share, row_share)`` by year and, as year ``All``, over all years; rows without an area don't count."""
    g = rollup_with_all(df.filter(col(area).isNotNull()), [area], year, [F.count("*").alias("_n")])
    small = F.col("_n") < least
    s = g.groupBy(year).agg(F.count("*").alias("cells"), F.sum("_n").alias("rows"), F.sum(small.cast("long")).alias("small_cells"), F.sum(F.when(small, F.col("_n")).otherwise(0)).alias("_in"))
    return s.select(year, "cells", "rows", "small_cells", F.round(F.col("small_cells") / F.col("cells"), 6).alias("cell_share"), F.round(F.col("_in") / F.col("rows"), 6).alias("row_share"))


def windows_of_weeks(df: DataFrame, ts: str, weeks: int = 4) -> DataFrame:
    """Counts by periods of whole weeks that end on Sundays, empty ones included."""
    day = F.datediff(F.to_date(col(ts)), F.lit("1970-01-05").cast("date"))  # a Monday
    g = df.filter(col(ts).isNotNull()).groupBy(F.floor(day / (7 * weeks)).alias("_w")).count()
    span = g.agg(F.min("_w").alias("a"), F.max("_w").alias("b")).filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("_w"))
    end = F.date_add(F.lit("1970-01-05").cast("date"), ((F.col("_w") + 1) * 7 * weeks - 1).cast("int"))
    return span.join(g, "_w", "left").select(end.alias("period_end"), F.coalesce("count", F.lit(0)).alias("n"))


def column_differences(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(keys..., column, n_values)``: columns that differ inside a group (least and greatest value compared, then counted)."""
    g = df.groupBy(*[col(k) for k in keys]).agg(*[F.count_distinct(col(c)).alias(f"_d{i}") for i, c in enumerate(columns)])
    parts = F.array(*[F.when(F.col(f"_d{i}") > 1, F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("n_values"))) for i, c in enumerate(columns)])
    return g.select(*[col(k) for k in keys], F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_x")).select(*[col(k) for k in keys], "_x.*")


def null_census(df: DataFrame) -> DataFrame:
    """``(column, n_null, n_rows)`` in one pass."""
    g = df.agg(F.count("*").alias("_n"), *[F.sum(col(c).isNull().cast("long")).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    return g.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"_c{i}"), F.lit(0)).alias("n_null"), F.col("_n").alias("n_rows")) for i, c in enumerate(df.columns)])).alias("_x")).select("_x.*")


def source_stats(df: DataFrame, source: str, date: Column) -> DataFrame:
    """``(source, n, first, last, range)`` by source."""
    g = df.groupBy(col(source)).agg(F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))
    return g.withColumn("range", F.concat(F.date_format("first", "yyyy/MM"), F.lit(" - "), F.date_format("last", "yyyy/MM")))


def melt_flags(df: DataFrame, keys: list[str], flags: list[str], name: str = "type") -> DataFrame:
    """One row for each flag that is 1."""
    return df.select(*keys, F.explode(F.filter(F.array(*[F.when(col(f) == 1, F.lit(f)) for f in flags]), lambda x: x.isNotNull())).alias(name))


def year_table(df: DataFrame, year: Column, groups: dict[str, Column]) -> DataFrame:
    """``(year, name...)``: for each year the number of rows that meet each named condition."""
    return df.groupBy(year.alias("year")).agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(n) for n, c in groups.items()])


def any_of(columns: Iterable[str]) -> Column:
    """1 where any of the flag columns is 1, else 0."""
    return F.greatest(*[F.coalesce((col(c) == 1).cast("int"), F.lit(0)) for c in columns], F.lit(0))


def false_counts(df: DataFrame, labels: Iterable[str], predicted: str = "{}_pred") -> DataFrame:
    """``(label, fp, fn)`` with a last row ``Total``."""
    parts = F.array(*[F.struct(F.lit(k).alias("label"), ((F.coalesce(col(predicted.format(k)), F.lit(0)) == 1) & (F.coalesce(col(k), F.lit(0)) == 0)).cast("long").alias("fp"), ((F.coalesce(col(predicted.format(k)), F.lit(0)) == 0) & (F.coalesce(col(k), F.lit(0)) == 1)).cast("long").alias("fn")) for k in labels])
    long = df.select(F.explode(parts).alias("_p")).select("_p.*")
    return long.select(F.explode(F.array(F.col("label"), F.lit("Total"))).alias("label"), "fp", "fn").groupBy("label").agg(F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
