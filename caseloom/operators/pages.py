"""Word tables of scanned pages turned into lines, columns and case rows.

The word table has ``page``, ``y``, ``x0``, ``x1``, ``word``; how words get out
of a document is a pluggable source. Pages are bounded, so what depends on the
order of words runs page by page.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINE_TOLERANCE = 3.0
LEAST_GAP = 8.0


def cluster_lines(words: DataFrame, tolerance: float = LINE_TOLERANCE) -> DataFrame:
    """Adds ``line``: a new line starts where a word lies more than the tolerance below its line's first word."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in words.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["y", "x0", "word"], kind="stable")
        lines, n, top = [], -1, None
        for y in pdf["y"]:
            if top is None or y - top > tolerance:
                n, top = n + 1, y
            lines.append(n)
        return pdf.assign(line=lines)

    return words.groupBy("page").applyInPandas(run, f"{kinds}, line int")


def merge_spans(spans: DataFrame, by: list[str], low: str = "x0", high: str = "x1") -> DataFrame:
    """Union of intervals in each group: ``(by..., low, high)``."""
    w = Window.partitionBy(*by).orderBy(low, high)
    before = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = spans.withColumn("_new", F.coalesce(F.col(low) > before, F.lit(True)).cast("int")).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(*by, "_g").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("_g")


def widest_gap(spans: DataFrame, by: list[str], low: str = "x0", high: str = "x1", least: float = LEAST_GAP) -> DataFrame:
    """Middle of the widest gap between merged spans, where it is wider than ``least``."""
    w = Window.partitionBy(*by).orderBy(low)
    m = merge_spans(spans, by, low, high).withColumn("_next", F.lead(low).over(w))
    g = m.withColumn("_gap", F.col("_next") - F.col(high)).filter(F.col("_gap") > least)
    return g.groupBy(*by).agg(F.max_by((F.col(high) + F.col("_next")) / 2, F.struct("_gap", -F.col(high))).alias("middle"), F.max("_gap").alias("gap"))


def column_of(x: Column, bounds: list[float]) -> Column:
    """Number of boundaries at or left of a position: the column index."""
    return F.size(F.filter(F.array(*map(F.lit, sorted(bounds))), lambda b: b <= x))


def tables_of_page(lines: DataFrame, is_header: Column) -> DataFrame:
    """Adds ``sub``: how many header lines stand at or above a line of its page."""
    w = Window.partitionBy("page").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("sub", F.sum(is_header.cast("int")).over(w))


def assign_rows(lines: DataFrame, case: str = "case", upward: bool = True) -> DataFrame:
    """Adds ``owner``: overflow lines without a case belong to the next case row below (or above), leftovers to the last."""
    base = Window.partitionBy("page", "sub")
    down = base.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    up = base.orderBy("line").rowsBetween(0, Window.unboundedFollowing)
    nxt, prev = F.first(case, ignorenulls=True).over(up), F.last(case, ignorenulls=True).over(down)
    return lines.withColumn("owner", F.coalesce(nxt, prev) if upward else F.coalesce(prev, nxt))


def case_rows(words: DataFrame, bounds: list[float], names: list[str], header: str, case_number: str = r"^20\d{2}-\d{4,5}$") -> DataFrame:
    """``(page, sub, line, names...)``: the case rows of printed tables, from the words of their pages.

    Words are gathered into lines, and each into the column its middle lies in
    (``bounds`` are the inner column boundaries, one fewer than ``names``). A
    line with a word that starts with ``header`` begins another table of the
    page. A line whose first column is a case number is a case row; lines
    without one run over into the case row below them, or into the last one if
    there is none. Cells are joined by line, empty ones are null. Pages without
    words or case rows give no rows.
    """
    lined = cluster_lines(words.select("page", "y", "x0", "x1", "word")).withColumn("_col", column_of((F.col("x0") + F.col("x1")) / 2, bounds))
    cell = lambda i: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_col") == i, F.struct("x0", "word")))), lambda x: x["word"]), " ")
    lines = lined.groupBy("page", "line").agg(F.max(F.col("word").startswith(header)).alias("_head"), *[F.nullif(cell(i), F.lit("")).alias(f"_t{i}") for i, _ in enumerate(names)])
    body = tables_of_page(lines, F.col("_head")).filter(~F.col("_head")).withColumn("_case", F.when(F.col("_t0").rlike(case_number), F.col("line")))
    owned = assign_rows(body, "_case").filter(F.col("owner").isNotNull())
    whole = lambda i: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(f"_t{i}").isNotNull(), F.struct("line", f"_t{i}")))), lambda x: x[f"_t{i}"]), " "), F.lit(""))
    return owned.groupBy("page", "sub", F.col("owner").alias("line")).agg(*[whole(i).alias(n) for i, n in enumerate(names)])


def merge_pages(rows: DataFrame, key: str, page: str, columns: list[str]) -> DataFrame:
    """One row a case: the last known value by page, and the sorted list of its pages."""
    known = lambda c: F.col(c).isNotNull() & (F.col(c) != "NULL")
    aggs = [F.max_by(c, F.when(known(c), F.col(page))).alias(c) for c in columns]
    return rows.groupBy(key).agg(*aggs, F.array_join(F.transform(F.array_sort(F.collect_set(page)), lambda p: p.cast("string")), ",").alias("SourcePages"))


def page_profile(pages: DataFrame, text: str = "text") -> DataFrame:
    """``(kind, shape, n)``: tables, text and empty pages, and the shapes of case numbers on them."""
    kind = F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty").when(F.col(text).rlike(r"(?i)case ?num"), "table").otherwise("text")
    shape = F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), r"(\d{2,4}-\d{3,6})", 1), r"\d", "X")
    return pages.groupBy(kind.alias("kind"), shape.alias("shape")).agg(F.count("*").alias("n"))


def page_range(text: str) -> list[int]:
    """Pages of a selector such as ``1-60,72``."""
    out: set[int] = set()
    for part in text.split(","):
        a, _, b = part.strip().partition("-")
        if a:
            out |= set(range(int(a), int(b or a) + 1))
    return sorted(out)
