"""Comparing and replaying versions of a master table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import cell_value, col
from caseloom.operators.entity import merge_records
from caseloom.session import cut


def last_of_year(df: DataFrame, key: str, date: Column, order: str, year: int | None = None) -> DataFrame:
    """The last row (by ``order``) of each non-null key, after an optional filter on the year."""
    d = df.filter(col(key).isNotNull())
    if year is not None:
        d = d.filter(F.year(date) == year)
    whole = F.struct(*[col(c) for c in df.columns])
    return d.groupBy(col(key)).agg(F.max_by(whole, col(order)).alias("_r")).select("_r.*")


def compare(old: DataFrame, new: DataFrame, key: str, columns: list[str], month: Column, by: list[str] = ()) -> dict[str, DataFrame]:
    """``added``, ``removed``, ``changed`` cells, ``columns`` (changes by column), ``months`` and ``summary`` of two versions.

    Only columns both versions have are compared, as trimmed text with whole
    decimals as whole numbers. ``month`` is the month key of a row. ``by`` names
    columns that number several pairs of versions compared at once; every result
    then starts with them. Keys are unique in a version.

    Plan: one full outer join by key serves all results; the summary is one
    aggregation over it.
    """
    by = list(by)
    shared = [c for c in columns if c in old.columns and c in new.columns]
    side = lambda df, n: df.select(*by, col(key).alias("_k"), F.struct(month.alias("m"), *[cell_value(col(c)).alias(f"v{i}") for i, c in enumerate(shared)]).alias(n))
    j = side(old, "_o").join(side(new, "_n"), [*by, "_k"], "full")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_o.v{i}").alias("old"), F.col(f"_n.v{i}").alias("new")) for i, c in enumerate(shared)])
    was, is_ = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    j = j.withColumn("_c", F.when(was & is_, F.filter(cells, lambda c: c["old"] != c["new"])).otherwise(F.slice(cells, 1, 0)))
    changed = j.select(*by, F.col("_k").alias(key), F.explode("_c").alias("_c")).select(*by, key, "_c.*")
    sides = F.array(F.when(was, F.struct(F.col("_o.m").alias("month"), F.lit(1).alias("a"), F.lit(0).alias("b"))), F.when(is_, F.struct(F.col("_n.m").alias("month"), F.lit(0).alias("a"), F.lit(1).alias("b"))))
    months = j.select(*by, F.explode(F.filter(sides, lambda x: x.isNotNull())).alias("_s")).groupBy(*by, "_s.month").agg(F.sum("_s.a").alias("old_n"), F.sum("_s.b").alias("new_n"))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    summary = j.groupBy(*by).agg(n(was).alias("old_rows"), n(is_).alias("new_rows"), n(~was).alias("added"), n(~is_).alias("removed"), n(was & is_).alias("shared"), n(F.size("_c")).alias("changed_cells"), n(F.size("_c") > 0).alias("changed_cases"))
    return {
        "added": j.filter(~was).select(*by, F.col("_k").alias(key)), "removed": j.filter(~is_).select(*by, F.col("_k").alias(key)), "changed": changed,
        "columns": changed.groupBy(*by, "column").count().withColumnRenamed("count", "n"), "months": months.withColumn("delta", F.col("new_n") - F.col("old_n")), "summary": summary}


def replay(files: DataFrame, step: str, key: str, order: str, columns: list[str], month: Column, incremental: bool = True) -> DataFrame:
    """``(step, added, removed, changed_cells)``: the master after each file against the one before.

    Incremental: the merged state competes with the next file's rows, as a
    running pipeline does; each state is written once to the checkpoint folder.
    Otherwise state k is the merge of files 1..k in one go. The steps are files
    (a bounded list, read from the driver); rows never leave the executors.
    """
    steps = [r[0] for r in files.select(step).distinct().orderBy(step).collect()]
    state, out = None, []
    for s in steps:
        part = files.filter(col(step) == s) if incremental and state is not None else files.filter(col(step) <= s)
        if incremental and state is not None:
            part = state.withColumn(order, F.lit(-1).cast("long")).unionByName(part.select(*state.columns, col(order).cast("long").alias(order)))
        keep = part.drop(step) if step in part.columns else part
        now = cut(merge_records(keep.withColumn(order, col(order).cast("long")), [key], order, "last"))
        if state is not None:
            c = compare(state, now, key, columns, month)["summary"]
            out.append(c.select(F.lit(s).alias(step), "added", "removed", "changed_cells"))
        state = now
    return reduce(DataFrame.unionByName, out)
