"""The surviving record of each duplicate group, attribute by attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.values import case_key, is_missing


def surviving_values(df: DataFrame, sources: DataFrame, fields: list[str], unsound: DataFrame | None = None, case: str = "CaseNumber", key: str = "row_id", source: str = "source_file", received: str = "received_at", at_least: int = 2) -> DataFrame:
    """One row a case: for each field its surviving value and the row it came from.

    Columns: the canonical case number, ``n_rows`` and for each field ``f`` the
    pair ``f``, ``f_row`` (null where no row qualifies). Each attribute is the
    maximum of a composite struct (sound, trust of the source, time received,
    smallest row, value), all in one aggregation, so a case of any size shrinks
    to one struct a field before it moves.

    Missing values never qualify; ``unsound`` (``row_id``, ``field``) names
    further values that don't. Sources without a trust come after all others,
    null times before all others. Rows whose case number has no canonical form
    belong to no case; cases of fewer than ``at_least`` rows are left out. Ties
    end at the smallest ``row_id``, which is unique.
    """
    trust = sources.select(F.col(source), F.col("trust").alias("_trust")).groupBy(source).agg(F.min("_trust").alias("_trust"))
    rows = df.select(case_key(F.col(case)).alias("_case"), F.col(key).alias("_id"), F.col(source), F.col(received).alias("_at"), *[F.col(f).alias(f"_v{i}") for i, f in enumerate(fields)]).filter(F.col("_case").isNotNull())
    rows = rows.join(trust, source, "left")
    if unsound is not None:
        bad = unsound.filter(F.col("field").isin(fields)).groupBy(F.col(key).alias("_id")).agg(F.collect_set("field").alias("_bad"))
        rows = rows.join(bad, "_id", "left")
    else:
        rows = rows.withColumn("_bad", F.lit(None).cast("array<string>"))

    def best(i: int, f: str):
        sound = ~is_missing(F.col(f"_v{i}")) & ~F.coalesce(F.array_contains("_bad", f), F.lit(False))
        order = F.struct((-F.coalesce(F.col("_trust"), F.lit(2**31 - 1)).cast("long")).alias("t"), F.col("_at").alias("at"), (-F.col("_id")).alias("r"), F.col(f"_v{i}").alias("v"))
        return F.max(F.when(sound, order)).alias(f"_b{i}")

    g = rows.groupBy("_case").agg(F.count("*").alias("n_rows"), *[best(i, f) for i, f in enumerate(fields)]).filter(F.col("n_rows") >= at_least)
    out = [c for i, f in enumerate(fields) for c in (F.col(f"_b{i}.v").alias(f), (-F.col(f"_b{i}.r")).alias(f"{f}_row"))]
    return g.select(F.col("_case").alias(case), "n_rows", *out)


def winners(survivors: DataFrame, fields: list[str], case: str = "CaseNumber", key: str = "row_id") -> DataFrame:
    """``(case, field, row_id)`` of every surviving value."""
    long = survivors.select(case, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_row").alias("row")) for f in fields])).alias("_f"))
    return long.filter("_f.row is not null").select(case, "_f.field", F.col("_f.row").alias(key))
