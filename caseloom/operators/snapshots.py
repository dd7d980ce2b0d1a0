"""What changed between full snapshots, from signed cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.timeparse import date_readings
from caseloom.functions.values import comparable, not_missing


def snapshot_changes(df: DataFrame, key: str, columns: list[str], dates: tuple[str, ...] = (), number: str = "snapshot_no", row_order: str = "row_no", as_of: str = "snapshot_date") -> DataFrame:
    """``(snapshot_no, key, change, field)`` of each snapshot against the one before.

    Each snapshot is unpivoted into cells (key, field, value) and one presence
    marker a key. A cell counts +1 in its own transition and -1 in the next one;
    cells whose sum isn't zero differ. A marker's sum says ``added`` (+1) or
    ``removed`` (-1); for keys on both sides each field with a nonzero sum is
    ``changed``. For added and removed keys ``field`` is empty.

    Keys are trimmed; rows whose key is null, blank or a placeholder are
    ignored; of several rows of a key in a snapshot the one with the highest
    ``row_order`` counts (repeated rows are harmless). Values are compared
    without letter case and white space, numbers and dates by value (``dates``
    are read month first), missing values equal each other and nothing else. One
    snapshot alone or an empty table gives no rows.

    Plan: the last row of a key is found with partial aggregation, so a hot key
    shrinks before it moves; one more shuffle by key then serves all grouped
    sums, since every grouping contains the key. Cells are first summed as they
    are written: equal writings cancel, and only the few that are left are
    brought to comparable form and summed again.
    """
    keyed = df.withColumn("_key", F.regexp_replace(not_missing(F.col(f"`{key}`")), r"^[\s\u00a0]+|[\s\u00a0]+$", "")).filter(F.col("_key").isNotNull())
    order = Window.orderBy("_no")  # over the list of snapshots, not over rows
    around = keyed.select(F.col(number).alias("_no")).distinct().select("_no", F.lag("_no").over(order).alias("_prev"), F.lead("_no").over(order).alias("_next"))

    kinds = dict(df.dtypes)
    # Cells carry the number of their field: 0 is the presence marker.
    plain = [0, *(i for i, c in enumerate(columns, 1) if kinds[c] in ("tinyint", "smallint", "int", "bigint", "boolean"))]
    dated = [i for i, c in enumerate(columns, 1) if c in dates]
    day = F.date_from_unix_date(F.get(date_readings("value", "as_of", "'mdy'"), F.lit(0))["day"]).cast("string")
    text = comparable(F.col("value"))
    form = F.when(F.col("field").isin(*plain), F.coalesce("value", F.lit(""))).when(F.col("field").isin(*(dated or [-1])), F.coalesce(day, text)).otherwise(text)

    raw = F.struct(F.col(as_of).cast("timestamp").alias("as_of") if as_of in df.columns else F.lit(None).cast("timestamp").alias("as_of"), *[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    last = keyed.groupBy("_key", F.col(number).alias("_no")).agg(F.max_by(raw, F.col(row_order)).alias("_v")).repartition("_key")
    signed = last.join(around, "_no").select("_key", "_v", F.explode(F.filter(F.array(
        F.when(F.col("_prev").isNotNull(), F.struct(F.col("_no").alias("no"), F.lit(1).alias("sign"))),
        F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("no"), F.lit(-1).alias("sign"))),
    ), lambda x: x.isNotNull())).alias("_t"))
    cells = signed.select("_key", F.col("_t.no").alias("_no"), F.col("_t.sign").alias("_sign"), F.col("_v.as_of").alias("as_of"), F.posexplode(F.array(
        F.lit("present"), *[F.col(f"_v.v{i}") for i, _ in enumerate(columns)])).alias("field", "value"))
    written = cells.groupBy("_key", "_no", "field", "value").agg(F.sum("_sign").alias("sum"), F.max("as_of").alias("as_of")).filter("sum <> 0")
    sums = written.groupBy("_key", "_no", "field", form.alias("value")).agg(F.sum("sum").alias("sum")).filter("sum <> 0")
    found = sums.groupBy("_key", "_no").agg(
        F.max(F.when(F.col("field") == 0, F.col("sum"))).alias("_mark"),
        F.collect_set(F.when(F.col("field") > 0, F.get(F.array(*map(F.lit, columns)), F.col("field") - 1))).alias("_fields"),
    )
    return found.select(
        F.col("_no").alias(number), F.col("_key").alias(key),
        F.when(F.col("_mark") > 0, "added").when(F.col("_mark") < 0, "removed").otherwise("changed").alias("change"),
        F.explode(F.when(F.col("_mark").isNotNull(), F.array(F.lit(""))).otherwise(F.col("_fields"))).alias("field"),
    )
