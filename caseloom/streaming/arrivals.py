"""Files that arrive over time: each once, the master recomputed and audited on arrival."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.stability import compare


def process_arrivals(spark: SparkSession, source: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], fmt: str = "parquet", **options: str) -> None:
    """All files not seen before, in micro-batches, then stop.

    The file source's checkpoint is the ledger: every file is handled once by
    name, also after a crash. ``handle`` must be idempotent by batch number.
    """
    q = spark.readStream.format(fmt).schema(schema).options(**options).load(source).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def master_updater(bronze: str, master: str, build: Callable[[DataFrame], DataFrame], audit: Callable[[DataFrame, DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch handler: new rows are added to the bronze table under their batch number, the master is rebuilt from all of it.

    Rebuilding lets a corrected file take cases away; appending wouldn't. The
    audit gets the master before and after.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{bronze}/batch={number}")
        after = build(spark.read.parquet(bronze))
        path = f"{master}/version={number}"
        after.write.mode("overwrite").parquet(path)
        if audit and number > 0:
            audit(spark.read.parquet(f"{master}/version={number - 1}"), spark.read.parquet(path), number)

    return handle


def audit_summary(old: DataFrame, new: DataFrame, key: str, columns: list[str], month) -> DataFrame:
    """The one-row summary of what an arrival changed."""
    return compare(old, new, key, columns, month)["summary"]


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window and kind, with a watermark for late rows; for batch and streaming frames."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("_w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("_w.start").alias("window_start"), kind, "n", F.round("total", 4).alias("total"))
