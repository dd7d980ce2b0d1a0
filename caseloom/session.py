"""Session settings the library was written and tested with."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "caseloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC time, AQE on and case-sensitive names left to the caller.

    Nothing here is needed for results: operators never depend on the number of
    shuffle partitions, on ANSI mode or on the session time zone being set by us.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | extra
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder and read back.

    Cuts lineage and plan size where a costly table feeds several branches. It
    is eager: the rows are computed when it is called. What it wrote is removed
    by Spark when the frame is no longer used, if the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``, and with the folder
    otherwise. The folder is ``spark.checkpoint.dir`` of the session; only where none is set (a
    local session, as in tests) a temporary one is used.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="caseloom-"))
    return df.checkpoint()
