"""Classification metrics in one or two aggregations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.text import col
from caseloom.session import cut


def long_predictions(df: DataFrame, labels: Iterable[str], truth: str = "{}", predicted: str = "{}_pred", key: str | None = None) -> DataFrame:
    """``([key], label, y, p)`` of label pairs; nulls count as 0."""
    parts = F.array(*[F.struct(F.lit(k).alias("label"), F.coalesce(col(truth.format(k)).cast("int"), F.lit(0)).alias("y"), F.coalesce(col(predicted.format(k)).cast("int"), F.lit(0)).alias("p")) for k in labels])
    keep = [key] if key else []
    return df.select(*keep, F.explode(parts).alias("_l")).select(*keep, "_l.*")


def _ratios(g: DataFrame) -> DataFrame:
    div = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return g.withColumns({"accuracy": F.round(div(tp + tn, tp + fp + fn + tn), 6), "precision": F.round(div(tp, tp + fp), 6), "recall": F.round(div(tp, tp + fn), 6), "f1": F.round(div(2 * tp, 2 * tp + fp + fn), 6)})


def label_metrics(long: DataFrame, *by: str) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 of each label; 0 where a denominator is 0."""
    n = lambda y, p: F.sum(((F.col("y") == y) & (F.col("p") == p)).cast("long"))
    return _ratios(long.groupBy("label", *by).agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn")))


def multilabel_metrics(df: DataFrame, labels: list[str], truth: str = "{}", predicted: str = "{}_pred") -> DataFrame:
    """One row: Hamming loss, subset accuracy and macro precision, recall and F1."""
    pairs = [(F.coalesce(col(truth.format(k)).cast("int"), F.lit(0)), F.coalesce(col(predicted.format(k)).cast("int"), F.lit(0))) for k in labels]
    wrong = sum((F.when(y != p, 1).otherwise(0) for y, p in pairs), F.lit(0))
    whole = df.select(wrong.alias("w")).agg(F.round(F.sum("w") / (F.count("*") * len(labels)), 6).alias("hamming_loss"), F.round(F.avg((F.col("w") == 0).cast("int")), 6).alias("subset_accuracy"))
    macro = label_metrics(long_predictions(df, labels, truth, predicted)).agg(*[F.round(F.avg(m), 6).alias(f"macro_{m}") for m in ("precision", "recall", "f1")])
    return whole.crossJoin(macro)  # one row with one row


def roc_auc(df: DataFrame, score: str, truth: str, *by: str, digits: int = 6) -> DataFrame:
    """Area under the ROC curve by rank sums, ties at their mean rank.

    Rows shrink to distinct scores first. These are partitioned by range and
    written once; ranks are the partition's offset plus running sums within it,
    so no task sorts more than its range, however many scores there are.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = df.groupBy(*by, col(score).alias("_s")).agg(F.count("*").alias("_n"), F.sum(col(truth).cast("long")).alias("_pos"))
    g = cut(g.repartitionByRange(n, *by, "_s").withColumn("_p", F.spark_partition_id()))
    parts = g.groupBy(*by, "_p").agg(F.sum("_n").alias("_in"))
    before = parts.select(*by, F.col("_p").alias("_q"), F.col("_in").alias("_m"))
    offset = parts.join(before, [*by]) if by else parts.crossJoin(before)  # partitions with partitions, not rows
    offset = offset.groupBy(*by, "_p").agg(F.sum(F.when(F.col("_q") < F.col("_p"), F.col("_m")).otherwise(0)).alias("_off"))
    w = Window.partitionBy(*by, "_p").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    r = g.join(offset, [*by, "_p"]).withColumn("_rank", F.col("_off") + F.coalesce(F.sum("_n").over(w), F.lit(0)) + (F.col("_n") + 1) / 2)
    a = r.groupBy(*by).agg(F.sum("_pos").alias("pos"), (F.sum("_n") - F.sum("_pos")).alias("neg"), F.sum(F.col("_rank") * F.col("_pos")).alias("_rs"))
    return a.select(*by, "pos", "neg", F.round(F.when((F.col("pos") > 0) & (F.col("neg") > 0), (F.col("_rs") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * F.col("neg"))), digits).alias("auc"))


def macro_auc(df: DataFrame, scores: dict[str, str]) -> DataFrame:
    """``(macro_auc)``: the mean area under the curve over labels; labels with one outcome only don't count."""
    parts = F.array(*[F.struct(F.lit(k).alias("label"), F.coalesce(col(k).cast("int"), F.lit(0)).alias("y"), col(s).cast("double").alias("s")) for k, s in scores.items()])
    long = df.select(F.explode(parts).alias("_p")).select("_p.*")
    return roc_auc(long, "s", "y", "label", digits=12).agg(F.round(F.avg("auc"), 6).alias("macro_auc"))


def best_thresholds(df: DataFrame, scores: dict[str, str], step: float = 0.01) -> DataFrame:
    """``(label, threshold, f1)``: the lowest threshold of 0..1 with the greatest F1 for each label.

    Scores are counted by hundredth first; the sweep runs over those counts.
    """
    steps = int(round(1 / step))
    parts = F.array(*[F.struct(F.lit(k).alias("label"), F.coalesce(col(k).cast("int"), F.lit(0)).alias("y"), F.floor(F.round(col(s) / step, 9)).cast("int").alias("b")) for k, s in scores.items()])
    h = df.select(F.explode(parts).alias("_p")).select("_p.*").groupBy("label", "b").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    spread = h.select("label", "pos", "n", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("t"), "b")
    at = spread.groupBy("label", "t").agg(F.sum(F.when(F.col("b") >= F.col("t"), F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("b") >= F.col("t"), F.col("n") - F.col("pos")).otherwise(0)).alias("fp"), F.sum(F.when(F.col("b") < F.col("t"), F.col("pos")).otherwise(0)).alias("fn"))
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") == 0, 0.0).otherwise(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")))
    best = at.withColumn("f1", F.round(f1, 6)).groupBy("label").agg(F.max_by(F.struct("t", "f1"), F.struct("f1", (-F.col("t")).alias("t"))).alias("_b"))
    return best.select("label", F.round(F.col("_b.t") * step, 2).alias("threshold"), F.col("_b.f1").alias("f1"))


def bootstrap_interval(df: DataFrame, value: str, key: str, resamples: int = 1000, seed: int = 42) -> DataFrame:
    """``(mean, low, high)``: mean of a column and its 95 % interval over Poisson resamples.

    Each row draws its weight in each resample from a hash of key and resample
    number (inverse Poisson(1) distribution; a resample of no weight is left out), so the result depends neither on
    partitioning nor on order, and resample sums combine before the shuffle.
    """
    u = (F.pmod(F.xxhash64(F.col(key), F.col("r"), F.lit(seed)), F.lit(1_000_003)) + 0.5) / 1_000_003
    cuts, p, acc = [], 0.36787944117144233, 0.0
    for k in range(8):
        acc += p
        cuts.append(acc)
        p /= k + 1
    weight = sum((F.when(u > c, 1).otherwise(0) for c in cuts), F.lit(0))
    rows = df.select(key, col(value).cast("double").alias("_v")).withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(resamples)))).withColumn("_w", weight)
    means = rows.groupBy("r").agg(F.try_divide(F.sum(F.col("_v") * F.col("_w")), F.sum("_w")).alias("m"))
    q = means.agg(F.expr("percentile(m, 0.025)").alias("low"), F.expr("percentile(m, 0.975)").alias("high"))
    return df.agg(F.avg(col(value)).alias("mean")).crossJoin(q)  # one row with one row


def metric_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Metrics of two runs side by side with their differences."""
    ms = ("accuracy", "precision", "recall", "f1")
    b = before.select("label", *[F.col(m).alias(f"{m}_before") for m in ms])
    a = after.select("label", *[F.col(m).alias(f"{m}_after") for m in ms])
    return b.join(a, "label").withColumns({f"{m}_delta": F.round(F.col(f"{m}_after") - F.col(f"{m}_before"), 6) for m in ms})
