"""One classic text model for each label, with Spark ML."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import col

ESTIMATORS = {
    "logistic": lambda label: LogisticRegression(labelCol=label, featuresCol="_features", predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob", regParam=0.01),
    "svc": lambda label: LinearSVC(labelCol=label, featuresCol="_features", predictionCol="_p", rawPredictionCol="_raw", regParam=0.01),
    "forest": lambda label: RandomForestClassifier(labelCol=label, featuresCol="_features", predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob", numTrees=20, seed=42),
}


def split_by_hash(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: stable whatever the partitioning."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) / 10_000
    return df.filter(u >= test_share), df.filter(u < test_share)


def tfidf(text: str, features: int = 1 << 14) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[^\p{L}\p{N}]+"), StopWordsRemover(inputCol="_tokens", outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features), IDF(inputCol="_tf", outputCol="_features", minDocFreq=2)])


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: the number of negative rows for each positive one."""
    return df.agg(F.try_divide(F.sum((col(label) == 0).cast("long")), F.sum((col(label) == 1).cast("long"))).alias("ratio"))


def train_labels(train: DataFrame, text: str, labels: list[str], kind: str = "logistic", rows: int = 200_000) -> tuple[PipelineModel, dict[str, object]]:
    """A shared TF-IDF model and one classifier for each label, fitted on at most about ``rows`` rows (the documented bound of the sample)."""
    n = train.count()
    fit = train if n <= rows else train.sample(fraction=rows / n, seed=42)
    feats = tfidf(text).fit(fit)
    f = feats.transform(fit).persist()
    models = {k: ESTIMATORS[kind]("_y").fit(f.withColumn("_y", F.coalesce(col(k), F.lit(0)).cast("double"))) for k in labels}
    f.unpersist()
    return feats, models


def predict_labels(df: DataFrame, feats: PipelineModel, models: dict[str, object], suffix: str = "_pred") -> DataFrame:
    """The rows with one 0/1 prediction for each label."""
    out = feats.transform(df)
    for k, m in models.items():
        out = m.transform(out).withColumn(k + suffix, F.col("_p").cast("int")).drop("_p", "_raw", "_prob")
    return out.drop("_tokens", "_words", "_tf", "_features")


def min_max_calibrated(df: DataFrame, fitted: DataFrame, score: str, out: str) -> DataFrame:
    """Scores as shares of the range between the least and greatest of a fitted part, cut to 0..1; null where the range is empty."""
    r = fitted.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    share = F.try_divide(F.col(score) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.crossJoin(r).withColumn(out, F.when(share.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)))).drop("_lo", "_hi")  # with one row


def save_models(path: str, feats: PipelineModel, models: dict[str, object]) -> None:
    """Features, one model a label, and the list of labels under one folder of any store Spark can write."""
    spark = SparkSession.getActiveSession()
    feats.write().overwrite().save(f"{path}/features")
    for i, m in enumerate(models.values()):
        PipelineModel([m]).write().overwrite().save(f"{path}/label_{i}")
    spark.createDataFrame([(json.dumps(list(models)),)], "labels string").write.mode("overwrite").json(f"{path}/labels")


def load_models(path: str) -> tuple[PipelineModel, dict[str, object]]:
    """What ``save_models`` wrote."""
    spark = SparkSession.getActiveSession()
    labels = json.loads(spark.read.schema("labels string").json(f"{path}/labels").first()[0])
    return PipelineModel.load(f"{path}/features"), {k: PipelineModel.load(f"{path}/label_{i}") for i, k in enumerate(labels)}


def stored_scorer(path: str, text: str = "text"):
    """A scorer from stored models: a 0/1 column for each of their labels on a frame with a ``text`` column; null text is empty."""
    feats, models = load_models(path)

    def score(df: DataFrame) -> DataFrame:
        plain = predict_labels(df.withColumn("_own", col(text)).withColumn(text, F.coalesce(col(text), F.lit(""))), feats, models, "")
        return plain.withColumn(text, F.col("_own")).drop("_own")

    return score
