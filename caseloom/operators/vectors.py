"""Sums and look-ups of word and concept vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_glove(spark: SparkSession, path: str) -> DataFrame:
    """``(word, vector)`` of a text file of word vectors."""
    parts = F.split("value", " ")
    return spark.read.text(path).select(F.get(parts, F.lit(0)).alias("word"), F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.cast("float")).alias("vector")).filter(F.size("vector") > 0)


def sum_vectors(df: DataFrame, by: list[str], vector: str) -> DataFrame:
    """``(by..., dim, total)``: component sums in double precision; partial sums combine before the shuffle."""
    return df.select(*by, F.posexplode(vector).alias("dim", "_x")).groupBy(*by, "dim").agg(F.sum(F.col("_x").cast("double")).alias("total"))


def looked_up_sum(docs: DataFrame, key: str, words: str, table: DataFrame, dims: int, once: bool = False) -> DataFrame:
    """``(key, vector)``: sum of the vectors of a row's words (each once, or as often as it stands); zeros if none is known."""
    w = docs.select(key, F.explode(F.array_distinct(words) if once else F.col(words)).alias("word")).groupBy(key, "word").count()
    s = w.join(table, "word").select(key, "count", F.posexplode("vector").alias("dim", "_x")).groupBy(key, "dim").agg(F.sum(F.col("_x").cast("double") * F.col("count")).alias("t"))
    v = s.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "t"))), lambda x: x["t"]).alias("vector"))
    return docs.select(key).join(v, key, "left").select(key, F.coalesce("vector", F.array_repeat(F.lit(0.0), dims)).alias("vector"))


def filled(vector: Column, dims: int) -> Column:
    """A vector, or zeros where it is missing or of another length."""
    return F.when(F.size(vector) == dims, vector).otherwise(F.array_repeat(F.lit(0.0), dims))


def keep_members(a: Column, members: list[str]) -> Column:
    """Array elements that belong to a set, each once."""
    return F.array_intersect(a, F.array(*map(F.lit, members)))
