"""Lexicon flags combined with model flags under a fixed set of corrections."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.lexicon import GENERAL_OPIOID, MDMA, SUBSTANCES, any_flag, build_lexicon, flag, general_drug, label_flags
from caseloom.functions.text import SEARCH_FIELDS, cause_text, col, row_text

LABELS = ("Methamphetamine", "Heroin", "Cocaine", "Fentanyl", "Alcohol", "Prescription.opioids", "Any Opioids", "Benzodiazepines", "Others", "Any Drugs")
OPIOIDS = ("Heroin", "Fentanyl", "Prescription.opioids")
#: A scorer adds a 0/1 column for each label to a frame that has a ``text`` column.
Scorer = Callable[[DataFrame], DataFrame]


def zero_scorer(df: DataFrame) -> DataFrame:
    """The scorer of a run without a model: all flags 0, so that only the lexicon counts."""
    return df.withColumns({k: F.lit(0) for k in LABELS})


def threshold_flags(df: DataFrame, scores: dict[str, str], thresholds: dict[str, float], strict: bool = True, default: float = 0.5) -> DataFrame:
    """Labels from logits: sigmoid above (or, not strict, at) the label's threshold."""
    p = lambda c: 1 / (1 + F.exp(-col(c)))
    cut = lambda k: F.lit(thresholds.get(k, default))
    return df.withColumns({k: (p(c) > cut(k) if strict else p(c) >= cut(k)).cast("int") for k, c in scores.items()})


def apply_corrections(df: DataFrame, text: Column | None = None, lexicon: dict[str, str] | None = None) -> DataFrame:
    """Final flags of a frame with model flags.

    In this order: lexicon flags of the text; where the model alone says
    Methamphetamine and the text names MDMA, that flag is cleared; every
    substance is model OR lexicon; their number and whether there are several;
    ``Any Opioids`` is a component, the model's flag or a generic opioid word;
    ``Any Drugs`` is any substance, any opioid or a generic drug phrase (the
    model's own flag is discarded). Null and missing model flags count as 0. A
    projection: no shuffle.
    """
    lexicon = lexicon or build_lexicon()
    d = df.withColumn("_text", row_text(df) if text is None else text)
    have = lambda c: F.coalesce(col(c).cast("int"), F.lit(0)) if c in df.columns else F.lit(0)
    d = label_flags(d, F.col("_text"), lexicon, "_l_")
    d = d.withColumns({f"_r{i}": col(f"_l_{k}") if k in lexicon else F.lit(0) for i, k in enumerate(SUBSTANCES)}).drop(*[f"_l_{k}" for k in lexicon])
    mask = (have("Methamphetamine") == 1) & (F.col("_r0") == 0) & (flag(F.col("_text"), MDMA) == 1)
    opioid = F.greatest(have("Any Opioids"), any_flag(F.col("_text"), GENERAL_OPIOID))
    d = d.withColumns({"_mask": mask, "_op": opioid, "_drug": general_drug(F.col("_text"))})
    out = {k: F.greatest(have(k), F.col(f"_r{i}")) for i, k in enumerate(SUBSTANCES)}
    out["Methamphetamine"] = F.when(F.col("_mask"), 0).otherwise(out["Methamphetamine"])
    d = d.withColumns(out)
    d = d.withColumn("Number_Substances", reduce(add, [col(k) for k in SUBSTANCES]))
    d = d.withColumn("Polysubstance", (F.col("Number_Substances") > 1).cast("int"))
    d = d.withColumn("Any Opioids", F.greatest(*[col(k) for k in OPIOIDS], F.col("_op")))
    d = d.withColumn("Any Drugs", F.greatest((F.col("Number_Substances") > 0).cast("int"), col("Any Opioids"), F.col("_drug")))
    return d.drop("_text", "_mask", "_op", "_drug", *[f"_r{i}" for i in range(len(SUBSTANCES))])


def or_flags(df: DataFrame, text: Column, lexicon: dict[str, str], labels: tuple[str, ...]) -> DataFrame:
    """Each label as its own value OR the lexicon's; nulls count as 0."""
    d = label_flags(df, text, lexicon, "_l_")
    return d.withColumns({k: F.greatest(F.coalesce(col(k), F.lit(0)), col(f"_l_{k}")) for k in labels if k in lexicon}).drop(*[f"_l_{k}" for k in lexicon])


def recode_by_keywords(df: DataFrame, text: str, words: tuple[str, ...], labels: list[str]) -> DataFrame:
    """Labels set to 1 where a text contains one of some words, also inside others; nulls count as 0."""
    hit = F.coalesce(F.lower(col(text)).rlike("|".join(re.escape(w.lower()) for w in words)), F.lit(False))
    return df.withColumns({k: F.when(hit, 1).otherwise(F.coalesce(col(k), F.lit(0))) for k in labels})


def label_diff(before: DataFrame, after: DataFrame, key: str, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Rows whose labels changed: key, each label with its ``_new`` twin, and a summary ``changes``."""
    z = lambda side, c: F.coalesce(F.col(f"{side}.`{c}`"), F.lit(0))
    j = before.alias("b").join(after.alias("a"), F.col(f"b.`{key}`") == F.col(f"a.`{key}`"))
    moved = {c: z("b", c) != z("a", c) for c in labels}
    text = F.concat_ws("; ", *[F.when(m, F.concat(F.lit(f"{c}: "), z("b", c).cast("string"), F.lit("→"), z("a", c).cast("string"))) for c, m in moved.items()])
    pairs = [x for c in labels for x in (z("b", c).alias(c), z("a", c).alias(f"{c}_new"))]
    return j.filter(reduce(lambda x, y: x | y, moved.values())).select(F.col(f"b.`{key}`").alias(key), *pairs, text.alias("changes"))


def evidence(df: DataFrame, lexicon: dict[str, str], fields: tuple[str, ...] = SEARCH_FIELDS) -> Column:
    """``Label=[field:'match'; ...] | ...`` of every label that a text field names."""
    def one(label: str, pattern: str) -> Column:
        hits = [F.regexp_extract(F.coalesce(col(f), F.lit("")), f"(?iu)({pattern})", 1) for f in fields if f in df.columns]
        names = [f for f in fields if f in df.columns]
        inner = F.concat_ws("; ", *[F.when(h != "", F.concat(F.lit(f"{n}:'"), h, F.lit("'"))) for n, h in zip(names, hits)])
        return F.when(inner != "", F.concat(F.lit(f"{label}=["), inner, F.lit("]")))

    return F.concat_ws(" | ", *[one(k, p) for k, p in lexicon.items()])


def to_frame(spark: SparkSession, source) -> DataFrame:
    """A frame with text fields from a string, a list of strings, a CSV or XLSX path, or a frame."""
    if isinstance(source, DataFrame):
        df = source
    elif isinstance(source, (list, tuple)):
        df = spark.createDataFrame([(None if t is None else str(t),) for t in source], "CauseA string")
    elif isinstance(source, str) and source.lower().endswith((".csv", ".xlsx")) and os.path.exists(source):
        from caseloom.sources.tabular import read_csv, read_xlsx

        df = (read_csv if source.lower().endswith(".csv") else read_xlsx)(spark, source)
    elif isinstance(source, str):
        df = spark.createDataFrame([(source,)], "CauseA string")
    else:
        raise TypeError(f"unsupported input: {type(source)!r}")
    df = df.toDF(*[c.replace(" ", "") for c in df.columns])
    if not any(f in df.columns for f in SEARCH_FIELDS):
        if "text" not in df.columns:
            raise ValueError(f"no text column; expected one of {SEARCH_FIELDS} or 'text'")
        df = df.withColumn("CauseA", F.col("text"))
    return df


def classify(spark: SparkSession, source, scorer: Scorer = zero_scorer, use_lexicon: bool = True, lexicon: dict[str, str] | None = None) -> DataFrame:
    """Text in, labels out: build the text, score it, and correct the flags with the lexicon."""
    df = to_frame(spark, source)
    scored = scorer(df.withColumn("text", cause_text(df)))
    return apply_corrections(scored, lexicon=lexicon) if use_lexicon else scored
