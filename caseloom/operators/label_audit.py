"""Checks of label columns against the lexicon and against each other."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.lexicon import SUBSTANCES, all_matches, label_flags
from caseloom.functions.text import col

OPIOIDS = ("Heroin", "Fentanyl", "Prescription.opioids")
# Generic class words that name no substance, and the aggregate they may point to.
CONVENTION_TERMS = ("opioid", "opioids", "opiate", "opiates", "benzodiazepine", "benzodiazepines")
AGGREGATE_OF = {"opioid": "Any Opioids", "opioids": "Any Opioids", "opiate": "Any Opioids", "opiates": "Any Opioids"}
# Negation triggers and how many words before a match they reach.
NEGATION = r"(?i)\b(denies|denied|deny|without|negative for|no evidence of|no evidence|no history of|no signs of|ruled out|rule out|absence of)\b"
NEGATION_WORDS = 8
CONVENTION = r"(?i)\b(opioids?|opiates?|benzodiazepines?)\b"


def _label(c: str) -> Column:
    return F.coalesce(col(c).cast("int"), F.lit(0))


def matches(df: DataFrame, key: str, text: str, lexicon: dict[str, str], labels: Iterable[str] = SUBSTANCES) -> DataFrame:
    """``(key, label, term, value)``: every occurrence of a label's terms with the row's label value."""
    have = [k for k in labels if k in lexicon and k in df.columns]
    d = label_flags(df.select(key, F.coalesce(F.col(text), F.lit("")).alias("_t"), *[_label(k).alias(f"_v_{k}") for k in have]), F.col("_t"), lexicon, "_l_")
    parts = F.array(*[F.when(col(f"_l_{k}") == 1, F.struct(F.lit(k).alias("label"), col(f"_v_{k}").alias("value"), all_matches(F.col("_t"), lexicon[k]).alias("terms"))) for k in have])
    return d.select(key, F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_m")).select(key, "_m.label", "_m.value", F.explode("_m.terms").alias("term"))


def term_precision(m: DataFrame) -> DataFrame:
    """``(term, label, tp, fp, n, precision)`` over all occurrences."""
    g = m.groupBy("term", "label").agg(F.sum("value").cast("long").alias("tp"), F.count("*").alias("n"))
    return g.select("term", "label", "tp", (F.col("n") - F.col("tp")).alias("fp"), "n", F.round(F.col("tp") / F.col("n"), 3).alias("precision"))


def review_candidates(m: DataFrame, precision: DataFrame, key: str, threshold: float = 0.9, min_support: int = 1, low: bool = True) -> DataFrame:
    """``(key, label, term, precision)``: label 0 although a term matches; one row a label, least precise term first.

    By default terms below the threshold are listed (``low``); else those at or above it.
    """
    p = precision.filter(~F.col("term").isin(*CONVENTION_TERMS) & (F.col("n") >= min_support) & ((F.col("precision") < threshold) if low else (F.col("precision") >= threshold)))
    j = m.filter("value = 0").join(p, ["term", "label"])
    return j.groupBy(key, "label").agg(F.min_by(F.struct("term", "precision"), F.struct("precision", (-F.col("fp")).alias("f"), "term")).alias("_t")).select(key, "label", "_t.*")


def unexplained_labels(df: DataFrame, key: str, text: str, lexicon: dict[str, str], labels: Iterable[str] = SUBSTANCES) -> DataFrame:
    """``(key, label)``: label 1 though no term of it occurs."""
    have = [k for k in labels if k in lexicon and k in df.columns]
    d = label_flags(df.select(key, F.coalesce(F.col(text), F.lit("")).alias("_t"), *[_label(k).alias(f"_v_{k}") for k in have]), F.col("_t"), lexicon, "_l_")
    miss = F.filter(F.array(*[F.when((col(f"_v_{k}") == 1) & (col(f"_l_{k}") == 0), F.lit(k)) for k in have]), lambda x: x.isNotNull())
    return d.select(key, F.explode(miss).alias("label"))


def invariants(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, check, severity)``: derived columns that disagree with their components."""
    ors = lambda cs: F.greatest(*[_label(c) for c in cs])
    op, any_op, sub, drug = ors(OPIOIDS), _label("Any Opioids"), ors(SUBSTANCES), _label("Any Drugs")
    generic = (any_op == 1) & F.coalesce(F.col(text), F.lit("")).rlike(CONVENTION)
    row = lambda cond, check, sev: F.when(cond, F.struct(F.lit(check).alias("check"), sev.alias("severity")))
    found = F.array(
        row(op != any_op, "opioids", F.when(generic, "info").otherwise("error")),
        row((sub == 1) & (drug == 0), "drugs missing", F.lit("error")),
        row((sub == 0) & (drug == 1), "drugs alone", F.lit("info")))
    return df.select(key, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("_c")).select(key, "_c.*")


def duplicate_conflicts(df: DataFrame, key: str, text: str, labels: Iterable[str]) -> DataFrame:
    """``(text_hash, label, n_rows, n_ones)``: equal texts whose labels differ; counts, so a text of any frequency stays one row."""
    d = df.filter(F.trim(F.col(text)) != "")
    g = d.groupBy(F.md5(F.col(text)).alias("text_hash")).agg(F.count("*").alias("n_rows"), F.min(key).alias("first_row"), *[F.sum(_label(k)).cast("long").alias(f"_s{i}") for i, k in enumerate(labels)])
    parts = F.array(*[F.when((F.col(f"_s{i}") > 0) & (F.col(f"_s{i}") < F.col("n_rows")), F.struct(F.lit(k).alias("label"), F.col(f"_s{i}").alias("n_ones"))) for i, k in enumerate(labels)])
    return g.select("text_hash", "first_row", "n_rows", F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_c")).select("text_hash", "first_row", "n_rows", "_c.*")


def duplicate_groups(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``(dup_group, text, n, row_ids, label_values)``: equal texts whose label differs, with their rows and values in order.

    Groups are numbered in order of their texts. The lists are the result; rows
    of texts without a conflict are left out before any is made.
    """
    d = df.filter(F.trim(col(text)) != "").select(col(key).alias("_k"), col(text).alias(text), _label(label).alias("_v"))
    bad = d.groupBy(text).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("n")).filter("_lo <> _hi")
    number = F.row_number().over(Window.orderBy(text))  # over the texts in conflict, not over rows
    g = d.join(bad.select(text, "n", number.alias("dup_group")), text).groupBy("dup_group", text, "n").agg(F.array_sort(F.collect_list(F.struct("_k", "_v"))).alias("_r"))
    listed = lambda c: F.array_join(F.transform("_r", lambda x: x[c].cast("string")), ",")
    return g.select("dup_group", text, "n", listed("_k").alias("row_ids"), listed("_v").alias("label_values"))


def negated_rows(df: DataFrame, key: str, text: str, lexicon: dict[str, str], labels: Iterable[str] = SUBSTANCES) -> DataFrame:
    """``(key, label, terms)``: label 1, and each of its matches follows a negation within eight words of its field.

    Fields of a text are separated by ``|``. One scan serves all labels. The text
    is split at a label's matches; what stands before a match is carried from
    piece to piece as its last words only, so a text of any length is read once.
    """
    have = [k for k in labels if k in lexicon and k in df.columns]
    d = label_flags(df.select(key, F.coalesce(F.col(text), F.lit("")).alias("_t"), *[_label(k).alias(f"_v_{k}") for k in have]), F.col("_t"), lexicon, "_l_")
    # The last words after the last separator; one more than the scope, as the first may be the end of a longer one.
    tail = lambda s: F.array_join(F.slice(F.concat(F.array_repeat(F.lit(""), NEGATION_WORDS + 1), F.split(F.element_at(F.split(s, r"\|"), -1), r"[,\s]+")), -(NEGATION_WORDS + 1), NEGATION_WORDS + 1), " ")
    scope = lambda before: F.array_join(F.slice(F.concat(F.array_repeat(F.lit(""), NEGATION_WORDS), F.split(F.trim(before), " +")), -NEGATION_WORDS, NEGATION_WORDS), " ")

    def negated(k: str) -> Column:
        pieces = F.split(F.regexp_replace("_t", f"(?iu)({lexicon[k]})", "\u0001$1\u0002"), "[\u0001\u0002]")  # text, match, text, match, ..., text
        state = F.struct(F.lit("").alias("before"), F.lit(True).alias("all"), F.lit(False).alias("match"))
        step = lambda s, p: F.struct(tail(F.concat(s["before"], p)).alias("before"), F.when(s["match"], s["all"] & scope(s["before"]).rlike(NEGATION)).otherwise(s["all"]).alias("all"), (~s["match"]).alias("match"))
        return F.aggregate(pieces, state, step)["all"]

    parts = F.array(*[F.when((col(f"_v_{k}") == 1) & (col(f"_l_{k}") == 1), F.when(negated(k), F.struct(F.lit(k).alias("label"), F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("_t", F.lit(f"(?iu)({lexicon[k]})"), F.lit(1)))), ", ").alias("terms")))) for k in have])
    return d.select(key, F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_n")).select(key, "_n.*")


def aggregate_signal(df: DataFrame, text: str, terms: dict[str, str] = AGGREGATE_OF) -> DataFrame:
    """``(term, label, n, tp, precision)``: how well generic words predict an aggregate, counted by record."""
    t = F.coalesce(F.col(text), F.lit(""))
    parts = F.array(*[F.when(t.rlike(rf"(?i)\b{w}\b"), F.struct(F.lit(w).alias("term"), F.lit(a).alias("label"), _label(a).alias("v"))) for w, a in terms.items()])
    long = df.select(F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_t")).select("_t.*")
    return long.groupBy("term", "label").agg(F.count("*").alias("n"), F.sum("v").cast("long").alias("tp")).withColumn("precision", F.round(F.col("tp") / F.col("n"), 3))


def pattern_leak(m: DataFrame, df: DataFrame, key: str, labels: Iterable[str] = SUBSTANCES) -> DataFrame:
    """``(term, label, other, n, n_other)``: records in which a term of one label occurs, and how many carry another label."""
    one = m.select(key, "term", "label").distinct()
    j = one.join(df.select(key, *[_label(k).alias(f"_l{i}") for i, k in enumerate(labels)]), key)
    g = j.groupBy("term", "label").agg(F.count("*").alias("n"), *[F.sum(f"_l{i}").cast("long").alias(f"_s{i}") for i, _ in enumerate(labels)])
    parts = F.array(*[F.struct(F.lit(k).alias("other"), F.col(f"_s{i}").alias("n_other")) for i, k in enumerate(labels)])
    return g.select("term", "label", "n", F.explode(parts).alias("_o")).select("term", "label", "n", "_o.*").filter("other <> label and n_other > 0")


def auto_correct(df: DataFrame, key: str, text: str, candidates: DataFrame, negated: DataFrame) -> DataFrame:
    """Rows with accepted candidates set to 1 (negated ones skipped) and the derived columns recomputed upwards."""
    ok = candidates.select(key, "label").join(negated.select(key, "label"), [key, "label"], "left_anti").groupBy(key).agg(F.collect_set("label").alias("_set"))
    d = df.join(ok, key, "left")
    d = d.withColumns({k: F.when(F.array_contains("_set", k), 1).otherwise(_label(k)) for k in SUBSTANCES if k in df.columns})
    d = d.withColumn("Any Opioids", F.greatest(*[_label(k) for k in OPIOIDS], F.when(F.coalesce(F.col(text), F.lit("")).rlike(CONVENTION), _label("Any Opioids")).otherwise(0)))
    return d.withColumn("Any Drugs", F.greatest(_label("Any Drugs"), *[_label(k) for k in SUBSTANCES], _label("Any Opioids"))).drop("_set")




def change_log(before: DataFrame, after: DataFrame, key: str, labels: Iterable[str]) -> DataFrame:
    """``(key, label, before, after)``: label values that differ between two versions of the same rows, nulls as 0."""
    labels = list(labels)
    side = lambda df, n: df.select(key, F.array(*[_label(k) for k in labels]).alias(n))
    j = side(before, "_b").join(side(after, "_a"), key)
    parts = F.array(*[F.when(F.get("_b", F.lit(i)) != F.get("_a", F.lit(i)), F.struct(F.lit(k).alias("label"), F.get("_b", F.lit(i)).alias("before"), F.get("_a", F.lit(i)).alias("after"))) for i, k in enumerate(labels)])
    return j.select(key, F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_c")).select(key, "_c.*")
