"""Texts cut off by field limits, found from where word sequences go on and where they end."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.values import is_missing
from caseloom.session import cut

END_SHARE = 0.35  # share of a usual ending's occurrences that end a text
CUT_SHARE = 0.03  # share of a passage's occurrences that are cut in it
CUT_PRIOR = 0.06  # share of texts that are cut at all
# The same shares for a word whatever stands before it, as words end texts more rarely than passages do.
WORD_END = 0.05
WORD_CUT = 0.005
LONG = 8  # words of the longer context: with the start of the text in it for all but long texts
TOKEN = r"[\p{L}\p{N}'.-]*[\p{L}\p{N}]|[^\p{L}\p{N}\s]"
MARK = r"\s*(?:…|\.\.+|(?<=[\p{L}\p{N}])-)\s*$"


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({TOKEN})"), F.lit(1))


def truncated_values(df: DataFrame, fields: list[str], key: str = "row_id", source: str = "source_file", end_share: float = END_SHARE, cut_share: float = CUT_SHARE, cut_prior: float = CUT_PRIOR) -> DataFrame:
    """``(row_id, field, value, why)``: values whose end was lost.

    Word trigrams (padded at the start, last word also as a fragment of longer
    words) are counted inside texts and at their ends, over all rows. A value is
    cut if its final trigram is frequent inside texts but almost never ends one:
    with ``on`` occurrences that go on and ``ends`` that end, the odds of a cut
    (ends at rate ``cut_share``, prior ``cut_prior``) against a usual ending
    (rate ``end_share``) must favour the cut. The same counts are kept for the
    last word after the ``LONG`` words before it, which tells ``ACUTE A AND B``
    (goes on with TOXICITY) from ``EFFECTS OF A AND B`` (ends): where they speak
    for a usual ending, the trigram can't overrule them. Where neither context
    was seen to end elsewhere, the last word's own counts may decide: a word that
    goes on everywhere (rates ``WORD_CUT`` and ``WORD_END``), such as AND or a
    comma, or one that stands nowhere else as a whole word but begins longer
    ones, a fragment, whose prior is even. Ends in the value's own source don't
    count, so a source that cuts every long value can't make its own cuts look
    usual.

    Three forms are cut whatever the counts: texts with a mark of omission
    (``...``, an ellipsis, a dangling hyphen), texts that leave a bracket open
    and texts that end in a separator. Values with a line break inside are broken, not cut, and are never
    reported; neither are null, blank and placeholder values. Texts of any
    length are counted whole; repeated rows count as often as they stand. Empty
    tables give no rows.

    Plan: rows shrink to distinct (field, source, text) with counts, written
    once, before any n-gram is made, n-grams to distinct types before their
    fragments are made; each word has two contexts of bounded length, so the
    work is linear in the text. All joins are equi-joins on (field, context,
    fragment).
    """
    cells = df.select(F.col(key).alias("_id"), F.col(source).alias("_src"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("_c")).select(
        "_id", "_src", "_c.field", "_c.value").filter(~is_missing(F.col("value")))
    norm = F.trim(F.upper(F.regexp_replace("value", r"[\s ]+", " ")))
    broken = F.trim(F.col("value")).rlike(r"[\r\n]")
    cells = cells.withColumns({"_broken": broken, "_text": norm})
    texts = cells.filter(~F.col("_broken")).groupBy("field", F.coalesce("_src", F.lit("")).alias("_src"), "_text").count()
    marked = F.col("_text").rlike(MARK)
    opened = F.length(F.regexp_replace("_text", r"[^(\[]", "")) > F.length(F.regexp_replace("_text", r"[^)\]]", ""))
    texts = cut(texts.withColumn("_why", F.when(marked, "mark").when(opened, "open bracket").when(F.col("_text").rlike(r"[(\[/&,;:+]$"), "separator")))
    toks = texts.withColumn("_t", _tokens(F.regexp_replace("_text", MARK, ""))).filter(F.size("_t") > 0)

    # One row for each word position, with its two contexts.
    pad = F.concat(F.array_repeat(F.lit("^"), LONG), F.col("_t"))
    n = F.size("_t")
    context = lambda i, k: F.concat_ws(" ", F.slice(pad, i + (LONG - k + 1), k))  # the k words before word i
    pos = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        context(i, 2).alias("tri"), context(i, LONG).alias("all"), F.get("_t", i).alias("word"), (i == n - 1).alias("last")))
    words = toks.filter("_why is null").select("field", "count", F.explode(pos).alias("_p"))
    types = words.groupBy("field", F.col("_p.tri").alias("tri"), F.col("_p.all").alias("all"), F.lit("").alias("uni"), F.col("_p.word").alias("word")).agg(
        F.sum("count").alias("n"), F.sum(F.when(F.col("_p.last"), F.col("count")).otherwise(0)).alias("ends"))

    def inside(ctx: str) -> DataFrame:
        """How often each fragment goes on after its context: as part of a longer word, or as a word with more to come."""
        t = types.groupBy("field", F.col(ctx).alias("ctx"), "word").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
        frag = F.transform(F.sequence(F.lit(1), F.length("word")), lambda k: F.struct(
            F.substring(F.col("word"), F.lit(1), k).alias("frag"), F.when(k == F.length("word"), F.col("n") - F.col("ends")).otherwise(F.col("n")).alias("on"),
            F.when(k == F.length("word"), F.lit(0)).otherwise(F.col("n")).alias("longer")))
        return t.select("field", "ctx", F.explode(frag).alias("_f")).groupBy("field", "ctx", F.col("_f.frag").alias("frag")).agg(F.sum("_f.on").alias("on"), F.sum("_f.longer").alias("longer")).filter("on > 0")

    last = toks.withColumn("frag", F.element_at("_t", -1)).withColumns({"tri": context(n - 1, 2), "all": context(n - 1, LONG)})

    def judged(rows: DataFrame, ctx: str) -> DataFrame:
        own = rows.groupBy("field", F.col(ctx).alias("ctx"), "frag", "_src").agg(F.sum("count").alias("own"))
        both = own.groupBy("field", "ctx", "frag").agg(F.sum("own").alias("ends"), F.collect_list(F.struct("_src", "own")).alias("_by"))
        seen = both.join(inside(ctx), ["field", "ctx", "frag"], "left").select("field", "ctx", "frag", "on", "longer", "ends", F.explode("_by").alias("_b"))
        return seen.select("field", F.col("ctx").alias(ctx), "frag", F.col("_b._src").alias("_src"), F.col("on").alias(f"on_{ctx}"), F.col("longer").alias(f"longer_{ctx}"), (F.col("ends") - F.col("_b.own")).alias(f"ends_{ctx}"))

    plain = last.filter("_why is null").withColumn("uni", F.lit(""))
    j = plain
    for ctx in ("all", "tri", "uni"):
        j = j.join(judged(plain, ctx), ["field", ctx, "frag", "_src"], "left")
    per_end, per_on = math.log(cut_share / end_share), math.log((1 - cut_share) / (1 - end_share))
    fragment = F.coalesce((F.col("longer_uni") >= 3) & (F.col("on_uni") - F.col("longer_uni") <= 0.02 * F.col("longer_uni")), F.lit(False))
    prior = F.when(fragment, 0.0).otherwise(math.log(cut_prior / (1 - cut_prior)))

    def odds(ctx: str, end: float = per_end, on: float = per_on) -> Column:
        return F.coalesce(F.col(f"ends_{ctx}"), F.lit(0)) * end + F.coalesce(F.col(f"on_{ctx}"), F.lit(0)) * on + prior

    seen = lambda ctx: F.coalesce(F.col(f"on_{ctx}"), F.lit(0)) > 0
    fresh = (F.col("ends_all") == 0) & (F.col("ends_tri") == 0)
    alone = fragment & fresh & ~seen("all") & ~seen("tri") & (odds("uni") > 0)
    word = ~fragment & fresh & (odds("uni", math.log(WORD_CUT / WORD_END), math.log((1 - WORD_CUT) / (1 - WORD_END))) > 0)
    is_cut = word | (seen("all") & (odds("all") > 0)) | (seen("tri") & (odds("tri") > 0) & (odds("all") > prior + per_end)) | alone
    by_count = j.filter(is_cut).select("field", "_src", "_text", F.lit("trigram").alias("why"))
    by_form = texts.filter("_why is not null").select("field", "_src", "_text", F.col("_why").alias("why"))
    found = by_count.unionByName(by_form)
    rows = cells.filter(~F.col("_broken")).withColumn("_src", F.coalesce("_src", F.lit("")))
    return rows.join(found, ["field", "_src", "_text"]).select(F.col("_id").alias(key), "field", "value", "why")


def truncation_by_source(df: DataFrame, found: DataFrame, fields: list[str], key: str = "row_id", source: str = "source_file") -> DataFrame:
    """``(source, field, n_values, n_cut, share)``: how often each source truncates each field."""
    cells = df.select(key, source, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("_c")).filter(~is_missing(F.col("_c.value")))
    flags = found.select(key, "field").withColumn("_cut", F.lit(1))
    j = cells.select(key, source, "_c.field").join(flags, [key, "field"], "left")
    return j.groupBy(source, "field").agg(F.count("*").alias("n_values"), F.sum(F.coalesce("_cut", F.lit(0))).alias("n_cut")).withColumn("share", F.round(F.col("n_cut") / F.col("n_values"), 6))
