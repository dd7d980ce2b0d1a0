import datetime

import pytest
from pyspark.sql import functions as F

from caseloom.functions import dates, lexicon, text
from caseloom.operators import classification, consensus, entity, label_audit, metrics, relations, reports, stability

from .conftest import rows


def test_merge_is_completeness_ranked_and_column_wise(spark):
    data = [(1, "k", "a", None, None), (2, "k", "b", 1, None), (3, "k", "c", 2, None), (4, None, "x", None, 9), (5, None, None, 3, 8), (6, "z", None, None, None)]
    df = spark.createDataFrame(data, "o long, k string, s string, n int, m int")
    assert rows(entity.merge_records(df, ["k"], "o", "last")) == [("k", "c", 2, None), ("z", None, None, None), (None, "x", 3, 8)]
    assert rows(entity.merge_records(df, ["k"], "o", "first"))[0] == ("k", "b", 1, None)
    once = entity.merge_records(df, ["k"], "o", "last")
    assert rows(entity.merge_records(once.withColumn("o", F.lit(0)), ["k"], "o")) == rows(once)
    assert entity.merge_records(df.limit(0), ["k"], "o").count() == 0


def test_merge_cases_ignores_flags_in_ranking(spark):
    df = spark.createDataFrame([(1, "k", "a", "b", 0, None), (2, "k", "c", None, 1, 1)], "o long, k string, s string, t string, f int, g int")
    assert rows(entity.merge_cases(df, "k", ["f", "g"], "o")) == [("k", "a", "b", 1, 1)]


def test_backfill_never_overwrites_or_repeats(spark):
    cur = spark.createDataFrame([(1, "k", None), (2, "k", "x"), (3, None, None)], "o long, k string, v string")
    his = spark.createDataFrame([(1, "k", "old"), (2, "k", "new"), (3, None, "n"), (4, "q", "u")], "o long, k string, v string")
    assert rows(entity.backfill(cur, his, "k", "o")) == [(1, "k", "new"), (2, "k", "x"), (3, None, "n")]


def test_aliases_and_best_row(spark):
    df = spark.createDataFrame([("", "b", 1), (None, None, 2)], "`Zip.1` string, `Zi\np` string, o int")
    names = {"Zip": ("Zip.1", "Zi\np", "none")}
    assert rows(entity.coalesce_aliases(df, names, blank_aware=True)) == [(1, "b"), (2, None)]
    assert rows(entity.coalesce_aliases(df, names)) == [(1, ""), (2, None)]
    assert rows(entity.first_alias(df, names)) == [("",), (None,)]
    assert rows(entity.best_row(df.withColumn("k", F.lit(1)), ["k"], [F.col("o")]).select("o")) == [(2,)]


def test_text(spark):
    df = spark.createDataFrame([("FENTANYL,\nNULL", " a , b ", None), (None, "", " ")], "CauseA string, CauseB string, CauseC string")
    assert [r[0] for r in df.select(text.cause_text(df)).collect()] == ["FENTANYL A B", ""]
    t = df.select(text.cause_text(df).alias("t"))
    assert rows(t) == rows(t.select(text.clean_model_text(F.col("t"))))  # idempotent
    assert [r[0] for r in df.select(text.row_text(df)).collect()][1] == ""
    with pytest.raises(ValueError):
        text.cause_text(df.select(F.lit(1).alias("x")))
    race = spark.createDataFrame([("Unknown/Other,Black",), ("Caucasian",), ("unknown",), ("Martian",), (None,), ("Pacific\nIslander",)], "r string")
    assert [r[0] for r in race.select(text.race_group(F.col("r"))).collect()] == ["BLACK", "WHITE", None, "martian", None, "PACIFIC ISLANDER"]
    a = spark.createDataFrame([("12  Main St #4B , Ü-town",)], "a string")
    assert a.select(text.clean_address(F.col("a"))).first()[0] == "12 Main St, U-town"


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2/29/2024",), ("05 MAY 2021",), ("seen 2024-01-07 pm",), (None,)], "d string")
    D = datetime.date
    assert [r[0] for r in df.select(dates.parse_mixed_date(F.col("d"))).collect()] == [None, D(2024, 2, 29), D(2021, 5, 5), None, None]
    assert [r[0] for r in df.select(dates.rescue_date(F.col("d"))).collect()][3] == D(2024, 1, 7)
    for y, m, d in ((2024, 1, 1), (2023, 1, 1), (2022, 12, 31), (2021, 1, 3), (2020, 2, 29)):
        x = spark.createDataFrame([(D(y, m, d),)], "d date").select(dates.week_of_year_sunday(F.col("d"))).first()[0]
        assert x == int(D(y, m, d).strftime("%U"))


def test_lexicon_and_corrections(spark):
    lex = lexicon.build_lexicon()
    data = [("ACUTE METH TOXICITY", 0, 0, 0), ("MDMA", 1, 0, 0), ("METHAMPHETAMINE AND MDMA", 1, 0, 0), ("OPIOID OVERDOSE", 0, 0, 0), ("FALL", 0, 0, 1), ("drug use", 0, 0, 0), (None, None, 1, 0), ("special   k and brown sugar", 0, 0, 0)]
    df = spark.createDataFrame(data, "CauseA string, Methamphetamine int, Heroin int, `Any Drugs` int")
    out = classification.apply_corrections(df, lexicon=lex).collect()
    assert [r["Methamphetamine"] for r in out] == [1, 0, 1, 0, 0, 0, 0, 0]
    assert [r["Any Opioids"] for r in out] == [0, 0, 0, 1, 0, 0, 1, 1]
    assert [r["Any Drugs"] for r in out] == [1, 1, 1, 1, 0, 1, 1, 1]
    assert [r["Number_Substances"] for r in out] == [1, 1, 2, 0, 0, 0, 1, 2]
    one = classification.classify(spark, ["ACUTE HEROIN TOXICITY", None]).collect()
    assert [r["Heroin"] for r in one] == [1, 0] and classification.classify(spark, "ETOH").first()["Alcohol"] == 1
    with pytest.raises(TypeError):
        classification.to_frame(spark, 3)


def test_consensus_folds_fragments_and_uses_reliability(spark):
    full = "EFFECTS OF METHAMPHETAMINE AND PHENCYCLIDINE"
    data = [
        ("2024-1", "a", full), ("2024-1", "b", "EFFECTS OF METHAMPHETAMINE AND"), ("2024-1", "c", "OTHER THING"), ("2024-1", "d", "OTHER THING"), ("2024-1", "e", "EFFECTS OF METHAMPHETA\nMINE AND PHENCYCLIDINE"),
        ("2024-2", "a", "X1"), ("2024-2", "c", "Y1"), ("2024-3", "a", "P"), ("2024-3", "b", "P"), ("2024-3", "c", "Q"), ("bad", "a", "Z"), ("2024-4", "a", "DEFERRED")]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(data)], "row_id long, CaseNumber string, source_file string, CauseA string")
    got = {r["CaseNumber"]: r["CauseA"] for r in consensus.collate(df, ["CauseA"])["consensus"].collect()}
    assert got == {"2024-1": full, "2024-2": "X1", "2024-3": "P"}


@pytest.mark.parametrize(
    ("part", "whole", "folded"),
    [
        ("METHAMPHETAMI", "METHAMPHETAMINE", True), ("EFFECTS", "EFFECTS OF X", False), ("EFFECTS OF", "EFFECTS OF X", True), ("FECTS OF X", "EFFECTS OF X", True), ("OF X AND Y", "EFFECTS OF X AND Y", False),
        ("EFFE", "EFFECTS OF X", False), ("EFFECTS, ", "EFFECTS OF X", True), ("EFFECT", "EFFECTS NULL OF X", True), ("THING", "OTHER X", False),
    ])
def test_fragments(spark, part, whole, folded):
    df = spark.createDataFrame([(1, "2024-1", "a", part), (2, "2024-1", "b", whole)], "row_id long, CaseNumber string, source_file string, CauseA string")
    kept = consensus.vote(consensus.ballots(df, ["CauseA"]))["winners"].first()
    assert kept["count"] == (2 if folded else 1)


def test_stability(spark):
    s = "k string, o long, d string, v string"
    old = spark.createDataFrame([("a", 1, "2024-01-01", "12.0"), ("b", 1, "2024-02-01", "x"), ("c", 1, "2024-01-03", "q")], s)
    new = spark.createDataFrame([("a", 1, "2024-01-01", "12"), ("c", 1, "2024-01-03", None), ("d", 1, None, "n")], s)
    month = F.date_format(dates.parse_mixed_date(F.col("d")), "yyyy-MM")
    c = stability.compare(old, new, "k", ["v", "d", "missing"], month)
    assert tuple(c["summary"].first()) == (3, 3, 1, 1, 2, 1, 1) and rows(c["changed"]) == [("c", "v", "q", "")]
    assert rows(stability.compare(old, old, "k", ["v"], month)["changed"]) == []
    files = old.withColumn("f", F.lit(1)).unionByName(new.withColumn("f", F.lit(2)).withColumn("o", F.lit(2).cast("long")))
    r = rows(stability.replay(files, "f", "k", "o", ["v", "d"], month))
    assert r == [(2, 1, 0, 0)]  # d comes, b stays, c keeps its known value, 12.0 equals 12


def test_label_audit(spark):
    lex = lexicon.build_lexicon()
    data = [(1, "patient denies heroin use", 1, 0), (2, "heroin found | denies fentanyl", 1, 1), (3, "HEROIN heroin", 0, 0), (4, "fall", 1, 0), (5, "fall", 0, 0), (6, None, 0, 0)]
    df = spark.createDataFrame(data, "id long, t string, Heroin int, Fentanyl int").withColumns({k: F.lit(0) for k in ("Cocaine", "Alcohol", "Prescription.opioids", "Benzodiazepines", "Others", "Methamphetamine", "Any Opioids", "Any Drugs")})
    m = label_audit.matches(df, "id", "t", lex)
    p = label_audit.term_precision(m)
    assert ("heroin", "Heroin", 2, 2, 4, 0.5) in rows(p)
    assert rows(label_audit.review_candidates(m, p, "id")) == [(3, "Heroin", "heroin", 0.5)]
    assert rows(label_audit.unexplained_labels(df, "id", "t", lex)) == [(4, "Heroin")]
    assert rows(label_audit.negated_rows(df, "id", "t", lex)) == [(1, "Heroin", "heroin"), (2, "Fentanyl", "fentanyl")]
    assert [r["label"] for r in label_audit.duplicate_conflicts(df, "id", "t", ["Heroin", "Fentanyl"]).collect()] == ["Heroin"]
    assert {(r["id"], r["check"]) for r in label_audit.invariants(df, "id", "t").collect()} == {(i, c) for i in (1, 2, 4) for c in ("opioids", "drugs missing")}


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.9), (2, 0, 1, 0.8), (3, 1, 0, 0.8), (4, 0, 0, 0.1), (5, 1, 1, 0.4)], "id long, A int, A_pred int, s double")
    r = metrics.label_metrics(metrics.long_predictions(df, ["A"])).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["f1"]) == (2, 1, 1, 1, 0.666667)
    assert metrics.roc_auc(df, "s", "A").first()["auc"] == round((2 + 1.5 + 1) / 6, 6)
    b = metrics.best_thresholds(df, {"A": "s"}).first()
    assert (b["threshold"], b["f1"]) == (0.11, 0.857143)
    ci = metrics.bootstrap_interval(df, "A", "id", 300).first()
    assert ci["low"] <= ci["mean"] <= ci["high"]
    m = metrics.label_metrics(metrics.long_predictions(df, ["A"]))
    assert metrics.metric_deltas(m, m).first()["f1_delta"] == 0


def test_relations_and_reports(spark):
    left = spark.createDataFrame([(1, "g", 5.0), (2, "g", 0.5), (3, "h", 9.0)], "id long, g string, x double")
    right = spark.createDataFrame([("g", 1.0, "a"), ("g", 4.9, "b"), ("g", 6.0, "c")], "g string, y double, v string")
    assert rows(relations.asof_backward(left, right, ["g"], "x", "y", "v").select("id", "v")) == [(1, "b"), (2, None), (3, None)]
    bands = spark.createDataFrame([("g", 0.0, 1.0), ("g", 5.0, 7.0), ("g", 9.0, 8.0)], "g string, lo double, hi double")
    assert rows(relations.interval_join(left, bands, ["g"], "x", "lo", "hi", 2.0).select("id", "lo")) == [(1, 5.0), (2, 0.0)]
    k = lambda *x: spark.createDataFrame([(v,) for v in x], "k string")
    assert rows(relations.outer_with_sides(k("a", "b", None), k("b", "c", None), "k")) == [("a", "left_only"), ("b", "both"), ("c", "right_only"), (None, "both")]
    assert rows(relations.not_in(k("a", None, "b"), k("b", None), "k")) == [("a",)]
    c = spark.createDataFrame([("m1", "x", 2), ("m2", "y", 1)], "m string, t string, n int")
    assert rows(reports.complete_grid(c, ["m", "t"], "n")) == [("m1", "x", 2), ("m1", "y", 0), ("m2", "x", 0), ("m2", "y", 1)]
    f = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 1, 1)], "a int, b int, c int")
    assert [tuple(r) for r in reports.cooccurrence(f, ["a", "b", "c"], (2,)).collect()] == [("a + b", 2, 2), ("b + c", 2, 2), ("a + c", 2, 1)]
