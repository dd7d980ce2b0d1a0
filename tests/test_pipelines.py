from pyspark.sql import functions as F

from caseloom.functions.lexicon import build_lexicon
from caseloom.operators import classification, reports
from caseloom.plans import pipelines

from .conftest import rows

SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}'


def _records(spark):
    data = [
        (1, "2024-1", "1/5/2024", "FENTANYL TOXICITY", "1 MAIN ST", "X", "White", "M", "44 years"), (2, "2024-1", None, "FALL", None, None, None, None, None),
        (3, "2024-2", "2024-01-02", "HEART DISEASE", "2 MAIN ST", "X", "Black", "F", "50"), (4, "2024-3", None, "OPIATE OVERDOSE", "9 MAIN ST", "X", "Unknown", "X", None)]
    return spark.createDataFrame(data, "_ord long, CaseNum string, `Date of Death` string, `Cause A` string, DeathAddr string, DeathCity string, Races string, Sex string, Age string").withColumns({"EventAddress": F.lit(None).cast("string")})


def test_surveillance(spark):
    cache = spark.createDataFrame([("1 MAIN ST, X", 0.5, 0.5, 1), ("1 MAIN ST, X", 9.0, 9.0, 2)], "address string, lon double, lat double, ord long")
    regions = spark.createDataFrame([("a", "77", "90001", SQUARE)], "area_id string, CT20 string, ZIPCODE string, geometry string")
    history = spark.createDataFrame([(1, "2024-3", "33")], "_ord long, CaseNumber string, Age string")
    out = pipelines.surveillance(_records(spark), cache, history, regions)
    got = {r["CaseNumber"]: r for r in out.collect()}
    assert set(got) == {"2024-1", "2024-3"}
    assert got["2024-1"]["CT20"] == "77" and got["2024-1"]["Race"] == "WHITE" and got["2024-1"]["Gender"] == "MALE" and got["2024-1"]["Age"] == 44.0
    assert got["2024-3"]["Age"] == 33.0 and got["2024-3"]["CT20"] is None and got["2024-3"]["Race"] is None
    assert pipelines.surveillance(_records(spark).limit(0)).count() == 0


def test_all_records_labels_before_merging(spark):
    got = {r["CaseNumber"]: (r["Fentanyl"], r["Any Drugs"]) for r in pipelines.all_records(_records(spark)).collect()}
    assert got == {"2024-1": (1, 1), "2024-2": (0, 0), "2024-3": (0, 1)}


def test_combine_and_deidentify(spark):
    a = spark.createDataFrame([(1, "k", "x"), (2, "k", None)], "_ord long, CaseNum string, v string")
    b = spark.createDataFrame([(1, "q", 3), (2, "q", 3)], "_ord long, other string, n int")
    assert rows(pipelines.combine_classes({"a": a, "b": b}, {"a": "CaseNum"})) == [("k", "x", None, None), (None, None, "q", 3), (None, None, "q", 3)]
    tied = [(1, "k", "1/2/2020", 0, "a"), (2, "k", "2020-03-01", 1, "b"), (3, "k", "2020-02-01", 1, "c"), (4, "k", "2020-03-01", 1, "d"), (5, "m", None, 1, "e"), (6, "m", "2021-01-01", None, "f")]
    c = spark.createDataFrame(tied, "_ord long, k string, DeathDate string, `Any Drugs` int, v string")
    assert rows(pipelines.combine_classes({"c": c}, {"c": "k"})) == [("k", "2020-03-01", 1, "b"), ("m", "2021-01-01", 1, "e")]
    d = spark.createDataFrame([("2024-03-05", "44", "90001", "m", "Black", "1/1/1980"), ("2024-03-05", "44", None, "m", "Black", "x")], "DeathDate string, Age string, ZIPCODE string, Gender string, Race string, DateofBirth string")
    r = pipelines.deidentify(d).collect()
    assert len(r) == 1 and (r[0]["MonthYear"], r[0]["Age_Bin"], r[0]["YearWeek"], r[0]["Gender"]) == ("2024-03", "40-49", "2024-09", "MALE") and "DateofBirth" not in r[0].asDict()


def test_evidence_and_counts(spark):
    df = spark.createDataFrame([("METH AND ETOH", "etoh")], "CauseA string, CauseOther string")
    lex = {k: v for k, v in build_lexicon().items() if k in ("Methamphetamine", "Alcohol")}
    assert df.select(classification.evidence(df, lex)).first()[0] == "Methamphetamine=[CauseA:'METH'] | Alcohol=[CauseA:'ETOH'; CauseOther:'etoh']"
    f = spark.createDataFrame([(1, 0), (0, 1), (None, 1)], "A int, A_pred int")
    assert rows(reports.false_counts(f, ["A"])) == [("A", 2, 1), ("Total", 2, 1)]
    assert [r[0] for r in f.select(reports.any_of(["A", "A_pred"])).collect()] == [1, 1, 1]


def test_evidence_comes_from_every_text_field(spark, tmp_path):
    from caseloom.plans import reference

    fields = reference.TEXT_FIELDS
    data = [(i, *["FENTANYL" if i == j else None for j in range(len(fields))]) for i in range(len(fields))]
    spark.createDataFrame(data, "row_id long, " + ", ".join(f"{f} string" for f in fields)).write.parquet(f"{tmp_path}/consensus.parquet")
    got = {(r["row_id"], r["field"], r["match"]) for r in reference.QUERIES["matched_terms"](spark, str(tmp_path)).filter("label = 'Fentanyl'").collect()}
    flagged = {r["row_id"] for r in reference.QUERIES["lexicon_flags"](spark, str(tmp_path)).filter("fentanyl = 1").collect()}
    assert got == {(i, f, "FENTANYL") for i, f in enumerate(fields)} and flagged == set(range(len(fields)))


def test_merges_rank_and_fill_whole_rows(spark, tmp_path):
    from caseloom.plans import reference

    data = [(1, "a", "k", "X", "1 MAIN ST", "JO", "DOE"), (2, "a", "k", "Y", None, None, None), (3, "me_master.csv", "k", None, None, "AL", None)]
    df = spark.createDataFrame(data, "row_id long, source_file string, CaseNumber string, CauseA string, DeathAddress string, FirstName string, LastName string")
    df.withColumn("received_at", F.lit(None).cast("timestamp")).write.parquet(f"{tmp_path}/consensus.parquet")
    for name in ("entity_merge_last", "entity_merge_first"):
        r = reference.QUERIES[name](spark, str(tmp_path)).first()
        assert (r["CauseA"], r["DeathAddress"], r["FirstName"], r["LastName"]) == ("X", "1 MAIN ST", "JO", "DOE")
    r = reference.QUERIES["backfill_history"](spark, str(tmp_path)).first()
    assert (r["row_id"], r["CauseA"], r["DeathAddress"], r["FirstName"], r["LastName"]) == (3, "X", "1 MAIN ST", "AL", "DOE")
