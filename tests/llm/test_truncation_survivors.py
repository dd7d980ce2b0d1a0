from datetime import datetime

from caseloom.llm.survivors import surviving_values, winners
from caseloom.llm.truncation import truncated_values, truncation_by_source

from ..conftest import rows


def _table(spark):
    full = ["COMPLICATIONS OF FENTANYL USE", "COMPLICATIONS OF HEROIN USE", "METH TOX", "ACUTE FENTANYL AND HEROIN TOXICITY", "EFFECTS OF FENTANYL AND HEROIN", "ASCVD"]
    data = [(f"s{i % 4}", t) for t in full for i in range(40)]
    cut = ["COMPLICATIONS OF FENTANYL", "COMPLICATIONS OF HER", "ACUTE FENTANYL AND HEROIN", "METH T", "ASCV…", "EFFECTS OF FENTANYL AND", "MULTIPLE (FENTANYL"]
    fine = ["MET\nH TOX", "ASCVD", None, "", "NULL", "OD"]
    data += [("s0", t) for t in cut + fine]
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(data)], "row_id long, source_file string, CauseA string"), len(full) * 40, len(cut)


def test_truncated_values(spark):
    df, n, k = _table(spark)
    found = truncated_values(df, ["CauseA"])
    assert sorted(r["row_id"] for r in found.collect()) == list(range(n, n + k))
    share = {r["source_file"]: (r["n_values"], r["n_cut"]) for r in truncation_by_source(df, found, ["CauseA"]).collect()}
    assert share["s0"] == (60 + k + 3, k) and share["s1"] == (60, 0)
    assert truncated_values(df.limit(0), ["CauseA"]).count() == 0


def test_one_source_cannot_hide_its_own_cuts(spark):
    data = [(f"s{i % 5}", "COMPLICATIONS OF FENTANYL USE") for i in range(100)] + [("big", "COMPLICATIONS OF FENTANYL")] * 100
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(data)], "row_id long, source_file string, CauseA string")
    assert truncated_values(df, ["CauseA"]).count() == 100


def test_survivors(spark):
    t = lambda d: datetime(2024, 1, d)
    data = [
        (1, "low", t(9), "2020-1", "X"), (2, "top", t(1), "2020-00001", None), (3, "mid", t(2), "Case# 2020-00001", "Y"), (4, "mid", t(3), "2020-00001 ", "Z"), (5, "mid", t(3), "2020-00001", "W"),
        (6, "new", t(8), "2020-00001", "V"), (7, "low", t(1), "2020-00002", "A"), (8, "low", t(1), None, "B"), (9, "mid", t(1), "2020-00003", "NULL"), (10, "mid", t(1), "2020-00003", "")]
    df = spark.createDataFrame(data, "row_id long, source_file string, received_at timestamp, CaseNumber string, v string")
    src = spark.createDataFrame([("top", 1), ("mid", 2), ("low", 3)], "source_file string, trust int")
    got = rows(winners(surviving_values(df, src, ["v"]), ["v"]))
    assert got == [("2020-00001", "v", 4)]
    bad = spark.createDataFrame([(4, "v"), (5, "v"), (3, "other")], "row_id long, field string")
    assert rows(winners(surviving_values(df, src, ["v"], bad), ["v"])) == [("2020-00001", "v", 3)]
    assert surviving_values(df.limit(0), src, ["v"]).count() == 0


def test_records_judge_every_field_that_can_be_cut(spark, tmp_path):
    from caseloom.llm.queries import p7_records

    fields = ["CauseA", "CauseOther", "DeathAddress", "DeathCity", "DeathZip", "Mode", "Race", "Gender", "FirstName", "LastName"]
    full = {"CauseA": "ASCVD", "CauseOther": "HTN, DM", "Race": "WHITE"}
    short = {"CauseA": "ASCV...", "CauseOther": "HTN,", "Race": "WHIT..."}
    data = [(i, s, datetime(2024, 1, 1), "2020-00001", *[v.get(f) for f in fields]) for i, (s, v) in enumerate([("top", short), ("low", full)])]
    spark.createDataFrame(data, "row_id long, source_file string, received_at timestamp, CaseNumber string, " + ", ".join(f"{f} string" for f in fields)).write.parquet(f"{tmp_path}/consensus.parquet")
    spark.createDataFrame([("top", 1), ("low", 2)], "source_file string, trust int").write.parquet(f"{tmp_path}/source_files.parquet")
    r = p7_records(spark, str(tmp_path)).first()
    assert {f: r[f] for f in full} == full
