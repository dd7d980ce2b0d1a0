import json
import zipfile

from pyspark.sql import functions as F

from caseloom.functions import pagefields
from caseloom.operators import models, pages, repair, vectors
from caseloom.sources import geo, ledger, tabular
from caseloom.streaming.arrivals import master_updater, process_arrivals

from .conftest import rows


def test_csv_headers_and_nulls(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("﻿Zip,Zip,text,Text,\"Death\nZip\"\n1,NA,x,\"a\nb\",\n2,3,None,y,5\n".encode())
    df = tabular.read_csv(spark, str(p))
    assert df.columns == ["Zip", "Zip.1", "text", "Text", "Death\nZip"]
    assert [tuple(r) for r in df.collect()] == [("1", None, "x", "a\nb", None), ("2", "3", None, "y", "5")]
    assert tabular.read_csv(spark, str(p), columns=["Zip.1"]).columns == ["Zip.1"]


def _xlsx(path, table):
    cell = lambda c, r, v: f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if v is not None else ""
    body = "".join(f'<row r="{r}">' + "".join(cell(c, r, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(table, 1))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')


def test_xlsx_and_directory(spark, tmp_path):
    _xlsx(tmp_path / "b.xlsx", [["CaseNumber", "Cause A"], ["1", None], ["2", "NULL"]])
    (tmp_path / "a.csv").write_text("CaseNumber,Age\n9,5\n")
    (tmp_path / "bad.xlsx").write_text("no zip")
    df, failed = tabular.read_directory(spark, str(tmp_path / "*.*"))
    assert [f[0].endswith("bad.xlsx") for f in failed] == [True]
    assert rows(df.select("CaseNumber", "Age", "Cause A", "source_file")) == [("1", None, None, "b.xlsx"), ("2", None, None, "b.xlsx"), ("9", "5", None, "a.csv")]
    assert tabular.route(["x/dmec_1.csv", "y.csv"], {"d": "dmec"}) == {"d": ["x/dmec_1.csv"], "other": ["y.csv"]}


def test_geojson(spark, tmp_path):
    p = tmp_path / "a.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"CT20": "7"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}))
    df = geo.read_geojson(spark, str(p), ["CT20"], "CT20")
    assert df.first()["CT20"] == "7" and json.loads(df.first()["geometry"])["type"] == "Polygon"
    geo.write_geojson(df, str(tmp_path / "o.geojson"))
    assert json.loads((tmp_path / "o.geojson").read_text())["features"][0]["properties"]["CT20"] == "7"


def test_ledger_and_sinks(spark, tmp_path):
    led = str(tmp_path / "done")
    ledger.append_ledger(led, ["a.csv", "a.csv"])
    assert ledger.new_files(["x/a.csv", "x/b.csv"], led) == ["x/b.csv"]
    path = str(tmp_path / "t")
    ledger.overwrite(spark.range(3), path)
    ledger.overwrite(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    d = spark.createDataFrame([("2024-03-05",), (None,)], "d string").withColumn("d", F.to_date("d"))
    assert ledger.range_name(d, "d") == "2024-03-2024-03-cases" and ledger.range_name(d.limit(0), "d") == "final"
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "a b.csv").write_text("")
    assert ledger.tidy_names(str(tmp_path / "n")) == [("a b.csv", "a_b.csv")]
    assert ledger.read_thresholds(str(tmp_path / "none"), ["x"]) == {"x": 0.5}


def test_pages(spark):
    w = spark.createDataFrame([(1, 10.0, 0.0, 5.0, "a"), (1, 12.9, 6.0, 9.0, "b"), (1, 13.1, 30.0, 35.0, "c"), (1, 16.2, 0.0, 4.0, "d")], "page int, y double, x0 double, x1 double, word string")
    assert [r["line"] for r in pages.cluster_lines(w).orderBy("y").collect()] == [0, 0, 1, 2]
    assert rows(pages.merge_spans(w, ["page"])) == [(1, 0.0, 5.0), (1, 30.0, 35.0), (1, 6.0, 9.0)]
    assert pages.widest_gap(w, ["page"]).first()["middle"] == 19.5
    lines = spark.createDataFrame([(1, 0, 0, None), (1, 0, 1, "A"), (1, 0, 2, None), (1, 0, 3, "B"), (1, 0, 4, None)], "page int, sub int, line int, case string")
    assert [r["owner"] for r in pages.assign_rows(lines).orderBy("line").collect()] == ["A", "A", "B", "B", "B"]
    r = spark.createDataFrame([("k", 2, "NULL"), ("k", 1, "x"), ("k", 10, None)], "k string, page int, v string")
    assert rows(pages.merge_pages(r, "k", "page", ["v"])) == [("k", "x", "1,2,10")]
    assert pages.page_range("1-3,7") == [1, 2, 3, 7]


def test_page_fields(spark):
    df = spark.createDataFrame([("Male Hispanic/Latino", None, "FOUND AT HOME White,Black", "x Port June 90210")], "g string, r string, t string, c string")
    x = df.select(pagefields.split_gender_race(F.col("g"), F.col("r")).alias("a"), pagefields.peel_trailing_race(F.col("t")).alias("b"), pagefields.earliest_label(F.col("t")).alias("e"), pagefields.split_city_suffix(F.lit("12 MAIN ST PORT JUNE"), ["June", "Port June"]).alias("c")).first()
    assert tuple(x["a"]) == ("Male", "Hispanic/Latino") and tuple(x["b"]) == ("FOUND AT HOME", "White,Black") and x["e"] == "White" and tuple(x["c"]) == ("12 MAIN ST", "PORT JUNE")
    z = pagefields.zip_from_city(spark.createDataFrame([(None, "June, 90210"), ("1", "X")], "z string, c string"), "z", "c")
    assert rows(z) == [("1", "X"), ("90210", "June")]


def test_repair(spark):
    data = [("EFFECTS OF METHAMPHETAMINE",)] * 5 + [("EFFECTS OF METHAM PHETA MINE ,",), (None,), ("",)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(data)], "id long, t string")
    got = [r["t"] for r in repair.repair_columns(df, ["t"]).orderBy("id").collect()]
    assert got == [t for t, in data[:5]] + ["EFFECTS OF METHAMPHETAMINE,", None, ""]
    assert repair.repair_columns(df.limit(0), ["t"]).count() == 0


def test_repair_against_the_whole_vocabulary(spark):
    """The same as with all counts in one dictionary."""
    import random
    import re
    from collections import Counter

    rng = random.Random(4)
    words = [f"{a}{b}ING" for a in ("TOX", "DROWN", "HANG", "FALL", "BURN") for b in ("", "ER", "AL")]
    cut = lambda w: w if rng.random() < 0.7 else f"{w[:3]} {w[3:]}"
    texts = [" ".join(cut(rng.choice(words)) for _ in range(rng.randrange(1, 7))) + rng.choice(["", ",", " ,"]) for _ in range(200)]
    counts = Counter(c for t in texts for w in t.split() if (c := re.sub("[^A-Z0-9]", "", w.upper())))
    want = [repair.repair_text(t, counts, {"TOXERING"}) if len(t.split()) > 1 else t for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    assert [r["t"] for r in repair.repair_columns(df, ["t"], ["TOXERING"]).orderBy("id").collect()] == want


def test_vectors_and_models(spark, tmp_path):
    (tmp_path / "g.txt").write_text("a 1 2\nb 3 4\n")
    t = vectors.read_glove(spark, str(tmp_path / "g.txt"))
    d = spark.createDataFrame([(1, ["a", "a", "b", "z"]), (2, ["z"])], "id long, w array<string>")
    got = {r["id"]: list(r["vector"]) for r in vectors.looked_up_sum(d, "id", "w", t, 2).collect()}
    assert got == {1: [5.0, 8.0], 2: [0.0, 0.0]}
    df = spark.createDataFrame([(i, "fentanyl found" if i % 2 else "heart failure", i % 2) for i in range(60)], "id long, t string, y int")
    train, test = models.split_by_hash(df, "id")
    feats, ms = models.train_labels(train, "t", ["y"])
    assert models.predict_labels(test, feats, ms).filter("y <> y_pred").count() == 0


def test_arrivals_once_and_recomputed(spark, tmp_path):
    src, seen = tmp_path / "in", []
    build = lambda b: b.groupBy("k").agg(F.max("v").alias("v"))
    handle = master_updater(str(tmp_path / "bronze"), str(tmp_path / "master"), build, lambda old, new, n: seen.append((old.count(), new.count())))
    for i, data in enumerate(([("a", 1)], [("a", 2), ("b", 1)])):
        spark.createDataFrame(data, "k string, v int").coalesce(1).write.parquet(str(src / f"f{i}"))
        process_arrivals(spark, str(src / "*"), "k string, v int", str(tmp_path / "ckpt"), handle)
        process_arrivals(spark, str(src / "*"), "k string, v int", str(tmp_path / "ckpt"), handle)
    assert seen == [(1, 2)] and rows(spark.read.parquet(str(tmp_path / "master" / "version=1"))) == [("a", 2), ("b", 1)]
