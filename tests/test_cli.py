"""The command line over small files."""

import json

from pyspark.sql import functions as F

from caseloom import cli
from caseloom.operators import models
from caseloom.sources import tabular

from .conftest import rows

HEAD = "CaseNum,Date of Death,Cause A,DeathAddress,DeathCity,EventAddress,Race,Gender,Age\n"


def _run(spark, *argv):
    cli.main([str(a) for a in argv])


def test_surveillance_reads_new_files_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "2024-1,1/5/2024,FENTANYL TOXICITY,1 MAIN ST,X,,White,M,44 years\n2024-2,2024-01-02,FALL,2 MAIN ST,X,,Black,F,50\n")
    (tmp_path / "c.cache").write_text("address,lon,lat\n\"1 MAIN ST, X\",0.5,0.5\n")
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"CT20": "7", "ZIPCODE": "90001"}, "geometry": square}]}))
    args = ["surveillance", tmp_path / "*.csv", "-o", tmp_path / "out", "--cache", tmp_path / "c.cache", "--polygons", tmp_path / "p.geojson", "--ledger", tmp_path / "done", "--log", tmp_path / "log" / "l.txt"]
    _run(spark, *args)
    got = spark.read.csv(str(tmp_path / "out"), header=True).select("CaseNumber", "CT20", "Fentanyl").collect()
    assert [tuple(r) for r in got] == [("2024-1", "7", "1")]
    assert (tmp_path / "done").read_text() == "a.csv\n" and (tmp_path / "log" / "l.txt").read_text() == "a.csv - 1 new entries in final csv file, 2024/01 - 2024/01\n"
    (tmp_path / "b.csv").write_text(HEAD + "2024-3,1/6/2024,HEROIN,1 MAIN ST,X,,White,M,4\n")
    _run(spark, *args)
    assert [r["CaseNumber"] for r in spark.read.csv(str(tmp_path / "out"), header=True).collect()] == ["2024-3"]
    _run(spark, "all-records", tmp_path / "*.csv", "-o", tmp_path / "all")
    assert spark.read.csv(str(tmp_path / "all"), header=True).count() == 3


def test_join_geocode_evaluate_replay(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "dmec_1.csv").write_text("k,v,DeathDate\na,1,2024-01-01\na,,2024-01-02\n")
    (tmp_path / "in" / "ucla_1.csv").write_text("k,w\nb,2\nb,2\n")
    _run(spark, "join", tmp_path / "in", "-o", tmp_path / "j", "--class", "d=dmec", "--class", "u=ucla", "--key", "d=k")
    assert spark.read.csv(str(tmp_path / "j"), header=True).count() == 3
    (tmp_path / "r.csv").write_text("id,DeathAddress,EventAddress\n1,9 A ST,8 B ST\n2,9 A ST,\n3,,\n")
    (tmp_path / "c.csv").write_text("address,lon,lat\n9 A ST,1.5,2.5\n")
    _run(spark, "geocode-cached", "--input", tmp_path / "r.csv", "--cache", tmp_path / "c.csv", "--output", tmp_path / "g")
    assert rows(spark.read.csv(str(tmp_path / "g"), header=True).select("id", "lon", "used_death_address")) == [("1", "1.5", "true"), ("2", "1.5", "false"), ("3", None, "false")]
    (tmp_path / "e.csv").write_text("text,Fentanyl,Fentanyl_pred\nfentanyl,1,0\nfall,0,0\n")
    _run(spark, "evaluate", "--input", tmp_path / "e.csv", "--outdir", tmp_path / "ev")
    r = spark.read.csv(str(tmp_path / "ev" / "evaluation_labels"), header=True).first()
    assert (r["recall_before"], r["recall_after"]) == ("0.0", "1.0")
    (tmp_path / "v").mkdir()
    for i, body in enumerate(("2024-1,x\n", "2024-1,x\n2024-2,y\n", "2024-2,z\n")):
        (tmp_path / "v" / f"{i}.csv").write_text("CaseNumber,Mode,DeathDate\n" + body.replace("\n", ",2024-01-01\n"))
    _run(spark, "replay", tmp_path / "v" / "*.csv", "-o", tmp_path / "rp")
    assert rows(spark.read.csv(str(tmp_path / "rp"), header=True)) == [("1.csv", "1", "0", "0"), ("2.csv", "0", "0", "1")]


def test_inferred_types_and_split_files(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,c,d,e\n1,1.5,true,007,NULL\n-2,2,FALSE,8,\n,,,9,NULL\n")
    df = tabular.read_csv(spark, str(p), multi_line=False, infer=True)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "string"} and df.count() == 3


def test_stored_models_score_alike(spark, tmp_path):
    df = spark.createDataFrame([(i, "fentanyl found" if i % 2 else "heart failure", i % 2) for i in range(40)], "id long, text string, Fentanyl int")
    feats, ms = models.train_labels(df, "text", ["Fentanyl"])
    models.save_models(str(tmp_path / "m"), feats, ms)
    scored = models.stored_scorer(str(tmp_path / "m"))(df.drop("Fentanyl").unionByName(spark.createDataFrame([(99, None)], "id long, text string")))
    assert scored.filter("text is null").count() == 1 and scored.join(df.select("id", F.col("Fentanyl").alias("y")), "id").filter("Fentanyl <> y").count() == 0
