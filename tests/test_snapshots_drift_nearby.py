import json
import math
import random
from datetime import date

from caseloom.operators import drift, nearby, snapshots

from .conftest import rows


def test_snapshot_changes(spark):
    d = date(2026, 1, 1)
    data = [
        (1, d, 1, "A ", "2024-01-05", "5", 1, "x"), (1, d, 2, "A", "2024-01-06", "5.0", 0, "x"), (1, d, 3, "B", "1/2/2024", None, 1, "x"), (1, d, 4, None, "z", "z", 1, "x"),
        (2, d, 1, "A", "06 JAN 2024", " 5", 1, "y"), (2, d, 2, "C", None, None, None, "x"), (3, d, 1, "A", "6-Jan-2024", "NULL", None, "y"), (3, d, 2, "C", "", "n/a", None, "x")]
    df = spark.createDataFrame(data, "snapshot_no int, snapshot_date date, row_no long, CaseNumber string, DeathDate string, Age string, `Any Drugs` int, snapshot string")
    got = rows(snapshots.snapshot_changes(df, "CaseNumber", ["DeathDate", "Age", "Any Drugs"], dates=("DeathDate",)))
    assert got == [(2, "A", "changed", "Any Drugs"), (2, "B", "removed", ""), (2, "C", "added", ""), (3, "A", "changed", "Age"), (3, "A", "changed", "Any Drugs")]
    for n in (0, 1):
        assert snapshots.snapshot_changes(df.filter(f"snapshot_no <= {n}"), "CaseNumber", ["Age"]).count() == 0


def _raw(files):
    out = []
    for no, recs in files.items():
        out += [("f", no, i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(recs)]
    return out


def test_schema_changes(spark):
    files = {
        1: [{"CaseNumber": "2020-00001", "Mode.1": "A", "Fentanyl": 1, "x1": "a b"}, '{"broken": ', None, "[1]"],
        3: [{"CASENUMBER": {"year": 2020, "serial": 1}, "Manner": "A", "Fentanyl": None, "Strange": "c d"}],
        4: [{"CASENUMBER": {"year": 2020, "serial": 1}, "Manner": "A", "Fentanyl": 1.0, "Strange": "c d", "Sex": "F"}],
        5: [{"CASENUMBER": {"year": 2020, "serial": 1}, "Fentanyl": True, "Strange": "c d", "Sex": "F", "DeathZip": "9"}]}
    df = spark.createDataFrame(_raw(files), "feed string, file_no int, row_no int, record string")
    got = rows(drift.schema_changes(df))
    assert got == sorted([
        ("f", 3, "renamed", "CaseNumber", "CASENUMBER"), ("f", 3, "retyped", "CaseNumber", "CASENUMBER"), ("f", 3, "renamed", "Mode.1", "Manner"), ("f", 3, "renamed", "x1", "Strange"),
        ("f", 4, "added", "", "Sex"), ("f", 5, "removed", "Manner", ""), ("f", 5, "added", "", "DeathZip"), ("f", 5, "retyped", "Fentanyl", "Fentanyl")], key=lambda t: tuple((False, str(x)) for x in t))
    table = drift.consistent_rows(df, ["feed", "file_no", "row_no"])
    assert table.count() == df.count()
    assert {r["CaseNumber"] for r in table.collect()} == {"2020-00001", None}
    spans = {(r["field"], r["kind"]): (r["first_file"], r["last_file"]) for r in drift.lifespans(drift.field_catalogue(df)).collect()}
    assert spans[("CASENUMBER", "object")] == (3, 5) and spans[("Fentanyl", "null")] == (3, 3)
    assert drift.schema_changes(df.limit(0)).count() == 0


def test_unknown_names_are_matched_by_content(spark):
    """Names that no alias covers: two text fields renamed in one file, one of them retyped to an array, and an unrelated one added."""
    rng = random.Random(2)
    fall, drug = ["fell", "from", "the", "ladder", "stairs"], ["took", "pills", "and", "spirits"]
    say = lambda ws: " ".join(rng.choice(ws) for _ in range(4)) + " " * 60 + rng.choice(ws)  # noqa: E731 - differs only far behind the start
    files = {
        1: [{"alpha": say(fall), "beta": say(drug), "code": f"{rng.randrange(1000)}-{rng.randrange(10)}"} for _ in range(40)],
        2: [{"gamma": say(drug), "delta": [say(fall)], "count": rng.randrange(9), "ref": f"{rng.randrange(1000)}-{rng.randrange(10)}"} for _ in range(40)],
    }
    df = spark.createDataFrame(_raw(files), "feed string, file_no int, row_no int, record string")
    assert rows(drift.schema_changes(df)) == [
        ("f", 2, "added", "", "count"), ("f", 2, "renamed", "alpha", "delta"), ("f", 2, "renamed", "beta", "gamma"), ("f", 2, "renamed", "code", "ref"), ("f", 2, "retyped", "alpha", "delta")]


def test_consistent_rows_keep_everything(spark):
    recs = [
        {"Case Number": "2020-7", "CaseNumber": "2021-8", "Zip": 3919, "Age": "44 years", "DeathDate": "1/2/2020", "new field": "x", "n": {"a": 1, "b": [2]}},
        {"DeathDate": "someday", "fentanyl_flag": True, "SourcePages": [1, 2], "CaseNum": {"year": 2020, "serial": 9}}, '{"a": 1, "a": 2, "zip": "90001"}', "{", None, "[1]", "{}"]
    df = spark.createDataFrame(_raw({1: recs}), "feed string, file_no int, row_no int, record string")
    got = {r["row_no"]: r.asDict() for r in drift.consistent_rows(df, ["row_no"]).collect()}
    assert len(got) == len(recs)
    one = got[0]
    assert (one["CaseNumber"], one["DeathZip"], one["Age"], str(one["DeathDate"])) == ("2021-00008", "03919", 44.0, "2020-01-02")
    assert one["_other"] == {"new field": "x", "n": "1-[2]"} and one["_unread"] == {}
    two = got[1]
    assert (two["CaseNumber"], two["Fentanyl"], two["SourcePages"], two["DeathDate"]) == ("2020-00009", 1, "1; 2", None) and two["_unread"] == {"DeathDate": "someday"}
    assert got[2]["DeathZip"] == "90001" and set(got[2]["_other"]) == {"a"}
    assert all(got[i]["CaseNumber"] is None and got[i]["_other"] == {} for i in (3, 4, 5, 6))


SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]],[[0.4,0.4],[0.6,0.4],[0.6,0.6],[0.4,0.6],[0.4,0.4]]]}'
TWO = '{"type":"MultiPolygon","coordinates":[[[[2,0],[3,0],[3,1],[2,1],[2,0]]],[[[0.9,0.9],[1.5,0.9],[1.5,1.5],[0.9,1.5],[0.9,0.9]]]]}'


def test_regions_of_points(spark):
    areas = spark.createDataFrame([("s", SQUARE), ("t", TWO), ("n", None), ("b", "{")], "area_id string, geometry string")
    pts = [(0.2, 0.2), (0.5, 0.5), (0.95, 0.95), (2.5, 0.5), (1.2, 1.2), (0.0, 0.5), (1.0, 1.0), (5.0, 5.0), (None, 1.0), (float("nan"), 0.5), (200.0, 0.5), (0.2, 0.2)]
    p = spark.createDataFrame(pts, "lon double, lat double")
    got = rows(nearby.regions_of_points(p, areas))
    assert got == [(0.0, 0.5, "s", True), (0.2, 0.2, "s", False), (0.95, 0.95, "s", False), (0.95, 0.95, "t", False), (1.0, 1.0, "s", True), (1.0, 1.0, "t", False), (1.2, 1.2, "t", False), (2.5, 0.5, "t", False)]
    assert nearby.regions_of_points(p.limit(0), areas).count() == 0


def _haversine(a, b):
    p1, p2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * nearby.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


def test_near_points_against_brute_force(spark):
    rng = random.Random(1)
    pts = [(round(c[0] + rng.uniform(-6e-4, 6e-4), 6), round(c[1] + rng.uniform(-3e-4, 3e-4), 6)) for c in ((-118.2, 34.0), (179.9998, 10.0), (0.0, 80.0)) for _ in range(60)]
    pts += [(-179.9999, 10.0), (179.9999, 10.0), (-179.9999, 10.0)]
    pts = [(x if x <= 180 else x - 360, y) for x, y in pts]
    got = {(r["lon_a"], r["lat_a"], r["lon_b"], r["lat_b"]) for r in nearby.near_points(spark.createDataFrame(pts, "lon double, lat double"), 25.0).collect()}
    uniq = sorted(set(pts), key=lambda p: (p[1], p[0]))
    want = {(*a, *b) for i, a in enumerate(uniq) for b in uniq[i:] if _haversine(a, b) <= 25}
    assert got == want


def test_near_keys(spark):
    areas = spark.createDataFrame([("s", "1", SQUARE), ("c", None, SQUARE)], "area_id string, CT20 string, geometry string")
    data = [(1, "B ", 0.2, 0.2), (1, "A", 0.2, 0.2001), (2, "C", 0.2, 0.2), (1, "D", 0.2, 0.2), (1, None, 0.2, 0.2), (1, "E", 0.2, 0.3), (1, "F", 0.5, 0.5), (1, "G", 0.5, 0.5)]
    got = rows(nearby.near_keys_in_regions(spark.createDataFrame(data, "snapshot_no int, CaseNumber string, lon double, lat double"), areas, "CaseNumber", "snapshot_no"))
    assert got == [("A", "B", "1"), ("A", "D", "1"), ("B", "D", "1")]
