"""Nulls, ties, repeated rows, clashing columns and empty tables for the page, report and nearby operators."""

from caseloom.operators import label_audit, metrics, nearby, pages, reports

from .conftest import rows


def test_case_rows(spark):
    w = "page int, y double, x0 double, x1 double, word string"
    head = [(1, 0.0, x, x + 1, t) for x, t in ((0.0, "CaseNum"), (50.0, "Mode"))]
    body = [(1, 10.0, 0.0, 1.0, "2024-00001"), (1, 10.0, 50.0, 51.0, "ACCI"), (1, 20.0, 50.0, 51.0, "HOMI"), (1, 30.0, 0.0, 1.0, "2024-00002"), (1, 30.0, 60.0, 61.0, "B"), (1, 30.0, 52.0, 53.0, "A"), (1, 40.0, 50.0, 51.0, "REST")]
    df = spark.createDataFrame([*head, *body, (2, 5.0, 0.0, 1.0, "nothing"), (3, 1.0, 0.0, 1.0, "2024-00003")], w)
    got = rows(pages.case_rows(df, [40.0], ["case_num", "mode"], "CaseNum").select("page", "case_num", "mode"))
    assert got == [(1, "2024-00001", "ACCI"), (1, "2024-00002", "HOMI A B REST"), (3, "2024-00003", None)]
    assert pages.case_rows(df.limit(0), [40.0], ["case_num", "mode"], "CaseNum").count() == 0


def test_reports(spark):
    a = spark.createDataFrame([(1, "k", "x"), (2, "k", "y"), (3, None, "z")], "o long, k string, v string")
    assert rows(reports.union_first_wins([a.limit(0), a], ["k"], "o")) == [(1, "k", "x"), (3, None, "z")]
    assert reports.ensure_columns(a, {"v": "no", "w": "yes"}).columns == ["o", "k", "v", "w"]
    s = reports.small_cell_shares(spark.createDataFrame([("2020", "a")] * 5 + [("2020", "b"), ("2021", None)], "y string, z string"), "y", "z")
    assert rows(s) == [("2020", 2, 6, 1, 0.5, 0.166667), ("All", 2, 6, 1, 0.5, 0.166667)]
    assert rows(reports.column_totals(spark.createDataFrame([(1, None)], "a int, b int"), spark.createDataFrame([(1, 1)], "a int, b int"), ["a", "b"])) == [("a", 1, 1, 0), ("b", 0, 1, 1)]


def test_label_audit(spark):
    df = spark.createDataFrame([(1, "fall", 1), (2, "fall", None), (3, "x", 1), (4, "x", 1), (5, None, 1), (6, " ", 0)], "id long, t string, A int")
    assert rows(label_audit.duplicate_groups(df, "id", "t", "A")) == [(1, "fall", 2, "1,2", "1,0")]
    after = df.fillna({"A": 1})
    assert rows(label_audit.change_log(df, after, "id", ["A"])) == [(2, "A", 0, 1)]
    assert label_audit.duplicate_groups(df.limit(0), "id", "t", "A").count() == 0


def test_ranks_over_ranges(spark):
    import random

    rng = random.Random(1)
    data = [(rng.random() if rng.random() < 0.7 else 0.5, rng.randrange(2)) for _ in range(400)]
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "s double, y int")
    assert abs(metrics.roc_auc(df, "s", "y").first()["auc"] - want) < 1e-6
    assert metrics.roc_auc(df.filter("y = 1"), "s", "y").first()["auc"] is None


def test_near_coordinates_count_keys(spark):
    square = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}'
    areas = spark.createDataFrame([("s", "1", square), ("c", None, square)], "area_id string, CT20 string, geometry string")
    data = [("A", 0.2, 0.2), ("A", 0.2, 0.2), (" B", 0.2, 0.2), ("C", 0.2, 0.2001), (None, 0.2, 0.2), ("D", 0.2, 0.5), ("E", None, 0.1)]
    df = spark.createDataFrame(data, "CaseNumber string, lon double, lat double")
    assert rows(nearby.near_coordinates(df, areas, "CaseNumber")) == [(0.2, 0.2, 0.2, 0.2, "1", 2, 2), (0.2, 0.2, 0.2, 0.2001, "1", 2, 1)]
    assert nearby.near_coordinates(df.limit(0), areas, "CaseNumber").count() == 0
