"""Extra columns with the names that operators use or report must neither crash nor change results."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseloom.operators import consensus, drift, entity, nearby, snapshots, timestamps

from .conftest import rows

EXTRA = ["value", "field", "count", "kind", "n", "ord", "sum", "change", "record_", "day", "time_zone", "date_order", "trust", "winner", "shape", "area_id", "metres"]


def wide(df):
    return df.withColumns({c: F.lit("extra") for c in EXTRA if c not in df.columns})


@pytest.fixture
def snaps(spark):
    d = date(2026, 1, 1)
    return spark.createDataFrame([(1, d, 1, "A", "1"), (1, d, 2, None, None), (2, d, 1, "A", "2"), (2, d, 2, "B", None)], "snapshot_no int, snapshot_date date, row_no long, CaseNumber string, Age string")


def test_snapshots(snaps):
    run = lambda df: rows(snapshots.snapshot_changes(df, "CaseNumber", ["Age"]))
    assert run(wide(snaps)) == run(snaps) == [(2, "A", "changed", "Age"), (2, "B", "added", "")]


def test_timestamps(spark):
    src = spark.createDataFrame([("a", "America/Phoenix", "mdy", "x")], "source_file string, time_zone string, date_order string, value string")
    df = spark.createDataFrame([(1, "a", datetime(2024, 1, 1), "1/2/2023", "10:00", None), (2, None, None, "1/2/23", None, "1/2/80"), (3, "a", None, None, "10:00", "")], "row_id long, source_file string, received_at timestamp, DeathDate string, DeathTime string, DateofBirth string")
    cols = ["row_id", "moment_utc", "moment_status", "birth_day"]
    assert rows(timestamps.normalise_timestamps(wide(df), src).select(*cols)) == rows(timestamps.normalise_timestamps(df, src).select(*cols))


def test_drift(spark):
    df = spark.createDataFrame([("f", 1, 1, '{"a": 1}'), ("f", 2, 1, '{"a": 1, "kind": null, "n": {"n": []}}'), (None, None, None, None)], "feed string, file_no int, row_no int, record string")
    assert rows(drift.schema_changes(wide(df))) == rows(drift.schema_changes(df)) == [("f", 2, "added", "", "kind"), ("f", 2, "added", "", "n")]


def test_nearby(spark):
    areas = spark.createDataFrame([("s", "1", '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}')], "area_id string, CT20 string, geometry string")
    df = spark.createDataFrame([(1, "A", 0.5, 0.5), (1, "B", 0.5, 0.5), (None, "C", 0.5, 0.5), (1, "D", None, None)], "snapshot_no int, CaseNumber string, lon double, lat double")
    run = lambda d: rows(nearby.near_keys_in_regions(d, areas, "CaseNumber", "snapshot_no"))
    assert run(wide(df)) == run(df) == [("A", "B", "1")]


def test_records(spark):
    df = spark.createDataFrame([(1, "2024-1", "a", "x"), (2, "2024-1", "b", None), (3, None, None, None)], "row_id long, CaseNumber string, source_file string, CauseA string")
    assert rows(consensus.collate(wide(df), ["CauseA"])["consensus"]) == rows(consensus.collate(df, ["CauseA"])["consensus"]) == [("2024-1", "x")]
    assert rows(entity.merge_records(wide(df), ["CaseNumber"], "row_id").select("CaseNumber", "CauseA")) == [("2024-1", "x"), (None, None)]
