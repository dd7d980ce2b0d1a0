from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseloom.functions.timeparse import date_readings, time_reading
from caseloom.functions.values import case_key, comparable, is_missing
from caseloom.operators.timestamps import choose_readings, disagreements, normalise_timestamps

from .conftest import rows

DAY0 = date(1970, 1, 1)


@pytest.mark.parametrize("text,order,days", [
    ("2023-01-29", "mdy", [date(2023, 1, 29)]), ("29 JAN 2023", "mdy", [date(2023, 1, 29)]), ("5-May-2020", "mdy", [date(2020, 5, 5)]),
    ("January 9, 1975", "mdy", [date(1975, 1, 9)]), ("8/1/75", "mdy", [date(1975, 8, 1)]), ("8/1/75", "dmy", [date(1975, 1, 8)]), ("31.12.2023", "mdy", [date(2023, 12, 31)]),
    ("20190101", "mdy", [date(2019, 1, 1)]), ("43466", "mdy", [date(2019, 1, 1)]), ("43466.5", "mdy", [date(2019, 1, 1)]), ("1546721682708", "mdy", [date(2019, 1, 5)]),
    ("3/4/2021", None, [date(2021, 3, 4), date(2021, 4, 3)]), ("4/4/2021", None, [date(2021, 4, 4)]), ("2023-02-30", "mdy", []), ("13/13/2020", "mdy", []), ("UNKNOWN", "mdy", []), ("", "mdy", []), (None, "mdy", []), ("x" * 100_000, "mdy", []),
])
def test_date_readings(spark, text, order, days):
    df = spark.createDataFrame([(text, datetime(2023, 3, 8), order)], "t string, r timestamp, o string")
    got = df.select(date_readings("t", "r", "o").alias("x")).first()["x"]
    assert [(x["day"]) for x in got] == [(d - DAY0).days for d in days]


@pytest.mark.parametrize("text,sec,off", [
    ("2054 HRS", 20 * 3600 + 54 * 60, None), ("1:05PM", 13 * 3600 + 300, None), ("12:10 a.m.", 600, None), ("19:14:46+0000", 19 * 3600 + 14 * 60 + 46, 0),
    ("23:58 PDT", 23 * 3600 + 58 * 60, -420), ("00:07 -07:00", 420, -420), ("00:00Z", 0, 0), ("25:00", None, None), ("2460", None, None), ("UNK", None, None), (None, None, None),
])
def test_time_reading(spark, text, sec, off):
    got = spark.createDataFrame([(text,)], "t string").select(time_reading("t").alias("x")).first()["x"]
    assert (got["seconds"], got["offset"]) == (sec, off) if sec is not None else got is None


def test_moments_and_clock_changes(spark):
    src = spark.createDataFrame([("a", "America/Los_Angeles", "mdy"), ("u", "UTC", "dmy")], "source_file string, time_zone string, date_order string")
    t = datetime(2024, 1, 1)
    data = [
        (1, "a", t, "2023-07-01", "10:00:59", "1/2/80"), (2, "a", t, "2023-03-12", "02:30", None), (3, "a", t, "2023-11-05", "01:30", "?"), (4, "a", t, "2023-11-05T01:30 PST", None, None),
        (5, "u", t, "1/7/2023", "17:00", "NULL"), (6, "x", t, "2023-07-01 17:00", None, None), (7, "a", t, None, None, None), (8, "a", t, "2023-07-01 00:00:00", "UNK", None)]
    df = spark.createDataFrame(data, "row_id long, source_file string, received_at timestamp, DeathDate string, DeathTime string, DateofBirth string")
    r = {x["row_id"]: x for x in normalise_timestamps(df, src).collect()}
    assert r[1]["moment_utc"] == datetime(2023, 7, 1, 17, 0) and r[1]["birth_day"] == date(1980, 1, 2)
    assert [r[i]["moment_status"] for i in (2, 3, 4, 7, 8)] == ["clock change", "clock change", "ok", "no date", "no time"]
    assert r[4]["moment_utc"] == datetime(2023, 11, 5, 9, 30)
    assert r[5]["moment_utc"] == r[6]["moment_utc"] == datetime(2023, 7, 1, 17, 0)
    empty = normalise_timestamps(df.limit(0), src)
    assert empty.count() == 0 and "moment_utc" in empty.columns


def _paths(spark, texts, block, apart=60, ids=int):
    t0 = datetime(2024, 1, 1).timestamp()
    data = [(ids(i), "s", datetime.fromtimestamp(t0 + apart * i), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "row_id long, source_file string, received_at timestamp, t string")
    df = df.withColumn("r", date_readings("t", "received_at", "cast(null as string)"))
    got = choose_readings(df, "source_file", "received_at", "row_id", {"r": 0.5}, blocks=block)
    return {x["row_id"]: x["choice"] for x in got.collect()}, df.select("row_id", "r").orderBy("row_id").collect()


def test_viterbi_follows_the_notation_and_blocks_agree(spark):
    texts = ["25/3/2023", "4/4/2023", "1/5/2023", "2/5/2023", "28/5/2023", "3/6/2023", "5/6/2023", "30/6/2023", "1/7/2023"]
    whole, readings = _paths(spark, texts, 1)
    for blocks in (3, 5, 9):
        assert _paths(spark, texts, blocks)[0] == whole
    assert _paths(spark, texts, 4, apart=0)[0] == whole  # all received in one minute
    assert _paths(spark, texts, 4, apart=0, ids=lambda i: (i - 4) * 2**60)[0] == {(i - 4) * 2**60: c for i, c in whole.items()}  # under hashed keys
    readings = {r["row_id"]: r for r in readings}
    assert all(readings[i]["r"][c]["notation"] == "dmy" or len(readings[i]["r"]) == 1 for i, c in whole.items())


def test_viterbi_is_optimal(spark):
    import itertools

    from caseloom.operators.timestamps import _decode, _matrix, _step

    rng = __import__("random").Random(3)
    for _ in range(20):
        names = [[rng.choice("ab") for _ in range(rng.choice([1, 2, 2]))] for _ in range(6)]
        days = [[rng.randrange(60) for _ in n] for n in names]
        own = [[rng.choice([0.0, 3.5]) for _ in n] for n in names]
        cost = lambda p: sum(_step(names[i], days[i], names[i + 1], days[i + 1], 0.5)[p[i]][p[i + 1]] + own[i + 1][p[i + 1]] for i in range(5))
        best = min(cost(p) for p in itertools.product(*[range(len(n)) for n in names]))
        m = _matrix(names, days, own, 0.5)
        a, b = divmod(int(m.argmin()), m.shape[1])
        assert abs(m.min() - best) < 1e-9 and abs(cost(_decode(names, days, own, a, b, 0.5)) - best) < 1e-9


def test_blocks_don_t_change_the_choice(spark):
    """Long random sources: the same choices whatever the size of blocks, and a declared order holds wherever it gives a date."""
    rng = __import__("random").Random(8)
    t0 = datetime(2024, 1, 1).timestamp()
    data = []
    for i in range(600):
        day = date(2023, 1, 1 + i * 27 // 600) if rng.random() < 0.5 else date(2023, rng.randrange(1, 13), rng.randrange(1, 29))
        text = rng.choice([day.isoformat(), f"{day.month}/{day.day}/{day.year}", f"{day.month}/{day.day}/{day.year}", f"{day.day}/{day.month}/{day.year}"])
        data.append((i, rng.choice("st"), datetime.fromtimestamp(t0 + 20 * i), text))
    df = spark.createDataFrame(data, "row_id long, source_file string, received_at timestamp, t string").withColumn("r", date_readings("t", "received_at", "cast(null as string)"))
    run = lambda d, **k: {r["row_id"]: r["choice"] for r in choose_readings(d, "source_file", "received_at", "row_id", {"r": 0.5}, **k).collect()}
    whole = run(df)
    assert whole == run(df, blocks=1) == run(df, blocks=12) == run(df, blocks=60) and set(whole.values()) == {0, 1}
    for order, choice in (("mdy", 0), ("dmy", 1)):
        assert set(run(df.withColumn("o", F.lit(order)), declared="o", blocks=12).values()) == {choice}


def test_disagreements(spark):
    df = spark.createDataFrame([(1, "c", "x"), (2, "c", "x"), (3, "c", "y"), (4, "c", None), (5, None, "z"), (6, "d", "q")], "row_id long, c string, m string")
    assert rows(disagreements(df, "c", "row_id", {"m": "death"})) == [(1, 3, "death"), (2, 3, "death")]
    assert disagreements(df.limit(0), "c", "row_id", {"m": "death"}).count() == 0


def test_disagreement_classes_count_the_pairs(spark):
    from caseloom.operators.timestamps import disagreement_classes

    df = spark.createDataFrame([(1, "c", "x"), (2, "c", "x"), (3, "c", "y"), (4, "c", None), (5, None, "z"), (6, "d", "q"), (7, "e", "a"), (8, "e", "b"), (9, "e", "c")], "row_id long, c string, m string")
    got = {r["row_id"]: r["n_links"] for r in disagreement_classes(df, "c", "row_id", {"m": "death"}).collect()}
    pairs = [r for r in disagreements(df, "c", "row_id", {"m": "death"}).collect()]
    assert got == {i: sum(i in (p["row_id_a"], p["row_id_b"]) for p in pairs) for i in (1, 2, 3, 7, 8, 9)}
    assert disagreement_classes(df.limit(0), "c", "row_id", {"m": "death"}).count() == 0


def test_values(spark):
    df = spark.createDataFrame([("Case# 2019-00109",), ("2019 - 62",), ("2019–123456",), ("PENDING",), (None,)], "k string")
    assert [r[0] for r in df.select(case_key(F.col("k"))).collect()] == ["2019-00109", "2019-00062", "2019-123456", None, None]
    m = spark.createDataFrame([("NULL NULL",), (" n/a ",), ("",), (None,), ("OD",), ("0",), ("-",)], "v string")
    assert [r[0] for r in m.select(is_missing(F.col("v"))).collect()] == [True, True, True, True, False, False, True]
    c = spark.createDataFrame([("54.0",), (" 54",), ("054",), ("Pacific  Islander",), ("unk",), ("0",)], "v string")
    assert [r[0] for r in c.select(comparable(F.col("v"))).collect()] == ["54", "54", "54", "PACIFICISLANDER", "", "0"]
