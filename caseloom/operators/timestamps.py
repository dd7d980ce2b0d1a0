"""Mixed timestamp formats and zones brought to one unambiguous form.

Every written value is expanded into the array of its valid readings. Where a
value has more than one, a Viterbi search over the record order of its source
picks the readings, at a cost for switching the notation, for jumping back in
time and for contradicting the order of day and month that the source declares.

The search is exact and split: records are cut into blocks of bounded size
along the order of their source, each block is reduced to its min-plus matrix
(cost from each reading of its first record to each of its last), the matrices
of a source are chained, and each block is then decoded by itself. A source of
any size costs only more blocks. Of the records with one reading only those next
to an open one enter the search: what lies between two of them costs the same on
every path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.timeparse import date_readings, time_reading, to_utc_seconds
from caseloom.session import cut

SWITCH_COST = 1.0
BACK_COST = 0.5
BACK_SCALE_DAYS = 30.0
# More than one value can save by another reading (two switches and two jumps): a declared order holds wherever it gives a date.
DECLARED_COST = 3.5


def _step(na: list, da: list, nb: list, db: list, back: float) -> np.ndarray:
    """Cost of going from each reading of one record to each of the next."""
    switch = np.array([[0.0 if x == y else SWITCH_COST for y in nb] for x in na])
    gap = np.maximum(0, np.subtract.outer(np.asarray(da, float), np.asarray(db, float)))
    return switch + back * np.minimum(1.0, gap / BACK_SCALE_DAYS)


def _matrix(names: list, days: list, costs: list, back: float) -> np.ndarray:
    """Least cost from each reading of the first record to each of the last; the first record's own costs don't count."""
    k = len(names[0])
    m = np.where(np.eye(k, dtype=bool), 0.0, np.inf)
    for i in range(1, len(names)):
        m = (m[:, :, None] + _step(names[i - 1], days[i - 1], names[i], days[i], back)[None]).min(axis=1) + np.asarray(costs[i], float)
    return m


def _decode(names: list, days: list, costs: list, first: int, last: int, back: float) -> list[int]:
    """The cheapest path between two fixed readings; ties go to the earlier reading."""
    cost = np.full(len(names[0]), np.inf)
    cost[first] = 0.0
    via = []
    for i in range(1, len(names)):
        t = cost[:, None] + _step(names[i - 1], days[i - 1], names[i], days[i], back)
        via.append(t.argmin(axis=0))
        cost = t.min(axis=0) + np.asarray(costs[i], float)
    path = [last]
    for v in reversed(via):
        path.append(int(v[path[-1]]))
    return path[::-1]


def _same_number(x: Column) -> Column:
    """Whether a reading of figures has one number as day and month."""
    d = F.date_from_unix_date(x["day"])
    return F.coalesce(x["notation"].isin("mdy", "dmy") & (F.dayofmonth(d) == F.month(d)), F.lit(False))


def _open_and_next(fields: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of sorted rows, for each field those with an open reading, their neighbours, and the first and last of each source; rows without a reading are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, pa.Table | None] = dict.fromkeys(fields)  # of each field the last row seen, and whether it was given out
        given = dict.fromkeys(fields, False)

        def part(rows: pa.Table, field: str) -> pa.Table:
            own = rows.column("_f").combine_chunks().field(fields.index(field))
            cols = {"field": pa.array([field] * len(rows)), **{c: rows.column(c) for c in ("_src", "_key", "_minute", "_block")}, **{c: own.field(i) for i, c in enumerate(("open", "names", "days", "costs"))}}
            return pa.table(cols)

        for b in batches:
            rows = pa.Table.from_batches([b])
            for f in fields:
                t = part(rows, f)
                t = t.filter(pc.greater(pc.list_value_length(t.column("names")), 0))
                if held[f] is not None:
                    t = pa.concat_tables([held[f], t])
                if not len(t):
                    continue
                many = pc.list_value_length(t.column("names")).to_numpy() > 1
                src = t.column("_src").to_numpy(zero_copy_only=False)
                other = np.concatenate([[True], src[1:] != src[:-1]])  # the first row of a source, and of what is seen here
                keep = many.copy()
                keep[1:] |= many[:-1] | other[1:]
                keep[:-1] |= many[1:] | other[1:]
                keep[0] |= held[f] is None
                if given[f]:
                    keep[0] = False
                last = bool(keep[-1]) or (given[f] and len(t) == 1)
                yield from t.filter(pa.array(keep)).combine_chunks().to_batches()
                held[f], given[f] = t.slice(len(t) - 1), last
        for f in fields:
            if held[f] is not None and not given[f]:
                yield from held[f].combine_chunks().to_batches()

    return run


def choose_readings(df: DataFrame, source: str, received: str, key: str, readings: dict[str, float], declared: str | None = None, blocks: int | None = None) -> DataFrame:
    """``(key, field, choice)`` for every row with more than one reading of a field.

    ``readings`` names the array columns of readings with the cost of a jump
    back in time by ``BACK_SCALE_DAYS`` or more; ``choice`` is the index of the
    reading chosen. ``declared`` names a column with the order (``mdy`` or
    ``dmy``) that the source declares; a reading in the other order costs
    ``DECLARED_COST``. Rows with no or one reading are not listed, nor are rows
    without a source: their first reading holds.

    The record order of a source is the minute of receipt, then the key (a
    unique whole number); rows never received stand first. Rows are partitioned
    by ranges of that order into ``blocks`` of about equal size (as many as
    shuffle partitions by default), however many a source or a minute holds, and
    pass through in batches; only open rows and their neighbours are kept.
    """
    minute = F.coalesce(F.date_trunc("minute", F.col(received)), F.timestamp_seconds(F.lit(0)))
    order = F.col(declared) if declared else F.lit(None).cast("string")
    cost = lambda x: F.when(x["notation"].isin("mdy", "dmy") & (x["notation"] != order), DECLARED_COST).otherwise(0.0)
    # Figures whose day and month are one number have one reading but speak for neither order: both stand for it in the search.
    read = lambda c: F.transform(c, lambda x: F.struct(x["notation"].alias("notation"), x["day"].alias("day")))
    swap = lambda x: F.struct(F.when(x["notation"] == "mdy", "dmy").otherwise("mdy").alias("notation"), x["day"].alias("day"))
    even = lambda c: (F.size(c) == 1) & _same_number(F.get(c, F.lit(0)))
    both = lambda c: F.when(even(c), F.concat(read(c), F.transform(c, swap))).otherwise(read(c))
    field = lambda c, q: F.struct((F.size(c) > 1).alias("open"), q["notation"].alias("names"), q["day"].alias("days"), F.transform(q, lambda x: F.coalesce(cost(x), F.lit(0.0))).alias("costs"))
    fields = F.struct(*[field(c, both(c)).alias(f"f{i}") for i, c in enumerate(readings)])
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = df.filter(F.col(source).isNotNull()).select(F.col(source).alias("_src"), F.col(key).cast("long").alias("_key"), minute.alias("_minute"), fields.alias("_f"))
    line = line.repartitionByRange(n, "_src", "_minute", "_key").sortWithinPartitions("_src", "_minute", "_key").withColumn("_block", F.spark_partition_id().cast("long"))
    part = ["field", "_src"]
    # Written once: the ranges are sampled, so they must not be drawn again.
    rows = cut(line.mapInArrow(_open_and_next(list(readings)), "field string, _src string, _key long, _minute timestamp, _block long, open boolean, names array<string>, days array<int>, costs array<double>"))

    def ordered(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list, list, list]:
        pdf = pdf.sort_values(["_minute", "_key"], kind="stable")
        return pdf, *([list(x) for x in pdf[c]] for c in ("names", "days", "costs"))

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, n, d, c = ordered(pdf)
        m = _matrix(n, d, c, readings[pdf["field"].iloc[0]])
        return pd.DataFrame({"field": [pdf["field"].iloc[0]], "_src": [pdf["_src"].iloc[0]], "_block": [pdf["_block"].iloc[0]], "_fn": [n[0]], "_fd": [d[0]], "_fc": [c[0]], "_ln": [n[-1]], "_ld": [d[-1]], "_m": [m.ravel().tolist()]})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        back = readings[pdf["field"].iloc[0]]
        ms = [np.asarray(m).reshape(len(a), len(b)) for m, a, b in zip(pdf["_m"], pdf["_fn"], pdf["_ln"])]
        first = [np.asarray(c, float) for c in pdf["_fc"]]
        entry, exits = [], []
        cost = first[0][:, None] + ms[0]
        arg = [cost.argmin(axis=0)]
        best = [cost.min(axis=0)]
        links = [None]
        for i in range(1, len(ms)):
            t = best[-1][:, None] + _step(list(pdf["_ln"].iloc[i - 1]), list(pdf["_ld"].iloc[i - 1]), list(pdf["_fn"].iloc[i]), list(pdf["_fd"].iloc[i]), back)
            links.append(t.argmin(axis=0))
            c = (t.min(axis=0) + first[i])[:, None] + ms[i]
            arg.append(c.argmin(axis=0))
            best.append(c.min(axis=0))
        out = int(best[-1].argmin())
        for i in range(len(ms) - 1, -1, -1):
            exits.append(out)
            begin = int(arg[i][out])
            entry.append(begin)
            if i:
                out = int(links[i][begin])
        return pd.DataFrame({"field": pdf["field"].to_numpy(), "_src": pdf["_src"].to_numpy(), "_block": pdf["_block"].to_numpy(), "_first": entry[::-1], "_last": exits[::-1]})

    def decode(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, n, d, c = ordered(pdf)
        path = _decode(n, d, c, int(pdf["_first"].iloc[0]), int(pdf["_last"].iloc[0]), readings[pdf["field"].iloc[0]])
        return pd.DataFrame({key: pdf["_key"].to_numpy(), "field": pdf["field"].to_numpy(), "choice": path})[pdf["open"].to_numpy()]

    own = "field string, _src string, _block long"
    sums = rows.groupBy(*part, "_block").applyInPandas(summarise, f"{own}, _fn array<string>, _fd array<int>, _fc array<double>, _ln array<string>, _ld array<int>, _m array<double>")
    ends = sums.groupBy(*part).applyInPandas(chain, f"{own}, _first int, _last int")
    return rows.join(ends, [*part, "_block"]).groupBy(*part, "_block").applyInPandas(decode, f"`{key}` {dict(df.dtypes)[key]}, field string, choice int")


def normalise_timestamps(df: DataFrame, sources: DataFrame, key: str = "row_id", source: str = "source_file", received: str = "received_at", date: str = "DeathDate", time: str = "DeathTime", birth: str = "DateofBirth") -> DataFrame:
    """The rows plus ``moment_utc``, ``moment_status``, ``moment_notation``, ``birth_day`` and ``birth_notation``.

    ``sources`` has ``source_file``, ``time_zone`` and ``date_order`` (a few
    rows for each producer; the join is left to the optimizer's size check). A
    source that isn't listed is read as UTC with no declared order. The time
    stands in the date's own text or, if that has none, in the time column; a
    written zone or offset on either holds for both.

    ``moment_status`` is ``ok``, ``no date``, ``no time`` or ``clock change``
    (a zoneless time that its zone skipped or repeated; ``moment_utc`` is null).
    Moments keep whole minutes, seconds are dropped. Null, blank and placeholder
    texts are missing; unreadable text counts as missing. Rows are neither
    dropped nor repeated; other columns pass through.

    Plan: values are read once and written once; only rows with an open reading
    (figures of which either may be the month) are joined with their choice.
    """
    about = sources.select(F.col(source), F.col("time_zone").alias("_zone"), F.col("date_order").alias("_order")).dropDuplicates([source])
    open_order = "cast(null as string)"
    r = df.join(about, source, "left").withColumns({
        "_dr": date_readings(f"`{date}`", f"`{received}`", open_order),
        "_br": date_readings(f"`{birth}`", f"`{received}`", open_order),
    })
    r = cut(r)
    picked = choose_readings(r.select(key, source, received, "_order", "_dr", "_br"), source, received, key, {"_dr": BACK_COST, "_br": 0.0}, "_order")
    choices = picked.groupBy(key).agg(*[F.max(F.when(F.col("field") == f, F.col("choice"))).alias(n) for f, n in (("_dr", "_dc"), ("_br", "_bc"))])
    unsure = (F.size("_dr") > 1) | (F.size("_br") > 1)
    none = F.lit(None).cast("int")
    r = r.filter(~unsure).withColumns({"_dc": none, "_bc": none}).unionByName(r.filter(unsure).join(choices, key, "left"))
    pick = lambda c, i: F.get(c, F.coalesce(F.col(i), F.lit(0)))
    r = r.withColumns({"_d": pick("_dr", "_dc"), "_b": pick("_br", "_bc"), "_t": time_reading(f"`{time}`")})
    r = r.withColumns({"_sec": F.coalesce("_d.seconds", "_t.seconds"), "_off": F.coalesce("_d.offset", "_t.offset")})
    r = r.withColumn("_utc", to_utc_seconds("cast(_d.day as bigint) * 86400 + _sec", "_off", "coalesce(_zone, 'UTC')"))
    notation = lambda c: F.when(_same_number(F.col(c)) & F.col("_order").isNotNull(), F.col("_order")).otherwise(F.col(f"{c}.notation"))
    return r.withColumns({
        "moment_utc": F.timestamp_seconds(F.floor(F.col("_utc") / 60) * 60),
        "moment_status": F.when(F.col("_d").isNull(), "no date").when(F.col("_sec").isNull(), "no time").when(F.col("_utc").isNull(), "clock change").otherwise("ok"),
        "moment_notation": notation("_d"),
        "birth_day": F.date_from_unix_date(F.col("_b.day")),
        "birth_notation": notation("_b"),
    }).drop("_zone", "_order", "_dr", "_br", "_dc", "_bc", "_d", "_b", "_t", "_sec", "_off", "_utc")


def disagreements(df: DataFrame, case: str, key: str, fields: dict[str, str]) -> DataFrame:
    """``(row_id_a, row_id_b, field)``: pairs of rows of a case with different values.

    ``fields`` maps a column to the name reported for it. Nulls disagree with
    nothing. Rows of a case are first split by value, so only the classes of a
    case meet; a case whose rows agree costs nothing beyond the grouping. The
    cells are written once, since three branches read them.
    """
    long = df.filter(F.col(case).isNotNull()).select(
        F.col(case).alias("_case"), F.col(key).alias("_key"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(c).cast("string").alias("value")) for c, n in fields.items()])).alias("_f"),
    ).select("_case", "_key", "_f.field", "_f.value").filter(F.col("value").isNotNull())
    long = cut(long)
    split = long.groupBy("_case", "field").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi")).filter("_lo <> _hi").select("_case", "field")
    rows = long.join(split, ["_case", "field"], "left_semi")
    a, b = rows.alias("a"), rows.alias("b")
    return a.join(b, (F.col("a._case") == F.col("b._case")) & (F.col("a.field") == F.col("b.field")) & (F.col("a._key") < F.col("b._key")) & (F.col("a.value") != F.col("b.value"))).select(
        F.col("a._key").alias("row_id_a"), F.col("b._key").alias("row_id_b"), F.col("a.field").alias("field"))


def disagreement_classes(df: DataFrame, case: str, key: str, fields: dict[str, str]) -> DataFrame:
    """``(row_id, case, field, value, n_links)``: rows of cases that disagree, with the number of rows they disagree with.

    The compact form of ``disagreements``: rows with one value of a case form a
    class, and a row's links are all rows of the case's other classes. One row
    for each row and field, however many a case has.
    """
    long = df.filter(F.col(case).isNotNull()).select(
        F.col(case).alias("_case"), F.col(key).alias("_key"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(c).cast("string").alias("value")) for c, n in fields.items()])).alias("_f"),
    ).select("_case", "_key", "_f.field", "_f.value").filter(F.col("value").isNotNull())
    classes = long.groupBy("_case", "field", "value").agg(F.count("*").alias("_n"))
    whole = classes.groupBy("_case", "field").agg(F.sum("_n").alias("_all"), F.count("*").alias("_k")).filter("_k > 1").drop("_k")
    links = classes.join(whole, ["_case", "field"]).select("_case", "field", "value", (F.col("_all") - F.col("_n")).alias("n_links"))
    return long.join(links, ["_case", "field", "value"]).select(F.col("_key").alias(key), F.col("_case").alias("case"), "field", "value", "n_links")
