"""What the consensus queries send through exchanges, and that large cases and odd texts come out alike."""

import random
import re

import pytest

from caseloom.operators import consensus
from caseloom.plans import reference
from tests.test_consensus_whole import TEXTS, VALUES, _brute


def _write(spark, d, data, columns):
    spark.createDataFrame([(i, s, k, *v) for i, s, k, v in data], "row_id long, source_file string, CaseNumber string, " + ", ".join(f"{c} string" for c in columns)).write.parquet(f"{d}/consensus.parquet")


def _records(spark):
    """Records written to exchanges so far."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


@pytest.mark.parametrize("query", ["consensus_collated", "consensus_vote"])
def test_rows_move_not_cells(spark, tmp_path, query):
    rnd, columns = random.Random(5), list(reference.MAPPED)
    data = [(i, f"s{rnd.randrange(4)}", f"2024-{i // 2}", [rnd.choice(VALUES.get(c, TEXTS)) for c in columns]) for i in range(600)]
    _write(spark, str(tmp_path), data, columns)
    before = _records(spark)
    assert reference.QUERIES[query](spark, str(tmp_path)).count() > 0
    assert 0 < _records(spark) - before < 3 * len(data)


@pytest.mark.parametrize("large", [0, 6, 200])
def test_large_cases_and_odd_texts(spark, tmp_path, monkeypatch, large):
    monkeypatch.setattr(consensus, "LARGE_CASE", large)
    rnd, columns = random.Random(7), list(reference.MAPPED)
    odd = [*TEXTS, "A\x1fB", "A\x1bs", "\x1bn", "", "\x1f", "A\x1be\x1f"]
    data = [(i, f"s{rnd.randrange(5)}", f"2024-{rnd.randrange(12)}", [rnd.choice([None, *VALUES.get(c, odd)]) for c in columns]) for i in range(80)]
    _write(spark, str(tmp_path), data, columns)
    best, _ = _brute([(i, s, k, [v if v is None or re.search("[A-Za-z0-9]", v) else None for v in vals]) for i, s, k, vals in data], columns)
    got = {(r["case_number"], r["field"]): (r["norm"], r["votes"]) for r in reference.consensus_vote(spark, str(tmp_path)).collect()}
    assert got == {k: (r[0], r[1]) for k, r in best.items()}
    out = {(r["CaseNumber"], c): r[c] for r in reference.consensus_collated(spark, str(tmp_path)).collect() for c in columns if r[c] is not None}
    assert out == {k: re.sub("[ \t\n\x0b\f\r]+", " ", r[2]).strip(" ") for k, r in best.items()}
