"""Extra columns and nulls in any column change nothing."""

from datetime import datetime

from pyspark.sql import functions as F

from caseloom.llm import addresses, leakage, packing, survivors, truncation

from ..conftest import rows

EXTRA = ["value", "field", "count", "kind", "n", "trust", "address", "city", "zip", "run", "pos", "h", "size", "part", "start", "bin", "why"]


def wide(df):
    return df.withColumns({c: F.lit("extra") for c in EXTRA if c not in df.columns})


def test_all(spark):
    c = spark.createDataFrame([
        (1, "a", datetime(2024, 1, 1), "2024-1", "X AND,", "1 A ST", "C", "90001"), (2, None, None, "2024-1", None, None, None, None), (3, "a", None, "2024-1", "X", "1 A STREET", None, "90001")],
        "row_id long, source_file string, received_at timestamp, CaseNumber string, CauseA string, DeathAddress string, DeathCity string, DeathZip string")
    src = spark.createDataFrame([("a", 1), (None, None)], "source_file string, trust int")
    groups = [("DeathAddress", "DeathCity", "DeathZip")]
    assert {tuple(r) for r in addresses.same_location_pairs(wide(c), groups).collect()} == {tuple(sorted(("1 A STREET||90001", "1 A ST|C|90001")))}
    cut = truncation.truncated_values(wide(c), ["CauseA"])
    assert rows(cut.select("row_id", "field")) == [(1, "CauseA")]
    assert rows(survivors.winners(survivors.surviving_values(wide(c), src, ["CauseA"], cut), ["CauseA"])) == [("2024-00001", "CauseA", 3)]
    d = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p"), (None, None), (2, None)], "doc_id long, text string")
    i = spark.createDataFrame([(9, "A B C D E F G H I J K L M N O P."), (None, None)], "item_id long, text string")
    assert rows(leakage.leaked_passages(wide(d), wide(i)).select("doc_id", "item_id")) == [(1, 9)]
    assert packing.harmonic_pack(wide(spark.createDataFrame([(1, 5), (1, 5), (None, None)], "doc_id long, n_tokens int")), capacity=4).count() == 5
