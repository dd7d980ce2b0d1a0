import random

from caseloom.llm.leakage import leaked_passages, longest_run

from ..conftest import rows


def _run(item, doc):
    return longest_run(" ".join(item), " ".join(doc))


def test_longest_run():
    item = [f"w{i}x" for i in range(30)]
    assert _run(item, item) == 30
    assert _run(item, ["x"] * 5 + item[3:20] + ["y"]) == 17
    assert _run(item, item[:8] + ["q"] + item[9:20]) == 20  # altered
    assert _run(item, item[:8] + item[9:20]) == 20  # left out
    assert _run(item, item[:8] + ["q"] + item[8:20]) == 20  # added
    assert _run(item, item[:8] + ["q", "r"] + item[8:20]) == 12  # two in a row end the run
    assert _run(item, ["z"]) == 0 and longest_run("", "") == 0


def test_slots_must_be_refilled_consistently():
    item = "The officer Ramos gave 12 mg of the drug to Ramos before noon and wrote that 12 mg had been the dose he knew"
    whole = len(item.split())
    assert longest_run(item, item.replace("Ramos", "Mary Ann Quimby").replace("12", "3 500")) == whole  # several words a slot
    assert longest_run(item, item.replace("Ramos", "Quimby")) == whole
    # One value that becomes two is no refilled slot: as an edit it still needs equal words next to it.
    assert longest_run(item, item.replace("to Ramos", "to Mary Ann")) < whole
    assert longest_run(item, item.replace("12 mg had", "7 8 mg had")) < whole
    # Two values that become one neither.
    assert longest_run("the lab saw 5 8 ng and then it saw 6 9 ng in the second of all samples", "the lab saw 1 1 ng and then it saw 1 1 ng in the second of all samples") < 17
    # More refilled than repeated is no leak.
    assert longest_run("1 2 3 4 5 6 7 8 9 of a b c d", "11 12 13 14 15 16 17 18 19 of a b c d") == 0


WORDS = "lantern copper fever ledger basin kettle orchard violin harbor meadow ribbon thicket ember quarry saddle turnip velvet walnut yonder zephyr".split()


def test_leaked_passages(spark):
    rng = random.Random(5)
    passage = [rng.choice(WORDS) for _ in range(40)]
    item = "Ferro's " + " ".join(passage) + " 34 mg."
    other = " ".join(rng.choice(WORDS) for _ in range(40))
    copy = passage[5:25]
    altered = copy[:9] + ["xxxx"] + copy[10:]
    docs = [
        (1, "Before. " + ", ".join(copy).upper() + "! After"), (2, " ".join(altered)), (3, " ".join(copy[:14])), (4, None), (5, ""), (6, "a b c"), (7, item), (8, item),
        (9, "Velto's " + " ".join(passage) + " 99 mg."), (10, " ".join(rng.choice(WORDS) for _ in range(20_000)) + " " + " ".join(copy))]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame([(100, item), (200, other), (300, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaked_passages(d, i).collect()}
    assert {x for x in got if x[1] == 100} == {(k, 100) for k in (1, 2, 7, 8, 9, 10)}
    assert leaked_passages(d.limit(0), i).count() == 0 and leaked_passages(d, i.limit(0)).count() == 0
    assert rows(leaked_passages(d, i, min_run=41).select("doc_id")) == [(7,), (8,), (9,)]


def test_blocks_of_items_and_many_names(spark):
    rng = random.Random(6)
    items = [(k, " ".join(rng.choice(WORDS) for _ in range(25)) + f" said Name{chr(97 + k % 26)}{'b' * (k // 26)} twice") for k in range(60)]
    docs = [(k, "x " + t.upper()) for k, t in items] + [(1000 + k, t.replace("Name", "Other")) for k, t in items]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole, cut = rows(leaked_passages(d, i)), rows(leaked_passages(d, i, block_words=500))
    assert whole == cut and {(k + o, k) for k, _ in items for o in (0, 1000)} <= {r[:2] for r in whole}


def test_against_brute_force(spark):
    """Runs of equal words only: every pair with 15 of them in a row is found, whatever stands around."""
    rng = random.Random(7)
    items = [(k, [rng.choice(WORDS) for _ in range(30)]) for k in range(12)]
    docs = []
    for n in range(80):
        k, long = rng.randrange(12), rng.randrange(8, 25)
        at = rng.randrange(30 - long)
        docs.append((n, [rng.choice(WORDS) for _ in range(rng.randrange(20))] + items[k][1][at : at + long] + [rng.choice(WORDS) for _ in range(rng.randrange(20))]))
    want = {(n, k) for n, d in docs for k, t in items if any(d[x : x + 15] == t[y : y + 15] for x in range(len(d) - 14) for y in range(16))}
    d = spark.createDataFrame([(n, " ".join(w)) for n, w in docs], "doc_id long, text string")
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    assert want <= {(r[0], r[1]) for r in leaked_passages(d, i).collect()}
