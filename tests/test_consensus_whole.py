"""The consensus queries over all mapped columns, against a plain Python vote."""

import random
import re
from collections import Counter, defaultdict

import pytest

from caseloom.plans import reference

TEXTS = ["EFFECTS OF COCAINE", "EFFECTS OF COCA", "EFFECTS OF COCAINE AND", "EFFECTS OF COCAINE AND HEROIN", "COCAINE AND HEROIN", "FECTS OF COCAINE", "HEROIN", "Heroin", "HER\nOIN"]
DATES, ZIPS, AGES = ["2024-01-05", "1/5/2024", "2024-02-06"], ["90001", "90001.0", "90002-1234"], ["44", "44 years", "45"]
VALUES = {"DeathDate": DATES, "DateofBirth": DATES, "DeathZip": ZIPS, "EventZip": ZIPS, "Age": AGES, "Gender": ["M", "MALE", "F"], "Race": ["White", "Caucasian", "Black"]}


def _norm(c, v):
    if c in ("DeathDate", "DateofBirth"):
        return "2024-01-05" if v == "1/5/2024" else v
    if c in ("DeathZip", "EventZip"):
        return v[:5]
    if c == "Age":
        return v[:2]
    k = re.sub("[^A-Z0-9]", "", v.upper())
    return {"Gender": {"M": "MALE", "F": "FEMALE"}, "Race": {"CAUCASIAN": "WHITE"}}.get(c, {}).get(k, k)


def _clipped(f, fv, t, tv):
    if len(f) < 5 or not (t.startswith(f) or t.endswith(f)):
        return False
    if t.startswith(f) and re.search(r"(,|\b(AND|OF))\s*$", fv):
        return True
    starts, n = {0}, 0
    for w in re.findall("[A-Z0-9]+", tv.upper()):
        n += len(w)
        starts.add(n)
    return n == len(t) and (len(f) if t.startswith(f) else len(t) - len(f)) not in starts


def _brute(data, columns):
    cells = defaultdict(dict)  # (case, column) -> {(source, norm): (ord, value)}
    for o, source, case, vals in data:
        for c, v in zip(columns, vals):
            if v is not None:
                cells[case, c].setdefault((source, _norm(c, v)), (o, v))
    votes, agree = {}, defaultdict(list)
    for (case, c), b in cells.items():
        first = lambda n: min((len(re.findall(r"\s", v)), o, v) for (_, m), (o, v) in b.items() if m == n)[2]
        rows = [[n, k, first(n), min(o for (_, m), (o, _) in b.items() if m == n)] for n, k in Counter(m for _, m in b).items()]
        kept = []
        for r in sorted(rows, key=lambda r: (-len(r[0]), r[0])):
            t = next((k for k in kept if _clipped(r[0], r[2], k[0], k[2])), None)
            if t:
                t[1] += r[1]
            else:
                kept.append(r)
        votes[case, c] = kept
        w = min(kept, key=lambda r: (-r[1], r[3]))[0]
        if len(kept) > 1 and c != "SourcePages":
            for s, n in b:
                agree[s].append(n == w or (len(n) >= 5 and (w.startswith(n) or w.endswith(n))))
    rel = {s: sum(a) / len(a) for s, a in agree.items()}
    best = {}
    for (case, c), kept in votes.items():
        back = lambda n: max(rel.get(s, -1) for s, m in cells[case, c] if m == n)
        best[case, c] = min(kept, key=lambda r: (-r[1], -back(r[0]), r[3]))
    return best, rel


@pytest.fixture(scope="module")
def voted(spark, tmp_path_factory):
    rnd, columns = random.Random(3), list(reference.MAPPED)
    data = [(i, f"s{rnd.randrange(5)}", f"2024-{rnd.randrange(12)}", [rnd.choice([None, *VALUES.get(c, TEXTS)]) for c in columns]) for i in range(90)]
    d = str(tmp_path_factory.mktemp("votes"))
    spark.createDataFrame([(i, s, k, *v) for i, s, k, v in data], "row_id long, source_file string, CaseNumber string, " + ", ".join(f"{c} string" for c in columns)).write.parquet(f"{d}/consensus.parquet")
    return d, *_brute(data, columns)


def test_vote_and_reliability(spark, voted):
    d, best, rel = voted
    got = {(r["case_number"], r["field"]): (r["norm"], r["votes"]) for r in reference.consensus_vote(spark, d).collect()}
    assert got == {k: (r[0], r[1]) for k, r in best.items()}
    assert {r["source"]: r["reliability"] for r in reference.source_reliability(spark, d).collect()} == {s: pytest.approx(x, abs=1e-6) for s, x in rel.items()}


def test_collated_has_every_mapped_column(spark, voted):
    d, best, _ = voted
    out = reference.consensus_collated(spark, d)
    assert set(out.columns) == {"CaseNumber", *reference.MAPPED}
    got = {(r["CaseNumber"], c): r[c] for r in out.collect() for c in reference.MAPPED if r[c] is not None}
    assert got == {k: re.sub(r"\s+", " ", r[2]).strip() for k, r in best.items()}
    lost = {r["column"] for r in reference.consensus_disagreements(spark, d).select("column").distinct().collect()}
    assert "DeathDate" in lost and "CauseB" in lost and "SourcePages" not in lost
