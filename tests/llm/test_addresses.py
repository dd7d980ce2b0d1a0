from caseloom.llm.addresses import parse_addresses, same_location_pairs

from ..conftest import rows

GROUPS = [("a", "c", "z")]


def _pairs(spark, data):
    df = spark.createDataFrame(data, "a string, c string, z string")
    return {tuple(r) for r in same_location_pairs(df, GROUPS).collect()}, df


def test_parse(spark):
    df = spark.createDataFrame([
        ("UNIT 12, 2064, HOOLPAWORTH WY", "X", "90001.0"), ("Rear of 19271 Twelfth Str", None, None), ("W DENXEDEN TER 1924", "PT JUNE", "90001-1234"),
        ("ZELNULAND WAY, NO. 16684, UNIT 11", "", ""), ("25601, kembal and dr", None, None), ("CORNER OF B PLACE AND A STREET", "X", None), ("9750 N Vensiland Blvd, Unit 4B, Juneside", None, None),
        ("SOMEWHERE", "X", None), ("22095 NO ELDDRU AVENUE", "X", None)], "address string, city string, zip string")
    got = [(r["kind"], r["num"], r["d1"], r["n1"], r["t1"], r["n2"], r["pcity"], r["pzip"]) for r in parse_addresses(df).collect()]
    assert got == [
        ("house", "2064", "", "HOOLPAWORTH", "WAY", "", "X", "90001"), ("house", "19271", "", "12TH", "ST", "", "", ""), ("house", "1924", "W", "DENXEDEN", "TER", "", "PORT JUNE", "90001"),
        ("house", "16684", "", "ZELNULAND", "WAY", "", "", ""), ("house", "25601", "", "KEMBALAND", "DR", "", "", ""), ("crossing", "", "", "A", "ST", "B", "X", ""), ("house", "9750", "N", "VENSILAND", "BLVD", "", "JUNESIDE", ""),
        (None, "", "", "SOMEWHERE", "", "", "X", ""), ("house", "22095", "N", "ELDDRU", "AVE", "", "X", "")]


def test_same_and_different_locations(spark):
    same = [("1924 W DENXEDEN TER", "BRENNIVILLE", "02270"), ("W DENXEDEN TERR., NO. 1924 APT 3", "BRENNIVILE", "02270"), ("1924 WEST DENXEDNE", None, "02270")]
    other = [("1924 E DENXEDEN TER", "BRENNIVILLE", "02270"), ("1924 W DENXEDEN AVE", "BRENNIVILLE", "02270"), ("1925 W DENXEDEN TER", "BRENNIVILLE", "02270"), ("1924 W DENXEDEN TER", "FERROTON", "92837"), ("UNKNOWN", "BRENNIVILLE", "02270"), (None, "X", None)]
    got, df = _pairs(spark, same + same + other)
    w = [f"{a}|{c or ''}|{z or ''}" for a, c, z in same]
    assert got == {tuple(sorted((x, y))) for i, x in enumerate(w) for y in w[i + 1:]}
    assert rows(same_location_pairs(df.limit(0), GROUPS)) == []


def test_crossings(spark):
    got, _ = _pairs(spark, [("A ST & B DR", "X", "1"), ("CORNER OF B AND A", "X", None), ("A ST / C DR", "X", "1"), ("A AVE @ B DR", "X", "1")])
    assert got == {("A ST & B DR|X|1", "CORNER OF B AND A|X|")}


def test_hot_building_is_one_location(spark):
    """Every writing agrees with the right one, however many misspelt writings stand between them in any order."""
    city, street, code = "BRENNIVILLE", "DENXEDEN", "02270"
    slips = lambda s, letters: sorted({s[:i] + x + s[i + 1:] for i in range(len(s)) for x in letters} - {s})
    right = [(f"1924 W {street} TER UNIT {i}", city, code) for i in range(5)]
    wrong = [(f"1924 W {street} TER", x, code) for x in slips(city, "ABCDEFGHIJKLM")] + [(f"1924 W {street} TER", None, x) for x in slips(code, "0123456789")]
    wrong += [(f"1924 {x}", city, code) for x in slips(street, "PQXYZ")] + [(f"{street} TER, 1924", None, None), (f"1924 W {street}", city, None)]
    common = [(f"{i} W {street} TER", city, code) for i in range(1, 40)]
    got, _ = _pairs(spark, right + wrong + common)
    n = len(right) + len(wrong)
    assert n > 200 and len(got) == n * (n - 1) // 2


def test_anchors_are_followed_to_the_end(spark):
    from caseloom.llm.addresses import _roots

    df = spark.createDataFrame([(str(i), str(min(i + 1, 11))) for i in range(12)] + [("a", "a"), ("b", "a")], "key string, to string")
    assert rows(_roots(df)) == sorted([(str(i), "11") for i in range(12)] + [("a", "a"), ("b", "a")])
    assert _roots(df.limit(0)).count() == 0


def test_members_and_pairs_say_the_same(spark):
    from caseloom.llm.addresses import location_members, same_location_pairs

    data = [("12 MAIN ST", "YORK", "90001"), ("12 Main Street", "York", None), ("12 MAIN STREET APT 4", None, "90001"), ("13 MAIN ST", "YORK", "90001"), ("C/O LEE 12 MAIN ST", "YORK", "90001"), (None, "YORK", "1"), ("", None, None)]
    df = spark.createDataFrame(data, "a string, c string, z string")
    members = {r["written"]: (r["location"], r["n_links"]) for r in location_members(df, [("a", "c", "z")]).collect()}
    pairs = {(r[0], r[1]) for r in same_location_pairs(df, [("a", "c", "z")]).collect()}
    assert pairs == {(x, y) for x in members for y in members if x < y and members[x][0] == members[y][0]}
    assert members["12 MAIN ST|YORK|90001"][1] == 3 and members["13 MAIN ST|YORK|90001"][1] == 0
