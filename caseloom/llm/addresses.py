"""Written postal addresses that denote one location."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.values import is_missing
from caseloom.session import cut

# A spelling is taken for a slip of a similar one if it stands on this few house numbers, or this small a share of the other's.
RARE_NAME = 2
RARE_SHARE = 0.25

# Street types and directions with their writings, ordinals in words.
TYPES = {
    "ST": ("STR", "STREET"), "AVE": ("AV", "AVENUE"), "BLVD": ("BL", "BOULEVARD"), "DR": ("DRIVE",), "RD": ("ROAD",),
    "LN": ("LANE",), "CT": ("CRT", "COURT"), "PL": ("PLACE",), "TER": ("TERR", "TERRACE"), "WAY": ("WY",),
    "CIR": ("CIRCLE",), "PKWY": ("PARKWAY",), "HWY": ("HIGHWAY",), "SQ": ("SQUARE",), "TRL": ("TRAIL",), "ALY": ("ALLEY",),
}
DIRECTIONS = {"N": ("NO", "NORTH"), "S": ("SO", "SOUTH"), "E": ("EAST",), "W": ("WEST",), "NE": ("NORTHEAST",), "NW": ("NORTHWEST",), "SE": ("SOUTHEAST",), "SW": ("SOUTHWEST",)}
ORDINALS = (
    "FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "SIXTH", "SEVENTH", "EIGHTH", "NINTH", "TENTH", "ELEVENTH", "TWELFTH", "THIRTEENTH",
    "FOURTEENTH", "FIFTEENTH", "SIXTEENTH", "SEVENTEENTH", "EIGHTEENTH", "NINETEENTH", "TWENTIETH",
)
_UNIT = r"(?:\b(?:UNIT|APT|APARTMENT|STE|SUITE|RM|ROOM|SPC|SPACE|BLDG|FL|FLOOR|LOT|TRLR)\b\.? ?#?|#) ?[A-Z]?[0-9]*-?[A-Z]?\b"
_LEAD = r"^(?:(?:RESIDENCE|RES|HOME|SCENE|ADDRESS|LOCATION) ?:|C/O [^,0-9]*(?:,|(?=[0-9]))|(?:AT |THE )*(?:(?:REAR|FRONT|SIDE|IN FRONT) OF|CORNER(?: OF)?|INTERSECTION(?: OF)?)\b|I/?F/?O|NEAR|BEHIND) ?"


def _lookup(c: Column, table: dict[str, tuple[str, ...]]) -> Column:
    flat = [F.lit(x) for k, v in table.items() for w in (k, *v) for x in (w, k)]
    return F.try_element_at(F.create_map(*flat), F.regexp_replace(c, r"\.", ""))


def _ordinal(name: Column) -> Column:
    suffix = lambda i: f"{i}{'TH' if 10 < i < 14 else {1: 'ST', 2: 'ND', 3: 'RD'}.get(i % 10, 'TH')}"
    m = F.create_map(*[F.lit(x) for i, w in enumerate(ORDINALS, 1) for x in (w, suffix(i))])
    return F.coalesce(F.try_element_at(m, name), name)


def _street(s: Column) -> Column:
    """``struct(dir, name, type, rest)`` of a street; broken words of the name are joined, missing parts are empty."""
    d, t = "|".join(w for k, v in DIRECTIONS.items() for w in (k, *v)), "|".join(w for k, v in TYPES.items() for w in (k, *v))
    p = rf"^(?:({d})\.? )?(.+?)(?: ({t})\.?(?: (.+))?)?$"
    x = lambda g: F.regexp_extract(s, p, g)
    none = F.lit("")
    return F.struct(
        F.coalesce(_lookup(x(1), DIRECTIONS), none).alias("dir"),
        _ordinal(F.regexp_replace(x(2), r"[^\p{L}\p{N}]", "")).alias("name"),
        F.coalesce(_lookup(x(3), TYPES), none).alias("type"), x(4).alias("rest"))


def _city(c: Column) -> Column:
    s = F.trim(F.regexp_replace(F.regexp_replace(F.upper(c), r"[^\p{L}\p{N} ]", " "), r"\s+", " "))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^(?:N|NO) ", "NORTH "), r"^(?:S|SO) ", "SOUTH "), r"^PT ", "PORT ")


def parse_addresses(df: DataFrame, address: str = "address", city: str = "city", zip_code: str = "zip") -> DataFrame:
    """Adds ``kind`` (``house``, ``crossing`` or null), ``num``, two streets (``d1 n1 t1 d2 n2 t2``), ``pcity`` and ``pzip``.

    Component order, case, punctuation, prefixes (``REAR OF``), units, spelled
    ordinals and abbreviations don't matter; a city written into the address
    stands in for a missing city. The streets of a crossing are sorted by name.
    What is missing is the empty string. Text with neither a house number nor
    two streets has a null ``kind``.
    """
    s = F.trim(F.regexp_replace(F.upper(F.col(address)), r"[\s ]+", " "))
    s = F.trim(F.regexp_replace(F.regexp_replace(s, _LEAD, ""), _LEAD, ""))
    s = F.regexp_replace(F.regexp_replace(s, _UNIT, " "), r"\bNO\. ?(?=[0-9])", "")
    df = df.withColumn("_s", F.trim(F.regexp_replace(s, r" +", " ")))
    number = r"(?:^|[ ,])([0-9]+(?:-?[A-Z])?)(?=$|[ ,.])"
    df = df.withColumn("num", F.regexp_replace(F.regexp_extract("_s", number, 1), "^0+(?=[0-9])", ""))
    rest = F.regexp_replace("_s", r"(?:^|(?<=[ ,]))[0-9]+(?:-?[A-Z])?(?=$|[ ,.])", " ")
    segs = F.filter(F.transform(F.split(rest, ","), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"[.;:]", " "), r" +", " "))), lambda x: x != "")
    df = df.withColumn("_g", segs)
    first = F.coalesce(F.get("_g", F.lit(0)), F.lit(""))
    df = df.withColumns({"_first": first, "_x": F.split(first, r" ?(?:&|/|@|\+| AND | AT ) ?")})
    crossing = (F.col("num") == "") & (F.size("_x") == 2)
    one = _street(F.regexp_replace("_first", r" (?:AND|AT) ", r" $0"))
    a, b = _street(F.get("_x", F.lit(0))), _street(F.get("_x", F.lit(1)))
    df = df.withColumns({"_one": one, "_a": a, "_b": b, "kind": F.when(crossing, "crossing").when((F.col("num") != "") & (one["name"] != ""), "house")})
    swap = F.col("_a.name") > F.col("_b.name")
    cols = {}
    for k, short in (("dir", "d"), ("name", "n"), ("type", "t")):
        lo = F.when(swap, F.col(f"_b.{k}")).otherwise(F.col(f"_a.{k}"))
        hi = F.when(swap, F.col(f"_a.{k}")).otherwise(F.col(f"_b.{k}"))
        cols[f"{short}1"] = F.when(F.col("kind") == "crossing", lo).otherwise(F.col(f"_one.{k}"))
        cols[f"{short}2"] = F.when(F.col("kind") == "crossing", hi).otherwise(F.lit(""))
    tail = F.when(F.size("_g") > 1, F.element_at("_g", -1)).otherwise(F.coalesce(F.when(F.col("kind") == "crossing", F.col("_b.rest")).otherwise(F.col("_one.rest")), F.lit("")))
    cols["pcity"] = _city(F.when(is_missing(F.col(city)), tail).otherwise(F.col(city)))
    cols["pzip"] = F.when(is_missing(F.col(zip_code)), "").otherwise(F.regexp_extract(F.col(zip_code), "([0-9]{5})", 1))
    return df.withColumns(cols).drop("_s", "_g", "_first", "_x", "_one", "_a", "_b")


def _typo(a: Column, b: Column) -> Column:
    """One wrong, missing, additional or transposed letter at most."""
    letters = lambda x: F.array_join(F.array_sort(F.split(x, "")), "")
    d = F.levenshtein(a, b, 2)
    swapped = (d == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b))
    return (a == b) | (d.between(0, 1) & (F.least(F.length(a), F.length(b)) >= 4)) | (swapped & (F.length(a) >= 4))


def _either(a: Column, b: Column) -> Column:
    return (a == "") | (b == "") | (a == b)


def _variants(c: Column) -> Column:
    """Hashes that any two texts of ``_typo`` share: the text, from four letters on each text with one letter left out, and its letters in order."""
    n = F.length(c)
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, n))))
    letters = F.xxhash64(F.concat(F.lit("="), F.array_join(F.array_sort(F.split(c, "")), "")))
    return F.array_distinct(F.when(n >= 4, F.concat(F.array(F.xxhash64(c), letters), less)).otherwise(F.array(F.xxhash64(c))))


def _similar(values: DataFrame, near: Column, v: Column, keep: list[str]) -> DataFrame:
    """Distinct pairs ``a``, ``b`` of the structs ``x`` of ``values`` that agree in ``keep``, share one of the hashes ``v`` and are ``near``; each struct with itself too."""
    e = values.select(*keep, "x", F.explode(v).alias("_v"))
    pairs = e.withColumnRenamed("x", "a").join(e.withColumnRenamed("x", "b"), [*keep, "_v"]).filter(F.col("a") != F.col("b")).select("a", "b").distinct().filter(near)
    return pairs.unionByName(values.select(F.col("x").alias("a"), F.col("x").alias("b")))


def _names(a: str, b: str) -> Column:
    """Whether the street names of two parsed addresses agree."""
    x = lambda c: F.col(f"{a}.{c}")
    y = lambda c: F.col(f"{b}.{c}")

    def name(i: int) -> Column:
        # Two spellings that both are common street names are two streets, however close.
        rare = F.least(x(f"f{i}"), y(f"f{i}")) <= F.greatest(F.lit(RARE_NAME), RARE_SHARE * F.greatest(x(f"f{i}"), y(f"f{i}")))
        digits = F.regexp_replace(x(f"n{i}"), r"\P{N}", "") == F.regexp_replace(y(f"n{i}"), r"\P{N}", "")
        return (x(f"n{i}") == y(f"n{i}")) | (_typo(x(f"n{i}"), y(f"n{i}")) & rare & digits)

    return name(1) & name(2)


PARTS = ["kind", "num", "d1", "n1", "t1", "d2", "n2", "t2", "pcity", "pzip"]
STREET = ["kind", "num", "n1", "n2"]
SIDES = ["d1", "t1", "d2", "t2"]


def _roots(anchor: DataFrame) -> DataFrame:
    """``(key, to)`` with every path of anchors followed to its end.

    An anchor ranks above what it anchors, so paths end. Only keys whose anchor
    has another one are followed; paths are doubled each time, so a path of n
    steps takes log2(n) rounds.
    """
    while True:
        onward = anchor.filter("key <> to").select(F.col("key").alias("to"), F.col("to").alias("next"))
        longer = cut(anchor.join(onward, "to").select("key", F.col("next").alias("to")))
        if longer.isEmpty():
            return anchor
        anchor = cut(anchor.join(longer.select("key", F.col("to").alias("_to")), "key", "left").select("key", F.coalesce("_to", "to").alias("to")))


def locations(written: DataFrame) -> DataFrame:
    """``(written, location)`` for parsed written addresses; ``location`` names the anchor of its group.

    Writings are merged to distinct component tuples. Two tuples agree if kind
    and number are equal, names are equal or one letter or transposition apart,
    directions and types equal or missing, and the places agree: cities one
    letter apart (two under the same code); without both cities the codes (one
    digit may be wrong); without both codes too, the streets must be spelled
    alike. Units don't count. Of all tuples it agrees with, itself included, a
    tuple takes the one with the most widespread street name, then the most
    complete, then the most frequent as its anchor; anchors are followed to the end.
    Linking to anchors rather than through chains keeps a writing without type
    or direction from joining two streets.

    Every agreeing tuple is considered, however many writings a building has:
    similar names, cities and codes share a hash of the text with one letter
    left out or of its letters in order, so all are found by equi-joins over
    distinct values. Pairs of tuples are not listed: each street with its sides
    offers its best tuple by city, by code and by what is missing, offers pass to
    the similar streets, and a tuple asks for the values similar to its own.
    """
    t = written.groupBy(*PARTS).agg(F.count("*").alias("cnt"))
    spread = t.select(F.explode(F.array(*[F.struct(F.col(f"n{i}").alias("name"), "num", "pcity") for i in (1, 2)])).alias("_n")).filter("_n.name <> ''").groupBy("_n.name").agg(F.count_distinct("_n.num", F.when(F.col("_n.num") == "", F.col("_n.pcity")).otherwise("")).alias("f"))
    for i in (1, 2):
        t = t.join(spread.select(F.col("name").alias(f"n{i}"), F.col("f").alias(f"f{i}")), f"n{i}", "left")
    full = reduce(lambda a, b: a + b, [(F.col(c) != "").cast("int") for c in ("d1", "t1", "d2", "t2", "pcity", "pzip")])
    t = t.withColumns({"f1": F.coalesce("f1", F.lit(0)), "f2": F.coalesce("f2", F.lit(0)), "key": F.concat_ws("|", *PARTS), "street": F.concat_ws("|", *STREET, *SIDES)})
    best = F.struct(F.struct((F.col("f1") + F.col("f2")).alias("f"), full.alias("full"), "cnt").alias("rank"), F.col("key").alias("to"))
    t = cut(t.select(*PARTS, "f1", "f2", "key", "street", best.alias("best")))

    names = t.select(F.struct(*STREET, "f1", "f2").alias("x")).distinct().select(F.col("x.kind").alias("kind"), F.col("x.num").alias("num"), "x")
    both = F.flatten(F.transform(_variants(F.col("x.n1")), lambda p: F.transform(_variants(F.col("x.n2")), lambda r: F.xxhash64(p, r))))
    alike = _similar(names, _names("a", "b"), both, ["kind", "num"])
    forms = t.select(*STREET, *SIDES, "street").distinct()
    mine = forms.select(*STREET, F.struct("street", *SIDES).alias("p"))
    other = forms.select(*[F.col(c).alias(f"o_{c}") for c in STREET], F.struct("street", *SIDES).alias("o"))
    streets = alike.select(*[F.col(f"a.{c}").alias(c) for c in STREET], *[F.col(f"b.{c}").alias(f"o_{c}") for c in STREET]).join(mine, STREET).join(other, [f"o_{c}" for c in STREET]).filter(
        reduce(lambda a, b: a & b, [_either(F.col(f"p.{c}"), F.col(f"o.{c}")) for c in SIDES])).select(
        F.col("p.street").alias("street"), F.col("o.street").alias("of"), ((F.col("n1") == F.col("o_n1")) & (F.col("n2") == F.col("o_n2"))).alias("exact"))

    # A tuple that stands alone on its street and the similar ones is its own anchor; the others are few, and only they go on.
    alone = t.groupBy(F.col("street").alias("of")).agg(F.count("*").alias("_n"))
    streets = cut(streets.join(alone, "of").withColumn("_all", F.sum("_n").over(Window.partitionBy("street"))).filter("_all > 1").select("street", "of", "exact"))
    every, t = t, t.join(streets.select("street").distinct(), "street", "left_semi")

    city, code = F.col("pcity") != "", F.col("pzip") != ""
    lacks = F.concat(F.when(city, "c").otherwise("-"), F.when(code, "z").otherwise("-"))
    # How a tuple offers itself and what it asks for: "c" similar cities, "z" similar codes where a city is missing ("z0" offered by tuples
    # without a city), "b" the same code with a city two letters away, "k" tuples of the same spelling that share neither cities nor codes.
    key = lambda how, value, name=F.lit(""): F.struct(F.lit(how).alias("how"), value.alias("value"), name.alias("name"))
    listed = lambda *ks: F.filter(F.array(*ks), lambda k: k.isNotNull())
    offers = listed(
        F.when(city, key("c", F.col("pcity"))), F.when(code & city, key("z1", F.col("pzip"))), F.when(code & ~city, key("z0", F.col("pzip"))),
        F.when(city & code, key("b", F.col("pzip"), F.col("pcity"))), key("k", lacks))
    own = t.select("street", "best", F.explode(offers).alias("_o")).select("street", "best", "_o.*").groupBy(F.col("street").alias("of"), "how", "value", "name").agg(F.max("best").alias("best"))
    offered = own.join(streets, "of").filter((F.col("how") != "k") | F.col("exact")).groupBy("street", "how", "value", "name").agg(F.max("best").alias("best"))

    values = t.select(F.explode(F.array(F.struct(F.lit("c").alias("part"), F.col("pcity").alias("value")), F.struct(F.lit("z").alias("part"), F.col("pzip").alias("value")))).alias("x")).filter("x.value <> ''").distinct().withColumn("part", F.col("x.part"))
    near = _similar(values, _typo(F.col("a.value"), F.col("b.value")), _variants(F.col("x.value")), ["part"]).select(F.col("a.part").alias("part"), F.col("a.value").alias("own"), F.col("b.value").alias("value"))
    ask = lambda part, value, *hows: F.struct(F.lit(part).alias("part"), value.alias("own"), F.array(*map(F.lit, hows)).alias("hows"))
    asks = listed(F.when(city, ask("c", F.col("pcity"), "c")), F.when(code & city, ask("z", F.col("pzip"), "z0")), F.when(code & ~city, ask("z", F.col("pzip"), "z0", "z1")))
    similar = t.select("key", "street", "pcity", F.explode(asks).alias("_a")).select("key", "street", "pcity", "_a.*").join(near, ["part", "own"]).select("key", "street", "pcity", F.explode("hows").alias("how"), "value")
    without = F.when(lacks == "--", F.array(*map(F.lit, ("--", "c-", "-z", "cz")))).when(lacks == "c-", F.array(F.lit("--"), F.lit("-z"))).when(lacks == "-z", F.array(F.lit("--"), F.lit("c-"))).otherwise(F.array(F.lit("--")))
    plain = t.select("key", "street", "pcity", F.lit("k").alias("how"), F.explode(without).alias("value"))
    same = t.filter(city & code).select("key", "street", "pcity", F.lit("b").alias("how"), F.col("pzip").alias("value"))
    asked = similar.unionByName(plain).unionByName(same).join(offered, ["street", "how", "value"]).filter((F.col("how") != "b") | F.levenshtein("pcity", "name", 2).between(0, 2))
    anchor = asked.select("key", "best").unionByName(every.select("key", "best")).groupBy("key").agg(F.max("best").alias("best")).select("key", F.col("best.to").alias("to"))
    location = _roots(cut(anchor)).withColumnRenamed("to", "location")
    return written.withColumn("key", F.concat_ws("|", *PARTS)).join(location, "key").select("written", "location")


def written_addresses(df: DataFrame, groups: list[tuple[str, str, str]]) -> DataFrame:
    """Distinct ``(written, address, city, zip)`` of several address column groups; ``written`` is ``address|city|zip`` as it stands."""
    parts = F.explode(F.array(*[F.struct(F.col(a).alias("address"), F.coalesce(c, F.lit("")).alias("city"), F.coalesce(z, F.lit("")).alias("zip")) for a, c, z in groups]))
    w = df.select(parts.alias("_p")).select("_p.*").filter(~is_missing(F.col("address"))).distinct()
    return w.withColumn("written", F.concat_ws("|", "address", "city", "zip")).dropDuplicates(["written"])


def location_members(df: DataFrame, groups: list[tuple[str, str, str]]) -> DataFrame:
    """``(written, location, n_links)``: each written address with its location and the number of other writings there.

    The compact form of ``same_location_pairs``: one row an address, however many
    share a location.
    """
    loc = locations(cut(parse_addresses(written_addresses(df, groups)).filter(F.col("kind").isNotNull())))
    return loc.join(loc.groupBy("location").agg((F.count("*") - 1).alias("n_links")), "location").select("written", "location", "n_links")


def same_location_pairs(df: DataFrame, groups: list[tuple[str, str, str]]) -> DataFrame:
    """``(address_a, address_b)``: pairs of different written addresses of one location, smaller string first.

    Missing addresses (null, blank, placeholders) and addresses without a house
    number or a crossing have no location. Repeated rows, null cities and codes
    are harmless; an empty table gives no rows.
    """
    parsed = cut(parse_addresses(written_addresses(df, groups)).filter(F.col("kind").isNotNull()))
    loc = locations(parsed)
    a, b = loc.select(F.col("written").alias("address_a"), "location"), loc.select(F.col("written").alias("address_b"), "location")
    return a.join(b, "location").filter("address_a < address_b").select("address_a", "address_b")
