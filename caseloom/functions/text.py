"""Text, category and key normalisation as column expressions (no UDFs)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEARCH_FIELDS = ("CauseA", "CauseB", "CauseC", "CauseD", "CauseOther", "OtherCause", "HowInjuryOccurred", "InjuryDesc")
# Race groups and what is folded into them.
RACE_GROUPS = {
    "AMERICAN INDIAN": ("americanindian", "nativeamerican"),
    "MIDDLE EASTERN": ("armenian", "middleeastern"),
    "ASIAN": ("asian", "cambodian", "chinese", "filipino", "japanese", "korean", "eastindian", "thai", "vietnamese"),
    "BLACK": ("black",),
    "PACIFIC ISLANDER": ("guamanian", "hawaiian", "pacificislander", "samoan", "tongan", "nativehawaiian/otherpacificislander"),
    "LATINE": ("hispanic/latino", "hispanic/latina", "hispanic/latinamerican"),
    "WHITE": ("white", "caucasian", "white/caucasian"),
}
RACE_UNKNOWN = ("unknown", "null", "unknown/other")
# Substrings that decide a race bucket, first hit wins.
RACE_BUCKETS = (
    ("HISPANIC", "LATINE"), ("LATIN", "LATINE"), ("CAUCASIAN", "WHITE"), ("WHITE", "WHITE"), ("BLACK", "BLACK"), ("AFRICANAMERICAN", "BLACK"),
    ("AMERICANINDIAN", "AMERICAN INDIAN"), ("NATIVEAMERICAN", "AMERICAN INDIAN"), ("PACIFICISLANDER", "PACIFIC ISLANDER"), ("ASIAN", "ASIAN"), ("MIDDLEEASTERN", "MIDDLE EASTERN"),
)
GENDERS = {"M": "MALE", "MALE": "MALE", "F": "FEMALE", "FEMALE": "FEMALE"}
NULL_KEYS = ("", "NULL", "NAN", "NONE", "N/A", "NA", "UNKNOWN", "UNKNOWNOTHER", "OTHER")
NULL_KEY_WORDS = r"\b(NULL|NONE|NAN|N/?A|TRUE|FALSE|UNKNOWN|PENDING|DEFERRED)\b"


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_text(c: Column) -> Column:
    """Null as empty text, line breaks and the word NULL as a blank."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\n\r]", " "), r"(?iu)\bNULL\b", " ")


def clean_model_text(c: Column) -> Column:
    """The model's text form: upper case, single blanks, no NULL words, ", " as a blank. Idempotent."""
    s = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\n\r]", " "), r"(?iu)\bNULL\b", " ")
    return F.trim(F.regexp_replace(F.upper(F.replace(s, F.lit(", "), F.lit(" "))), r"[\s ]+", " "))


def row_text(df: DataFrame, fields: tuple[str, ...] = SEARCH_FIELDS) -> Column:
    """The non-blank search fields that the frame has, joined by " | "."""
    parts = [normalize_text(col(f)) for f in fields if f in df.columns]
    return F.concat_ws(" | ", *[F.when(F.trim(p) != "", p) for p in parts]) if parts else F.lit("")


def cause_text(df: DataFrame, fields: tuple[str, ...] = SEARCH_FIELDS) -> Column:
    """The model text of a record: trimmed non-empty fields joined by ", ", then cleaned. Fails if no field exists."""
    have = [f for f in fields if f in df.columns]
    if not have:
        raise ValueError(f"none of the text fields {fields} is present")
    trimmed = [F.trim(col(f)) for f in have]
    return clean_model_text(F.concat_ws(", ", *[F.when(t != "", t) for t in trimmed]))


def race_group(c: Column) -> Column:
    """Race folded into seven groups; of several the first known one; unknown as null, other text kept lower-cased."""
    s = F.replace(F.regexp_replace(F.lower(c), r"\n", ""), F.lit(" "), F.lit(""))
    known = F.filter(F.split(s, ","), lambda p: ~p.isin(*RACE_UNKNOWN))
    one = F.when(s.contains(","), F.coalesce(F.get(known, F.lit(0)), F.lit("unknown/other"))).otherwise(s)
    out = F.when(one.isin(*RACE_UNKNOWN), None)
    for group, names in RACE_GROUPS.items():
        out = out.when(one.isin(*names), group)
    return out.otherwise(one)


def race_labels(c: Column, labels: tuple[str, ...] = ("Hispanic/Latino", "White", "Black", "Asian", "Pacific Islander", "American Indian", "Middle Eastern", "Unknown/Other")) -> Column:
    """A comma list of races in canonical spelling, each once, in order."""
    parts = F.transform(F.split(F.regexp_replace(c, r"\s+", " "), ","), lambda p: F.trim(p))
    canon = F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.coalesce(*[F.when(F.upper(p) == x.upper(), F.lit(x)) for x in labels], p))
    return F.array_join(F.array_distinct(canon), ",")


def mode_clean(c: Column) -> Column:
    """Manner of death without line breaks, upper case; the cut-off UNDETERMI completed."""
    s = F.upper(F.trim(F.replace(c, F.lit("\n"), F.lit(""))))
    return F.when(s == "UNDETERMI", "UNDETERMINED").otherwise(s)


def race_whitelist(c: Column) -> Column:
    """Upper-cased race if it is one of the groups, else null."""
    s = F.upper(F.trim(F.replace(c, F.lit("\n"), F.lit(""))))
    return F.when(s.isin(*RACE_GROUPS), s)


def gender_clean(c: Column) -> Column:
    """MALE or FEMALE, anything else null."""
    s = F.upper(F.trim(F.replace(c, F.lit("\n"), F.lit(""))))
    return F.coalesce(*[F.when(s == k, F.lit(v)) for k, v in GENDERS.items()])


def plain_key(c: Column) -> Column:
    """The letters and digits of a value without words that mean nothing; null if none are left."""
    return plain_word(plain_text(c))


def plain_text(c: Column) -> Column:
    """The first half of ``plain_key``: letters and digits only, also where they say nothing."""
    return F.regexp_replace(F.regexp_replace(F.upper(c), NULL_KEY_WORDS, " "), "[^A-Z0-9]", "")


def plain_word(k: Column) -> Column:
    """The second half of ``plain_key``: null for keys that mean nothing."""
    return F.when(~k.isin(*NULL_KEYS), k)


def vote_key(column: Column, c: Column, k: Column) -> Column:
    """The key under which values of a named column count as the same vote; null where there is no information.

    ``k`` is the value's ``plain_key``, as a column of its own: it is used many times.
    """
    keys = lambda name: column_key(name, c, k)
    return (
        F.when(column.isin("DeathDate", "DateofBirth"), keys("DeathDate"))
        .when(column == "Age", keys("Age"))
        .when(column.isin("DeathZip", "EventZip"), keys("DeathZip"))
        .when(column == "Gender", keys("Gender"))
        .when(column == "Race", keys("Race"))
        .otherwise(k))


def column_key(name: str, c: Column, k: Column) -> Column:
    """``vote_key`` of one column by its name."""
    from caseloom.functions.dates import parse_mixed_date

    if name in ("DeathDate", "DateofBirth"):
        return parse_mixed_date(c).cast("string")
    if name == "Age":
        return F.nullif(F.regexp_extract(F.upper(c), r"(\d+)", 1), F.lit(""))
    if name in ("DeathZip", "EventZip"):
        return zip5(F.upper(c))
    if name == "Gender":
        return F.when(k == "F", "FEMALE").when(k == "M", "MALE").otherwise(k)
    if name == "Race":
        race = F
        for part, bucket in RACE_BUCKETS:
            race = race.when(k.contains(part), bucket)
        return race.otherwise(k)
    return k


def zip5(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.regexp_replace(c, r"\.0$", ""), r"(\d{5})", 1), F.lit(""))


def age_number(c: Column) -> Column:
    """The first run of digits as a number."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).cast("double")


def cell_value(c: Column) -> Column:
    """A value for cell comparison: null as empty, whole decimals as whole numbers, otherwise trimmed text."""
    s = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.regexp_replace(s, r"^(-?\d+)\.0+$", "$1")


def fold_accents() -> tuple[str, str]:
    """Accented Latin letters and their plain forms, for ``translate`` (built from Unicode decompositions)."""
    pairs = [(chr(i), unicodedata.normalize("NFKD", chr(i))[0]) for i in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def clean_address(c: Column) -> Column:
    """An address fit for geocoding: plain letters, single blanks, no units after #, no care-of, tidy commas."""
    a, b = fold_accents()
    s = F.translate(F.regexp_replace(c, r"[ \p{Cntrl}\s]+", " "), a, b)
    s = F.regexp_replace(F.regexp_replace(s, r"[^\x20-\x7E]", " "), r"[\"'`*;:!?<>{}\[\]|\\]", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"(?i)\bc/o\b", " "), r"#\s*\S+", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"\s+", " "), r"\s*,(?:\s*,)*\s*", ", ")
    return F.nullif(F.regexp_replace(F.trim(s), r"^,\s*|,\s*$", ""), F.lit(""))


def full_address(address: Column, city: Column, zip_code: Column) -> Column:
    """"address, city, zip" of what is known; null where the address itself is missing or unknown."""
    ok = lambda c: F.when(~F.lower(F.trim(c)).isin("", "unknown", "null", "nan"), F.regexp_replace(F.trim(c), r"\.0$", ""))
    a = F.regexp_replace(ok(address), r"(?i)\s*(?:#|\bunit\b|\bapt\b).*?(?=,|$)", "")
    return F.when(a.isNotNull(), F.concat_ws(", ", a, ok(city), ok(zip_code)))


def stop_filtered(c: Column, stop: tuple[str, ...]) -> Column:
    """The comma-separated words of a text without stop words."""
    return F.filter(F.transform(F.split(F.lower(c), r"[,\s]+"), lambda w: F.trim(w)), lambda w: (w != "") & ~w.isin(*stop))


def drop_frequent(a: Column, most: int = 5) -> Column:
    """Array elements that occur at most ``most`` times, order kept."""
    return F.filter(a, lambda x: F.size(F.filter(a, lambda y: y == x)) <= most)


def truthy(c: Column) -> Column:
    """Whether a flag is set, however it is written."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "t", "y", "yes"), F.lit(False))


def clean_cell(c: Column) -> Column:
    """A cell with single blanks, and the word NULL where nothing is known."""
    s = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(c.isNull() | F.upper(F.trim(c)).isin("", "NULL", "NAN", "NONE"), "NULL").otherwise(s)
