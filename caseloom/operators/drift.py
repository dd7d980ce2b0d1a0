"""Schemas that drift between files: a catalogue of column lifespans."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.dates import parse_mixed_date
from caseloom.functions.text import age_number, zip5
from caseloom.functions.values import case_key
from caseloom.session import cut

# Canonical fields and the names they go by.
ALIASES: dict[str, tuple[str, ...]] = {
    "CaseNumber": ("CaseNum", "Case Number", "Case#", "case_no", "ME Case No."),
    "ResidenceType": ("ResType", "Residence Type"),
    "DeathDate": ("Date of Death", "Death Date", "DateOfDeath", "DOD"),
    "DeathTime": ("Time of Death", "Death Time", "TimeofDeath"),
    "DeathPlace": ("Death Place",),
    "DeathAddress": ("DeathAddr", "DeathAdress", "DeathAddr.1", "address.death", "DeathAdress.1", "Death Address"),
    "DeathZip": ("DeathZip.1", "DeathZipCode", "DeathZi\np", "Zip", "Death Zip", "PostalCodeOfDeath"),
    "DeathCity": ("Death City", "DeathCityDesc"),
    "EventPlace": ("Event Place",),
    "EventAddress": ("EventAddr", "EventAddr.1", "eventaddress", "Event Address"),
    "EventZip": ("EventZip.1", "EventZi\np", "EventZipCode", "Zip.1", "Event Zip"),
    "EventCity": ("EventCityDesc", "Event City"),
    "Mode": ("Mode.1", "Manner"),
    "CauseA": ("Cause A", "DeathCauseA"),
    "CauseB": ("Cause B", "DeathCauseB"),
    "CauseC": ("Cause C", "DeathCauseC"),
    "CauseD": ("Cause D", "DeathCauseD"),
    "CauseOther": ("Other Cause", "OtherCause"),
    "HowInjuryOccurred": ("InjuryDesc", "HowInjuryOccu\nrred", "Injury Narrative", "injury_description"),
    "FirstName": ("First Name",),
    "MiddleName": ("Middle Name",),
    "LastName": ("Last Name",),
    "DateofBirth": ("Date of Birth", "BirthDate"),
    "Race": ("Races",),
    "Gender": ("Sex",),
    "Age": ("AgeYears",),
    "Fentanyl": ("fentanyl_flag",),
    "SourcePages": ("Pages",),
}


# The type of each canonical field in the consistent table; fields not listed are text.
TYPES: dict[str, str] = {
    "CaseNumber": "case number",
    "DeathDate": "date",
    "DateofBirth": "date",
    "DeathZip": "zip",
    "EventZip": "zip",
    "Age": "number",
    "Fentanyl": "flag",
}
SIMILAR = 0.5  # least likeness of two fields' contents to be one field under another name
SIDE = "struct<field:string,kind:string,canonical:string,file:bigint>"


def plain_name(name: str) -> str:
    """A field name without case, white space and punctuation other than a trailing ``.1``."""
    return re.sub(r"[^a-z0-9.#]", "", name.lower())


def canonical_name(field: Column, aliases: dict[str, tuple[str, ...]] = ALIASES) -> Column:
    """The canonical field a name stands for; a name no alias covers stands for itself without case and blanks."""
    table = {plain_name(a): c for c, names in aliases.items() for a in (c, *names)}
    short = F.regexp_replace(F.lower(field), r"[^a-z0-9.#]", "")
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, short), short)


def json_kind(schema: Column) -> Column:
    """JSON type of a variant's schema string; null for JSON null."""
    return (
        F.when(schema == "VOID", None).when(schema == "BIGINT", "whole number").when(schema.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$"), "whole number")
        .when(schema.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "decimal number").when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("ARRAY"), "array").when(schema.startswith("OBJECT"), "object").otherwise("string")
    )


def _cells(rows: DataFrame, feed: str, file_no: str, record: str) -> DataFrame:
    """``(feed, file, field, variant)`` of every field of every usable record."""
    v = rows.select(F.col(feed).alias("feed"), F.col(file_no).cast("long").alias("file"), F.try_parse_json(F.col(record)).alias("_v")).filter(F.schema_of_variant("_v").startswith("OBJECT"))
    return v.select("feed", "file", F.explode(F.expr("try_variant_get(_v, '$', 'map<string, variant>')")).alias("field", "x"))


def field_catalogue(rows: DataFrame, feed: str = "feed", file_no: str = "file_no", record: str = "record") -> DataFrame:
    """The footer metadata of JSON extracts: ``(feed, file_no, field, kind, n_rows, n_values, ord, next_file, canonical)``.

    One row for each field of each file. ``kind`` is the most frequent JSON type
    of its non-null values (ties by name; null if all are null), ``ord`` numbers
    the files of a feed. Broken records, null records and records that are no
    objects are ignored; a file without any usable record keeps its place in the
    order. Aggregation is partial, so a hot feed shrinks to its fields before it
    moves.
    """
    w = Window.partitionBy("feed").orderBy("file")
    files = rows.select(F.col(feed).alias("feed"), F.col(file_no).cast("long").alias("file")).distinct().withColumns({"ord": F.row_number().over(w), "next_file": F.lead("file").over(w)})
    kinds = _cells(rows, feed, file_no, record).groupBy("feed", "file", "field", F.coalesce(json_kind(F.schema_of_variant("x")), F.lit("")).alias("kind")).count()
    one = kinds.groupBy("feed", "file", "field").agg(
        F.max_by(F.when(F.col("kind") != "", F.col("kind")), F.when(F.col("kind") != "", F.struct(F.col("count"), F.col("kind")))).alias("kind"),
        F.sum("count").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("kind") != "", F.col("count"))), F.lit(0)).alias("n_values"))
    named = one.join(files, ["feed", "file"]).withColumn("canonical", canonical_name(F.col("field")))
    own = dict(rows.dtypes)[file_no]
    return named.select(F.col("feed").alias(feed), F.col("file").cast(own).alias(file_no), "field", "kind", "n_rows", "n_values", "ord", F.col("next_file").cast(own).alias("next_file"), "canonical")


def lifespans(catalogue: DataFrame, feed: str = "feed", file_no: str = "file_no") -> DataFrame:
    """Islands of successive files in which a field of a feed keeps its type.

    ``(feed, field, kind, canonical, first_file, last_file, n_files, first_ord,
    next_file)``; ``next_file`` is the feed's file after the last one, null if
    there is none. In a file whose values are all null a field has the kind
    ``null``.
    """
    w = Window.partitionBy(feed, "field", "_kind").orderBy("ord")
    c = catalogue.withColumn("_kind", F.coalesce("kind", F.lit("null")))
    c = c.withColumn("_new", (F.col("ord") - F.lag("ord").over(w) != 1) | F.lag("ord").over(w).isNull())
    c = c.withColumn("_island", F.sum(F.col("_new").cast("int")).over(w))
    return c.groupBy(feed, "field", F.col("_kind").alias("kind"), "_island").agg(
        F.first("canonical").alias("canonical"), F.min(file_no).alias("first_file"), F.max(file_no).alias("last_file"), F.count("*").alias("n_files"),
        F.min("ord").alias("first_ord"), F.max_by("next_file", "ord").alias("next_file")).drop("_island")


def starts_and_endings(spans: DataFrame, feed: str = "feed") -> DataFrame:
    """``(feed, file, old, new)``: the log of the lifespans, one row for each field of a file in which one of its islands starts or ends.

    An island starts in its first file unless that is the feed's first, and ends
    in the file after its last. ``old`` and ``new`` hold the field's side before
    and in the file (null where it isn't there): both, if only the type changes.
    """
    side = lambda file: F.struct(F.col("field"), F.col("kind"), F.col("canonical"), F.col(file).cast("long").alias("file")).cast(SIDE)
    none = F.lit(None).cast(SIDE)
    log = spans.select(F.col(feed).alias("feed"), "field", F.explode(F.filter(F.array(
        F.when(F.col("first_ord") > 1, F.struct(F.col("first_file").cast("long").alias("file"), none.alias("old"), side("first_file").alias("new"))),
        F.when(F.col("next_file").isNotNull(), F.struct(F.col("next_file").cast("long").alias("file"), side("last_file").alias("old"), none.alias("new"))),
    ), lambda x: x.isNotNull())).alias("_s")).select("feed", "field", "_s.*")
    return log.groupBy("feed", "file", "field").agg(F.max("old").alias("old"), F.max("new").alias("new")).drop("field")


def _likeness(rows: DataFrame, open_sides: DataFrame, feed: str, file_no: str, record: str) -> DataFrame:
    """``(feed, file, old_field, new_field)``: endings and starts of one file that are each other's best match by content.

    The contents of a field in a file are its shares of word patterns (letters
    and figures) and of words, over all its values read whole; names of members
    of objects don't count. Likeness is the common share, averaged over both.
    """
    text = F.lower(F.regexp_replace(F.regexp_replace(F.to_json("x"), r'"(?:[^"\\]|\\.)*"\s*:', " "), r"(?<=[0-9])\.0+(?![0-9])", ""))
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    shape = F.array_join(F.transform(words, lambda w: F.regexp_replace(F.regexp_replace(w, r"\p{L}+", "a"), r"\p{N}", "9")), " ")
    data = _cells(rows, feed, file_no, record).join(open_sides.select("feed", F.col("data_file").alias("file"), "field").distinct(), ["feed", "file", "field"]).filter(F.to_json("x") != "null")
    facts = data.select("feed", F.col("file").alias("data_file"), "field", F.explode(F.concat(F.array(F.struct(F.lit("s").alias("part"), shape.alias("fact"))), F.transform(words, lambda w: F.struct(F.lit("w").alias("part"), w.alias("fact"))))).alias("_f"))
    n = facts.groupBy("feed", "data_file", "field", "_f.part", "_f.fact").count()
    total = n.groupBy("feed", "data_file", "field", "part").agg(F.sum("count").alias("total"))
    share = n.join(total, ["feed", "data_file", "field", "part"]).withColumn("share", F.col("count") / F.col("total")).join(open_sides, ["feed", "data_file", "field"])
    key = ["feed", "file", "part", "fact"]
    old = share.filter("side = 'old'").select(*key, F.col("field").alias("old_field"), F.col("share").alias("a"), F.col("known").alias("ka"))
    new = share.filter("side = 'new'").select(*key, F.col("field").alias("new_field"), F.col("share").alias("b"), F.col("known").alias("kb"))
    like = old.join(new, key).filter("not (ka and kb)").groupBy("feed", "file", "old_field", "new_field").agg((F.sum(F.least("a", "b")) / 2).alias("like")).filter(F.round("like", 6) >= SIMILAR)
    best = lambda c, o: F.row_number().over(Window.partitionBy("feed", "file", c).orderBy(F.desc("like"), o))
    return like.withColumns({"_a": best("old_field", "new_field"), "_b": best("new_field", "old_field")}).filter("_a = 1 and _b = 1").select("feed", "file", "old_field", "new_field")


def schema_changes(rows: DataFrame, feed: str = "feed", file_no: str = "file_no", record: str = "record") -> DataFrame:
    """``(feed, file_no, change, old_field, new_field)`` of each file against the file before it in its feed.

    The changes are read off the log of starts and endings of column lifespans.
    A field whose islands of two types meet in a file is ``retyped``. A start
    and an ending in one file are one ``renamed`` if both names stand for one
    canonical field, or, where an alias covers only one of them or none, if
    their contents are each other's best match (see ``_likeness``); if their
    types differ too, they are also ``retyped``. What is left is ``added`` or
    ``removed``. A field whose values are all null has no type and isn't
    retyped. The first file of a feed has no changes; empty tables give none.

    Plan: one pass over the records makes the catalogue, which is as small as
    the fields of all files and is written once; a second pass reads only the
    fields that are still unmatched, if there are any.
    """
    log = starts_and_endings(lifespans(cut(field_catalogue(rows, feed, file_no, record)), feed, file_no), feed)
    either = F.coalesce(F.col("old"), F.col("new"))
    open_ = F.col("old").isNull() | F.col("new").isNull()
    # Endings and starts of one canonical field, in order of their names; rows with both sides take no part in the numbering.
    nth = F.sum(open_.cast("int")).over(Window.partitionBy("feed", "file", either["canonical"], F.col("new").isNull()).orderBy(either["field"]))
    own = F.concat_ws("\u0001", F.lit("f"), F.coalesce(F.col("old.field"), F.lit("")), F.coalesce(F.col("new.field"), F.lit("")))
    key = F.when(open_, F.concat_ws("\u0001", F.lit("c"), either["canonical"], nth.cast("string"))).otherwise(own)
    named = cut(log.withColumn("_k", key).groupBy("feed", "file", "_k").agg(F.max("old").alias("old"), F.max("new").alias("new")).drop("_k"))

    known = either["canonical"].isin(*ALIASES)
    sides = named.filter(open_).select("feed", "file", F.when(F.col("new").isNull(), "old").otherwise("new").alias("side"), either["field"].alias("field"), either["file"].alias("data_file"), known.alias("known"))
    w = Window.partitionBy("feed", "file")
    has = lambda c: F.max(F.when(c, 1).otherwise(0)).over(w) == 1
    unmatched = sides.withColumns({"_o": has(F.col("side") == "old"), "_n": has(F.col("side") == "new"), "_u": has(~F.col("known"))}).filter("_o and _n and _u").drop("_o", "_n", "_u")
    if not unmatched.isEmpty():
        pairs = cut(_likeness(rows, unmatched, feed, file_no, record))
        mine = lambda side: F.when(F.col(side).isNotNull(), F.col(f"{side}.field"))
        j = named.withColumns({"_of": F.when(open_, mine("old")), "_nf": F.when(open_, mine("new"))})
        j = j.join(pairs.select("feed", "file", F.col("old_field").alias("_of"), F.col("new_field").alias("_to")), ["feed", "file", "_of"], "left")
        j = j.join(pairs.select("feed", "file", F.col("new_field").alias("_nf"), F.col("old_field").alias("_from")), ["feed", "file", "_nf"], "left")
        pair = F.when(F.col("_to").isNotNull(), F.concat_ws("\u0001", F.lit("p"), "_of", "_to")).when(F.col("_from").isNotNull(), F.concat_ws("\u0001", F.lit("p"), "_from", "_nf")).otherwise(own)
        named = j.withColumn("_k", pair).groupBy("feed", "file", "_k").agg(F.max("old").alias("old"), F.max("new").alias("new")).drop("_k")
    typed = (F.col("old.kind") != "null") & (F.col("new.kind") != "null") & (F.col("old.kind") != F.col("new.kind"))
    change = F.filter(F.array(
        F.when(F.col("old").isNull(), "added"), F.when(F.col("new").isNull(), "removed"),
        F.when(F.col("old.field") != F.col("new.field"), "renamed"), F.when(typed, "retyped"),
    ), lambda x: x.isNotNull())
    return named.select(F.col("feed").alias(feed), F.col("file").cast(dict(rows.dtypes)[file_no]).alias(file_no), F.explode(change).alias("change"), F.coalesce("old.field", F.lit("")).alias("old_field"), F.coalesce("new.field", F.lit("")).alias("new_field"))


def _plain_text(v: Column) -> Column:
    """A JSON value as text: objects and arrays as their members, whole decimals as whole numbers."""
    parts = F.transform(F.map_entries(F.from_json(v, "map<string,string>")), lambda e: e["value"])
    return (
        F.when(v.startswith("{") & F.from_json(v, "map<string,string>").isNotNull(), F.array_join(parts, "-")).when(v.startswith("["), F.array_join(F.from_json(v, "array<string>"), "; "))
        .otherwise(F.regexp_replace(v, r"^(-?[0-9]+)\.0+$", "$1")))


def cast_expression(kind: str, v: Column) -> Column:
    """The typed value of a text; null where it can't be read. A code written as a number gets its leading zeros back."""
    flag = F.lower(F.trim(v))
    return {
        "case number": lambda: case_key(v), "date": lambda: parse_mixed_date(v), "zip": lambda: F.coalesce(zip5(v), F.when(F.trim(v).rlike("^[0-9]{3,4}$"), F.lpad(F.trim(v), 5, "0"))), "number": lambda: age_number(v),
        "flag": lambda: F.when(flag.isin("1", "true", "yes", "y"), 1).when(flag.isin("0", "false", "no", "n"), 0),
        "text": lambda: v,
    }[kind]()


def consistent_rows(rows: DataFrame, keep: list[str], record: str = "record", aliases: dict[str, tuple[str, ...]] = ALIASES, types: dict[str, str] = TYPES) -> DataFrame:
    """All records in one table: a typed column for each canonical field, ``_other`` and ``_unread``.

    Columns and casts are generated from the alias table and its types. A
    column takes the first non-null value among its names, the canonical name
    first, then the aliases in their order. Objects are read as their members
    joined by a dash, arrays by ``; ``, whole decimals as whole numbers. Fields
    that no alias covers are kept under their own names in the map ``_other``;
    values that their column's type can't hold are kept in the map ``_unread``,
    so nothing is lost. Broken records give nulls and empty maps, and no row is
    dropped. A projection only: no shuffle.
    """
    names = {c: list(dict.fromkeys(plain_name(a) for a in (c, *n))) for c, n in aliases.items()}
    every = [n for ns in names.values() for n in ns]
    short = lambda k: F.regexp_replace(F.lower(k), r"[^a-z0-9.#]", "")
    out = rows.select(*keep, F.coalesce(F.map_entries(F.from_json(F.col(record), "map<string,string>")), F.array()).cast("array<struct<key:string,value:string>>").alias("_m"))
    first = lambda x, i: x["value"].isNotNull() & (F.array_position(F.transform("_m", lambda y: y["key"]), x["key"]) == i + 1)  # a name may be repeated in a record
    out = out.withColumn("_e", F.transform(F.filter("_m", first), lambda x: F.struct(short(x["key"]).alias("k"), x["key"].alias("key"), _plain_text(x["value"]).alias("v"))))

    def pick(c: str) -> Column:
        mine = F.filter("_e", lambda x: x["k"].isin(*names[c]))
        ranked = F.transform(mine, lambda x: F.struct(F.array_position(F.array(*map(F.lit, names[c])), x["k"]).alias("p"), (x["key"] != c).alias("other"), x["key"].alias("key"), x["v"].alias("v")))
        return F.array_min(ranked)["v"]

    out = out.withColumns({f"_p{i}": pick(c) for i, c in enumerate(aliases)})
    cells = {c: cast_expression(types.get(c, "text"), F.col(f"_p{i}")) for i, c in enumerate(aliases)}
    lost = F.array(*[F.struct(F.lit(c).alias("key"), F.when(cells[c].isNull(), F.col(f"_p{i}")).alias("value")) for i, c in enumerate(aliases) if c in types])
    other = F.map_from_entries(F.transform(F.filter("_e", lambda x: ~x["k"].isin(*every)), lambda x: F.struct(x["key"], x["v"])))
    return out.select(*keep, *[v.alias(c) for c, v in cells.items()], other.alias("_other"), F.map_from_entries(F.filter(lost, lambda x: x["value"].isNotNull())).alias("_unread"))
