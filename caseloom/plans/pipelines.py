"""The named runs over the operators; labelled rows are written once, so that merge plans stay small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import dates, text
from caseloom.functions.text import col
from caseloom.operators import classification, entity, nearby, relations, reports
from caseloom.operators.classification import LABELS, Scorer, zero_scorer
from caseloom.operators.drift import ALIASES
from caseloom.session import cut

ORDER = "_ord"
DROPPED = ("FirstName", "MiddleName", "LastName", "DateofBirth", "CauseC", "CauseD")


def harmonise(df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES, blank_aware: bool = True) -> DataFrame:
    """Aliased columns under their canonical names, the canonical name itself first."""
    return entity.coalesce_aliases(df, {c: (c, *n) for c, n in aliases.items()}, blank_aware)


def labelled(df: DataFrame, scorer: Scorer = zero_scorer, lexicon: dict[str, str] | None = None) -> DataFrame:
    """Text built, scored and corrected; a frame without text columns gets empty text."""
    scored = scorer(df.withColumn("text", text.cause_text(df)))
    return classification.apply_corrections(scored, lexicon=lexicon)


def final_clean(df: DataFrame) -> DataFrame:
    """Manner, race and gender standardised, age as a number, dates as dates; rows in order of death date, unknown last."""
    clean = {"Mode": text.mode_clean, "Gender": text.gender_clean, "Age": text.age_number}
    d = df.withColumns({c: f(F.col(c)) for c, f in clean.items() if c in df.columns})
    if "Race" in df.columns:
        d = d.withColumn("Race", text.race_whitelist(text.race_group(F.col("Race"))))
    if "DeathDate" in df.columns:
        d = d.withColumn("DeathDate", dates.rescue_date(F.col("DeathDate"))).orderBy(F.asc_nulls_last("DeathDate"))
    return d


def surveillance(records: DataFrame, cache: DataFrame | None = None, history: DataFrame | None = None, regions: DataFrame | None = None, inside=None, scorer: Scorer = zero_scorer, lexicon: dict[str, str] | None = None, key: str = "CaseNumber", keep_names: bool = False) -> DataFrame:
    """From raw records to the final overdose table.

    Harmonise, label, keep ``Any Drugs``, geocode through the address cache,
    merge to one row a case (ties: last), fill gaps from history, attach the
    regions that hold each point, clean. ``records`` need an order column
    ``_ord``. A point in two regions gives two rows, as the spatial join does;
    they are merged again by completeness. Two shuffles by key (merge,
    backfill) and the joins of cache and regions.
    """
    d = cut(labelled(harmonise(records), scorer, lexicon)).filter(col("Any Drugs") != 0)
    if cache is not None and "DeathAddress" in d.columns and "EventAddress" in d.columns:
        full = lambda kind: text.full_address(F.col(f"{kind}Address"), F.col(f"{kind}City") if f"{kind}City" in d.columns else F.lit(None), F.col(f"{kind}Zip") if f"{kind}Zip" in d.columns else F.lit(None))
        d = d.withColumns({"_event": F.coalesce(full("Event"), full("Death")), "_death": full("Death")})
        d = relations.geocode(d, cache, "_event", "_death", inside or (lambda lon, lat: nearby.usable_point(lon, lat))).drop("_event", "_death")
    d = entity.merge_records(d, [key], ORDER, "last").withColumn(ORDER, F.lit(0))
    if history is not None:
        d = entity.backfill(d, history, key, ORDER)
    if regions is not None and "lon" in d.columns:
        area = nearby.regions_of_points(d, regions, keep=("CT20", "ZIPCODE")).filter(~F.col("on_boundary")).select("lon", "lat", "CT20", "ZIPCODE", F.col("area_id"))
        j = d.join(area, ["lon", "lat"], "left").withColumn(ORDER, F.shiftright(F.xxhash64("area_id"), 2))
        d = entity.merge_records(j.drop("area_id"), [key], ORDER, "last").withColumn(ORDER, F.lit(0))
    return final_clean(d.drop(ORDER, *(() if keep_names else DROPPED)))


def all_records(records: DataFrame, scorer: Scorer = zero_scorer, lexicon: dict[str, str] | None = None, key: str = "CaseNumber") -> DataFrame:
    """Every case with its labels: rows are labelled before they are merged, so a stale row can't hide a positive."""
    d = cut(labelled(harmonise(records), scorer, lexicon))
    flags = [*LABELS, "Number_Substances", "Polysubstance"]
    return final_clean(entity.merge_cases(d, key, flags, ORDER))


def combine_classes(frames: dict[str, DataFrame], keys: dict[str, str], drugs: str = "Any Drugs", date: str = "DeathDate") -> DataFrame:
    """Frames of several file classes united by column name.

    A class with a key is merged on it first, by completeness; among equally
    complete rows the one with the drug flag comes first, then the latest date,
    then the first row by ``_ord``. A class without a key stays as it is. Absent
    columns are null.
    """
    out = None
    for name, df in frames.items():
        if name in keys:
            prefer = [c for have, c in ((drugs, col(drugs).cast("int")), (date, F.unix_date(dates.parse_mixed_date(col(date))))) if have in df.columns]
            df = entity.merge_records(df, [keys[name]], ORDER, "first", prefer=prefer)
        else:
            df = df.drop(ORDER)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def deidentify(df: DataFrame, date: str = "DeathDate", age: str = "Age", required: str | None = "ZIPCODE") -> DataFrame:
    """Month, year and week instead of the date, age bins, no birth date or names; rows without the required area left out."""
    day = dates.parse_mixed_date(col(date))
    d = df.filter(col(required).isNotNull()) if required and required in df.columns else df
    d = d.withColumns({"MonthYear": F.date_format(day, "yyyy-MM"), "Year": F.year(day), "YearWeek": F.concat_ws("-", F.year(day).cast("string"), F.lpad(dates.week_of_year_sunday(day).cast("string"), 2, "0")), "Age_Bin": dates.age_bin(text.age_number(col(age).cast("string")))})
    known = {c: F.coalesce(text.gender_clean(col(c)) if c == "Gender" else text.race_whitelist(text.race_group(col(c))), F.lit("Unknown")) for c in ("Gender", "Race") if c in df.columns}
    return d.withColumns(known).drop("DateofBirth", *DROPPED)


def monthly_series(df: DataFrame, area: str, month: str, labels: list[str]) -> DataFrame:
    """``(area, type, month, n, rolling)`` by area and over all areas, with the mean of the last twelve rows."""
    long = reports.melt_flags(df, [area, month], labels)
    counts = reports.rollup_with_all(long, ["type", month], area, [F.count("*").alias("n")])
    return reports.rolling_mean(counts, [area, "type"], month, "n")


def space_time_cube(df: DataFrame, area: str, month: str, flags: list[str], age: Column) -> DataFrame:
    """Every area and month with counts, flag sums and ages; zeros where nothing happened."""
    c = df.groupBy(area, month).agg(F.count("*").alias("n"), *[F.sum(F.coalesce(col(f).cast("int"), F.lit(0))).alias(f"n_{i}") for i, f in enumerate(flags)], F.round(F.avg(age), 6).alias("age_mean"), F.min(age).alias("age_min"), F.max(age).alias("age_max"))
    g = reports.complete_grid(c, [area, month], "n")
    return g.na.fill(0, [f"n_{i}" for i in range(len(flags))])
