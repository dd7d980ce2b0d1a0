"""Date parsing and formatting rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_mixed_date(c: Column) -> Column:
    """The day of a date in one of the usual notations (month first), null if unreadable."""
    s = F.trim(F.upper(c.cast("string")))
    iso, us = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[T ].*)?$", r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: .*)?$"
    mon = r"^(\d{1,2})[- ]([A-Z]{3})[A-Z]*[- ](\d{4})$"
    months = F.array(*[F.lit(m) for m in ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")])
    named = F.concat_ws("-", F.regexp_extract(s, mon, 3), F.array_position(months, F.regexp_extract(s, mon, 2)).cast("string"), F.regexp_extract(s, mon, 1))
    plain = F.when(s.rlike(iso), F.regexp_replace(s, iso, "$1-$2-$3")).when(s.rlike(us), F.regexp_replace(s, us, "$3-$1-$2")).when(s.rlike(mon), named)
    return plain.try_cast("date")


def parse_exact_date(c: Column) -> Column:
    """``m/d/yyyy`` or ``yyyy-mm-dd`` and nothing else."""
    s = F.trim(c)
    return F.when(s.rlike(r"^(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{2}-\d{2})$"), parse_mixed_date(s))


def rescue_date(c: Column) -> Column:
    """A whole-text parse, else the first date token inside the text."""
    token = F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.coalesce(parse_mixed_date(c), parse_mixed_date(token))


def week_of_year_sunday(d: Column) -> Column:
    """Week number with weeks from Sunday, days before the first Sunday in week 0."""
    return F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")


def age_bin(age: Column, width: int = 10, top: int = 100) -> Column:
    """``0-9`` ... ``90-99``, right-open; outside null."""
    lo = (F.floor(age / width) * width).cast("int")
    return F.when((age >= 0) & (age < top), F.concat(lo.cast("string"), F.lit("-"), (lo + width - 1).cast("string")))
