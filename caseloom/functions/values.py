"""Missing values, case keys and other value-level rules shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing value.
MISSING_WORDS = (
    "NULL", "NONE", "NAN", "NA", "N/A", "<NA>", "#N/A", "NIL", "UNK", "UNKNOWN", "PENDING",
    "DEFERRED", "UNASSIGNED", "NOT AVAILABLE", "NOT KNOWN", "TBD", "-", "--", "?", ".",
)


def squeeze(c: Column) -> Column:
    """Upper case, runs of white space as one space, trimmed; null stays null."""
    return F.trim(F.upper(F.regexp_replace(c, r"[\s ]+", " ")))


def is_missing(c: Column) -> Column:
    """True for null, blank and placeholder words (also repeated ones such as ``NULL NULL``)."""
    words = "|".join(w.replace("/", r"\/").replace("?", r"\?").replace(".", r"\.") for w in MISSING_WORDS)
    # One match on the text as it stands, which ends at the first letter of most values.
    return F.coalesce(c.rlike(rf"(?iu)^[\s ]*(?:(?:{words})(?:[\s ]+(?:{words}))*[\s ]*)?$"), F.lit(True))


def not_missing(c: Column) -> Column:
    """The value itself, or null where it is missing."""
    return F.when(~is_missing(c), c)


def case_key(c: Column) -> Column:
    """Canonical ``yyyy-nnnnn`` of a case number however written, null if it holds none.

    The year and the serial number are taken from anything shaped like
    ``[label] yyyy <dash> n [blanks]``; the serial is padded to five digits and
    longer ones keep their digits (leading zeros beyond five are dropped).
    """
    s = F.regexp_replace(squeeze(c), r"[‐-―−_/]", "-")
    shape = r"^[^0-9]*?((?:19|20)[0-9]{2}) ?- ?0*([0-9]+)$"
    year, serial = F.regexp_extract(s, shape, 1), F.regexp_extract(s, shape, 2)
    return F.when(
        F.length(year) == 4,
        F.concat(year, F.lit("-"), F.when(F.length(serial) < 5, F.lpad(serial, 5, "0")).otherwise(serial)),
    )


def comparable(c: Column, numbers: bool = True) -> Column:
    """A form in which two writings of the same value are equal.

    Letter case and all white space are dropped, numbers lose trailing zeros,
    missing values become the empty string (which no other value maps to).
    """
    s = F.regexp_replace(F.upper(c), r"[\s ]+", "")
    if numbers:
        n = F.regexp_replace(F.regexp_replace(s, r"^([+-]?[0-9]+)\.0*$", "$1"), r"^([+-]?[0-9]*\.[0-9]*?[1-9])0+$", "$1")
        s = F.regexp_replace(n, r"^\+?(-?)0+(?=[0-9])(?=[0-9.]+$)", "$1")
    return F.when(is_missing(c), F.lit("")).otherwise(s)
