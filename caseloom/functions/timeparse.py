"""Every valid reading of a written date or time, as Spark expressions.

A reading is a struct ``(notation, day, seconds, offset)``: days since
1970-01-01, seconds of the day (null if the text has no time) and minutes east
of UTC (null if no zone is written).

The expressions are composed as SQL text, with ``transform`` over one-element
arrays to bind what is used more than once: the plan holds each part once and
the driver parses one string instead of building thousands of columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

READING = "struct<notation:string,day:int,seconds:int,offset:int>"

# Zone abbreviations and their minutes east of UTC.
ZONES = {
    "Z": 0, "UTC": 0, "GMT": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

_TIME = r"(?:[T ]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,][0-9]+)?)? ?((?:[AP]\.?M\.?)?) ?(Z|[A-Z]{3,4}|[+-][0-9]{2}:?[0-9]{2})?)?"
_ISO = rf"^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}}){_TIME}$"
_FIG = rf"^([0-9]{{1,2}})[/.]([0-9]{{1,2}})[/.]([0-9]{{4}}|[0-9]{{2}}){_TIME}$"
_DMON = rf"^([0-9]{{1,2}})[- ]([A-Z]{{3,9}})[-, ]+([0-9]{{4}}|[0-9]{{2}}){_TIME}$"
_MOND = rf"^([A-Z]{{3,9}})\.? ([0-9]{{1,2}}),? ([0-9]{{4}}|[0-9]{{2}}){_TIME}$"
_DIGITS = r"^([0-9]{4})([0-9]{2})([0-9]{2})$"
_CLOCK = r"^([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,][0-9]+)?)? ?((?:[AP]\.?M\.?)?) ?(Z|[A-Z]{3,4}|[+-][0-9]{2}:?[0-9]{2})?$"
_MILITARY = r"^([0-9]{1,2})([0-9]{2}) ?(?:HRS?|HOURS?|H)?\.? ?(Z|[A-Z]{3,4}|[+-][0-9]{2}:?[0-9]{2})?$"




def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` bound to ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _q(pattern: str) -> str:
    return "r'" + pattern.replace("'", "") + "'"


def _groups(s: str, pattern: str, n: int, body: str) -> str:
    """``body`` with the ``n`` groups of a match bound to ``g``: one match and one split, however many groups are used."""
    marked = "\\u0001".join(f"${i}" for i in range(1, n + 1))
    return _let(f"split(regexp_replace({s}, {_q(pattern)}, '{marked}'), '\\u0001', -1)", "g", body)


def _x(group: int) -> str:
    return f"get(g, {group - 1})"


def _n(group: int) -> str:
    return f"cast(nullif({_x(group)}, '') as int)"


def _clean(c: str) -> str:
    return f"trim(regexp_replace(upper({c}), r'[\\s\u00a0]+', ' '))"


def _day(y: str, m: str, d: str) -> str:
    """Days since 1970, null where the parts are no date (by arithmetic: no parser, no caught exceptions)."""
    return _let(f"struct({y} as y, {m} as m, {d} as d)", "ymd", (
        "case when ymd.y between 1 and 9999 and ymd.m between 1 and 12 and ymd.d between 1 and "
        "case when ymd.m = 2 then if(ymd.y % 4 = 0 and (ymd.y % 100 <> 0 or ymd.y % 400 = 0), 29, 28) when ymd.m in (4, 6, 9, 11) then 30 else 31 end "
        "then unix_date(make_date(ymd.y, ymd.m, ymd.d)) end"))


def _year(digits: str, m: str, d: str, received: str) -> str:
    """The year of two or four digits; two-digit years lie in the hundred years before the row was received."""
    full = f"(cast(floor(year({received}) / 100) as int) * 100 + cast(yy as int))"
    return _let(digits, "yy", f"case when length(yy) = 4 then cast(yy as int) when yy <> '' then if(coalesce({_day(full, m, d)} <= unix_date(cast({received} as date)), {full} <= year({received})), {full}, {full} - 100) end")


def _offset(z: str) -> str:
    named = ", ".join(f"'{k}', {v}" for k, v in ZONES.items())
    return (
        f"case when {z} = '' then cast(null as int) when {z} rlike '^[+-]' then if({z} like '-%', -1, 1) * "
        f"(cast(substr({z}, 2, 2) as int) * 60 + cast(substr(replace({z}, ':', ''), 4, 2) as int)) else try_element_at(map({named}), {z}) end")


def _clock(h: str, m: str, sec: str, half: str) -> str:
    """Seconds of the day; 24:00 is the end of the day; null where the parts are no time."""
    return _let(f"struct({h} as h, {m} as m, coalesce({sec}, 0) as s, {half} as half)", "hms", _let(
        "(if(hms.half <> '' and hms.h <= 12, pmod(hms.h, 12) + if(hms.half like 'P%', 12, 0), hms.h) * 3600 + hms.m * 60 + hms.s)", "tot",
        "case when hms.m < 60 and hms.s < 60 and tot <= 86400 then tot end"))


def _reading(notation: str, day: str, sec: str = "null", off: str = "null") -> str:
    return f"named_struct('notation', '{notation}', 'day', cast({day} as int), 'seconds', cast({sec} as int), 'offset', cast({off} as int))"


def _timed(notation: str, day: str) -> str:
    """A reading with whatever time and zone the pattern found; null if a part is invalid."""
    parts = f"struct({day} as day, {_x(4)} <> '' as has, {_clock(_n(4), _n(5), _n(6), _x(7))} as sec, {_x(8)} as zone)"
    return _let(parts, "p", _let(_offset("p.zone"), "zo", (
        "case when p.day is not null and (not p.has or p.sec is not null) and (p.zone = '' or zo is not null) "
        f"then {_reading(notation, 'p.day', 'if(p.has, p.sec, null)', 'zo')} end")))


def date_readings(c: str, received: str, order: str) -> Column:
    """All valid readings of a written date (with or without time and zone). The arguments are SQL expressions.

    ``order`` is the source's declared order of figures-only dates (``mdy`` or
    ``dmy``); where it is declared and gives a date, the other order is no valid
    reading. A null order keeps both. Numbers are read as yyyymmdd, as day
    serials of spreadsheets (with the time as fraction) or as seconds or
    milliseconds since 1970 (moments in UTC), whichever their length allows. A
    midnight written with seconds after a blank (``yyyy-mm-dd 00:00:00``) is how
    spreadsheets render a bare date and carries no time. Null, missing or
    unreadable text (also any of more than 60 characters) gives an empty array.
    """
    empty = f"cast(array() as array<{READING}>)"
    iso_day = _day(_n(1), _n(2), _n(3))
    bare = f"s rlike '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}} 00:00:00$'"
    iso = _groups("s", _ISO, 8, f"case when {bare} then {_reading('isodate', iso_day)} else {_timed('iso', iso_day)} end")
    days = _let(f"struct({_n(1)} as a, {_n(2)} as b, {_x(3)} as c)", "f", (
        f"struct({_day(_year('f.c', 'f.a', 'f.b', received), 'f.a', 'f.b')} as mdy, {_day(_year('f.c', 'f.b', 'f.a', received), 'f.b', 'f.a')} as dmy)"))
    use_mdy = f"(coalesce({order} <> 'dmy', true) or fd.dmy is null)"
    use_dmy = f"((coalesce({order} <> 'mdy', true) or fd.mdy is null) and (coalesce(fd.mdy <> fd.dmy, true) or not {use_mdy}))"
    figures = _groups("s", _FIG, 8, _let(days, "fd", f"array(if({use_mdy}, {_timed('mdy', 'fd.mdy')}, null), if({use_dmy}, {_timed('dmy', 'fd.dmy')}, null))"))

    def worded(notation: str, pattern: str, month: int, day: int) -> str:
        names = ", ".join(f"'{m}'" for m in MONTHS)
        parts = f"struct(cast(array_position(array({names}), substr({_x(month)}, 1, 3)) as int) as m, {_n(day)} as d)"
        return _groups("s", pattern, 8, _let(parts, "md", _timed(notation, _day(_year(_x(3), "md.m", "md.d", received), "md.m", "md.d"))))

    num = "cast(s as double)"
    digits = _groups("s", _DIGITS, 3, _day(_n(1), _n(2), _n(3)))
    # Day 0 of spreadsheet serials is 1899-12-30.
    number = (
        f"case when s rlike {_q(_DIGITS)} then {_let(digits, 'dg', 'if(dg is null, null, ' + _reading('ymd', 'dg') + ')')} "
        rf"when s rlike r'^[0-9]{{4,5}}(\.[0-9]+)?$' and {num} >= 3000 then {_reading('serial', f'floor({num}) - 25569', f'if(contains(s, chr(46)), round(({num} - floor({num})) * 86400), null)')} "
        f"when s rlike '^([0-9]{{9,10}}|[0-9]{{12,13}})$' then {_let(f'cast(if(length(s) >= 12, floor({num} / 1000), {num}) as bigint)', 'es', _reading('epoch', 'floor(es / 86400)', 'pmod(es, 86400)', '0'))} end")
    read = (
        f"case when length(s) > 60 then {empty} when s rlike {_q(_ISO)} then array({iso}) when s rlike {_q(_FIG)} then {figures} "
        f"when s rlike {_q(_DMON)} then array({worded('dmon', _DMON, 2, 1)}) when s rlike {_q(_MOND)} then array({worded('mond', _MOND, 1, 2)}) "
        rf"when s rlike r'^[0-9]+(\.[0-9]+)?$' then array({number}) else {empty} end")
    return F.expr(f"coalesce(array_compact({_let(_clean(c), 's', read)}), {empty})")


def time_reading(c: str) -> Column:
    """``struct(seconds, offset)`` of a written time of day (an SQL expression), null where missing or unreadable."""
    clock = _groups("s", _CLOCK, 5, f"struct({_clock(_n(1), _n(2), _n(3), _x(4))} as seconds, {_x(5)} as zone)")
    digits = _groups("s", _MILITARY, 3, "struct(" + _clock(_n(1), _n(2), "0", "''") + f" as seconds, {_x(3)} as zone)")
    parts = f"case when s rlike {_q(_CLOCK)} then {clock} when s rlike {_q(_MILITARY)} then {digits} end"
    done = _let(_offset("p.zone"), "zo", "case when p.seconds is not null and (p.zone = '' or zo is not null) then struct(p.seconds as seconds, zo as offset) end")
    return F.expr(_let(_clean(c), "s", _let(parts, "p", done)))


def to_utc_seconds(local: str, offset: str, zone: str) -> Column:
    """Seconds since 1970 in UTC of a local time; null if a clock change skipped or repeated it.

    A written ``offset`` wins; otherwise ``zone`` names the rules to apply. The
    arguments are SQL expressions.
    """
    back = lambda u: f"cast(from_utc_timestamp(timestamp_seconds({u}), {zone}) as bigint)"
    ruled = _let(f"cast(to_utc_timestamp(timestamp_seconds(l), {zone}) as bigint)", "u", f"case when {back('u')} = l and {back('u - 3600')} <> l and {back('u + 3600')} <> l then u end")
    return F.expr(_let(local, "l", f"if({offset} is not null, l - {offset} * 60, {ruled})"))
