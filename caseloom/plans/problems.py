"""The general data-cleaning problems as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import timeparse
from caseloom.functions.values import MISSING_WORDS, case_key
from caseloom.operators import drift, nearby, snapshots, timestamps
from caseloom.session import table

LABELS = ("Methamphetamine", "Heroin", "Cocaine", "Fentanyl", "Alcohol", "Prescription.opioids", "Any Opioids", "Benzodiazepines", "Others", "Any Drugs")
SNAPSHOT_COLUMNS = ["DeathDate", "Age", "Gender", "Race", "Mode", "CauseA", *LABELS]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(table(spark, d, "raw_rows")).select("feed", "file_no", "change", "old_field", "new_field")


def p2_lifespans(spark: SparkSession, d: str) -> DataFrame:
    return drift.lifespans(drift.field_catalogue(table(spark, d, "raw_rows")))


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    t = drift.consistent_rows(table(spark, d, "raw_rows"), ["feed", "file_no", "row_no"])
    return t.withColumns({c: F.to_json(c) for c in ("_other", "_unread")}).withColumnsRenamed({"_other": "other", "_unread": "unread"})


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nearby.near_keys_in_regions(table(spark, d, "audit_stability"), table(spark, d, "tracts").filter("area_level = 'tract'"), "CaseNumber", "snapshot_no")


def p3_coordinates(spark: SparkSession, d: str) -> DataFrame:
    return nearby.near_coordinates(table(spark, d, "audit_stability"), table(spark, d, "tracts").filter("area_level = 'tract'"), "CaseNumber")


def p3_areas(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "audit_stability")
    areas = nearby.regions_of_points(rows, table(spark, d, "tracts"), keep=("area_level", "CT20"))
    return rows.select("snapshot_no", "row_no", "lon", "lat", "in_la_county").join(areas, ["lon", "lat"]).select("snapshot_no", "row_no", "area_id", "area_level", "CT20", "on_boundary", F.col("in_la_county").cast("int").alias("in_la_county"))


def _dated(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "consensus").select("row_id", "source_file", "received_at", "CaseNumber", "DeathDate", "DeathTime", "DateofBirth")
    return timestamps.normalise_timestamps(c, table(spark, d, "source_files"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _dated(spark, d).withColumn("_case", case_key(F.col("CaseNumber")))
    return timestamps.disagreements(rows, "_case", "row_id", {"moment_utc": "death", "birth_day": "birth"})


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    rows = _dated(spark, d).withColumn("_case", case_key(F.col("CaseNumber")))
    return timestamps.disagreement_classes(rows, "_case", "row_id", {"moment_utc": "death", "birth_day": "birth"})


def p4_normalised(spark: SparkSession, d: str) -> DataFrame:
    return _dated(spark, d).select("row_id", "moment_utc", "moment_status", "moment_notation", "birth_day", "birth_notation")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, d, "audit_stability"), "CaseNumber", SNAPSHOT_COLUMNS, dates=("DeathDate",))


QUERIES = {f.__name__: f for f in (p2_found, p2_lifespans, p2_table, p3_found, p3_coordinates, p3_areas, p4_found, p4_classes, p4_normalised, p5_found)}

# SQL equivalents, independent of the operators: pairwise comparison of snapshots, and brute-force geometry.
_missing = "^((" + "|".join(w.replace("/", "/").replace("?", "[?]").replace(".", "[.]") for w in MISSING_WORDS) + ")( (" + "|".join(w.replace("?", "[?]").replace(".", "[.]") for w in MISSING_WORDS) + "))*)?$"


def _sql_value(c: str) -> str:
    t = f'CAST("{c}" AS VARCHAR)'
    n = rf"regexp_replace(regexp_replace(upper({t}), '\s+', '', 'g'), '^([+-]?\d+)\.0*$', '\1')"
    gone = rf"({t} IS NULL OR regexp_matches(trim(upper(regexp_replace({t}, '\s+', ' ', 'g'))), '{_missing}'))"
    if c == "DeathDate":
        n = f"coalesce(CAST(CAST(try_strptime(trim({t}), ['%Y-%m-%d', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%d %b %Y', '%d-%b-%Y']) AS DATE) AS VARCHAR), {n})"
    return f"CASE WHEN {gone} THEN '' ELSE {n} END"


_last = 'SELECT snapshot_no AS s, trim(CaseNumber) AS k, ' + ", ".join(f'{_sql_value(c)} AS v{i}' for i, c in enumerate(SNAPSHOT_COLUMNS)) + " FROM audit_stability WHERE trim(CaseNumber) <> '' QUALIFY row_number() OVER (PARTITION BY snapshot_no, trim(CaseNumber) ORDER BY row_no DESC) = 1"
_edges = (
    "g AS (SELECT area_id, CT20, json_extract_string(geometry, '$.type') AS t, json_extract(geometry, '$.coordinates') AS c FROM tracts), parts AS (SELECT area_id, CT20, row_number() OVER () AS part, p FROM (SELECT area_id, CT20, unnest(CASE WHEN t = 'Polygon' THEN [CAST(c AS DOUBLE[][][])] ELSE CAST(c AS DOUBLE[][][][]) END) AS p FROM g)), "
    "rings AS (SELECT area_id, CT20, part, unnest(p) AS r FROM parts), edges AS (SELECT area_id, CT20, part, r[i] AS a, r[i + 1] AS b FROM (SELECT area_id, CT20, part, r, unnest(range(1, len(r))) AS i FROM rings)), "
    "pts AS (SELECT DISTINCT lon, lat FROM audit_stability WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90), "
    "hits AS (SELECT lon, lat, area_id, CT20, part, count(*) AS n FROM pts JOIN edges ON (a[2] > lat) <> (b[2] > lat) AND lon < (b[1] - a[1]) * (lat - a[2]) / (b[2] - a[2]) + a[1] GROUP BY ALL), inside AS (SELECT DISTINCT lon, lat, area_id, CT20 FROM hits WHERE n % 2 = 1)")
# Fields of the extracts: one row for each field of each readable record, and the names they stand for.
_names = ", ".join(f"('{drift.plain_name(a)}', '{c}', {i})" for c, ns in drift.ALIASES.items() for i, a in enumerate((c, *ns)))
_cells = (
    f"names AS (SELECT plain, min(canon) AS canon, min(rank) AS rank FROM (VALUES {_names}) n(plain, canon, rank) GROUP BY plain), "
    "ok AS (SELECT feed, file_no, row_no, CASE WHEN json_valid(record) AND json_type(record) = 'OBJECT' THEN CAST(record AS JSON) END AS j FROM raw_rows), "
    "keys AS (SELECT feed, file_no, row_no, j, unnest(json_keys(j)) AS field FROM ok WHERE j IS NOT NULL), "
    "cells AS (SELECT feed, file_no, row_no, field, regexp_replace(lower(field), '[^a-z0-9.#]', '', 'g') AS plain, json_extract(j, '$.\"' || field || '\"') AS x FROM keys)")
_kinds = (
    "kinds AS (SELECT feed, file_no, field, min(plain) AS plain, CASE json_type(x) WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'decimal number' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'whole number' END AS kind, count(*) AS n FROM cells GROUP BY feed, file_no, field, kind), "
    "cat AS (SELECT feed, file_no, field, min(plain) AS plain, arg_max(kind, (n, kind)) FILTER (WHERE kind IS NOT NULL) AS kind FROM kinds GROUP BY feed, file_no, field), "
    "files AS (SELECT feed, file_no, row_number() OVER w AS ord, lag(file_no) OVER w AS prev, lead(file_no) OVER w AS next FROM (SELECT DISTINCT feed, file_no FROM raw_rows) WINDOW w AS (PARTITION BY feed ORDER BY file_no)), "
    "named AS (SELECT c.*, coalesce(canon, plain) AS canon, canon IS NOT NULL AS known, ord, prev, next FROM cat c LEFT JOIN names USING (plain) JOIN files USING (feed, file_no))")
# By comparing each file with the one before; every name of these feeds is in the alias table, so contents needn't be compared.
_changes = (
    f"WITH {_cells}, {_kinds}, o AS (SELECT feed, next AS file_no, field, canon, kind FROM named WHERE next IS NOT NULL), n AS (SELECT feed, file_no, field, canon, kind FROM named WHERE prev IS NOT NULL), "
    "gone AS (SELECT *, row_number() OVER (PARTITION BY feed, file_no, canon ORDER BY field) AS i FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.feed = o.feed AND n.file_no = o.file_no AND n.field = o.field)), "
    "come AS (SELECT *, row_number() OVER (PARTITION BY feed, file_no, canon ORDER BY field) AS i FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.feed = o.feed AND n.file_no = o.file_no AND n.field = o.field)), "
    "both_ AS (SELECT n.feed, n.file_no, o.field AS f, n.field AS t, o.kind AS ok, n.kind AS nk FROM n JOIN o ON n.feed = o.feed AND n.file_no = o.file_no AND n.field = o.field UNION ALL SELECT come.feed, come.file_no, gone.field, come.field, gone.kind, come.kind FROM come JOIN gone USING (feed, file_no, canon, i)) "
    "SELECT feed, file_no, 'retyped' AS change, f AS old_field, t AS new_field FROM both_ WHERE ok <> nk UNION ALL SELECT feed, file_no, 'renamed', f, t FROM both_ WHERE f <> t "
    "UNION ALL SELECT feed, file_no, 'removed', field, '' FROM gone ANTI JOIN come USING (feed, file_no, canon, i) UNION ALL SELECT feed, file_no, 'added', '', field FROM come ANTI JOIN gone USING (feed, file_no, canon, i)")
_spans = (
    f"WITH {_cells}, {_kinds}, k AS (SELECT *, coalesce(kind, 'null') AS k FROM named), i AS (SELECT *, ord - row_number() OVER (PARTITION BY feed, field, k ORDER BY ord) AS island FROM k) "
    "SELECT feed, field, k AS kind, min(canon) AS canonical, min(file_no) AS first_file, max(file_no) AS last_file, count(*) AS n_files, min(ord) AS first_ord, arg_max(coalesce(next, -1), ord) AS next_file FROM i GROUP BY feed, field, k, island")
_spans = f"SELECT * REPLACE (nullif(next_file, -1) AS next_file) FROM ({_spans})"
_mixed = "coalesce(try_strptime(trim(v), ['%Y-%m-%d', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%m/%d/%Y %H:%M:%S', '%d %b %Y', '%d-%b-%Y']))::DATE"
_cast_sql = {
    "case number": r"CASE WHEN regexp_matches(v, '^\D*(19|20)\d{2} ?- ?\d+$') THEN regexp_extract(v, '((?:19|20)\d{2}) ?- ?0*(\d+)$', 1) || '-' || lpad(regexp_extract(v, '((?:19|20)\d{2}) ?- ?0*(\d+)$', 2), greatest(5, length(regexp_extract(v, '((?:19|20)\d{2}) ?- ?0*(\d+)$', 2)), 5)::INT, '0') END",
    "date": _mixed,
    "zip": r"coalesce(nullif(regexp_extract(regexp_replace(v, '\.0$', ''), '(\d{5})', 1), ''), CASE WHEN regexp_matches(trim(v), '^\d{3,4}$') THEN lpad(trim(v), 5, '0') END)",
    "number": r"CAST(nullif(regexp_extract(v, '(\d+)', 1), '') AS DOUBLE)",
    "flag": "CASE WHEN lower(trim(v)) IN ('1', 'true', 'yes', 'y') THEN 1 WHEN lower(trim(v)) IN ('0', 'false', 'no', 'n') THEN 0 END",
    "text": "v",
}


def _typed_sql(c: str) -> str:
    v = f"(SELECT {_cast_sql[drift.TYPES.get(c, 'text')]} FROM (SELECT w.\"{c}\" AS v))"
    return f'{v} AS "{c}"'


_table_sql = (
    f"WITH {_cells}, t AS (SELECT feed, file_no, row_no, canon, field, plain, rank, CASE json_type(x) WHEN 'OBJECT' THEN array_to_string(list_transform(json_keys(x), lambda k: json_extract_string(x, '$.\"' || k || '\"')), '-') "
    r"WHEN 'ARRAY' THEN array_to_string(CAST(x AS VARCHAR[]), '; ') ELSE regexp_replace(json_extract_string(x, '$'), '^(-?\d+)\.0+$', '\1') END AS v FROM cells LEFT JOIN names USING (plain) WHERE json_type(x) <> 'NULL'), "
    "g AS (SELECT feed, file_no, row_no, canon, arg_min(v, (rank, field <> canon, field)) AS v FROM t WHERE canon IS NOT NULL GROUP BY ALL), "
    "w AS (SELECT r.feed, r.file_no, r.row_no, " + ", ".join(f"max(v) FILTER (WHERE canon = '{c}') AS \"{c}\"" for c in drift.ALIASES) + " FROM raw_rows r LEFT JOIN g USING (feed, file_no, row_no) GROUP BY ALL), "
    "o AS (SELECT feed, file_no, row_no, string_agg(to_json(field) || ':' || to_json(v), ',' ORDER BY field) AS other FROM t WHERE canon IS NULL GROUP BY ALL), "
    "c AS (SELECT feed, file_no, row_no, " + ", ".join(_typed_sql(c) for c in drift.ALIASES) + " FROM w) "
    "SELECT c.*, '{' || coalesce(other, '') || '}' AS other, '{' || concat_ws(',', " + ", ".join(f"CASE WHEN w.\"{c}\" IS NOT NULL AND c.\"{c}\" IS NULL THEN '\"{c}\":' || to_json(w.\"{c}\") END" for c in drift.ALIASES if c in drift.TYPES) + ") || '}' AS unread "
    "FROM c JOIN w USING (feed, file_no, row_no) LEFT JOIN o USING (feed, file_no, row_no)")
# Timestamps: each text by the notation it matches, the declared order of figures, and the clock changes of the source's zone.
_NAMED = "['a', 'b', 'c', 'h', 'm', 's', 'half', 'zone']"
_tidy_text = lambda c: rf"trim(regexp_replace(upper({c}), '\s+', ' ', 'g'))"
_off = lambda z: f"CASE WHEN {z} = '' THEN NULL WHEN regexp_matches({z}, '^[+-]') THEN (CASE WHEN {z} LIKE '-%' THEN -1 ELSE 1 END) * (substr({z}, 2, 2)::INT * 60 + substr(replace({z}, ':', ''), 4, 2)::INT) ELSE CASE {z} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in timeparse.ZONES.items()) + " END END"
_hour = lambda h, half: f"(CASE WHEN {half} <> '' AND {h} <= 12 THEN {h} % 12 + CASE WHEN {half} LIKE 'P%' THEN 12 ELSE 0 END ELSE {h} END)"
_sec = lambda h, m, s, half: f"CASE WHEN {m} < 60 AND coalesce({s}, 0) < 60 AND {_hour(h, half)} * 3600 + {m} * 60 + coalesce({s}, 0) <= 86400 THEN {_hour(h, half)} * 3600 + {m} * 60 + coalesce({s}, 0) END"
_int = lambda x: f"TRY_CAST(nullif({x}, '') AS INT)"
_ymd = lambda y, m, d: f"TRY_CAST(lpad(({y})::VARCHAR, 4, '0') || '-' || ({m})::VARCHAR || '-' || ({d})::VARCHAR AS DATE)"
_full = "((year(recv) // 100) * 100 + c::INT)"
_year4 = lambda m, d: f"CASE WHEN length(c) = 4 THEN c::INT WHEN coalesce({_ymd(_full, m, d)} <= recv::DATE, {_full} <= year(recv)) THEN {_full} ELSE {_full} - 100 END"
_mon = "(list_position([" + ", ".join(f"'{m}'" for m in timeparse.MONTHS) + "], substr({0}, 1, 3)))"
_dated_day = lambda m, d: _ymd(f"({_year4(m, d)})", m, d)
_clock_sql = (
    f"CASE WHEN regexp_matches(ts, '{timeparse._CLOCK}') THEN {_sec(*[_int(f'tg.{x}') for x in 'hms'], 'tg.half')} WHEN regexp_matches(ts, '{timeparse._MILITARY}') THEN {_sec(_int('mg.h'), _int('mg.m'), '0', chr(39) * 2)} END")
_moments = (
    f"WITH c AS (SELECT row_id, CaseNumber, received_at AS recv, date_order AS o, coalesce(time_zone, 'UTC') AS tz, {_tidy_text('DeathTime')} AS ts, DeathDate, DateofBirth FROM consensus LEFT JOIN source_files USING (source_file)), "
    f"x AS (SELECT row_id, recv, o, 'death' AS field, {_tidy_text('DeathDate')} AS s FROM c UNION ALL SELECT row_id, recv, o, 'birth', {_tidy_text('DateofBirth')} FROM c), "
    "k AS (SELECT *, CASE WHEN length(s) > 60 THEN NULL " + " ".join(f"WHEN regexp_matches(s, '{pat}') THEN '{n}'" for n, pat in (("iso", timeparse._ISO), ("fig", timeparse._FIG), ("dmon", timeparse._DMON), ("mond", timeparse._MOND))) + r" WHEN regexp_matches(s, '^[0-9]+(\.[0-9]+)?$') THEN 'num' END AS kind FROM x), "
    "g AS (SELECT *, CASE kind " + " ".join(f"WHEN '{n}' THEN regexp_extract(s, '{pat}', {_NAMED})" for n, pat in (("iso", timeparse._ISO), ("fig", timeparse._FIG), ("dmon", timeparse._DMON), ("mond", timeparse._MOND))) + " END AS g FROM k), "
    "f AS (SELECT row_id, recv, o, field, s, kind, g.a AS a, g.b AS b, g.c AS c, g.h AS h, g.m AS m, g.s AS sec, g.half AS half, g.zone AS zone FROM g), "
    f"p AS (SELECT *, CASE WHEN kind = 'fig' THEN {_dated_day('a::INT', 'b::INT')} END AS mdy, CASE WHEN kind = 'fig' THEN {_dated_day('b::INT', 'a::INT')} END AS dmy FROM f), "
    f"d AS (SELECT *, CASE kind WHEN 'iso' THEN {_ymd('a', 'b', 'c')} WHEN 'fig' THEN CASE WHEN o = 'dmy' THEN coalesce(dmy, mdy) ELSE coalesce(mdy, dmy) END WHEN 'dmon' THEN {_dated_day(_mon.format('b'), 'a::INT')} WHEN 'mond' THEN {_dated_day(_mon.format('a'), 'b::INT')} "
    "WHEN 'num' THEN CASE WHEN regexp_matches(s, '^[0-9]{8}$') THEN TRY_CAST(substr(s, 1, 4) || '-' || substr(s, 5, 2) || '-' || substr(s, 7, 2) AS DATE) WHEN regexp_matches(s, '^[0-9]{4,5}([.][0-9]+)?$') AND s::DOUBLE >= 3000 THEN DATE '1899-12-30' + floor(s::DOUBLE)::INT "
    "WHEN regexp_matches(s, '^([0-9]{9,10}|[0-9]{12,13})$') THEN DATE '1970-01-01' + ((s::BIGINT // CASE WHEN length(s) >= 12 THEN 1000 ELSE 1 END) // 86400)::INT END END AS day, "
    "kind = 'iso' AND regexp_matches(s, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} 00:00:00$') AS bare, CASE WHEN bare THEN 'isodate' WHEN kind = 'fig' THEN CASE WHEN mdy = dmy THEN coalesce(o, 'mdy') WHEN o = 'dmy' THEN CASE WHEN dmy IS NULL THEN 'mdy' ELSE 'dmy' END ELSE CASE WHEN mdy IS NULL THEN 'dmy' ELSE 'mdy' END END "
    "WHEN kind = 'num' THEN CASE WHEN regexp_matches(s, '^[0-9]{8}$') THEN 'ymd' WHEN regexp_matches(s, '^[0-9]{4,5}([.][0-9]+)?$') THEN 'serial' ELSE 'epoch' END ELSE kind END AS note, "
    f"CASE WHEN kind = 'num' THEN CASE WHEN regexp_matches(s, '^[0-9]{{4,5}}[.][0-9]+$') THEN round((s::DOUBLE - floor(s::DOUBLE)) * 86400)::INT WHEN regexp_matches(s, '^([0-9]{{9,10}}|[0-9]{{12,13}})$') THEN ((s::BIGINT // CASE WHEN length(s) >= 12 THEN 1000 ELSE 1 END) % 86400)::INT END WHEN h <> '' THEN {_sec(*[_int(x) for x in ('h', 'm', 'sec')], 'half')} END AS secs, "
    f"CASE WHEN kind = 'num' THEN CASE WHEN regexp_matches(s, '^([0-9]{{9,10}}|[0-9]{{12,13}})$') THEN 0 END ELSE {_off('zone')} END AS off FROM p), "
    "v AS (SELECT row_id, field, note, day, CASE WHEN NOT bare THEN secs END AS secs, CASE WHEN NOT bare THEN off END AS off FROM d WHERE day IS NOT NULL AND (bare OR kind = 'num' OR ((h = '' OR secs IS NOT NULL) AND (zone = '' OR off IS NOT NULL)))), "
    f"tp AS (SELECT *, regexp_extract(ts, '{timeparse._CLOCK}', ['h', 'm', 's', 'half', 'zone']) AS tg, regexp_extract(ts, '{timeparse._MILITARY}', ['h', 'm', 'zone']) AS mg FROM c), "
    f"tq AS (SELECT *, {_clock_sql} AS t_secs, CASE WHEN regexp_matches(ts, '{timeparse._CLOCK}') THEN tg.zone ELSE mg.zone END AS t_zone FROM tp), "
    f"tr AS (SELECT *, CASE WHEN t_zone = '' OR {_off('t_zone')} IS NOT NULL THEN t_secs END AS t_sec, CASE WHEN t_secs IS NOT NULL THEN {_off('t_zone')} END AS t_off FROM tq), "
    "u AS (SELECT tr.row_id, CaseNumber, tz, dd.day, coalesce(dd.secs, t_sec) AS sec, coalesce(dd.off, CASE WHEN t_sec IS NOT NULL THEN t_off END) AS off, bb.day AS birth_day, dd.note AS note, bb.note AS birth_note FROM tr LEFT JOIN v dd ON dd.row_id = tr.row_id AND dd.field = 'death' LEFT JOIN v bb ON bb.row_id = tr.row_id AND bb.field = 'birth'), "
    "l AS (SELECT *, day::TIMESTAMP + to_seconds(sec) AS local FROM u), z AS (SELECT *, CASE WHEN off IS NOT NULL THEN local - to_minutes(off) ELSE timezone('UTC', timezone(tz, local)) END AS utc FROM l), "
    "moments AS (SELECT row_id, CaseNumber, birth_day, day, sec, note, birth_note, CASE WHEN off IS NOT NULL OR (timezone(tz, timezone('UTC', utc)) = local AND timezone(tz, timezone('UTC', utc - INTERVAL 1 HOUR)) <> local AND timezone(tz, timezone('UTC', utc + INTERVAL 1 HOUR)) <> local) THEN date_trunc('minute', utc) END AS moment FROM z)")
_squeezed_key = r"trim(upper(regexp_replace(regexp_replace(CaseNumber, '\s+', ' ', 'g'), '[‐-―−_/]', '-', 'g')))"
_key_shape = r"'^[^0-9]*?((?:19|20)[0-9]{2}) ?- ?0*([0-9]+)$'"
_kase = f"CASE WHEN regexp_matches({_squeezed_key}, {_key_shape}) THEN regexp_extract({_squeezed_key}, {_key_shape}, 1) || '-' || lpad(regexp_extract({_squeezed_key}, {_key_shape}, 2), greatest(5, length(regexp_extract({_squeezed_key}, {_key_shape}, 2)))::INT, '0') END"
_values = f", q AS (SELECT row_id, {_kase} AS kase, moment, birth_day FROM moments), w AS (SELECT row_id, kase, 'death' AS field, moment::VARCHAR AS v FROM q UNION ALL SELECT row_id, kase, 'birth', birth_day::VARCHAR FROM q), y AS (SELECT * FROM w WHERE kase IS NOT NULL AND v IS NOT NULL) "
ORACLE: dict[str, str] = {
    "p4_found": _moments + _values + "SELECT a.row_id AS row_id_a, b.row_id AS row_id_b, a.field FROM y a JOIN y b ON a.kase = b.kase AND a.field = b.field AND a.row_id < b.row_id AND a.v <> b.v",
    "p4_normalised": _moments + " SELECT row_id, moment AS moment_utc, CASE WHEN day IS NULL THEN 'no date' WHEN sec IS NULL THEN 'no time' WHEN moment IS NULL THEN 'clock change' ELSE 'ok' END AS moment_status, note AS moment_notation, birth_day, birth_note AS birth_notation FROM moments",
    "p4_classes": _moments + _values + ", n AS (SELECT kase, field, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY kase, field) AS total FROM y GROUP BY kase, field, v) SELECT row_id, kase AS \"case\", field, v AS value, (total - n)::BIGINT AS n_links FROM y JOIN n USING (kase, field, v) WHERE total > n",
    "p2_found": _changes,
    "p2_lifespans": _spans,
    "p2_table": _table_sql,
    "p5_found": (
        f"WITH l AS ({_last}), prev AS (SELECT s, lag(s) OVER (ORDER BY s) AS p FROM (SELECT DISTINCT s FROM l)), c AS (SELECT l.*, p FROM l JOIN prev USING (s)) "
        "SELECT c.s AS snapshot_no, c.k AS CaseNumber, 'added' AS change, '' AS field FROM c WHERE p IS NOT NULL AND NOT EXISTS (SELECT 1 FROM l o WHERE o.s = c.p AND o.k = c.k) "
        "UNION ALL SELECT prev.s, o.k, 'removed', '' FROM l o JOIN prev ON prev.p = o.s WHERE NOT EXISTS (SELECT 1 FROM l n WHERE n.s = prev.s AND n.k = o.k) "
        + " ".join(f"UNION ALL SELECT c.s, c.k, 'changed', '{n}' FROM c JOIN l o ON o.s = c.p AND o.k = c.k WHERE o.v{i} <> c.v{i}" for i, n in enumerate(SNAPSHOT_COLUMNS))),
    "p3_found": (
        f"WITH {_edges}, spot AS (SELECT DISTINCT trim(CaseNumber) AS k, snapshot_no AS s, a.lon, a.lat, CT20 FROM audit_stability a JOIN inside i ON a.lon = i.lon AND a.lat = i.lat WHERE CT20 IS NOT NULL AND trim(CaseNumber) <> '') "
        "SELECT DISTINCT x.k AS case_a, y.k AS case_b, x.CT20 FROM spot x JOIN spot y ON x.s = y.s AND x.CT20 = y.CT20 AND x.k < y.k WHERE 2 * 6371008.8 * asin(sqrt(least(1, pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2)))) <= 25"),
    "p3_coordinates": (
        f"WITH {_edges}, c AS (SELECT a.lon, a.lat, count(DISTINCT trim(CaseNumber)) AS n FROM audit_stability a WHERE trim(CaseNumber) <> '' AND lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 GROUP BY ALL), s AS (SELECT DISTINCT c.lon, c.lat, n, CT20 FROM c JOIN inside i ON c.lon = i.lon AND c.lat = i.lat WHERE CT20 IS NOT NULL) "
        "SELECT x.lon AS lon_a, x.lat AS lat_a, y.lon AS lon_b, y.lat AS lat_b, x.CT20, x.n AS n_a, y.n AS n_b FROM s x JOIN s y ON x.CT20 = y.CT20 AND ((x.lat, x.lon) < (y.lat, y.lon) OR (x.lat = y.lat AND x.lon = y.lon AND x.n > 1)) "
        "WHERE 2 * 6371008.8 * asin(sqrt(least(1, pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2)))) <= 25"),
    "p3_areas": f"WITH {_edges} SELECT snapshot_no, row_no, i.area_id, t.area_level, i.CT20, false AS on_boundary, CAST(in_la_county AS INT) AS in_la_county FROM audit_stability a JOIN inside i ON a.lon = i.lon AND a.lat = i.lat JOIN tracts t ON t.area_id = i.area_id",
}
