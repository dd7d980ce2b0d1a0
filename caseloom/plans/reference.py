"""One query for each family of operators, over whole tables, with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import dates, text
from caseloom.functions.lexicon import GENERAL_DRUG, GENERAL_OPIOID, SUBSTANCES, build_lexicon, first_matches, label_flags
from caseloom.functions.text import col
from caseloom.operators import classification, consensus, entity, label_audit, metrics, nearby, pages, relations, repair, reports, stability, vectors
from caseloom.operators.classification import LABELS
from caseloom.plans import pipelines
from caseloom.session import table
from caseloom.streaming.arrivals import windowed_counts

LEX = build_lexicon()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def safe(c: str) -> str:
    """A label as a plain column name."""
    return c.lower().replace(".", "_").replace(" ", "_")


def q(c: str) -> str:
    return '"' + c + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- records merged and filled ------------------------------------------------------
MAPPED = [
    "ResidenceType", "DeathDate", "DeathTime", "DeathPlace", "DeathAddress", "DeathZip", "DeathCity", "EventPlace", "EventAddress", "EventZip", "EventCity", "Mode",
    "CauseA", "CauseB", "CauseC", "CauseD", "CauseOther", "HowInjuryOccurred", "FirstName", "LastName", "DateofBirth", "Race", "Gender", "Age", "SourcePages",
]
MERGED = ["source_file", *MAPPED]
_count = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in ["CaseNumber", *MERGED])


def _merge_sql(sign: str) -> str:
    cols = ", ".join(f"arg_min({c}, r) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in MERGED)
    return f"WITH k AS (SELECT *, -({_count})::BIGINT * 10000000000 {sign} row_id AS r FROM consensus) SELECT CaseNumber, {cols} FROM k GROUP BY CaseNumber"


def _merge(spark: SparkSession, d: str, tie: str) -> DataFrame:
    c = table(spark, d, "consensus")
    return entity.merge_records(c.select("row_id", "CaseNumber", *[x for x in MERGED if x in c.columns]), ["CaseNumber"], "row_id", tie)


@query(_merge_sql("-"))
def entity_merge_last(spark, d):
    return _merge(spark, d, "last")


@query(_merge_sql("+"))
def entity_merge_first(spark, d):
    return _merge(spark, d, "first")


FILLED = MAPPED


@query(
    "WITH h AS (SELECT *, -(" + " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in ["CaseNumber", *FILLED]) + ")::BIGINT * 10000000000 - row_id AS r FROM consensus WHERE source_file NOT LIKE 'me_master%'), "
    "m AS (SELECT CaseNumber, " + ", ".join(f"arg_min({c}, r) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in FILLED) + " FROM h GROUP BY CaseNumber) "
    "SELECT c.row_id, c.CaseNumber, " + ", ".join(f"coalesce(c.{c}, m.{c}) AS {c}" for c in FILLED) + " FROM consensus c LEFT JOIN m ON c.CaseNumber IS NOT DISTINCT FROM m.CaseNumber WHERE c.source_file LIKE 'me_master%'")
def backfill_history(spark, d):
    c = table(spark, d, "consensus")
    c = c.select("row_id", "source_file", "CaseNumber", *[x for x in FILLED if x in c.columns])
    mine = F.col("source_file").startswith("me_master")
    return entity.backfill(c.filter(mine).drop("source_file"), c.filter(~mine).drop("source_file"), "CaseNumber", "row_id")


# A row of any snapshot: row_no is unique within one only.
_all = "(SELECT * REPLACE (snapshot_no::BIGINT * 10000000000 + row_no AS row_no) FROM audit_stability)"


def _every(spark, d):
    return table(spark, d, "audit_stability").withColumn("row_no", F.col("snapshot_no").cast("long") * 10_000_000_000 + F.col("row_no"))


_others = ["DeathDate", "Age", "Gender", "Race", "Mode", "CauseA"]


@query(
    "WITH k AS (SELECT *, -(" + " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in ["CaseNumber", *_others]) + ")::BIGINT * 1000000000000 - row_no AS r FROM " + _all + ") SELECT CaseNumber, "
    + ", ".join(f"arg_min({c}, r) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _others) + ", " + ", ".join(f"max({q(c)}) AS {safe(c)}" for c in LABELS) + " FROM k GROUP BY CaseNumber")
def flag_max_merge(spark, d):
    a = _every(spark, d).select("row_no", "CaseNumber", *_others, *[col(c).alias(safe(c)) for c in LABELS])
    return entity.merge_cases(a, "CaseNumber", [safe(c) for c in LABELS], "row_no")


@query("SELECT row_id, coalesce(CASE WHEN trim(DeathAddress) <> '' THEN DeathAddress END, CASE WHEN trim(EventAddress) <> '' THEN EventAddress END) AS address, coalesce(CASE WHEN trim(DeathZip) <> '' THEN DeathZip END, CASE WHEN trim(EventZip) <> '' THEN EventZip END) AS zip FROM consensus")
def alias_coalesce(spark, d):
    c = table(spark, d, "consensus").select("row_id", "DeathAddress", "EventAddress", "DeathZip", "EventZip")
    return entity.coalesce_aliases(c, {"address": ("DeathAddress", "EventAddress"), "zip": ("DeathZip", "EventZip")}, blank_aware=True)


@query("SELECT CaseNumber, arg_max(row_id, k) AS row_id FROM (SELECT CaseNumber, row_id, (CASE WHEN CauseA IS NOT NULL THEN 1 ELSE 0 END)::BIGINT * 100000000000000 + coalesce(length(DeathAddress), 0)::BIGINT * 10000000000 - row_id AS k FROM consensus) GROUP BY CaseNumber")
def resolve_duplicates(spark, d):
    c = table(spark, d, "consensus").select("CaseNumber", "row_id", "CauseA", "DeathAddress")
    return entity.best_row(c, ["CaseNumber"], [F.col("CauseA").isNotNull(), F.coalesce(F.length("DeathAddress"), F.lit(0)), -F.col("row_id")]).select("CaseNumber", "row_id")


# --- text and labels ----------------------------------------------------------------
TEXT_FIELDS = ["CauseA", "CauseB", "CauseC", "CauseD", "CauseOther", "HowInjuryOccurred"]
_cause = "concat_ws(', ', " + ", ".join(f"nullif(trim({f}), '')" for f in TEXT_FIELDS) + ")"
_clean = rf"trim(regexp_replace(upper(replace(regexp_replace(regexp_replace({_cause}, '[\t\n\r]', ' ', 'g'), '(?i)\bNULL\b', ' ', 'g'), ', ', ' ')), '\s+', ' ', 'g'))"
_norm = lambda f: rf"regexp_replace(regexp_replace(coalesce({f}, ''), '[\n\r]', ' ', 'g'), '(?i)\bNULL\b', ' ', 'g')"
_rowtext = "concat_ws(' | ', " + ", ".join(f"CASE WHEN trim({_norm(f)}) <> '' THEN {_norm(f)} END" for f in TEXT_FIELDS) + ")"


@query(f"SELECT row_id, {_clean} AS clean_text, {_rowtext} AS row_text FROM consensus")
def text_build(spark, d):
    c = table(spark, d, "consensus")
    return c.select("row_id", text.cause_text(c).alias("clean_text"), text.row_text(c).alias("row_text"))


def _hit(t: str, p: str) -> str:
    return f"CASE WHEN regexp_matches({t}, {lit('(?i)' + p)}) THEN 1 ELSE 0 END"


@query(f"WITH t AS (SELECT row_id, {_rowtext} AS t FROM consensus) SELECT row_id, " + ", ".join(f"{_hit('t', LEX[k])} AS {safe(k)}" for k in SUBSTANCES) + " FROM t")
def lexicon_flags(spark, d):
    c = table(spark, d, "consensus")
    return label_flags(c.select("row_id", text.row_text(c).alias("t")), F.col("t"), LEX).select("row_id", *[col(k).alias(safe(k)) for k in SUBSTANCES])


_model = {k: i + 5 for i, k in enumerate(LABELS)}  # a stand-in scorer: label i fires for row numbers divisible by i + 5


def _scored(spark, d):
    return table(spark, d, "consensus").select("row_id", *TEXT_FIELDS).withColumns({k: (F.col("row_id") % p == 0).cast("int") for k, p in _model.items()})


_m = lambda k: f"(CASE WHEN row_id % {_model[k]} = 0 THEN 1 ELSE 0 END)"
_any = lambda ps: _hit("t", "(?:" + "|".join(ps) + ")")
_sub = {k: f"greatest({_m(k)}, {_hit('t', LEX[k])})" for k in SUBSTANCES}
_sub["Methamphetamine"] = f"CASE WHEN {_m('Methamphetamine')} = 1 AND ({_hit('t', LEX['Methamphetamine'])}) = 0 AND regexp_matches(t, '(?i)methylenedioxy|(^|\\W)mdma(\\W|$)|ecstasy') THEN 0 ELSE {_sub['Methamphetamine']} END"
_corrected = (
    f"WITH t AS (SELECT row_id, {_rowtext} AS t FROM consensus), s AS (SELECT row_id, t, " + ", ".join(f"{_sub[k]} AS {safe(k)}" for k in SUBSTANCES) + " FROM t), "
    "n AS (SELECT *, " + " + ".join(safe(k) for k in SUBSTANCES) + f" AS number_substances, greatest(heroin, fentanyl, prescription_opioids, {_m('Any Opioids')}, {_any(GENERAL_OPIOID)}) AS any_opioids FROM s), "
    f"f AS (SELECT row_id, " + ", ".join(safe(k) for k in SUBSTANCES) + f", number_substances, CASE WHEN number_substances > 1 THEN 1 ELSE 0 END AS polysubstance, any_opioids, greatest(CASE WHEN number_substances > 0 THEN 1 ELSE 0 END, any_opioids, {_any(GENERAL_DRUG)}) AS any_drugs FROM n) ")


@query(_corrected + "SELECT * FROM f")
def corrections(spark, d):
    out = classification.apply_corrections(_scored(spark, d), lexicon=LEX)
    return out.select("row_id", *[col(k).alias(safe(k)) for k in (*SUBSTANCES, "Number_Substances", "Polysubstance", "Any Opioids", "Any Drugs")])


_chg = ", ".join(f"CASE WHEN {_m(k)} <> {safe(k)} THEN '{k}: ' || {_m(k)} || '→' || {safe(k)} END" for k in LABELS)


@query(_corrected + f"SELECT row_id, concat_ws('; ', {_chg}) AS changes FROM f WHERE concat_ws('; ', {_chg}) <> ''")
def classification_diff(spark, d):
    s = _scored(spark, d)
    return classification.label_diff(s, classification.apply_corrections(s, lexicon=LEX), "row_id").select("row_id", "changes")


_fm = " UNION ALL ".join(f"SELECT row_id, '{k}' AS label, '{f}' AS field, regexp_extract({_norm(f)}, {lit('(?i)(' + LEX[k] + ')')}, 1) AS match FROM consensus" for k in SUBSTANCES for f in TEXT_FIELDS)


@query(f"SELECT * FROM ({_fm}) WHERE match <> ''")
def matched_terms(spark, d):
    return first_matches(table(spark, d, "consensus"), TEXT_FIELDS, LEX, ["row_id"])


_in = lambda xs: ", ".join(f"'{x}'" for x in xs)
_up = lambda c: f"upper(trim(replace({c}, chr(10), '')))"
_rg = "CASE WHEN o IN (" + _in(text.RACE_UNKNOWN) + ") THEN NULL " + " ".join(f"WHEN o IN ({_in(v)}) THEN '{k}'" for k, v in text.RACE_GROUPS.items()) + " ELSE o END"


@query(
    "WITH s AS (SELECT *, replace(replace(lower(Race), chr(10), ''), ' ', '') AS s FROM consensus), p AS (SELECT *, CASE WHEN s LIKE '%,%' THEN coalesce(list_filter(string_split(s, ','), lambda x: x NOT IN (" + _in(text.RACE_UNKNOWN) + "))[1], 'unknown/other') ELSE s END AS o FROM s), "
    f"g AS (SELECT *, {_rg} AS race_group FROM p) SELECT row_id, race_group, CASE WHEN upper(race_group) IN ({_in(text.RACE_GROUPS)}) THEN upper(race_group) END AS race, "
    f"CASE WHEN {_up('Gender')} IN ('M', 'MALE') THEN 'MALE' WHEN {_up('Gender')} IN ('F', 'FEMALE') THEN 'FEMALE' END AS gender, CASE WHEN {_up('Mode')} = 'UNDETERMI' THEN 'UNDETERMINED' ELSE {_up('Mode')} END AS mode, "
    r"CAST(nullif(regexp_extract(Age, '(\d+)', 1), '') AS DOUBLE) AS age, nullif(regexp_extract(regexp_replace(DeathZip, '\.0$', ''), '(\d{5})', 1), '') AS zip FROM g")
def demographics_clean(spark, d):
    c = table(spark, d, "consensus").withColumn("race_group", text.race_group(F.col("Race")))
    return c.select("row_id", "race_group", text.race_whitelist(F.col("race_group")).alias("race"), text.gender_clean(F.col("Gender")).alias("gender"), text.mode_clean(F.col("Mode")).alias("mode"), text.age_number(F.col("Age")).alias("age"), text.zip5(F.col("DeathZip")).alias("zip"))


# --- consensus ----------------------------------------------------------------------
_words = lambda c: rf"regexp_replace(upper({c}), '\b(NULL|NONE|NAN|N/?A|TRUE|FALSE|UNKNOWN|PENDING|DEFERRED)\b', ' ', 'g')"
_k = lambda c: f"regexp_replace({_words(c)}, '[^A-Z0-9]', '', 'g')"
_kn = lambda c: f"CASE WHEN {_k(c)} NOT IN ({_in(text.NULL_KEYS)}) THEN {_k(c)} END"


def _day_key(c: str) -> str:
    s = f"trim(upper({c}))"
    months = "".join(f" WHEN '{m}' THEN '{i}'" for i, m in enumerate(("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"), 1))
    iso, us, mon = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[T ].*)?$", r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: .*)?$", r"^(\d{1,2})[- ]([A-Z]{3})[A-Z]*[- ](\d{4})$"
    return (
        f"CAST(CASE WHEN regexp_matches({s}, '{iso}') THEN TRY_CAST(regexp_replace({s}, '{iso}', '\\1-\\2-\\3') AS DATE) WHEN regexp_matches({s}, '{us}') THEN TRY_CAST(regexp_replace({s}, '{us}', '\\3-\\1-\\2') AS DATE) "
        f"WHEN regexp_matches({s}, '{mon}') THEN TRY_CAST(regexp_extract({s}, '{mon}', 3) || '-' || CASE regexp_extract({s}, '{mon}', 2){months} END || '-' || regexp_extract({s}, '{mon}', 1) AS DATE) END AS VARCHAR)")


def _key_sql(c: str) -> str:
    if c in ("DeathDate", "DateofBirth"):
        return _day_key(c)
    if c == "Age":
        return r"nullif(regexp_extract(Age, '(\d+)', 1), '')"
    if c in ("DeathZip", "EventZip"):
        return rf"nullif(regexp_extract(regexp_replace(upper({c}), '\.0$', ''), '(\d{{5}})', 1), '')"
    if c == "Gender":
        return f"CASE {_kn(c)} WHEN 'F' THEN 'FEMALE' WHEN 'M' THEN 'MALE' ELSE {_kn(c)} END"
    if c == "Race":
        return "CASE " + " ".join(f"WHEN {_kn(c)} LIKE '%{a}%' THEN '{b}'" for a, b in text.RACE_BUCKETS) + f" ELSE {_kn(c)} END"
    return _kn(c)


_kept_entry = "{'norm': %s, 'n': %s, 'val': %s, 'ord': %s, 'heads': %s, 'tails': %s}"
_fragment = (
    "length(w.norm) >= 5 AND x.norm <> w.norm AND CASE WHEN starts_with(x.norm, w.norm) THEN w.hang OR coalesce(NOT list_contains(x.heads, w.norm), false) "
    "WHEN ends_with(x.norm, w.norm) THEN coalesce(NOT list_contains(x.tails, w.norm), false) ELSE false END")
# Ballots, votes by key, folding from the longest key to the shortest (one step of the recursion a vote), reliability, backers.
_votes = (
    "WITH RECURSIVE c AS (SELECT * FROM consensus WHERE regexp_matches(CaseNumber, '^\\d{4}-\\d+$')), u AS (" + " UNION ALL ".join(f"SELECT CaseNumber AS cn, source_file AS src, row_id AS ord, '{c}' AS col, {c} AS val, {_key_sql(c)} AS norm FROM c" for c in MAPPED) + "), "
    "l AS (SELECT cn, col, src, norm, arg_min(val, ord) AS val, min(ord) AS ord FROM u WHERE val IS NOT NULL AND norm IS NOT NULL GROUP BY ALL), "
    r"v AS (SELECT cn, col, norm, count(*) AS n, arg_min(val, (length(val) - length(regexp_replace(val, '\s', '', 'g')), ord)) AS val, min(ord) AS ord FROM l GROUP BY ALL), "
    f"x AS (SELECT *, count(*) OVER (PARTITION BY cn, col) AS k, row_number() OVER (PARTITION BY cn, col ORDER BY -length(norm), norm) AS rk, regexp_extract_all({_words('val')}, '[A-Z0-9]+') AS ws FROM v), "
    r"w AS (SELECT *, regexp_matches(val, '(?i)(,|\b(" + "|".join(consensus.HANGING_WORDS) + r"))\s*$') AS hang, "
    "CASE WHEN array_to_string(ws, '') = norm THEN list_transform(range(1, len(ws) + 1), lambda i: array_to_string(ws[1:i], '')) END AS heads, CASE WHEN array_to_string(ws, '') = norm THEN list_transform(range(1, len(ws) + 1), lambda i: array_to_string(ws[i:], '')) END AS tails FROM x), "
    f"r AS (SELECT cn, col, rk, k, [{_kept_entry % ('norm', 'n', 'val', 'ord', 'heads', 'tails')}] AS kept FROM w WHERE rk = 1 UNION ALL SELECT r.cn, r.col, w.rk, r.k, CASE WHEN list_contains(list_transform(r.kept, lambda x: {_fragment}), true) "
    f"THEN list_transform(r.kept, lambda x, i: {_kept_entry % ('x.norm', f'x.n + CASE WHEN i = list_position(list_transform(r.kept, lambda x: {_fragment}), true) THEN w.n ELSE 0 END', 'x.val', 'x.ord', 'x.heads', 'x.tails')}) "
    f"ELSE list_append(r.kept, {_kept_entry % ('w.norm', 'w.n', 'w.val', 'w.ord', 'w.heads', 'w.tails')}) END FROM r JOIN w ON w.cn = r.cn AND w.col = r.col AND w.rk = r.rk + 1), "
    "f AS (SELECT cn, col, len(kept) AS kk, unnest(kept) AS e FROM r WHERE rk = k), q AS (SELECT cn, col, kk, e.norm AS norm, e.n AS n, e.val AS val, e.ord AS ord FROM f), "
    "p AS (SELECT cn, col, norm AS winner FROM q WHERE kk > 1 AND col <> 'SourcePages' QUALIFY row_number() OVER (PARTITION BY cn, col ORDER BY n DESC, ord) = 1), "
    "s AS (SELECT l.*, winner, norm = winner OR (length(norm) >= 5 AND (starts_with(winner, norm) OR ends_with(winner, norm))) AS agree FROM l JOIN p USING (cn, col)), "
    "rel AS (SELECT src, avg(CASE WHEN agree THEN 1.0 ELSE 0.0 END) AS rel FROM s GROUP BY src), b AS (SELECT cn, col, norm, max(rel) AS rel FROM l LEFT JOIN rel USING (src) GROUP BY ALL), "
    "win AS (SELECT cn, col, norm, n, val, rel FROM q JOIN b USING (cn, col, norm) QUALIFY row_number() OVER (PARTITION BY cn, col ORDER BY n DESC, coalesce(rel, -1) DESC, ord) = 1) ")
_tidy = lambda c: rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def _vote(spark, d):
    return consensus.vote(consensus.ballots(table(spark, d, "consensus"), MAPPED))


@query(_votes + "SELECT cn AS case_number, col AS field, norm, n::BIGINT AS votes, round(rel, 6) AS reliability FROM win")
def consensus_vote(spark, d):
    w = consensus.winners(table(spark, d, "consensus"), MAPPED, "norm").select("case", F.posexplode("won").alias("_i", "_w")).filter("_w is not null")
    return w.select(F.col("case").alias("case_number"), F.get(F.array(*map(F.lit, MAPPED)), F.col("_i")).alias("field"), F.col("_w.text").alias("norm"), F.col("_w.count").alias("votes"), F.round("_w.reliability", 6).alias("reliability"))


@query(_votes + "SELECT src AS source, round(rel, 6) AS reliability FROM rel")
def source_reliability(spark, d):
    return _vote(spark, d)["reliability"].select("source", F.round("reliability", 6).alias("reliability"))


@query(_votes + "SELECT cn AS CaseNumber, " + ", ".join(f"max({_tidy('val')}) FILTER (WHERE col = '{c}') AS {c}" for c in MAPPED) + " FROM win GROUP BY cn")
def consensus_collated(spark, d):
    return consensus.collated(table(spark, d, "consensus"), MAPPED)


@query(_votes + f"SELECT s.cn AS \"case\", s.col AS \"column\", s.src AS source, {_tidy('s.val')} AS value, {_tidy('win.val')} AS winning_value FROM s JOIN win USING (cn, col) WHERE NOT agree")
def consensus_disagreements(spark, d):
    return consensus.collate(table(spark, d, "consensus"), MAPPED)["disagreements"]


@query(
    _votes + ", a AS (SELECT src, count(*) AS contested, sum((NOT agree)::INT)::BIGINT AS against FROM s GROUP BY src), h AS (SELECT source_file AS src, count(*) AS rows FROM c GROUP BY 1), g AS (SELECT src, count(*) AS cells FROM l WHERE col <> 'SourcePages' GROUP BY src) "
    "SELECT src AS source, contested, against, round(rel, 6) AS reliability, round(against / contested, 6) AS rate, rows, cells FROM a JOIN h USING (src) JOIN g USING (src) JOIN rel USING (src)")
def consensus_files(spark, d):
    f = consensus.collate(table(spark, d, "consensus"), MAPPED)["files"]
    return f.withColumn("reliability", F.round("reliability", 6))


# --- versions of the master ---------------------------------------------------------
CELLS = ["DeathDate", "Age", "Gender", "Race", "Mode", "CauseA", "Fentanyl", "Heroin"]
_date = "coalesce(try_strptime(trim(DeathDate), ['%Y-%m-%d', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S', '%d %b %Y', '%d-%b-%Y']))::DATE"
_cv = lambda c: rf"regexp_replace(trim(coalesce(CAST({c} AS VARCHAR), '')), '^(-?\d+)\.0+$', '\1')"
_chgd = "(" + " UNION ALL ".join(f"SELECT s, CaseNumber, '{c}' AS field, {_cv('o.' + c)} AS old_value, {_cv('n.' + c)} AS new_value FROM o JOIN n USING (s, CaseNumber) WHERE {_cv('o.' + c)} <> {_cv('n.' + c)}" for c in CELLS) + ")"
# Each snapshot against the one before; s numbers the later one.
_versions = (
    "WITH l AS (SELECT * FROM audit_stability WHERE CaseNumber IS NOT NULL QUALIFY row_number() OVER (PARTITION BY snapshot_no, CaseNumber ORDER BY row_no DESC) = 1), d AS (SELECT snapshot_no AS s, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS nx FROM (SELECT DISTINCT snapshot_no FROM audit_stability)), "
    "o AS (SELECT nx AS s, l.* FROM l JOIN d ON d.s = l.snapshot_no WHERE nx IS NOT NULL), n AS (SELECT snapshot_no AS s, l.* FROM l WHERE snapshot_no > (SELECT min(s) FROM d)) ")


def _compare(spark, d):
    a = table(spark, d, "audit_stability")
    number = a.select("snapshot_no").distinct()
    after = number.join(number.select(F.col("snapshot_no").alias("s")), F.col("s") > F.col("snapshot_no")).groupBy("snapshot_no").agg(F.min("s").alias("s"))
    last = a.filter("CaseNumber is not null").groupBy("snapshot_no", "CaseNumber").agg(F.max_by(F.struct(*CELLS), "row_no").alias("_r")).select("snapshot_no", "CaseNumber", "_r.*")
    old = last.join(after, "snapshot_no").drop("snapshot_no")
    new = last.join(after.select(F.col("s").alias("snapshot_no")), "snapshot_no", "left_semi").withColumnRenamed("snapshot_no", "s")
    return stability.compare(old, new, "CaseNumber", CELLS, F.date_format(dates.parse_mixed_date(F.col("DeathDate")), "yyyy-MM"), ["s"])


_n = lambda q: f"(SELECT count(*) FROM {q} x WHERE x.s = t.s)"


@query(_versions + f", t AS (SELECT nx AS s FROM d WHERE nx IS NOT NULL) SELECT s, {_n('o')} AS old_rows, {_n('n')} AS new_rows, {_n('(SELECT n.s FROM n ANTI JOIN o USING (s, CaseNumber))')} AS added, {_n('(SELECT o.s FROM o ANTI JOIN n USING (s, CaseNumber))')} AS removed, {_n('(SELECT n.s FROM n JOIN o USING (s, CaseNumber))')} AS shared, {_n(_chgd)} AS changed_cells, {_n(f'(SELECT DISTINCT s, CaseNumber FROM {_chgd})')} AS changed_cases FROM t")
def snapshot_summary(spark, d):
    return _compare(spark, d)["summary"]


@query(_versions + f"SELECT * FROM {_chgd}")
def changed_cells(spark, d):
    return _compare(spark, d)["changed"].select("s", "CaseNumber", F.col("column").alias("field"), F.col("old").alias("old_value"), F.col("new").alias("new_value"))


@query(_versions + f", a AS (SELECT s, strftime({_date}, '%Y-%m') AS month, 1 AS x, 0 AS y FROM o UNION ALL SELECT s, strftime({_date}, '%Y-%m'), 0, 1 FROM n) SELECT s, month, sum(x)::BIGINT AS old_n, sum(y)::BIGINT AS new_n, (sum(y) - sum(x))::BIGINT AS delta FROM a GROUP BY s, month")
def monthly_delta(spark, d):
    return _compare(spark, d)["months"]


def _replay_sql(steps: int = 5) -> str:
    """The master after each of five files: the state competes with the next file's rows, ties going to the later row."""
    merge = ", ".join(f"arg_min({c}, r) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in CELLS)
    full = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in ["CaseNumber", *CELLS])
    cols = ", ".join(CELLS)
    out = []
    for k in range(1, steps + 1):
        part = f"SELECT CaseNumber, {cols}, row_no AS ord FROM audit_stability WHERE snapshot_no = {k}" + (f" UNION ALL SELECT CaseNumber, {cols}, -1 FROM s{k - 1}" if k > 1 else "")
        out.append(f"s{k} AS (SELECT CaseNumber, {merge} FROM (SELECT *, -({full})::BIGINT * 1000000000000 - ord AS r FROM ({part})) GROUP BY CaseNumber)")
    tell = " UNION ALL ".join(
        f"SELECT {k} AS snapshot_no, (SELECT count(*) FROM (SELECT CaseNumber AS k FROM s{k} WHERE CaseNumber IS NOT NULL) ANTI JOIN (SELECT CaseNumber AS k FROM s{k - 1}) USING (k)) + (SELECT count(*) FROM s{k} WHERE CaseNumber IS NULL) AS added, "
        f"(SELECT count(*) FROM (SELECT CaseNumber AS k FROM s{k - 1} WHERE CaseNumber IS NOT NULL) ANTI JOIN (SELECT CaseNumber AS k FROM s{k}) USING (k)) + (SELECT count(*) FROM s{k - 1} WHERE CaseNumber IS NULL) AS removed, "
        "(SELECT " + " + ".join(f"coalesce(sum(({_cv('o.' + c)} <> {_cv('n.' + c)})::INT), 0)" for c in CELLS) + f" FROM s{k - 1} o JOIN s{k} n USING (CaseNumber))::BIGINT AS changed_cells" for k in range(2, steps + 1))
    return "WITH " + ", ".join(out) + " " + tell


@query(_replay_sql())
def replay_audit(spark, d):
    a = table(spark, d, "audit_stability").select("snapshot_no", (F.col("snapshot_no") * 10_000_000_000 + F.col("row_no")).alias("ord"), "CaseNumber", *CELLS)
    return stability.replay(a, "snapshot_no", "CaseNumber", "ord", CELLS, F.date_format(dates.parse_mixed_date(F.col("DeathDate")), "yyyy-MM"))


# --- label audits -------------------------------------------------------------------
def _labelled(spark, d):
    return _every(spark, d).select("row_no", "CauseA", *[col(c) for c in LABELS])


_lab = lambda c: f"coalesce({q(c)}, 0)"
_base = f"WITH a AS (SELECT * FROM {_all}), "
_match = "m AS (" + " UNION ALL ".join(f"SELECT row_no, '{k}' AS label, {_lab(k)} AS v, lower(unnest(regexp_extract_all(coalesce(CauseA, ''), {lit('(?i)' + LEX[k])}))) AS term FROM a" for k in SUBSTANCES) + "), p AS (SELECT term, label, sum(v)::BIGINT AS tp, count(*) - sum(v)::BIGINT AS fp, count(*) AS n, round(sum(v) / count(*), 3) AS precision FROM m GROUP BY term, label) "


def _matches(spark, d):
    return label_audit.matches(_labelled(spark, d), "row_no", "CauseA", LEX)


@query(_base + _match + "SELECT * FROM p")
def term_precision(spark, d):
    return label_audit.term_precision(_matches(spark, d))


@query(_base + _match + f"SELECT row_no, label, term, precision FROM (SELECT m.*, p.precision, p.fp FROM m JOIN p USING (term, label) WHERE v = 0 AND term NOT IN ({_in(label_audit.CONVENTION_TERMS)}) AND p.precision < 0.9) QUALIFY row_number() OVER (PARTITION BY row_no, label ORDER BY precision, fp DESC, term) = 1")
def review_candidates(spark, d):
    m = _matches(spark, d)
    return label_audit.review_candidates(m, label_audit.term_precision(m), "row_no")


@query(_base + "x AS (SELECT 1) " + " UNION ALL ".join(f"SELECT row_no, '{k}' AS label FROM a WHERE {_lab(k)} = 1 AND NOT regexp_matches(coalesce(CauseA, ''), {lit('(?i)' + LEX[k])})" for k in SUBSTANCES))
def unexplained_labels(spark, d):
    return label_audit.unexplained_labels(_labelled(spark, d), "row_no", "CauseA", LEX)


_ors = lambda cs: "greatest(" + ", ".join(_lab(c) for c in cs) + ")"


@query(
    _base + f"b AS (SELECT row_no, coalesce(CauseA, '') AS t, {_ors(label_audit.OPIOIDS)} AS op, {_lab('Any Opioids')} AS ao, {_ors(SUBSTANCES)} AS su, {_lab('Any Drugs')} AS ad FROM a) "
    "SELECT row_no, 'opioids' AS \"check\", CASE WHEN ao = 1 AND regexp_matches(t, '(?i)\\b(opioids?|opiates?|benzodiazepines?)\\b') THEN 'info' ELSE 'error' END AS severity FROM b WHERE op <> ao "
    "UNION ALL SELECT row_no, 'drugs missing', 'error' FROM b WHERE su = 1 AND ad = 0 UNION ALL SELECT row_no, 'drugs alone', 'info' FROM b WHERE su = 0 AND ad = 1")
def label_invariants(spark, d):
    return label_audit.invariants(_labelled(spark, d), "row_no", "CauseA")


@query(
    _base + "g AS (SELECT md5(CauseA) AS text_hash, min(row_no) AS first_row, count(*) AS n_rows, " + ", ".join(f"sum({_lab(k)})::BIGINT AS s{i}" for i, k in enumerate(LABELS)) + " FROM a WHERE trim(CauseA) <> '' GROUP BY 1) "
    + " UNION ALL ".join(f"SELECT text_hash, first_row, n_rows, '{k}' AS label, s{i} AS n_ones FROM g WHERE s{i} > 0 AND s{i} < n_rows" for i, k in enumerate(LABELS)))
def duplicate_conflicts(spark, d):
    return label_audit.duplicate_conflicts(_labelled(spark, d), "row_no", "CauseA", LABELS)


@query(
    _base + "o AS (SELECT DISTINCT row_no, term, label FROM (" + " UNION ALL ".join(f"SELECT row_no, '{k}' AS label, lower(unnest(regexp_extract_all(coalesce(CauseA, ''), {lit('(?i)' + LEX[k])}))) AS term FROM a" for k in SUBSTANCES) + ")), "
    "g AS (SELECT term, label, count(*) AS n, " + ", ".join(f"sum({_lab(k)})::BIGINT AS s{i}" for i, k in enumerate(SUBSTANCES)) + " FROM o JOIN a USING (row_no) GROUP BY term, label) "
    + " UNION ALL ".join(f"SELECT term, label, n, '{k}' AS other, s{i} AS n_other FROM g WHERE label <> '{k}' AND s{i} > 0" for i, k in enumerate(SUBSTANCES)))
def pattern_leak(spark, d):
    a = _labelled(spark, d)
    return label_audit.pattern_leak(label_audit.matches(a, "row_no", "CauseA", LEX), a, "row_no")


def _negated_sql(key: str, txt: str, source: str, labels, value) -> str:
    """Labels whose every match follows a negation within the last words before it in its field."""
    last = r"string_split(trim(regexp_replace(string_split(array_to_string(p[1:i - 1], ''), '|')[-1], '[,\s]+', ' ', 'g')), ' ')"
    one = lambda k: (
        f"SELECT {key}, '{k}' AS label, array_to_string(list_sort(list_distinct(m)), ', ') AS terms FROM (SELECT {key}, string_split(regexp_replace({txt}, {lit('(?i)(' + LEX[k] + ')')}, chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS p, regexp_extract_all({txt}, {lit('(?i)' + LEX[k])}) AS m FROM {source} WHERE {value(k)} = 1) "
        f"WHERE len(m) > 0 AND len(list_filter(range(2, len(p) + 1, 2), lambda i: NOT regexp_matches(array_to_string(list_slice({last}, -{label_audit.NEGATION_WORDS}, -1), ' '), {lit(label_audit.NEGATION)}))) = 0")
    return " UNION ALL ".join(one(k) for k in labels)


@query(_negated_sql("doc_id", "coalesce(text, '')", "documents", SUBSTANCES, lambda k: "1"))
def negated_mentions(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text", *[F.lit(1).alias(k) for k in SUBSTANCES])
    return label_audit.negated_rows(t, "doc_id", "text", LEX)


_conv = r"regexp_matches(coalesce(CauseA, ''), '(?i)\b(opioids?|opiates?|benzodiazepines?)\b')"
_set = {k: f"CASE WHEN EXISTS (SELECT 1 FROM ok WHERE ok.row_no = a.row_no AND ok.label = '{k}') THEN 1 ELSE {_lab(k)} END" for k in SUBSTANCES}


_auto_sql = (
    _base + _match + f", cand AS (SELECT DISTINCT row_no, label FROM m JOIN p USING (term, label) WHERE v = 0 AND term NOT IN ({_in(label_audit.CONVENTION_TERMS)}) AND p.precision >= 0.9), neg AS ({_negated_sql('row_no', 'coalesce(CauseA, chr(32))', 'a', SUBSTANCES, _lab)}), "
    "ok AS (SELECT row_no, label FROM cand ANTI JOIN neg USING (row_no, label)), n AS (SELECT row_no, CauseA, " + ", ".join(f"{v} AS {safe(k)}" for k, v in _set.items()) + f", {_lab('Any Opioids')} AS ao, {_lab('Any Drugs')} AS ad FROM a), "
    f"o AS (SELECT *, greatest(heroin, fentanyl, prescription_opioids, CASE WHEN {_conv} THEN ao ELSE 0 END) AS any_opioids FROM n) "
    "SELECT row_no, " + ", ".join(safe(k) for k in SUBSTANCES) + ", any_opioids, greatest(ad, any_opioids, " + ", ".join(safe(k) for k in SUBSTANCES) + ") AS any_drugs FROM o")


@query(_auto_sql)
def auto_corrections(spark, d):
    return _auto_corrected(spark, d).select("row_no", *[col(c).alias(safe(c)) for c in LABELS])


def _auto_corrected(spark, d):
    a = _labelled(spark, d)
    m = label_audit.matches(a, "row_no", "CauseA", LEX)
    cand = label_audit.review_candidates(m, label_audit.term_precision(m), "row_no", low=False)
    return label_audit.auto_correct(a, "row_no", "CauseA", cand, label_audit.negated_rows(a, "row_no", "CauseA", LEX))


@query(
    f"WITH f AS ({_auto_sql}), b AS (SELECT row_no, " + ", ".join(f"{_lab(k)} AS {safe(k)}" for k in LABELS) + f" FROM {_all}) "
    + " UNION ALL ".join(f"SELECT row_no, '{k}' AS label, b.{safe(k)} AS before, f.{safe(k)} AS after FROM f JOIN b USING (row_no) WHERE b.{safe(k)} <> f.{safe(k)}" for k in LABELS))
def auto_correction_log(spark, d):
    """Every label value that the automatic corrections changed."""
    return label_audit.change_log(_labelled(spark, d), _auto_corrected(spark, d), "row_no", LABELS)


# --- metrics ------------------------------------------------------------------------
def _predicted(spark, d):
    a = _labelled(spark, d)
    return a.withColumns({f"{k}_pred": F.coalesce(F.col("CauseA").rlike("(?i)" + LEX[k]), F.lit(False)).cast("int") for k in SUBSTANCES}).withColumn("score", (F.col("row_no") * 7919 % 1000) / 1000)


_pred = lambda k: _hit("coalesce(CauseA, '')", LEX[k])
_pairs = "l AS (" + " UNION ALL ".join(f"SELECT '{k}' AS label, {_lab(k)} AS y, {_pred(k)} AS p FROM a" for k in SUBSTANCES) + "), c AS (SELECT label, sum((y = 1 AND p = 1)::INT)::BIGINT AS tp, sum((y = 0 AND p = 1)::INT)::BIGINT AS fp, sum((y = 1 AND p = 0)::INT)::BIGINT AS fn, sum((y = 0 AND p = 0)::INT)::BIGINT AS tn FROM l GROUP BY label), "
_rat = "e AS (SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(tp / (tp + fp), 6) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0 ELSE round(tp / (tp + fn), 6) END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM c) "


@query(_base + _pairs + _rat + "SELECT * FROM e")
def label_metrics(spark, d):
    return metrics.label_metrics(metrics.long_predictions(_predicted(spark, d), SUBSTANCES))


_wrong = " + ".join(f"(CASE WHEN {_lab(k)} <> {_pred(k)} THEN 1 ELSE 0 END)" for k in SUBSTANCES)


@query(_base + _pairs + _rat + f", w AS (SELECT {_wrong} AS w FROM a) SELECT (SELECT round(sum(w) / (count(*) * 8), 6) FROM w) AS hamming_loss, (SELECT round(avg((w = 0)::INT), 6) FROM w) AS subset_accuracy, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1 FROM e")
def multilabel_metrics(spark, d):
    return metrics.multilabel_metrics(_predicted(spark, d), list(SUBSTANCES))


@query(_base + "s AS (SELECT (row_no * 7919 % 1000) / 1000 AS s, coalesce(Fentanyl, 0) AS y FROM a), r AS (SELECT s, y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS k FROM s), t AS (SELECT sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg, sum(k * y) AS rs FROM r) SELECT pos, neg, round(CASE WHEN pos > 0 AND neg > 0 THEN (rs - pos * (pos + 1) / 2) / (pos * neg) END, 6) AS auc FROM t")
def roc_auc(spark, d):
    return metrics.roc_auc(_predicted(spark, d).withColumn("y", F.coalesce("Fentanyl", F.lit(0))), "score", "y")


@query(
    _base + "s AS (" + " UNION ALL ".join(f"SELECT '{k}' AS label, floor((row_no * 7919 % 1000) / 10)::INT AS b, coalesce({q(k)}, 0) AS y FROM a" for k in SUBSTANCES) + "), h AS (SELECT label, b, sum(y) AS pos, count(*) AS n FROM s GROUP BY ALL), g AS (SELECT unnest(range(0, 101)) AS t), "
    "x AS (SELECT label, t, sum(CASE WHEN b >= t THEN pos ELSE 0 END) AS tp, sum(CASE WHEN b >= t THEN n - pos ELSE 0 END) AS fp, sum(CASE WHEN b < t THEN pos ELSE 0 END) AS fn FROM g, h GROUP BY label, t), f AS (SELECT label, t, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM x) "
    "SELECT label, round(t / 100.0, 2)::DOUBLE AS threshold, f1::DOUBLE AS f1 FROM f QUALIFY row_number() OVER (PARTITION BY label ORDER BY f1 DESC, t) = 1")
def best_thresholds(spark, d):
    return metrics.best_thresholds(_predicted(spark, d), {k: "score" for k in SUBSTANCES})


@query()
def bootstrap_interval(spark, d):
    return metrics.bootstrap_interval(_predicted(spark, d).withColumn("y", F.coalesce("Fentanyl", F.lit(0))), "y", "row_no", 200)


# --- reports ------------------------------------------------------------------------
def _dated(spark, d):
    a = _every(spark, d).withColumn("day", dates.parse_mixed_date(F.col("DeathDate")))
    return a.withColumns({"year": F.year("day"), "month": F.date_format("day", "yyyy-MM")})


_dt = f"WITH a AS (SELECT *, {_date} AS day FROM {_all}), b AS (SELECT *, year(day) AS year, strftime(day, '%Y-%m') AS month FROM a) "


@query(_dt + "SELECT Mode AS mode, CASE WHEN grouping(year) = 1 THEN 'All' ELSE CAST(year AS VARCHAR) END AS year, count(*) AS n, sum(Fentanyl)::BIGINT AS fentanyl FROM b GROUP BY GROUPING SETS ((Mode, year), (Mode))")
def rollup_all(spark, d):
    a = _dated(spark, d).withColumnRenamed("Mode", "mode")
    return reports.rollup_with_all(a, ["mode"], "year", [F.count("*").alias("n"), F.sum("Fentanyl").alias("fentanyl")])


_melt = " UNION ALL ".join(f"SELECT *, '{k}' AS type FROM b WHERE {q(k)} = 1" for k in LABELS)


@query(_dt + f", m AS (SELECT type, month, count(*) AS n FROM ({_melt}) GROUP BY type, month) SELECT type, month, n, round(avg(n) OVER (PARTITION BY type ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS rolling FROM m")
def rolling12(spark, d):
    m = reports.melt_flags(_dated(spark, d), ["month"], list(LABELS)).groupBy("type", "month").agg(F.count("*").alias("n"))
    return reports.rolling_mean(m, ["type"], "month", "n")


@query(_dt + "SELECT m.month, s.Mode AS mode, count(b.row_no) AS n FROM (SELECT DISTINCT month FROM b WHERE month IS NOT NULL) m CROSS JOIN (SELECT DISTINCT Mode FROM b WHERE Mode IS NOT NULL) s LEFT JOIN b ON b.month = m.month AND b.Mode = s.Mode GROUP BY ALL")
def complete_grid(spark, d):
    c = _dated(spark, d).groupBy("month", F.col("Mode").alias("mode")).agg(F.count("*").alias("n"))
    return reports.complete_grid(c, ["month", "mode"], "n")


@query(_dt + "SELECT year, " + ", ".join(f"sum((Mode = '{m}')::INT)::BIGINT AS Mode_{m}" for m in ("ACCIDENT", "NATURAL", "SUICIDE")) + " FROM b GROUP BY year")
def category_counts(spark, d):
    return reports.category_counts(_dated(spark, d), ["year"], "Mode", ["ACCIDENT", "NATURAL", "SUICIDE"], "Mode_")


_combos = [c for k in (2, 3, 4, 5) for c in __import__("itertools").combinations(SUBSTANCES, k)]


@query(_base + "x AS (" + " UNION ALL ".join(f"SELECT '{' + '.join(c)}' AS combination, {len(c)} AS size FROM a WHERE " + " AND ".join(f"{q(k)} = 1" for k in c) for c in _combos) + ") SELECT combination, size, count(*) AS n FROM x GROUP BY ALL ORDER BY n DESC, combination LIMIT 20")
def cooccurrence(spark, d):
    return reports.cooccurrence(_labelled(spark, d), list(SUBSTANCES))


@query(_dt + ", g AS (SELECT count(*) AS n FROM b GROUP BY year, Race) SELECT count(*) AS cells, sum(n)::BIGINT AS rows, sum((n < 5)::INT)::BIGINT AS small_cells, sum(CASE WHEN n < 5 THEN n ELSE 0 END)::BIGINT AS rows_in_small FROM g")
def small_cells(spark, d):
    return reports.small_cells(_dated(spark, d), ["year", "Race"])


@query("WITH o AS (SELECT DISTINCT Mode AS mode, CaseNumber, source_file FROM consensus WHERE CaseNumber IS NOT NULL AND Mode IS NOT NULL), f AS (SELECT mode, CaseNumber, min(source_file) AS first_file FROM o GROUP BY ALL) SELECT mode, source_file, count(*) AS n_cases, sum((source_file = first_file)::INT)::BIGINT AS n_new FROM o JOIN f USING (mode, CaseNumber) GROUP BY ALL")
def novel_contribution(spark, d):
    c = table(spark, d, "consensus").filter("CaseNumber is not null and Mode is not null").select(F.col("Mode").alias("mode"), "CaseNumber", "source_file")
    return reports.novel_contribution(c, "mode", "CaseNumber", "source_file")


@query("SELECT CaseNumber, string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS sources, count(DISTINCT source_file) AS n_sources FROM consensus GROUP BY CaseNumber HAVING count(DISTINCT source_file) >= 3")
def coverage(spark, d):
    return reports.coverage(table(spark, d, "consensus"), "CaseNumber", "source_file")


@query(_dt + ", g AS (SELECT floor(date_diff('day', DATE '1970-01-05', day) / 28)::BIGINT AS w, count(*) AS n FROM b WHERE day IS NOT NULL GROUP BY 1), s AS (SELECT unnest(range((SELECT min(w) FROM g), (SELECT max(w) FROM g) + 1)) AS w) SELECT CAST((DATE '1970-01-05' + CAST((w + 1) * 28 - 1 AS INT))::DATE AS VARCHAR) AS period_end, coalesce(n, 0) AS n FROM s LEFT JOIN g USING (w)")
def four_week_counts(spark, d):
    return reports.windows_of_weeks(_dated(spark, d), "day").withColumn("period_end", F.col("period_end").cast("string"))


@query("WITH g AS (SELECT CaseNumber, " + ", ".join(f"count(DISTINCT {c}) AS d{i}" for i, c in enumerate(FILLED)) + " FROM consensus GROUP BY CaseNumber) " + " UNION ALL ".join(f"SELECT CaseNumber, '{c}' AS field, d{i} AS n_values FROM g WHERE d{i} > 1" for i, c in enumerate(FILLED)))
def column_differences(spark, d):
    return reports.column_differences(table(spark, d, "consensus"), ["CaseNumber"], FILLED).withColumnRenamed("column", "field")


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, sum(({c} IS NULL)::INT)::BIGINT AS n_null, count(*) AS n_rows FROM consensus" for c in MERGED))
def null_census(spark, d):
    return reports.null_census(table(spark, d, "consensus").select(*MERGED)).withColumnRenamed("column", "field")


@query("SELECT source_file, count(*) AS n, CAST(CAST(min(received_at) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(received_at) AS DATE) AS VARCHAR) AS last, strftime(min(received_at), '%Y/%m') || ' - ' || strftime(max(received_at), '%Y/%m') AS range FROM consensus GROUP BY source_file")
def source_stats(spark, d):
    return reports.source_stats(table(spark, d, "consensus"), "source_file", F.to_date("received_at")).withColumns({c: F.col(c).cast("string") for c in ("first", "last")})


@query(_dt + r", g AS (SELECT row_no, day, TRY_CAST(nullif(regexp_extract(Age, '(\d+)', 1), '') AS DOUBLE) AS n FROM b) SELECT row_no, strftime(day, '%Y-%m') AS month, year(day) AS year, CAST(strftime(day, '%U') AS INT) AS week, CASE WHEN n >= 0 AND n < 100 THEN CAST(floor(n / 10) * 10 AS INT) || '-' || CAST(floor(n / 10) * 10 + 9 AS INT) END AS age_bin FROM g")
def deidentified(spark, d):
    a = _dated(spark, d)
    return a.select("row_no", "month", "year", dates.week_of_year_sunday(F.col("day")).alias("week"), dates.age_bin(text.age_number(F.col("Age"))).alias("age_bin"))


# --- joins --------------------------------------------------------------------------
@query("WITH p AS (SELECT event_id, user_id, epoch_us(ts)::DOUBLE AS t FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, epoch_us(ts)::DOUBLE AS t, max(event_id) AS last_click FROM events WHERE event_type = 'click' GROUP BY ALL) SELECT p.event_id, p.user_id, c.last_click FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.t >= c.t")
def asof_last_click(spark, d):
    e = table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")).cast("double"))
    p = e.filter("event_type = 'purchase'").select("event_id", "user_id", "t")
    c = e.filter("event_type = 'click'").select("user_id", "t", F.col("event_id").alias("last_click"))
    return relations.asof_backward(p, c, ["user_id"], "t", "t", "last_click").select("event_id", "user_id", "last_click")


@query("SELECT e.event_id, p.p_partkey FROM events e JOIN part p ON e.user_id % 50 = p.p_size AND e.value BETWEEN p.p_retailprice - 900 AND p.p_retailprice - 880")
def interval_match(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("user_id") % 50).cast("int").alias("p_size"), "value")
    p = table(spark, d, "part").select("p_partkey", "p_size", (F.col("p_retailprice") - 900).alias("lo"), (F.col("p_retailprice") - 880).alias("hi"))
    return relations.interval_join(e, p, ["p_size"], "value", "lo", "hi", 20.0).select("event_id", "p_partkey")


@query("SELECT coalesce(a.k, b.k) AS CaseNumber, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side FROM (SELECT DISTINCT CaseNumber AS k FROM audit_stability WHERE snapshot_no = 1 AND CaseNumber IS NOT NULL) a FULL JOIN (SELECT DISTINCT CaseNumber AS k FROM audit_stability WHERE snapshot_no = 5 AND CaseNumber IS NOT NULL) b ON a.k = b.k")
def outer_sides(spark, d):
    a = table(spark, d, "audit_stability").filter("CaseNumber is not null")
    return relations.outer_with_sides(a.filter("snapshot_no = 1"), a.filter("snapshot_no = 5"), "CaseNumber")


@query("SELECT row_no, CaseNumber FROM audit_stability a WHERE snapshot_no = 5 AND NOT EXISTS (SELECT 1 FROM consensus c WHERE c.CaseNumber IS NOT DISTINCT FROM a.CaseNumber)")
def not_in_sources(spark, d):
    return relations.not_in(table(spark, d, "audit_stability").filter("snapshot_no = 5").select("row_no", "CaseNumber"), table(spark, d, "consensus"), "CaseNumber")


@query("WITH n AS (SELECT CaseNumber, max(Age) AS Age, max(Gender) AS Gender FROM audit_stability WHERE snapshot_no = 5 GROUP BY CaseNumber) SELECT a.row_no, a.CaseNumber, coalesce(n.Age, a.Age) AS Age, coalesce(n.Gender, a.Gender) AS Gender FROM audit_stability a LEFT JOIN n ON a.CaseNumber = n.CaseNumber WHERE a.snapshot_no = 1")
def updated_rows(spark, d):
    a = table(spark, d, "audit_stability").select("snapshot_no", "row_no", "CaseNumber", "Age", "Gender")
    return relations.update_from(a.filter("snapshot_no = 1").drop("snapshot_no"), a.filter("snapshot_no = 5"), "CaseNumber", ["Age", "Gender"])


@query(
    "WITH c AS (SELECT DeathAddress AS address, (row_id % 1000) / 1000.0 AS lon, (row_id % 777) / 777.0 AS lat, row_id AS ord FROM consensus), k AS (SELECT address, lon, lat FROM c WHERE address IS NOT NULL QUALIFY row_number() OVER (PARTITION BY address ORDER BY ord) = 1) "
    "SELECT x.row_id, CASE WHEN u THEN d_lon ELSE e_lon END AS lon, CASE WHEN u THEN d_lat ELSE e_lat END AS lat, u AS used_death_address FROM (SELECT a.row_id, e.lon AS e_lon, e.lat AS e_lat, d.lon AS d_lon, d.lat AS d_lat, (e.lon IS NULL OR NOT (e.lon < 0.5)) AND d.lon IS NOT NULL AS u FROM consensus a LEFT JOIN k e ON a.EventAddress = e.address LEFT JOIN k d ON a.DeathAddress = d.address) x")
def geocoded(spark, d):
    c = table(spark, d, "consensus").select("row_id", "EventAddress", "DeathAddress")
    cache = c.select(F.col("DeathAddress").alias("address"), (F.col("row_id") % 1000 / 1000).alias("lon"), (F.col("row_id") % 777 / 777).alias("lat"), F.col("row_id").alias("ord"))
    return relations.geocode(c, cache, "EventAddress", "DeathAddress", lambda lon, lat: lon < 0.5).select("row_id", "lon", "lat", "used_death_address")


@query(
    "WITH g AS (SELECT area_id, json_extract_string(geometry, '$.type') AS t, json_extract(geometry, '$.coordinates') AS c FROM tracts), parts AS (SELECT area_id, row_number() OVER () AS part, p FROM (SELECT area_id, unnest(CASE WHEN t = 'Polygon' THEN [CAST(c AS DOUBLE[][][])] ELSE CAST(c AS DOUBLE[][][][]) END) AS p FROM g)), "
    "rings AS (SELECT area_id, part, unnest(p) AS r FROM parts), edges AS (SELECT area_id, part, r[i] AS a, r[i + 1] AS b FROM (SELECT area_id, part, r, unnest(range(1, len(r))) AS i FROM rings)), "
    "pts AS (SELECT DISTINCT lon, lat FROM audit_stability WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90), "
    "hits AS (SELECT lon, lat, area_id, part, count(*) AS n FROM pts JOIN edges ON (a[2] > lat) <> (b[2] > lat) AND lon < (b[1] - a[1]) * (lat - a[2]) / (b[2] - a[2]) + a[1] GROUP BY ALL) SELECT DISTINCT lon, lat, area_id FROM hits WHERE n % 2 = 1")
def points_in_areas(spark, d):
    r = nearby.regions_of_points(table(spark, d, "audit_stability"), table(spark, d, "tracts"))
    return r.filter(~F.col("on_boundary")).select("lon", "lat", "area_id")


# --- whole runs ---------------------------------------------------------------------
def _records(spark, d):
    return table(spark, d, "consensus").withColumnRenamed("row_id", "_ord").drop("received_at")


@query()
def surveillance_master(spark, d):
    c = table(spark, d, "consensus").select("row_id", "DeathAddress", "DeathCity", "DeathZip")
    spot = F.xxhash64("address")
    cache = c.select(text.full_address(F.col("DeathAddress"), F.col("DeathCity"), F.col("DeathZip")).alias("address"), F.col("row_id").alias("ord")).filter("address is not null")
    cache = cache.withColumns({"lon": -118.95 + F.pmod(spot, F.lit(9000)) / 10000, "lat": 33.65 + F.pmod(F.shiftright(spot, 13), F.lit(8000)) / 10000})
    return pipelines.surveillance(_records(spark, d), cache, None, table(spark, d, "tracts").filter("area_level = 'tract'"), lexicon=LEX).select("CaseNumber", "DeathDate", "Mode", "Race", "Gender", "Age", "lon", "lat", "CT20", *[col(k).alias(safe(k)) for k in LABELS])


@query(
    f"WITH t AS (SELECT CASE WHEN trim(CaseNumber) <> '' THEN CaseNumber END AS CaseNumber, {_rowtext} AS t FROM consensus), f AS (SELECT CaseNumber, " + ", ".join(f"max({_hit('t', LEX[k])}) AS {safe(k)}" for k in SUBSTANCES) + " FROM t GROUP BY CaseNumber) SELECT * FROM f")
def all_records_flags(spark, d):
    r = _records(spark, d).select("_ord", "CaseNumber", *TEXT_FIELDS)
    return pipelines.all_records(r, lexicon=LEX).select("CaseNumber", *[col(k).alias(safe(k)) for k in SUBSTANCES])


@query(_base + _pairs + "g AS (SELECT label, fp, fn FROM c UNION ALL SELECT 'Total', sum(fp)::BIGINT, sum(fn)::BIGINT FROM c) SELECT * FROM g")
def false_counts(spark, d):
    return reports.false_counts(_predicted(spark, d), SUBSTANCES)


@query(_dt + "SELECT year, count(*) AS all_rows, sum((Fentanyl = 1)::INT)::BIGINT AS fentanyl, sum((Mode = 'ACCIDENT')::INT)::BIGINT AS accidents FROM b GROUP BY year")
def year_table(spark, d):
    return reports.year_table(_dated(spark, d), F.col("year"), {"all_rows": F.lit(True), "fentanyl": F.col("Fentanyl") == 1, "accidents": F.col("Mode") == "ACCIDENT"})


@query(_dt + f", m AS (SELECT coalesce(Gender, '') AS sex, type, month FROM ({_melt})), n AS (SELECT CASE WHEN grouping(sex) = 1 THEN 'All' ELSE sex END AS sex, type, month, count(*) AS n FROM m GROUP BY GROUPING SETS ((sex, type, month), (type, month))) SELECT sex, type, month, n, round(avg(n) OVER (PARTITION BY sex, type ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS rolling FROM n")
def monthly_series(spark, d):
    a = _dated(spark, d).withColumn("sex", F.coalesce("Gender", F.lit("")))
    return pipelines.monthly_series(a, "sex", "month", list(LABELS))


@query(_dt + r", v AS (SELECT *, CAST(nullif(regexp_extract(Age, '(\d+)', 1), '') AS DOUBLE) AS ag FROM b), g AS (SELECT Mode, month, count(*) AS n, " + ", ".join(f"sum(coalesce({q(c)}, 0))::BIGINT AS n_{i}" for i, c in enumerate(LABELS)) + ", round(avg(ag), 6) AS age_mean, min(ag) AS age_min, max(ag) AS age_max FROM v GROUP BY Mode, month) SELECT x.Mode AS mode, y.month, coalesce(n, 0) AS n, " + ", ".join(f"coalesce(n_{i}, 0) AS n_{i}" for i, _ in enumerate(LABELS)) + ", age_mean, age_min, age_max FROM (SELECT DISTINCT Mode FROM b WHERE Mode IS NOT NULL) x CROSS JOIN (SELECT DISTINCT month FROM b WHERE month IS NOT NULL) y LEFT JOIN g ON g.Mode = x.Mode AND g.month = y.month")
def space_time_cube(spark, d):
    a = _dated(spark, d).withColumnRenamed("Mode", "mode")
    return pipelines.space_time_cube(a, "mode", "month", list(LABELS), text.age_number(F.col("Age")))


# --- vectors, streams, pages, repair --------------------------------------------------
@query("SELECT label, dim, round(sum(x), 4) AS total FROM (SELECT label, unnest(range(0, len(embedding)))::INT AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY label, dim")
def vector_sum(spark, d):
    return vectors.sum_vectors(table(spark, d, "embeddings"), ["label"], "embedding").withColumn("total", F.round("total", 4))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def hourly_counts(spark, d):
    return windowed_counts(table(spark, d, "events"))


def _words(spark, d):
    e = table(spark, d, "events")
    x0 = F.col("value") % 500
    return e.select((F.col("event_id") / 200).cast("int").alias("page"), (F.col("event_id") % 200 * 1.7).alias("y"), x0.alias("x0"), (x0 + 20).alias("x1"), F.col("event_type").alias("word"))


@query()
def page_lines(spark, d):
    return pages.cluster_lines(_words(spark, d))


@query("WITH w AS (SELECT (event_id // 200)::INT AS page, value % 500 AS x0, value % 500 + 20 AS x1 FROM events), s AS (SELECT *, max(x1) OVER (PARTITION BY page ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM w), g AS (SELECT *, sum(CASE WHEN before IS NULL OR x0 > before THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0, x1 ROWS UNBOUNDED PRECEDING) AS g FROM s) SELECT page, round(min(x0), 4) AS x0, round(max(x1), 4) AS x1 FROM g GROUP BY page, g")
def merged_spans(spark, d):
    return pages.merge_spans(_words(spark, d), ["page"]).select("page", F.round("x0", 4).alias("x0"), F.round("x1", 4).alias("x1"))


@query(r"SELECT word, count(*) AS n FROM (SELECT regexp_replace(unnest(regexp_split_to_array(upper(concat_ws(' ', CauseA, CauseOther)), '\s+')), '[^A-Z0-9]', '', 'g') AS word FROM consensus) WHERE word <> '' GROUP BY word")
def word_counts(spark, d):
    return repair.vocabulary(table(spark, d, "consensus"), ["CauseA", "CauseOther"])


@query()
def repaired_text(spark, d):
    return repair.repair_columns(table(spark, d, "consensus").select("row_id", "CauseA", "CauseOther"), ["CauseA", "CauseOther"], ["METHAMPHETAMINE", "FENTANYL"])
