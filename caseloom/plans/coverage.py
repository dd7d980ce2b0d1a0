"""More queries of the reference's operators, one for each small family, with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import dates, lexicon, text
from caseloom.functions.lexicon import SUBSTANCES
from caseloom.functions.text import col
from caseloom.operators import classification, label_audit, metrics, pages, reports, vectors
from caseloom.operators.classification import LABELS
from caseloom.operators.models import min_max_calibrated
from caseloom.plans import pipelines
from caseloom.plans.reference import LEX, _all, _date, _every, _hit, lit, q, safe
from caseloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _audit(spark, d):
    return table(spark, d, "audit_stability").withColumn("day", dates.parse_mixed_date(F.col("DeathDate")))


_a = f"WITH a AS (SELECT *, {_date} AS day FROM audit_stability) "


# --- rows and columns ---------------------------------------------------------------
@query(_a + "SELECT snapshot_no, row_no FROM a WHERE day > DATE '2021-01-01' AND day < DATE '2024-07-01' AND month(day) IN (3, 4) AND contains(CauseA, 'FENT') AND lower(trim(CAST(in_la_county AS VARCHAR))) IN ('1', 'true', 't', 'y', 'yes')")
def filtered_rows(spark, d):
    """An open range of dates, months, a piece of text and a flag however it is written."""
    a = _audit(spark, d)
    return a.filter((F.col("day") > "2021-01-01") & (F.col("day") < "2024-07-01") & F.month("day").isin(3, 4) & F.contains("CauseA", F.lit("FENT")) & text.truthy(F.col("in_la_county"))).select("snapshot_no", "row_no")


@query(
    "SELECT 'audit' AS origin, 1 AS run, snapshot_no, row_no, coalesce(CAST(CaseNumber AS VARCHAR), 'nan') || '_' || CAST(snapshot_no AS VARCHAR) AS row_key, 'NULL' AS County, CauseA AS cause FROM audit_stability")
def shaped_columns(spark, d):
    """Constants in front, a composite key, a rename, a missing column with its default, and a tolerant drop."""
    a = table(spark, d, "audit_stability").select("snapshot_no", "row_no", "CaseNumber", "CauseA").withColumnsRenamed({"CauseA": "cause", "Cause A": "cause"})
    a = reports.ensure_columns(a, {"County": "NULL", "cause": "NULL"}).withColumn("row_key", F.concat_ws("_", F.coalesce("CaseNumber", F.lit("nan")), F.col("snapshot_no").cast("string")))
    return a.drop("CaseNumber", "FirstName", "no such column").select(F.lit("audit").alias("origin"), F.lit(1).alias("run"), "*")


@query(f"SELECT snapshot_no, row_no, CASE WHEN {_hit('CauseA', '(alcohol|ethanol|etoh|drunk)')} = 1 THEN 1 ELSE coalesce(Alcohol, 0) END AS alcohol, CASE WHEN {_hit('CauseA', '(alcohol|ethanol|etoh|drunk)')} = 1 THEN 1 ELSE coalesce({q('Any Drugs')}, 0) END AS any_drugs FROM audit_stability")
def recoded_labels(spark, d):
    a = classification.recode_by_keywords(table(spark, d, "audit_stability"), "CauseA", ("alcohol", "ethanol", "etoh", "drunk"), ["Alcohol", "Any Drugs"])
    return a.select("snapshot_no", "row_no", F.col("Alcohol").alias("alcohol"), col("Any Drugs").alias("any_drugs"))


@query(
    "WITH u AS (SELECT CaseNumber, Mode, 0 AS p, row_no AS o FROM audit_stability WHERE snapshot_no = 5 UNION ALL SELECT CaseNumber, Mode, 1, row_no FROM audit_stability WHERE snapshot_no = 1) "
    "SELECT CaseNumber, Mode AS mode FROM u WHERE CaseNumber IS NOT NULL QUALIFY row_number() OVER (PARTITION BY CaseNumber ORDER BY p, o) = 1")
def union_first_wins(spark, d):
    a = table(spark, d, "audit_stability").filter("CaseNumber is not null").select("snapshot_no", "CaseNumber", F.col("Mode").alias("mode"), "row_no")
    return reports.union_first_wins([a.filter("snapshot_no = 5"), a.filter("snapshot_no = 1")], ["CaseNumber"], "row_no").select("CaseNumber", "mode")


@query(
    "WITH t AS (SELECT CaseNumber, arg_min(\"Any Drugs\", row_no) AS y FROM audit_stability WHERE snapshot_no = 1 AND CaseNumber IS NOT NULL GROUP BY 1) SELECT a.row_no, a.CaseNumber, coalesce(t.y, 0) AS truth FROM audit_stability a LEFT JOIN t USING (CaseNumber) WHERE a.snapshot_no = 5")
def truth_enriched(spark, d):
    a = table(spark, d, "audit_stability")
    truth = a.filter("snapshot_no = 1 and CaseNumber is not null").groupBy("CaseNumber").agg(F.min_by(F.struct(col("Any Drugs").alias("y")), "row_no")["y"].alias("truth"))
    return a.filter("snapshot_no = 5").join(truth, "CaseNumber", "left").select("row_no", "CaseNumber", F.coalesce("truth", F.lit(0)).alias("truth"))


@query("SELECT t.area_id, t.CT20, count(x.CT20) AS n, t.geometry FROM tracts t LEFT JOIN (SELECT a.lon, b.CT20 FROM (SELECT DISTINCT lon FROM audit_stability WHERE snapshot_no = 5 AND lon IS NOT NULL AND NOT isnan(lon)) a JOIN (SELECT DISTINCT CT20 FROM tracts WHERE CT20 IS NOT NULL) b ON CAST(floor(abs(a.lon) * 1000) AS BIGINT) % 100 = TRY_CAST(right(b.CT20, 2) AS BIGINT)) x ON x.CT20 = t.CT20 GROUP BY ALL")
def geometry_attached(spark, d):
    """Counts by area with the area's geometry put back; areas without a count keep their row."""
    t = table(spark, d, "tracts").select("area_id", "CT20", "geometry")
    p = table(spark, d, "audit_stability").filter("snapshot_no = 5 and lon is not null and not isnan(lon)").select("lon").distinct().withColumn("k", F.pmod(F.floor(F.abs("lon") * 1000), F.lit(100)))
    c = p.join(t.select("CT20").filter("CT20 is not null").distinct().withColumn("k", F.expr("try_cast(right(CT20, 2) as bigint)")), "k").groupBy("CT20").agg(F.count("*").alias("n"))
    return t.join(c, "CT20", "left").select("area_id", "CT20", F.coalesce("n", F.lit(0)).alias("n"), "geometry")


@query("SELECT word, n FROM (SELECT word, count(*) AS n FROM (SELECT left(unnest(regexp_split_to_array(upper(CauseA), ' ')), 200) AS word FROM consensus) WHERE word <> '' GROUP BY word) ORDER BY n DESC, word LIMIT 25")
def head_rows(spark, d):
    """The first rows of an ordered list (a report), with texts shortened for display."""
    w = table(spark, d, "consensus").select(F.explode(F.split(F.upper("CauseA"), " ")).alias("w")).select(F.substring("w", 1, 200).alias("word")).filter("word <> ''")
    return w.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(25)


@query(
    r"SELECT row_id, CAST(CASE WHEN regexp_matches(trim(DeathDate), '^(\d{1,2}/\d{1,2}/\d{4})$') THEN try_strptime(trim(DeathDate), '%m/%d/%Y')::DATE WHEN regexp_matches(trim(DeathDate), '^\d{4}-\d{2}-\d{2}$') THEN try_strptime(trim(DeathDate), '%Y-%m-%d')::DATE END AS VARCHAR) AS exact_day, "
    r"CAST(coalesce(CASE WHEN regexp_matches(trim(DeathDate), '^(\d{1,2}/\d{1,2}/\d{4})$') THEN try_strptime(trim(DeathDate), '%m/%d/%Y')::DATE WHEN regexp_matches(trim(DeathDate), '^\d{4}-\d{2}-\d{2}$') THEN try_strptime(trim(DeathDate), '%Y-%m-%d')::DATE END, received_at::DATE) AS VARCHAR) AS first_day FROM consensus")
def dates_read(spark, d):
    """Dates in one of two exact notations, and the first known of two date columns."""
    c = table(spark, d, "consensus").withColumn("e", dates.parse_exact_date(F.col("DeathDate")))
    return c.select("row_id", F.col("e").cast("string").alias("exact_day"), F.coalesce("e", F.to_date("received_at")).cast("string").alias("first_day"))


# --- text ---------------------------------------------------------------------------
_stop = ("of", "and", "the", "due", "to", "by", "with")


@query(
    f"WITH w AS (SELECT row_id, list_filter(regexp_split_to_array(lower(CauseA), '[,\\s]+'), lambda x: x <> '' AND x NOT IN ({', '.join(lit(s) for s in _stop)})) AS w FROM consensus WHERE CauseA IS NOT NULL) "
    "SELECT row_id, array_to_string(w, ' ') AS words, array_to_string(list_filter(w, lambda x: len(list_filter(w, lambda y: y = x)) <= 1), ' ') AS rare FROM w")
def token_lists(spark, d):
    """Words without stop words, and of these the ones that stand once."""
    c = table(spark, d, "consensus").filter("CauseA is not null").withColumn("w", text.stop_filtered(F.col("CauseA"), _stop))
    return c.select("row_id", F.array_join("w", " ").alias("words"), F.array_join(text.drop_frequent(F.col("w"), 1), " ").alias("rare"))


@query(
    "SELECT row_id, CASE WHEN Gender IS NULL OR upper(trim(Gender)) IN ('', 'NULL', 'NAN', 'NONE') THEN 'NULL' ELSE trim(regexp_replace(Gender, '\\s+', ' ', 'g')) END AS cell, "
    "coalesce(CASE upper(trim(replace(Gender, chr(10), ''))) WHEN 'M' THEN 'Male' WHEN 'MALE' THEN 'Male' WHEN 'F' THEN 'Female' WHEN 'FEMALE' THEN 'Female' END, 'Unknown') AS gender FROM consensus")
def cells_cleaned(spark, d):
    """Cells with the word NULL for what is missing, and gender in title case with Unknown filled in."""
    c = table(spark, d, "consensus")
    return c.select("row_id", text.clean_cell(F.col("Gender")).alias("cell"), F.coalesce(F.initcap(text.gender_clean(F.col("Gender"))), F.lit("Unknown")).alias("gender"))


@query(
    "WITH p AS (SELECT row_id, CASE WHEN trim(DeathAddress) IS NULL OR lower(trim(DeathAddress)) IN ('', 'unknown', 'null', 'nan') THEN NULL ELSE regexp_replace(trim(DeathAddress), '\\.0$', '') END AS a, CASE WHEN lower(trim(DeathCity)) NOT IN ('', 'unknown', 'null', 'nan') THEN regexp_replace(trim(DeathCity), '\\.0$', '') END AS c, "
    "CASE WHEN lower(trim(DeathZip)) NOT IN ('', 'unknown', 'null', 'nan') THEN regexp_replace(trim(DeathZip), '\\.0$', '') END AS z FROM consensus) "
    "SELECT row_id, CASE WHEN a IS NOT NULL THEN concat_ws(', ', regexp_replace(a, '(?i)\\s*(?:#|\\bunit\\b|\\bapt\\b)[^,]*', '', 'g'), c, z) END AS full_address FROM p")
def addresses_joined(spark, d):
    c = table(spark, d, "consensus")
    return c.select("row_id", text.full_address(F.col("DeathAddress"), F.col("DeathCity"), F.col("DeathZip")).alias("full_address"))


_substances = [
    ("Fentanyl X", "Fentanyl and Fentanyl-related", "ffx; fx;fentanyl x"), ("Amphetamine", "Phenethylamines (Amphetamines) (S)", "benzedrine"), ("Phentermine", "Stimulants", "adipex"), ("Ecgonine", "Narcotics", "thing"),
    ("Naloxone", "Narcotics", None), ("Insulin", "Other substances", "humulin"), ("AB", "Heroin", "nan; horse tar"), (None, "Heroin", "Brown Tar"), ("Mitragynine", "Narcotic Analgesics", "Methorphan;kratom leaf")]
_values = ", ".join("(" + ", ".join("NULL" if x is None else lit(x) for x in r) + ")" for r in _substances)
_case_of = lambda m, c: "CASE " + c + " " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in m.items()) + " END"


@query(
    f"WITH s(name, cat, syn) AS (VALUES {_values}), t AS (SELECT cat, lower(trim(name)) AS term FROM s UNION ALL SELECT cat, lower(trim(unnest(string_split(syn, ';')))) FROM s WHERE cat <> 'Narcotics' AND syn IS NOT NULL) "
    f"SELECT DISTINCT term, CASE WHEN cat = 'Narcotics' THEN {_case_of(lexicon.NARCOTICS, 'term')} ELSE CASE WHEN {_case_of(lexicon.CATEGORY_LABELS, 'cat')} IS NOT NULL THEN coalesce({_case_of(lexicon.NAME_LABELS, 'term')}, {_case_of(lexicon.CATEGORY_LABELS, 'cat')}) END END AS label FROM t "
    f"WHERE length(term) >= 3 AND term <> 'nan' AND (cat = 'Narcotics' OR term NOT IN ({', '.join(lit(x) for x in lexicon.EXCLUDED_NAMES)})) AND label IS NOT NULL")
def substance_terms(spark, d):
    """Terms and labels of a substance table with mapped, unmapped, overridden, excluded and narcotic names."""
    df = spark.createDataFrame(_substances, "`Substance Name` string, `NFLIS Detailed Drug Category` string, Synonyms string")
    return lexicon.lexicon_from_table(df)


# --- labels -------------------------------------------------------------------------
_after = {k: f"greatest(coalesce({q(k)}, 0), {_hit('CauseA', LEX[k])})" for k in SUBSTANCES}


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS label, sum(coalesce({q(k)}, 0))::BIGINT AS before, sum({_after[k]})::BIGINT AS after, (sum({_after[k]}) - sum(coalesce({q(k)}, 0)))::BIGINT AS delta FROM audit_stability" for k in SUBSTANCES) + ")")
def column_totals(spark, d):
    """Label totals before and after the lexicon."""
    a = table(spark, d, "audit_stability")
    after = classification.or_flags(a, F.coalesce("CauseA", F.lit("")), LEX, SUBSTANCES)
    return reports.column_totals(a, after, list(SUBSTANCES))


@query(
    f"WITH g AS (SELECT CauseA, count(*) AS n, string_agg(row_no::VARCHAR, ',' ORDER BY row_no) AS row_list, string_agg(coalesce(Fentanyl, 0)::VARCHAR, ',' ORDER BY row_no) AS value_list, count(DISTINCT coalesce(Fentanyl, 0)) AS k FROM {_all} WHERE trim(CauseA) <> '' GROUP BY CauseA HAVING n > 1 AND k > 1) "
    "SELECT dense_rank() OVER (ORDER BY CauseA) AS dup_group, CauseA, n, row_list AS row_ids, value_list AS label_values FROM g")
def duplicate_groups(spark, d):
    return label_audit.duplicate_groups(_every(spark, d), "row_no", "CauseA", "Fentanyl")


@query(_a + f"SELECT term, 'Any Drugs' AS label, count(*) AS n, sum(coalesce({q('Any Drugs')}, 0))::BIGINT AS tp, round(sum(coalesce({q('Any Drugs')}, 0)) / count(*), 3) AS precision FROM (" + " UNION ALL ".join(f"SELECT '{w}' AS term, * FROM a WHERE regexp_matches(coalesce(CauseA, ''), '(?i)\\b{w}\\b')" for w in ("toxicity", "overdose", "intoxication", "drug")) + ") GROUP BY term")
def aggregate_signal(spark, d):
    """How well general words predict the aggregate label."""
    return label_audit.aggregate_signal(table(spark, d, "audit_stability"), "CauseA", {w: "Any Drugs" for w in ("toxicity", "overdose", "intoxication", "drug")})


_roll = {"opioids": ["Heroin", "Fentanyl", "Prescription.opioids"], "stimulants": ["Methamphetamine", "Cocaine"], "sedatives": ["Benzodiazepines", "Alcohol"]}


@query("SELECT snapshot_no, row_no, " + ", ".join("CASE WHEN " + " OR ".join(f"{q(c)} = 1" for c in cs) + f" THEN 1 ELSE 0 END AS {k}" for k, cs in _roll.items()) + ", greatest(" + ", ".join(q(c) for c in LABELS) + ") AS most FROM audit_stability")
def outcome_rollup(spark, d):
    """Labels rolled up by lists of columns, and the greatest of a row's labels (nulls left out)."""
    a = table(spark, d, "audit_stability")
    return a.select("snapshot_no", "row_no", *[reports.any_of(cs).alias(k) for k, cs in _roll.items()], F.greatest(*[col(c) for c in LABELS]).alias("most"))


_scores = {k: f"((row_no * {7919 + i} % 1000) / 1000.0)" for i, k in enumerate(("Fentanyl", "Heroin", "Alcohol"))}


@query(
    "WITH " + ", ".join(f"r{i} AS (SELECT coalesce({k}, 0) AS y, rank() OVER (ORDER BY {s}) + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0 AS k FROM audit_stability), u{i} AS (SELECT (sum(k * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS auc FROM r{i})" for i, (k, s) in enumerate(_scores.items()))
    + " SELECT round((" + " + ".join(f"(SELECT auc FROM u{i})" for i in range(len(_scores))) + f") / {len(_scores)}, 6) AS macro_auc")
def macro_auc(spark, d):
    a = table(spark, d, "audit_stability").withColumns({f"{k}_s": F.pmod(F.col("row_no") * (7919 + i), F.lit(1000)) / 1000 for i, k in enumerate(_scores)})
    return metrics.macro_auc(a, {k: f"{k}_s" for k in _scores})


@query("SELECT row_no, snapshot_no, CASE WHEN 1 / (1 + exp(-((row_no % 200 - 100) / 25.0))) > 0.5 THEN 1 ELSE 0 END AS above, CASE WHEN 1 / (1 + exp(-((row_no % 200 - 100) / 25.0))) >= 0.5 THEN 1 ELSE 0 END AS from_, least(1, greatest(0, ((row_no % 200 - 100) / 25.0 - lo) / nullif(hi - lo, 0))) AS calibrated FROM audit_stability, (SELECT min((row_no % 200 - 100) / 25.0) AS lo, max((row_no % 200 - 100) / 25.0) AS hi FROM audit_stability WHERE snapshot_no = 1)")
def thresholds_applied(spark, d):
    """Logits against a threshold, strictly or not, and as scores between the least and greatest of a training part."""
    a = table(spark, d, "audit_stability").select("snapshot_no", "row_no", ((F.pmod(F.col("row_no"), F.lit(200)) - 100) / 25.0).alias("z"))
    a = classification.threshold_flags(classification.threshold_flags(a, {"above": "z"}, {}), {"from_": "z"}, {}, strict=False)
    return min_max_calibrated(a, a.filter("snapshot_no = 1"), "z", "calibrated").drop("z")


_ev = lambda k, p: f"CASE WHEN regexp_matches(coalesce(CauseA, ''), {lit('(?i)' + p)}) OR regexp_matches(coalesce(CauseOther, ''), {lit('(?i)' + p)}) THEN '{k}=[' || concat_ws('; ', " + ", ".join(f"CASE WHEN regexp_matches(coalesce({f}, ''), {lit('(?i)' + p)}) THEN '{f}:''' || regexp_extract({f}, {lit('(?i)(' + p + ')')}, 1) || '''' END" for f in ("CauseA", "CauseOther")) + ") || ']' END"


@query("SELECT row_id, concat_ws(' | ', " + ", ".join(_ev(k, LEX[k]) for k in LEX) + ") AS evidence FROM consensus")
def evidence_text(spark, d):
    c = table(spark, d, "consensus").select("row_id", "CauseA", "CauseOther")
    return c.select("row_id", classification.evidence(c, LEX).alias("evidence"))


_p = lambda k: _hit("coalesce(CauseA, '')", LEX[k])
_metric = lambda pred, s: "SELECT label, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 6) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn), 6) END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS label, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM (SELECT coalesce({q(k)}, 0) AS y, {pred(k)} AS p FROM audit_stability)" for k in SUBSTANCES) + f") {s}"
_m4 = ("accuracy", "precision", "recall", "f1")


@query(f"WITH b AS ({_metric(lambda k: '(row_no % 7 = 0)::INT', '')}), a AS ({_metric(lambda k: f'greatest((row_no % 7 = 0)::INT, {_p(k)})', '')}) SELECT label, " + ", ".join(f"b.{m} AS {m}_before, a.{m} AS {m}_after, round(a.{m} - b.{m}, 6) AS {m}_delta" for m in _m4) + " FROM b JOIN a USING (label)")
def metrics_before_after(spark, d):
    """Metrics of a stand-in scorer alone and together with the lexicon, over all snapshots."""
    a = table(spark, d, "audit_stability")
    before = a.withColumns({f"{k}_pred": (F.col("row_no") % 7 == 0).cast("int") for k in SUBSTANCES})
    flags = lexicon.label_flags(before, F.coalesce("CauseA", F.lit("")), LEX, "_l_")
    after = flags.withColumns({f"{k}_pred": F.greatest(col(f"{k}_pred"), col(f"_l_{k}")) for k in SUBSTANCES})
    m = lambda df: metrics.label_metrics(metrics.long_predictions(df, SUBSTANCES))
    return metrics.metric_deltas(m(before), m(after))


# --- reports ------------------------------------------------------------------------
_z = "nullif(regexp_extract(regexp_replace(DeathZip, '\\.0$', ''), '(\\d{5})', 1), '')"


@query(
    f"WITH b AS (SELECT year(received_at)::VARCHAR AS year, {_z} AS area FROM consensus), r AS (SELECT * FROM b WHERE area IS NOT NULL UNION ALL SELECT 'All', area FROM b WHERE area IS NOT NULL), g AS (SELECT year, area, count(*) AS n FROM r GROUP BY ALL) "
    "SELECT year, count(*) AS cells, sum(n)::BIGINT AS rows, sum((n < 5)::INT)::BIGINT AS small_cells, round(sum((n < 5)::INT) / count(*), 6) AS cell_share, round(sum(CASE WHEN n < 5 THEN n ELSE 0 END) / sum(n), 6) AS row_share FROM g GROUP BY year")
def small_cell_shares(spark, d):
    """Shares of small areas and of the rows in them, by year and overall."""
    c = table(spark, d, "consensus").select(F.year("received_at").cast("string").alias("year"), text.zip5(F.col("DeathZip")).alias("area"))
    return reports.small_cell_shares(c, "year", "area")


@query(
    "WITH o AS (SELECT DISTINCT strftime(received_at, '%Y-%m') AS month, source_file FROM consensus), p AS (SELECT month, string_agg(source_file, ',' ORDER BY source_file) AS sources, count(*) AS n_sources FROM o GROUP BY month HAVING count(*) >= 3), "
    "k AS (SELECT strftime(received_at, '%Y-%m') AS month, CaseNumber, count(DISTINCT source_file) AS n FROM consensus WHERE CaseNumber IS NOT NULL GROUP BY ALL) SELECT month, sources, n_sources, coalesce((SELECT count(*) FROM k WHERE k.month = p.month AND k.n > 1), 0) AS shared_cases FROM p")
def coverage_by_month(spark, d):
    """Months that at least three sources cover, with the cases that several of them have."""
    c = table(spark, d, "consensus").withColumn("month", F.date_format("received_at", "yyyy-MM"))
    shared = c.filter("CaseNumber is not null").groupBy("month", "CaseNumber").agg(F.count_distinct("source_file").alias("n")).filter("n > 1").groupBy("month").agg(F.count("*").alias("shared_cases"))
    return reports.coverage(c, "month", "source_file").join(shared, "month", "left").withColumn("shared_cases", F.coalesce("shared_cases", F.lit(0)))


@query(
    "WITH s AS (SELECT source_file, min(received_at) AS t FROM consensus GROUP BY 1), o AS (SELECT DISTINCT strftime(received_at, '%Y') AS year, CaseNumber, source_file FROM consensus WHERE CaseNumber IS NOT NULL), "
    "f AS (SELECT year, CaseNumber, arg_min(source_file, (t, source_file)) AS first_file FROM o JOIN s USING (source_file) GROUP BY ALL) SELECT year, source_file, count(*) AS n_cases, sum((source_file = first_file)::INT)::BIGINT AS n_new FROM o JOIN f USING (year, CaseNumber) GROUP BY ALL")
def novel_by_arrival(spark, d):
    """Cases of each source and those that no source that arrived earlier has, by year."""
    c = table(spark, d, "consensus").filter("CaseNumber is not null").withColumn("year", F.date_format("received_at", "yyyy"))
    arrived = table(spark, d, "consensus").groupBy("source_file").agg(F.min("received_at").alias("arrived"))
    return reports.novel_contribution(c.join(arrived, "source_file"), "year", "CaseNumber", "source_file", "arrived")


_cmb = lambda s: f"SELECT * FROM audit_stability WHERE snapshot_no = {s}"
_cc = ["DeathDate", "Mode", "CauseA", "Any Drugs"]


@query(
    f"WITH k AS (SELECT *, {_date} AS day, (CASE WHEN CaseNumber IS NULL THEN 0 ELSE 1 END) + " + " + ".join(f"(CASE WHEN {q(c)} IS NULL THEN 0 ELSE 1 END)" for c in _cc) + f" AS full_ FROM ({_cmb(5)})), r AS (SELECT *, row_number() OVER (ORDER BY full_ DESC, \"Any Drugs\" DESC NULLS LAST, day DESC NULLS LAST, row_no) AS r FROM k) "
    "SELECT CaseNumber, " + ", ".join(f"arg_min({q(c)}, r) FILTER (WHERE {q(c)} IS NOT NULL) AS {safe(c)}" for c in _cc) + " FROM r GROUP BY CaseNumber UNION ALL SELECT CaseNumber, " + ", ".join(q(c) for c in _cc) + f" FROM ({_cmb(1)})")
def combined_classes(spark, d):
    """One class merged on its key with its ties, another kept row by row."""
    a = table(spark, d, "audit_stability").select("snapshot_no", "CaseNumber", *[col(c) for c in _cc], F.col("row_no").alias("_ord"))
    out = pipelines.combine_classes({"keyed": a.filter("snapshot_no = 5").drop("snapshot_no"), "rows": a.filter("snapshot_no = 1").drop("snapshot_no")}, {"keyed": "CaseNumber"})
    return out.select("CaseNumber", *[col(c).alias(safe(c)) for c in _cc])


@query(
    _a + r", v AS (SELECT *, TRY_CAST(nullif(regexp_extract(Age, '(\d+)', 1), '') AS DOUBLE) AS n FROM a) SELECT snapshot_no, row_no, strftime(day, '%Y-%m') AS month_year, year(day) AS year, CASE WHEN day IS NOT NULL THEN concat_ws('-', year(day)::VARCHAR, lpad(CAST(strftime(day, '%U') AS INT)::VARCHAR, 2, '0')) ELSE '' END AS year_week, "
    r"CASE WHEN n >= 0 AND n < 100 THEN CAST(floor(n / 10) * 10 AS INT) || '-' || CAST(floor(n / 10) * 10 + 9 AS INT) END AS age_bin, coalesce(CASE upper(trim(replace(Gender, chr(10), ''))) WHEN 'M' THEN 'MALE' WHEN 'MALE' THEN 'MALE' WHEN 'F' THEN 'FEMALE' WHEN 'FEMALE' THEN 'FEMALE' END, 'Unknown') AS gender FROM v WHERE lon IS NOT NULL")
def deidentified_rows(spark, d):
    a = pipelines.deidentify(table(spark, d, "audit_stability"), required="lon")
    return a.select("snapshot_no", "row_no", F.col("MonthYear").alias("month_year"), F.col("Year").alias("year"), F.col("YearWeek").alias("year_week"), F.col("Age_Bin").alias("age_bin"), F.col("Gender").alias("gender"))


# --- vectors and pages --------------------------------------------------------------
@query(
    "WITH e AS (SELECT vec_id, label, embedding FROM embeddings), w AS (SELECT DISTINCT label AS id, vec_id % 7 AS word FROM e), t AS (SELECT vec_id AS word, unnest(range(0, 4))::INT AS dim, CAST(unnest(embedding[1:4]) AS DOUBLE) AS x FROM e WHERE vec_id < 7) "
    "SELECT id, dim, round(sum(x), 4) AS total FROM w JOIN t USING (word) GROUP BY ALL")
def vector_lookup(spark, d):
    """Sums of looked-up vectors, each once, as one vector a row."""
    e = table(spark, d, "embeddings")
    words = e.groupBy(F.col("label").alias("id")).agg(F.collect_list((F.col("vec_id") % 7).cast("string")).alias("w"))
    look = e.filter("vec_id < 7").select(F.col("vec_id").cast("string").alias("word"), F.slice("embedding", 1, 4).alias("vector"))
    got = vectors.looked_up_sum(words, "id", "w", look, 4, once=True)
    return got.select("id", F.posexplode(vectors.filled(F.col("vector"), 4)).alias("dim", "x")).select("id", "dim", F.round("x", 4).alias("total"))


_PRINTED = ["CaseNum", "Mode", "Gender", "Age", "CauseA"]
_BOUNDS = [100.0, 200.0, 280.0, 360.0]


def _printed(spark, d):
    """A word table: cases printed thirty to a page under a header, causes of several words running over from the line above."""
    c = table(spark, d, "consensus").filter(r"CaseNumber rlike '^20[0-9]{2}-[0-9]{4,5}$'").select(F.floor(F.col("row_id") / 30).cast("int").alias("page"), ((F.col("row_id") % 30) * 24 + 20).cast("double").alias("y"), F.col("CaseNumber").alias("CaseNum"), "Mode", "Gender", "Age", "CauseA")
    tokens = lambda x: F.filter(F.split(F.coalesce(F.col(x), F.lit("")), r"\s+"), lambda w: w != "")
    left = dict(zip(_PRINTED, [0.0, *_BOUNDS]))

    def word(x, w, i, over):
        at = F.lit(left[x]) + i * (2.0 if x == "CauseA" else 1.0)
        return F.struct((F.col("y") - over).alias("y"), at.alias("x0"), (at + 1.0).alias("x1"), w.alias("word"))

    half = F.floor(F.size(tokens("CauseA")) / 2)
    parts = [F.transform(tokens(x), _placed(x, word, half)) for x in _PRINTED]
    body = c.select("page", F.explode(F.concat(*parts)).alias("_w")).select("page", "_w.*")
    head = c.select("page").distinct().select("page", F.explode(F.array(*[F.struct(F.lit(0.0).alias("y"), F.lit(left[x] + 1).alias("x0"), F.lit(left[x] + 2).alias("x1"), F.lit(x).alias("word")) for x in _PRINTED])).alias("_w")).select("page", "_w.*")
    return body.unionByName(head)


def _placed(x, word, half):
    return lambda w, i: word(x, w, i, F.when(i < half, 10.0).otherwise(0.0) if x == "CauseA" else F.lit(0.0))


@query(
    "SELECT CAST(floor(row_id / 30) AS INT) AS page, CaseNumber AS case_num, " + ", ".join(f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '') AS {c.lower()}" for c in ("Mode", "Gender", "Age", "CauseA")) + " FROM consensus WHERE regexp_matches(CaseNumber, '^20[0-9]{2}-[0-9]{4,5}$')")
def page_cases(spark, d):
    """Words of printed pages back to case rows: the table that was printed."""
    r = pages.case_rows(_printed(spark, d), _BOUNDS, _PRINTED, "CaseNum")
    return r.select("page", F.col("CaseNum").alias("case_num"), *[F.col(c).alias(c.lower()) for c in ("Mode", "Gender", "Age", "CauseA")])
