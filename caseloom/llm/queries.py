"""Queries of the training-data operators and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import addresses, leakage, packing, splitting, survivors, truncation
from caseloom.functions.values import MISSING_WORDS
from caseloom.session import table

CUT_FIELDS = ["CauseA", "CauseOther", "Race"]
KEPT_FIELDS = ["CauseA", "DeathAddress"]
RECORD_FIELDS = ["CauseA", "CauseOther", "DeathAddress", "DeathCity", "DeathZip", "Mode", "Race", "Gender", "FirstName", "LastName"]
ADDRESSES = [("DeathAddress", "DeathCity", "DeathZip"), ("EventAddress", "EventCity", "EventZip")]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return addresses.same_location_pairs(table(spark, d, "consensus"), ADDRESSES)


def p1_locations(spark: SparkSession, d: str) -> DataFrame:
    return addresses.location_members(table(spark, d, "consensus"), ADDRESSES)


def _cut(spark: SparkSession, d: str, fields: list[str]) -> DataFrame:
    return truncation.truncated_values(table(spark, d, "consensus").select("row_id", "source_file", *fields), fields)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _cut(spark, d, CUT_FIELDS).select("row_id", "field")


def p6_by_source(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_by_source(table(spark, d, "consensus"), _cut(spark, d, CUT_FIELDS), CUT_FIELDS)


def _survivors(spark: SparkSession, d: str, fields: list[str]) -> DataFrame:
    return survivors.surviving_values(table(spark, d, "consensus"), table(spark, d, "source_files"), fields, _cut(spark, d, [f for f in fields if f in CUT_FIELDS]))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.winners(_survivors(spark, d, KEPT_FIELDS), KEPT_FIELDS)


def p7_records(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d, RECORD_FIELDS)


def p8_sequences(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(p8_sequences(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_passages(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "text")).select("doc_id", "item_id")


def p9_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    return p9_found(spark, d).groupBy("item_id").count().withColumnRenamed("count", "n_docs")


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_documents(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_locations, p6_found, p6_by_source, p7_found, p7_records, p8_sequences, p8_report, p9_found, p9_leaked_items, p10_pieces)}


# SQL of the truncation counts: texts, words with their contexts, fragments, and the last words joined with them.
_gone = "^\\s*((" + "|".join(w.replace("?", "[?]").replace(".", "[.]") for w in MISSING_WORDS) + ")(\\s+(" + "|".join(w.replace("?", "[?]").replace(".", "[.]") for w in MISSING_WORDS) + "))*\\s*)?$"
_missing = lambda c: f"({c} IS NULL OR regexp_matches({c}, '(?i){_gone}'))"
_pad = ", ".join(["'^'"] * truncation.LONG)
_CONTEXTS = {"long_": f"array_to_string(pad[i:i + {truncation.LONG - 1}], ' ')", "tri": f"array_to_string(pad[i + {truncation.LONG - 2}:i + {truncation.LONG - 1}], ' ')", "uni": "''"}
_TRUNCATED = (
    "cells AS (" + " UNION ALL ".join(f"SELECT row_id, source_file, coalesce(source_file, '') AS src, '{f}' AS field, {f} AS value FROM consensus" for f in CUT_FIELDS) + f"), sound AS (SELECT * FROM cells WHERE NOT {_missing('value')}), "
    r"c AS (SELECT *, trim(upper(regexp_replace(value, '\s+', ' ', 'g'))) AS text FROM sound WHERE NOT regexp_matches(trim(value), '[\r\n]')), t AS (SELECT field, src, text, count(*) AS n FROM c GROUP BY ALL), "
    r"w AS (SELECT *, CASE WHEN regexp_matches(text, '(…|\.\.+|[\p{L}\p{N}]-)\s*$') THEN 'mark' WHEN length(regexp_replace(text, '[^(\[]', '', 'g')) > length(regexp_replace(text, '[^)\]]', '', 'g')) THEN 'open bracket' WHEN regexp_matches(text, '[(\\[/&,;:+]$') THEN 'separator' END AS why, "
    r"regexp_extract_all(text, '[\p{L}\p{N}''.-]*[\p{L}\p{N}]|[^\p{L}\p{N}\s]') AS tk FROM t), "
    f"k AS (SELECT field, src, text, n, list_concat([{_pad}], tk) AS pad, len(tk) AS m FROM w WHERE why IS NULL AND len(tk) > 0), p AS (SELECT *, unnest(range(1, m + 1)) AS i FROM k), "
    f"q AS (SELECT field, src, text, n, i = m AS last, pad[i + {truncation.LONG}] AS word, " + ", ".join(f"{e} AS {k}" for k, e in _CONTEXTS.items()) + " FROM p), "
    "g AS (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, field, {k} AS ctx, word, sum(n) AS n, coalesce(sum(n) FILTER (WHERE last), 0) AS ends FROM q GROUP BY ALL" for k in _CONTEXTS) + "), "
    "l AS (SELECT *, unnest(range(1, length(word) + 1)) AS z FROM g), f AS (SELECT kind, field, ctx, left(word, z::INT) AS frag, sum(CASE WHEN z = length(word) THEN n - ends ELSE n END) AS on_, sum(CASE WHEN z = length(word) THEN 0 ELSE n END) AS longer FROM l GROUP BY ALL HAVING on_ > 0), "
    "e AS (SELECT *, sum(own) OVER (PARTITION BY kind, field, ctx, frag) - own AS others FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, field, {k} AS ctx, word AS frag, src, sum(n) AS own FROM q WHERE last GROUP BY ALL" for k in _CONTEXTS) + ")), "
    "j AS (SELECT e.*, coalesce(on_, 0) AS on_, coalesce(longer, 0) AS longer FROM e LEFT JOIN f USING (kind, field, ctx, frag)), "
    "s AS (SELECT q.field, q.src, q.text, a.others AS ae, a.on_ AS ao, b.others AS be, b.on_ AS bo, u.others AS ue, u.on_ AS uo, u.longer >= 3 AND u.on_ - u.longer <= 0.02 * u.longer AS fragment FROM q "
    + " ".join(f"JOIN j {x} ON {x}.kind = '{k}' AND {x}.field = q.field AND {x}.ctx = q.{k} AND {x}.frag = q.word AND {x}.src = q.src" for x, k in (("a", "long_"), ("b", "tri"), ("u", "uni"))) + " WHERE q.last), "
    f"r AS (SELECT *, CASE WHEN fragment THEN 0 ELSE ln({truncation.CUT_PRIOR} / (1 - {truncation.CUT_PRIOR})) END AS prior, ln({truncation.CUT_SHARE} / {truncation.END_SHARE}) AS pe, ln((1 - {truncation.CUT_SHARE}) / (1 - {truncation.END_SHARE})) AS po, ae = 0 AND be = 0 AS fresh FROM s), "
    f"o AS (SELECT *, ae * pe + ao * po + prior AS oa, be * pe + bo * po + prior AS ob, ue * pe + uo * po + prior AS ou, ue * ln({truncation.WORD_CUT} / {truncation.WORD_END}) + uo * ln((1 - {truncation.WORD_CUT}) / (1 - {truncation.WORD_END})) + prior AS ow FROM r), "
    "d AS (SELECT field, src, text FROM o WHERE (NOT fragment AND fresh AND ow > 0) OR (ao > 0 AND oa > 0) OR (bo > 0 AND ob > 0 AND oa > prior + pe) OR (fragment AND fresh AND ao = 0 AND bo = 0 AND ou > 0) UNION ALL SELECT field, src, text FROM w WHERE why IS NOT NULL), "
    "cut AS (SELECT row_id, source_file, field, value FROM c JOIN d USING (field, src, text))")
_squeezed = r"trim(upper(regexp_replace(regexp_replace(CaseNumber, '\s+', ' ', 'g'), '[‐-―−_/]', '-', 'g')))"
_shape = r"'^[^0-9]*?((?:19|20)[0-9]{2}) ?- ?0*([0-9]+)$'"
_case = f"CASE WHEN regexp_matches({_squeezed}, {_shape}) THEN regexp_extract({_squeezed}, {_shape}, 1) || '-' || lpad(regexp_extract({_squeezed}, {_shape}, 2), greatest(5, length(regexp_extract({_squeezed}, {_shape}, 2)))::INT, '0') END"


def _survivor_sql(fields: list[str]) -> str:
    """Ranked rows of each case and field: ``best(kase, field, row_id, value)``, and the number of rows of each case."""
    long = " UNION ALL ".join(f"SELECT kase, row_id, source_file, received_at, '{f}' AS field, {f} AS value FROM b" for f in fields)
    return (
        f"WITH {_TRUNCATED}, b AS (SELECT *, {_case} AS kase FROM consensus), n AS (SELECT kase, count(*) AS n_rows FROM b WHERE kase IS NOT NULL GROUP BY kase HAVING count(*) > 1), v AS ({long}), "
        f"best AS (SELECT kase, field, v.row_id, v.value FROM v JOIN n USING (kase) LEFT JOIN source_files s USING (source_file) ANTI JOIN cut x ON x.row_id = v.row_id AND x.field = v.field WHERE NOT {_missing('v.value')} "
        "QUALIFY row_number() OVER (PARTITION BY kase, field ORDER BY coalesce(trust, 2147483647), received_at DESC NULLS LAST, v.row_id) = 1) ")


ORACLE: dict[str, str] = {
    "p6_found": f"WITH {_TRUNCATED} SELECT row_id, field FROM cut",
    "p6_by_source": f"WITH {_TRUNCATED} SELECT source_file, field, count(*) AS n_values, sum((EXISTS (SELECT 1 FROM cut x WHERE x.row_id = a.row_id AND x.field = a.field))::INT)::BIGINT AS n_cut, round(sum((EXISTS (SELECT 1 FROM cut x WHERE x.row_id = a.row_id AND x.field = a.field))::INT) / count(*), 6) AS share FROM sound a GROUP BY source_file, field",
    "p7_found": _survivor_sql(KEPT_FIELDS) + "SELECT kase AS CaseNumber, field, row_id FROM best",
    "p7_records": _survivor_sql(RECORD_FIELDS) + "SELECT n.kase AS CaseNumber, n_rows, " + ", ".join(f"max(value) FILTER (WHERE field = '{f}') AS {f}, max(row_id) FILTER (WHERE field = '{f}') AS {f}_row" for f in RECORD_FIELDS) + " FROM n LEFT JOIN best USING (kase) GROUP BY n.kase, n_rows",
}
