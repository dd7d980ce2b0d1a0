"""Command line: ``python -m caseloom.cli <command> ...``."""

from __future__ import annotations

import argparse
import glob
from functools import reduce

from pyspark.sql import functions as F

from caseloom.functions import dates, text
from caseloom.functions.lexicon import SUBSTANCES, build_lexicon, label_flags, lexicon_from_table
from caseloom.functions.text import col
from caseloom.operators import classification, consensus, drift, entity, label_audit, metrics, models, nearby, relations, repair, reports, stability
from caseloom.plans import pipelines
from caseloom.session import build_session
from caseloom.sources import geo, ledger, tabular


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="caseloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("classify", help="label texts of a string, CSV or XLSX")
    c.add_argument("text", nargs="?")
    c.add_argument("-i", "--input")
    c.add_argument("-o", "--output")
    c.add_argument("--skip-lexicon", action="store_true")
    d = sub.add_parser("diff", help="rows whose labels the corrections change")
    d.add_argument("--input", required=True)
    d.add_argument("--output", required=True)
    d.add_argument("--key", default="CaseNumber")
    v = sub.add_parser("consensus", help="majority vote over a directory of files")
    v.add_argument("pattern")
    v.add_argument("--outdir", required=True)
    m = sub.add_parser("merge", help="one row a case by completeness")
    m.add_argument("pattern")
    m.add_argument("-o", "--output", required=True)
    m.add_argument("--key", default="CaseNumber")
    m.add_argument("--tie", choices=("first", "last"), default="last")
    a = sub.add_parser("stability", help="compare two versions of a master")
    a.add_argument("--old", required=True)
    a.add_argument("--new", required=True)
    a.add_argument("--key", default="CaseNumber")
    a.add_argument("--year", type=int)
    a.add_argument("--outdir", required=True)
    a.add_argument("--prefix", default="audit")
    a.add_argument("--compare-column", action="append", default=[])
    q = sub.add_parser("audit-labels", help="check labels against the lexicon")
    q.add_argument("csv")
    q.add_argument("--text-col", default="text")
    q.add_argument("--out-dir", required=True)
    q.add_argument("--precision-threshold", type=float, default=0.9)
    q.add_argument("--min-support", type=int, default=1)
    r = sub.add_parser("repair", help="put broken words together")
    r.add_argument("input")
    r.add_argument("output")
    r.add_argument("-c", "--column", action="append", required=True)
    r.add_argument("--max-merge", type=int, default=repair.MAX_PARTS)
    r.add_argument("--min-freq", type=int, default=repair.MIN_FREQ)
    r.add_argument("--extra-word", action="append", default=[])
    s = sub.add_parser("surveillance", help="new raw files to the final overdose table")
    s.add_argument("pattern")
    s.add_argument("-o", "--output", required=True)
    s.add_argument("--cache", help="CSV of address, lon, lat")
    s.add_argument("--history", help="CSV of an earlier final table")
    s.add_argument("--polygons", help="GeoJSON of areas with CT20 and ZIPCODE")
    s.add_argument("--ledger", help="list of files already processed; new ones are added")
    s.add_argument("--log", help="log of entries by source")
    s.add_argument("--keep-names", action="store_true")
    s.add_argument("--model", help="folder of stored models")
    s.add_argument("--substances", help="CSV of substance names, categories and synonyms")
    t = sub.add_parser("all-records", help="every case with its labels")
    t.add_argument("pattern")
    t.add_argument("-o", "--output", required=True)
    t.add_argument("--model")
    t.add_argument("--substances")
    j = sub.add_parser("join", help="files of several classes united, a class with a key merged on it")
    j.add_argument("directory")
    j.add_argument("-o", "--output", required=True)
    j.add_argument("--class", dest="classes", action="append", required=True, help="name=pattern of base names")
    j.add_argument("--key", dest="keys", action="append", default=[], help="name=column")
    g = sub.add_parser("geocode-cached", help="points for addresses from a cache")
    g.add_argument("--input", required=True)
    g.add_argument("--cache", required=True)
    g.add_argument("--output")
    g.add_argument("--dry-run", action="store_true")
    e = sub.add_parser("evaluate", help="metrics of predictions before and after the lexicon")
    e.add_argument("--input", required=True, help="CSV with text, labels and <label>_pred columns")
    e.add_argument("--text-col", default="text")
    e.add_argument("--outdir", required=True)
    y = sub.add_parser("replay", help="the master rebuilt file by file, with what each file changed")
    y.add_argument("pattern")
    y.add_argument("-o", "--output", required=True)
    y.add_argument("--key", default="CaseNumber")
    y.add_argument("--once", action="store_true", help="merge files 1..k in one go instead of one after the other")
    n = sub.add_parser("rename", help="blanks in file names as underscores")
    n.add_argument("directory")
    return p


def _lexicon(spark, path: str | None):
    if not path:
        return build_lexicon()
    terms = lexicon_from_table(tabular.read_csv(spark, path)).orderBy("term", "label")
    return build_lexicon([(r["term"], r["label"]) for r in terms.toLocalIterator()])  # a dimension


def _points(spark, path: str):
    c = tabular.read_csv(spark, path)
    return c.select("address", F.col("lon").try_cast("double").alias("lon"), F.col("lat").try_cast("double").alias("lat"), F.monotonically_increasing_id().alias("ord"))


def _files(spark, pattern: str, exclude: tuple[str, ...] = ()):
    """All files of a pattern with an order column ``_ord``."""
    df, failed = tabular.read_directory(spark, pattern, exclude)
    for path, why in failed:
        print(f"skipped {path}: {why}")
    if df is None:
        raise SystemExit(f"nothing to read in {pattern}")
    return df.withColumn("_ord", F.col("_src_ord") * F.lit(1 << 40) + F.col("_row_ord")).drop("_src_ord", "_row_ord")


def _runs(a: argparse.Namespace, spark, out) -> None:
    """The whole runs."""
    if a.command in ("surveillance", "all-records"):
        scorer = models.stored_scorer(a.model) if a.model else classification.zero_scorer
        lex = _lexicon(spark, a.substances)
        done = tuple(sorted(ledger.read_ledger(a.ledger))) if a.command == "surveillance" and a.ledger else ()
        df = _files(spark, a.pattern, done)
        if a.command == "all-records":
            return out(pipelines.all_records(df, scorer, lex), a.output)
        history = tabular.read_csv(spark, a.history).withColumn("_ord", F.monotonically_increasing_id()) if a.history else None
        regions = geo.read_geojson(spark, a.polygons, ["CT20", "ZIPCODE"], "CT20").withColumn("area_id", F.monotonically_increasing_id().cast("string")) if a.polygons else None
        final = pipelines.surveillance(df, _points(spark, a.cache) if a.cache else None, history, regions, scorer=scorer, lexicon=lex, keep_names=a.keep_names)
        out(final, a.output)
        if a.log:
            ledger.append_log(reports.source_stats(final, "source_file", F.col("DeathDate")), a.log)
        if a.ledger:
            ledger.append_ledger(a.ledger, [r[0] for r in df.select("source_file").distinct().orderBy("source_file").toLocalIterator()])
    elif a.command == "join":
        paths = tabular.route(sorted(glob.glob(f"{a.directory}/*")), dict(x.split("=", 1) for x in a.classes))
        keys = dict(x.split("=", 1) for x in a.keys)
        union = lambda ps: reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [tabular.read_any(spark, p).withColumn("_ord", F.lit(i * (1 << 40)) + F.monotonically_increasing_id()) for i, p in enumerate(ps)])
        out(pipelines.combine_classes({k: union(ps) for k, ps in paths.items() if ps and k != "other"}, keys), a.output)
    elif a.command == "geocode-cached":
        df = tabular.read_any(spark, a.input)
        full = lambda k: text.full_address(*[col(f"{k}{c}") if f"{k}{c}" in df.columns else F.lit(None).cast("string") for c in ("Address", "City", "Zip")])
        d = df.drop("lon", "lat", "used_death_address").withColumns({"_event": F.coalesce(full("Event"), full("Death")), "_death": full("Death")})
        d = relations.geocode(d, _points(spark, a.cache), "_event", "_death", nearby.usable_point).drop("_event", "_death")
        n = d.agg(F.count("lon").alias("hits"), (F.count("*") - F.count("lon")).alias("misses")).first()
        print(f"{n['hits']} found, {n['misses']} not in the cache")
        if a.output and not a.dry_run:
            out(d, a.output)
    elif a.command == "evaluate":
        df = tabular.read_any(spark, a.input)
        labels = [k for k in SUBSTANCES if k in df.columns and f"{k}_pred" in df.columns]
        before = df.withColumns({c: col(c).try_cast("double").cast("int") for k in labels for c in (k, f"{k}_pred")})
        after = label_flags(before, F.coalesce(col(a.text_col), F.lit("")), build_lexicon(), "_l_")
        after = after.withColumns({f"{k}_pred": F.greatest(F.coalesce(col(f"{k}_pred"), F.lit(0)), col(f"_l_{k}")) for k in labels})
        m = lambda d: metrics.label_metrics(metrics.long_predictions(d, labels))
        ledger.write_bundle({"labels": metrics.metric_deltas(m(before), m(after)), "before": metrics.multilabel_metrics(before, labels), "after": metrics.multilabel_metrics(after, labels)}, a.outdir, "evaluation")
    elif a.command == "replay":
        df = pipelines.harmonise(_files(spark, a.pattern))
        columns = [c for c in df.columns if c not in (a.key, "_ord", "source_file")]
        out(stability.replay(df, "source_file", a.key, "_ord", columns, F.date_format(dates.parse_mixed_date(F.col("DeathDate")), "yyyy-MM"), not a.once), a.output)


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    if a.command == "rename":
        for old, new in ledger.tidy_names(a.directory):
            print(f"{old} -> {new}")
        return
    spark = build_session()
    out = lambda df, path: df.write.mode("overwrite").csv(path, header=True)
    if a.command in ("surveillance", "all-records", "join", "geocode-cached", "evaluate", "replay"):
        _runs(a, spark, out)
    elif a.command == "classify":
        if not (a.text or a.input):
            raise SystemExit("give a text or --input")
        r = classification.classify(spark, a.input or a.text, use_lexicon=not a.skip_lexicon)
        out(r, a.output) if a.output else r.show(truncate=False)
    elif a.command == "diff":
        df = tabular.read_any(spark, a.input)
        out(classification.label_diff(df, classification.apply_corrections(df), a.key), a.output)
    elif a.command in ("consensus", "merge"):
        df, failed = tabular.read_directory(spark, a.pattern)
        for path, why in failed:
            print(f"skipped {path}: {why}")
        df = entity.coalesce_aliases(df.withColumn("_ord", F.col("_src_ord") * F.lit(1 << 40) + F.col("_row_ord")).drop("_src_ord", "_row_ord"), {c: (c, *n) for c, n in drift.ALIASES.items()})
        if a.command == "merge":
            out(entity.merge_records(df, [a.key], "_ord", a.tie), a.output)
        else:
            ledger.write_bundle(consensus.collate(df, [c for c in df.columns if c not in ("CaseNumber", "source_file", "_ord", *consensus.NO_VOTE)], order="_ord"), a.outdir, "consensus")
    elif a.command == "stability":
        day = dates.parse_mixed_date(F.col("DeathDate"))
        old, new = (stability.last_of_year(tabular.read_any(spark, p).withColumn("_ord", F.monotonically_increasing_id()), a.key, day, "_ord", a.year) for p in (a.old, a.new))
        columns = a.compare_column or [c for c in old.columns if c not in (a.key, "_ord")]
        ledger.write_bundle(stability.compare(old, new, a.key, columns, F.date_format(day, "yyyy-MM")), a.outdir, a.prefix)
    elif a.command == "audit-labels":
        df = tabular.read_any(spark, a.csv).withColumn("_row", F.monotonically_increasing_id())
        lex = build_lexicon()
        m = label_audit.matches(df, "_row", a.text_col, lex)
        p = label_audit.term_precision(m)
        ledger.write_bundle({
            "term_precision": p, "candidates": label_audit.review_candidates(m, p, "_row", a.precision_threshold, a.min_support),
            "unexplained": label_audit.unexplained_labels(df, "_row", a.text_col, lex), "derived": label_audit.invariants(df, "_row", a.text_col),
            "negated": label_audit.negated_rows(df, "_row", a.text_col, lex)}, a.out_dir, "labels")
    elif a.command == "repair":
        out(repair.repair_columns(tabular.read_any(spark, a.input), a.column, a.extra_word, a.max_merge, a.min_freq), a.output)


if __name__ == "__main__":
    main()
