"""CSV and XLSX files with hostile headers, and unions of whole directories."""

from __future__ import annotations

import csv
import glob
import io
import os
import re
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from caseloom.functions.text import col

# Texts read as missing.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def mangle(names: list[str]) -> list[str]:
    """Headers without a byte-order mark, repeats numbered ``.1``, ``.2``; empty ones named by position."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for i, n in enumerate(names):
        n = (n or "").lstrip("﻿") or f"Unnamed: {i}"
        k = n
        while k in seen:
            seen[n] += 1
            k = f"{n}.{seen[n]}"
        seen.setdefault(k, 0)
        out.append(k)
    return out


def read_csv(spark: SparkSession, path: str, null_tokens: tuple[str, ...] = NULL_TOKENS, encoding: str = "UTF-8", columns: list[str] | None = None, multi_line: bool = True, infer: bool = False) -> DataFrame:
    """A CSV file as strings; the header is read apart, so repeated and case-only names survive.

    Quoted line breaks are kept, which takes one task a file; a file known to
    have none is split with ``multi_line=False``. Null tokens become null.
    ``columns`` prunes. ``infer`` types the columns (see ``infer_types``).
    """
    with open(path, encoding=encoding, errors="replace", newline="") as f:
        header = mangle(next(csv.reader(f), []))
    if not header:
        raise ValueError(f"{path} is empty")
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(header))])
    raw = spark.read.csv(path, schema=schema, header=True, enforceSchema=True, multiLine=multi_line, quote='"', escape='"', encoding=encoding, mode="PERMISSIVE")
    keep = [(i, h) for i, h in enumerate(header) if columns is None or h in columns]
    out = raw.select(*[F.when(~F.col(f"c{i}").isin(*null_tokens), F.col(f"c{i}")).alias(h) for i, h in keep])
    return infer_types(out) if infer else out


def infer_types(df: DataFrame) -> DataFrame:
    """String columns as whole numbers, decimals or booleans where every value is one; empty columns stay strings.

    One aggregation over the table decides; values with leading zeros (codes) stay text.
    """
    names = [c for c, k in df.dtypes if k == "string"]
    kinds = ("bigint", "double", "boolean")
    code = lambda c: F.coalesce(col(c).rlike(r"^\s*[+-]?0[0-9]"), F.lit(False))
    tests = [F.count(col(c)).alias(f"n{i}") for i, c in enumerate(names)] + [F.count(F.when(~code(c) | F.lit(k == "boolean"), col(c).try_cast(k))).alias(f"{k}{i}") for i, c in enumerate(names) for k in kinds]
    r = df.agg(*tests).first() if names else None
    found = {c: next((k for k in kinds if r[f"n{i}"] and r[f"{k}{i}"] == r[f"n{i}"]), None) for i, c in enumerate(names)}
    return df.select(*[col(c).cast(found[c]).alias(c) if found.get(c) else col(c) for c in df.columns])


def _xlsx_rows(data: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, cells as text."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si"):
                shared.append("".join(t.text or "" for t in si.iter(f"{ns}t")))
        sheet = sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        for row in ElementTree.fromstring(z.read(sheet)).iter(f"{ns}row"):
            cells: dict[int, str | None] = {}
            for c in row.iter(f"{ns}c"):
                at = 0
                for ch in re.match(r"[A-Z]+", c.get("r", "A"))[0]:
                    at = at * 26 + ord(ch) - 64
                v = c.find(f"{ns}v")
                text = None if v is None else v.text
                if c.get("t") == "s" and text is not None:
                    text = shared[int(text)]
                elif c.get("t") == "inlineStr":
                    text = "".join(t.text or "" for t in c.iter(f"{ns}t"))
                cells[at - 1] = text
            yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]


class XlsxReader(DataSourceReader):
    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def partitions(self):
        return [InputPartition(self.path)]

    def read(self, partition):
        with open(partition.value, "rb") as f:
            rows = _xlsx_rows(f.read())
            next(rows, None)
            for r in rows:
                if any(x not in (None, "") for x in r):
                    yield tuple((r + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """``spark.read.format("xlsx")``: the first sheet of a workbook as strings."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _header(self) -> list[str]:
        with open(self.options["path"], "rb") as f:
            return mangle([x or "" for x in next(_xlsx_rows(f.read()), [])])

    def schema(self) -> StructType:
        return StructType([StructField(h, StringType()) for h in self._header()])

    def reader(self, schema: StructType) -> DataSourceReader:
        return XlsxReader(self.options["path"], len(schema))


def read_xlsx(spark: SparkSession, path: str, null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """The first sheet of a workbook as strings, null tokens as null."""
    spark.dataSource.register(XlsxSource)
    df = spark.read.format("xlsx").load(path)
    return df.select(*[F.when(~col(c).isin(*null_tokens), col(c)).alias(c) for c in df.columns])


def read_any(spark: SparkSession, path: str) -> DataFrame:
    return read_xlsx(spark, path) if path.lower().endswith((".xlsx", ".xls")) else read_csv(spark, path)


def read_directory(spark: SparkSession, pattern: str, exclude: tuple[str, ...] = (), reader: Callable[[SparkSession, str], DataFrame] = read_any) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """All files of a pattern as one table with ``source_file``, ``_src_ord`` and ``_row_ord``; and the files that couldn't be read.

    Columns are united by name, missing ones null. An unreadable file is
    skipped and reported, never fatal.
    """
    frames, failed = [], []
    for i, path in enumerate(sorted(p for p in glob.glob(pattern) if os.path.basename(p) not in exclude)):
        try:
            df = reader(spark, path)
        except Exception as e:  # noqa: BLE001 - whatever a broken file raises
            failed.append((path, str(e).split("\n")[0]))
            continue
        frames.append(df.select("*", F.lit(os.path.basename(path)).alias("source_file"), F.lit(i).alias("_src_ord"), F.monotonically_increasing_id().alias("_row_ord")))
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None), failed


def route(paths: list[str], classes: dict[str, str]) -> dict[str, list[str]]:
    """Paths by the first class whose pattern their base name matches, the rest under ``other``."""
    out: dict[str, list[str]] = {k: [] for k in (*classes, "other")}
    for p in paths:
        out[next((k for k, r in classes.items() if re.search(r, os.path.basename(p), re.IGNORECASE)), "other")].append(p)
    return out
