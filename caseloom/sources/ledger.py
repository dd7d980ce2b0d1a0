"""Which files were processed, and careful sinks."""

from __future__ import annotations

import json
import os
import shutil
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_ledger(path: str) -> set[str]:
    """Names of processed files; none if there is no ledger yet."""
    if not os.path.exists(path):
        return set()
    with open(path) as f:
        return {x.strip() for x in f if x.strip()}


def new_files(paths: list[str], ledger: str) -> list[str]:
    done = read_ledger(ledger)
    return sorted(p for p in paths if os.path.basename(p) not in done)


def append_ledger(path: str, names: list[str]) -> None:
    """Adds names that aren't listed yet."""
    done = read_ledger(path)
    with open(path, "a") as f:
        f.writelines(n + "\n" for n in dict.fromkeys(names) if n not in done)


def read_thresholds(path: str, labels: list[str], default: float = 0.5) -> dict[str, float]:
    """Cut-offs from a JSON object, the default where the file or a label is missing."""
    data = {}
    if os.path.exists(path):
        with open(path) as f:
            data = json.load(f)
    return {k: float(data.get(k, default)) for k in labels}


def overwrite(df: DataFrame, path: str, keep_backup: bool = False) -> None:
    """Replaces a Parquet directory, also one the frame reads from: written beside it, then swapped in."""
    temp = f"{path}.new-{int(time.time() * 1000)}"
    df.write.parquet(temp)
    if os.path.exists(path):
        old = f"{path}.bak-{time.strftime('%Y%m%d%H%M%S')}"
        os.rename(path, old)
        os.rename(temp, path)
        if not keep_backup:
            shutil.rmtree(old)
    else:
        os.rename(temp, path)


def range_name(df: DataFrame, date: str, suffix: str = "cases", fallback: str = "final") -> str:
    """``yyyy-mm-yyyy-mm-suffix`` of a date column, the fallback if it is empty."""
    r = df.agg(F.date_format(F.min(date), "yyyy-MM"), F.date_format(F.max(date), "yyyy-MM")).first()
    return f"{r[0]}-{r[1]}-{suffix}" if r[0] else fallback


def write_bundle(frames: dict[str, DataFrame], directory: str, prefix: str) -> list[str]:
    """Each named frame as ``<prefix>_<name>`` (CSV with header)."""
    out = []
    for name, df in frames.items():
        out.append(os.path.join(directory, f"{prefix}_{name}"))
        df.write.mode("overwrite").csv(out[-1], header=True)
    return out


def append_log(stats: DataFrame, path: str, what: str = "new entries in final csv file") -> list[str]:
    """Appends a line for each source of ``source_stats`` to a log file, in order of the sources; returns the lines.

    ``stats`` has a row a source, so only that many reach the driver.
    """
    rows = stats.orderBy("source_file").select("source_file", "n", "range").toLocalIterator()
    lines = [f"{r['source_file']} - {r['n']} {what}, {r['range'] or 'No dates available'}" for r in rows]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a") as f:
        f.writelines(x + "\n" for x in lines)
    return lines


def tidy_names(directory: str) -> list[tuple[str, str]]:
    """Blanks in file names as underscores; a counter keeps names apart. Returns the renames."""
    done = []
    for n in sorted(os.listdir(directory)):
        if " " in n:
            stem, ext = os.path.splitext(n.replace(" ", "_"))
            to, i = stem + ext, 1
            while os.path.exists(os.path.join(directory, to)):
                to, i = f"{stem}_{i}{ext}", i + 1
            os.rename(os.path.join(directory, n), os.path.join(directory, to))
            done.append((n, to))
    return done
