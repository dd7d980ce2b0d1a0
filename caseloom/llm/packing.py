"""Filling fixed-capacity sequences with whole documents (harmonic packing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.tokens import VOCABULARY, with_token_counts
from caseloom.session import cut

CAPACITY = 2048
CLASSES = 64
CELL_DOCS = 20_000


def split_oversized(sized: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """``(key, part, start, size)``: items within the capacity whole, larger ones as full pieces and a rest."""
    parts = F.when(F.col(size) <= capacity, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.floor((F.col(size) - 1) / capacity).cast("int")))
    p = sized.select(key, F.col(size).cast("long").alias("_size"), F.explode(parts).alias("part"))
    start = F.col("part").cast("long") * capacity
    return p.select(key, "part", start.alias("start"), F.least(F.lit(capacity).cast("long"), F.col("_size") - start).alias("size"))


def harmonic_pack(sized: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, classes: int = CLASSES, cell_docs: int = CELL_DOCS) -> DataFrame:
    """``(key, part, start, size, bin, offset)``: every item in exactly one bin, bins never over capacity.

    Items above the capacity are cut into full pieces and a rest; all others
    stay whole. Pieces in (capacity/(k+1), capacity/k] form class k; a bin of
    class k takes exactly k of its pieces, so no bin has to know another. The
    last class (pieces of at most capacity/``classes``) fills by running sums.

    Plain harmonic bins of the low classes leave up to half their space open, so
    bins are not closed at once: going from class 1 upwards, the free space g of
    the bins so far offers floor(g * k / capacity) slots to class k - slots of
    the class's upper bound, again a fixed count a bin - and pieces take slots
    before they open bins of their own.

    Work is split into cells of about ``cell_docs`` pieces by a hash of the
    key (a deterministic function of the data's size); each cell packs by
    itself, which costs at most one part-filled bin a class and cell. Ranks
    inside a cell are by size, then key, so the result doesn't depend on
    partitioning; keys may repeat (equal rows get separate places). Null and
    negative sizes count as 0; items of size 0 take a place without space. An
    empty table gives no rows.
    """
    sized = cut(sized.select(key, F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).alias(size)))
    cells = max(1, -(-sized.count() // cell_docs))
    p = split_oversized(sized, key, size, capacity)
    k = F.least(F.floor(F.lit(capacity) / F.greatest("size", F.lit(1))), F.lit(classes)).cast("int")
    p = p.withColumns({"_cell": F.pmod(F.xxhash64(key, "part"), F.lit(cells)), "_k": k})
    schema = f"`{key}` {dict(sized.dtypes)[key]}, part int, start long, size long, bin string, `offset` long"

    def pack(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["size", key, "part", "start"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        cell = int(pdf["_cell"].iloc[0]) if len(pdf) else 0
        sizes, ks = pdf["size"].to_numpy(), pdf["_k"].to_numpy()
        where = np.empty(len(pdf), dtype=np.int64)
        free = np.empty(0, dtype=np.int64)  # free space of the bins of this cell
        for c in range(1, classes + 1):
            rows = np.flatnonzero(ks == c)
            if not len(rows):
                continue
            top = capacity // c
            slots = free // top
            have = np.repeat(np.flatnonzero(slots > 0), slots[slots > 0])[: len(rows)]
            where[rows[: len(have)]] = have
            np.subtract.at(free, have, sizes[rows[: len(have)]])
            rest = rows[len(have):]
            if len(rest):
                own = len(free) + np.arange(len(rest)) // c
                if c == classes:  # by running sums, restarted where the next piece wouldn't fit
                    fill, b, own = 0, len(free), np.empty(len(rest), dtype=np.int64)
                    for i, x in enumerate(sizes[rest]):
                        if fill + x > capacity:
                            fill, b = 0, b + 1
                        own[i] = b
                        fill += x
                free = np.concatenate([free, np.full(own[-1] + 1 - len(free), capacity, dtype=np.int64)])
                where[rest] = own
                np.subtract.at(free, own, sizes[rest])
        out = pd.DataFrame({key: pdf[key], "part": pdf["part"], "start": pdf["start"], "size": sizes, "_b": where})
        out["offset"] = out.groupby("_b")["size"].cumsum() - out["size"]
        out["bin"] = [f"{cell}-{b}" for b in where]
        return out[[key, "part", "start", "size", "bin", "offset"]]

    return p.groupBy("_cell").applyInPandas(pack, schema)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str = VOCABULARY) -> DataFrame:
    """Documents packed into training sequences by their token counts."""
    return harmonic_pack(with_token_counts(docs.select(key, text), text, path).select(key, "n_tokens"), key, "n_tokens", capacity)


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: bins, tokens, share of the capacity used, and the least bins any packing needs."""
    b = packed.groupBy("bin").agg(F.sum("size").alias("fill"))
    return b.agg(F.count("*").alias("bins"), F.coalesce(F.sum("fill"), F.lit(0)).alias("tokens"), F.max("fill").alias("fullest")).select(
        "bins", "tokens", "fullest", F.ceil(F.col("tokens") / capacity).alias("least_bins"), F.round(F.try_divide(F.col("tokens"), F.col("bins") * capacity), 6).alias("used"))


