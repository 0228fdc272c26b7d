"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every row gets a short fingerprint (the top bits of a 64-bit text hash; ``log2(rows) + 12``
   bits, so about one row in 4,000 is a false suspect).
2. Senders (blocks of rows) send each owner (a fingerprint range) their sorted distinct
   fingerprints as Golomb-Rice coded gaps - about 14 bits a row.
3. An owner decodes all its messages and answers each with a bitmap: which fingerprints occur
   more than once anywhere.
4. Senders turn the bitmaps into suspect fingerprints; only rows with such a fingerprint are
   shuffled, grouped by their whole text (byte verification, partial aggregation first).

Scale: the exchange moves about two bytes a row; text moves only for suspects.  Messages of a
block are bounded by ``BLOCK_ROWS``.  Suspect fingerprints are broadcast as a filter only below
``max_broadcast_rows``; beyond it the same semi-join is shuffled.  A group of copies of any
size is one row after partial aggregation, and its rows meet their class in a skew-split join.

Defined cases: NULL text counts as empty; of equal texts the row with the largest id stays
(NULL ids last); of rows that repeat both id and text exactly one stays; an empty table gives
an empty result; other columns are carried or ignored, never compared.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.llm.common import groups_for, stored, text_or_empty

EXTRA_BITS = 12
BLOCK_ROWS = 2_000_000
MAX_BROADCAST_ROWS = 2_000_000
_P = "__ed_"


# ---------------------------------------------------------------- Golomb-Rice coding

def rice_encode(values: np.ndarray) -> tuple[bytes, int]:
    """Sorted distinct non-negative integers as Rice-coded gaps; returns (bits, parameter)."""
    gaps = np.diff(values, prepend=np.int64(0)).astype(np.int64)
    mean = max(1.0, float(gaps.mean())) if len(gaps) else 1.0
    k = max(0, int(math.log2(mean * math.log(2))) if mean > 1.5 else 0)
    q = gaps >> k
    ends = np.cumsum(q + 1 + k)
    bits = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    bits[ends - k - 1] = 1
    for j in range(k):
        bits[ends - k + j] = (gaps >> (k - 1 - j)) & 1
    return np.packbits(bits).tobytes(), k


def rice_decode(payload: bytes, k: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(payload, np.uint8))
    if not n:
        return np.zeros(0, np.int64)
    ones = np.flatnonzero(bits)
    # A terminator is the first one at or after the end of the previous code.
    stops = np.empty(n, np.int64)
    if k == 0:
        stops[:] = ones[:n]
    else:
        nxt = np.searchsorted(ones, ones + k + 1).tolist()
        at, where = 0, ones.tolist()
        for i in range(n):
            stops[i] = where[at]
            at = nxt[at]
    begins = np.concatenate(([0], stops[:-1] + k + 1))
    rest = np.zeros(n, np.int64)
    for j in range(k):
        rest = (rest << 1) | bits[stops + 1 + j]
    return np.cumsum(((stops - begins) << k) | rest)


# ---------------------------------------------------------------- the exchange

def owners_of(values: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """``values * owners >> bits`` by the owners' first fingerprints (the product itself passes 64 bits)."""
    if not len(values):
        return np.zeros(0, np.int64)
    # Of the owners between the first and the last value only; Python's integers do not overflow.
    lo, hi = int(values.min()) * owners >> bits, int(values.max()) * owners >> bits
    first = np.array([-(-(o << bits) // owners) for o in range(lo + 1, hi + 1)], np.int64)
    return lo + np.searchsorted(first, values, "right")


def exchange_groups(spark: SparkSession, rows: int) -> int:
    """Number of senders and of owners: groups of at most about ``BLOCK_ROWS`` rows, more for a busy cluster, but
    no more than leaves 16 rows a message."""
    wanted = groups_for(spark, rows, 2_000, BLOCK_ROWS)
    return max(1, math.ceil(rows / BLOCK_ROWS), min(wanted, math.isqrt(rows // 16)))


def _outgoing(prints: np.ndarray, owners: int, bits: int):
    """For each owner with rows: (owner, sorted distinct fingerprints, locally repeated)."""
    values, counts = np.unique(prints, return_counts=True)
    owner = owners_of(values, owners, bits)
    cut = np.flatnonzero(np.diff(owner, prepend=-1))
    for a, b in zip(cut, np.append(cut[1:], len(values))):
        yield int(owner[a]), values[a:b], counts[a:b] > 1


def _send(owners: int, bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sender, rows = int(pdf["sender"].iloc[0]), []
        for owner, values, twice in _outgoing(pdf["print"].to_numpy(np.int64), owners, bits):
            base = int(values[0])
            payload, k = rice_encode(values - base)
            rows.append((owner, sender, base, len(values), k, payload, np.packbits(twice).tobytes()))
        return pd.DataFrame(rows, columns=["owner", "sender", "base", "n", "k", "payload", "twice"])
    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    values = [rice_decode(p, k, n) + base for p, k, n, base in zip(pdf["payload"], pdf["k"], pdf["n"], pdf["base"])]
    twice = [np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(bool) for t, n in zip(pdf["twice"], pdf["n"])]
    every = np.concatenate(values)
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    same[:-1] |= same[1:]
    dup = np.empty(len(s), bool)
    dup[order] = same
    dup |= np.concatenate(twice)
    cut = np.cumsum([0, *map(len, values)])
    return pd.DataFrame({"sender": pdf["sender"], "owner": pdf["owner"],
                         "bitmap": [np.packbits(dup[a:b]).tobytes() for a, b in zip(cut, cut[1:])]})


def _receive(owners: int, bits: int):
    def run(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        bitmaps = dict(zip(answers["owner"], answers["bitmap"]))
        out = [values[np.unpackbits(np.frombuffer(bitmaps[owner], np.uint8))[:len(values)].astype(bool)]
               for owner, values, _ in _outgoing(pdf["print"].to_numpy(np.int64), owners, bits)] if len(pdf) else []
        return pd.DataFrame({"print": np.concatenate(out) if out else np.zeros(0, np.int64)})
    return run


def suspect_prints(prints: DataFrame, rows: int, bits: int) -> DataFrame:
    """Distinct fingerprints (column ``print``) that more than one row of ``prints``
    (``sender``, ``print``) carries."""
    owners = exchange_groups(prints.sparkSession, rows)
    src = prints.select("sender", "print")
    messages = src.groupBy("sender").applyInPandas(
        _send(owners, bits), "owner int, sender int, base long, n int, k int, payload binary, twice binary")
    answers = messages.groupBy("owner").applyInPandas(_answer, "sender int, owner int, bitmap binary")
    got = src.groupBy("sender").cogroup(answers.groupBy("sender")).applyInPandas(_receive(owners, bits), "print long")
    return got.distinct()


class Duplicates:
    """The state of one run: ``prints`` (a row per document), the suspect rows and classes."""

    def __init__(self, docs: DataFrame, text_col: str, id_col: str, extra: dict | None = None,
                 max_broadcast_rows: int = MAX_BROADCAST_ROWS):
        self.docs, self.id_col = docs, id_col
        spark = docs.sparkSession
        text = text_or_empty(text_col)
        h = F.xxhash64(text)
        first = stored(docs.select(F.col(id_col).alias("id"), h.alias("h"), F.spark_partition_id().alias("part"),
                                   *[c.alias(n) for n, c in (extra or {}).items()]), "dedup-prints")
        self.rows = first.count()
        bits = min(61, max(8, math.ceil(math.log2(max(2, self.rows))) + EXTRA_BITS))
        senders = exchange_groups(spark, self.rows)
        self.print_of = lambda hashed: F.shiftrightunsigned(hashed, 64 - bits)
        self.prints = first.withColumns({"print": self.print_of(F.col("h")),
                                         "sender": F.pmod(F.col("part") * F.lit(31) + F.pmod("h", F.lit(31)), F.lit(senders)).cast("int")})
        suspects = stored(suspect_prints(self.prints, self.rows, bits), "dedup-suspects")
        n = suspects.count()
        self.suspects = F.broadcast(suspects) if n <= max_broadcast_rows else suspects
        self.copies = stored(
            docs.withColumns({f"{_P}text": text, f"{_P}print": self.print_of(F.xxhash64(text))}).join(self.suspects.withColumnRenamed("print", f"{_P}print"), f"{_P}print", "left_semi")
                .withColumn(f"{_P}row", F.monotonically_increasing_id()), "dedup-copies")
        # Byte verification: equal texts meet here as whole texts.
        # Stored, so that both sides of a join with the copies are dealt anew and a hot text can be split.
        self.classes = stored(self.copies.groupBy(f"{_P}text")
                        .agg(F.max(F.struct(F.col(id_col).alias("id"), F.col(f"{_P}row").alias("row"))).alias("keep"),
                             F.count(F.lit(1)).alias("group_size")), "dedup-classes")


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per document row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    d = Duplicates(docs.select(id_col, text_col), text_col, id_col,
                   {"sha": F.sha2(text_or_empty(text_col), 256)}, **kw)
    alone = d.prints.join(d.suspects, "print", "left_anti").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    grouped = d.copies.select(id_col, f"{_P}text", f"{_P}row").join(d.classes, f"{_P}text").select(
        id_col, F.col("keep.id").alias("keep_id"), "group_size", (F.col(f"{_P}row") == F.col("keep.row")).alias("kept"),
        F.sha2(f"{_P}text", 256).alias("text_sha256"))
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with its own columns and one row of each group of equal texts."""
    d = Duplicates(docs, text_col, id_col, **kw)
    text = text_or_empty(text_col)
    alone = (docs.withColumn(f"{_P}print", d.print_of(F.xxhash64(text)))
                 .join(d.suspects.withColumnRenamed("print", f"{_P}print"), f"{_P}print", "left_anti")
                 .select(*docs.columns))
    keep = d.classes.select(F.col("keep.row").alias(f"{_P}row"))
    return alone.unionByName(d.copies.join(keep, f"{_P}row", "left_semi").select(*docs.columns))
