"""Substring dedup: repeated windows of ``WINDOW`` words found by FM-index matching statistics.

A word goes if a window of 50 consecutive words covers it that also starts in a document with
a smaller id.  Windows are judged on the input.

1. Routing: each window elects an anchor (its least 8-word hash).  Equal windows elect equal
   anchors, so a passage - the run of windows with one anchor, 50 to about 92 words - need only
   meet passages with the same anchor.  Anchors that only one text has are dropped.  The passages
   are cut in one more scan, from the owner's row of each text with a shared anchor; bit arrays of
   those rows and anchors (at most ``2 ** FILTER_BITS`` bits, by a broadcast) tell which, so whole
   texts are not shuffled for it.  What passes by mistake is one passage more in an index; hits
   count only where the row is the text's owner.
2. Shards by anchor: each holds an FM-index (wavelet matrix over the Burrows-Wheeler transform)
   of its distinct passages; passages stream through it by backward search, and where the match
   reaches 50 words, the block of the interval tells the least document that has the window.
   A crowded anchor is split: its passages are dealt to several indexes and stream through all.
3. Intervals whose least document is smaller are put together a document, and cut out.

Scale: texts are collapsed by hash, so copies of any number are searched once (a copy with a
larger id goes whole); anchor rows are one in about 22 words, 32 bytes each; only passages of
shared anchors carry text; shards hold about ``SHARD_WORDS`` words.

Defined cases: NULL text has no words; a text of fewer than 50 words stays; a NULL id sorts
after all ids; rows that repeat id and text get the same result; an empty table gives an empty
result; other columns are ignored.  Ids are integers.  Texts are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.llm.bits import bit_array, has
from disparo.llm.common import stored, text_or_empty
from disparo.llm.fm_index import NONE, FMIndex
from disparo.llm.textscan import Words, chunks, in_row, mixed_sums, non_space_class, window_hash

WINDOW = 50
ANCHOR_WORDS = 8
SHARD_WORDS = 400_000
CROWDED = 4_000
MAX_BROADCAST_ROWS = 200_000
FILTER_BITS = 27
_LAST_ID = (1 << 63) - 1


# ---------------------------------------------------------------- anchors

def anchor_runs(words: Words, window: int, q: int):
    """(row, anchor hash, first window, number of windows) of each run of windows that elect
    the same anchor; window positions count within the row."""
    n = len(words.start) - window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, np.uint64), z, z
    grams = window_hash(words.hash, q)
    at = np.flatnonzero(in_row(words.first, len(words.start), window))
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, np.uint64), z, z
    elected = at + sliding_window_view(grams, window - q + 1)[at].argmin(axis=1) if len(at) < n // 2 else (
        sliding_window_view(grams, window - q + 1).argmin(axis=1)[at] + at)
    row = np.searchsorted(words.first, at, "right") - 1
    cut = np.flatnonzero(np.append(True, (elected[1:] != elected[:-1]) | (at[1:] != at[:-1] + 1)))
    many = np.diff(np.append(cut, len(at)))
    return row[cut], grams[elected[cut]], at[cut] - words.first[row[cut]], many


def _anchors(window: int, q: int):
    def run(batches):
        for part, data, off in chunks(batches):
            row, anchor, start, many = anchor_runs(Words(data, off, non_space_class()), window, q)
            nodes = part.column(part.schema.get_field_index("node")).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[row]), pa.array(anchor.view(np.int64)), pa.array(start.astype(np.int32)),
                 pa.array(many.astype(np.int32))], ["node", "anchor", "start", "windows"])
    return run


# ---------------------------------------------------------------- passages

_PASSAGES = "node long, id long, anchor long, start int, content long, words binary"


def _owned(batches, rows: np.ndarray):
    """The rows of the batches that are in the bit array, repeated ones once a task."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        fresh = np.zeros(batch.num_rows, bool)
        hit = np.flatnonzero(has(rows, col["h"].to_numpy().view(np.uint64)))
        for i, pair in zip(hit.tolist(), zip(col["node"].to_numpy()[hit].tolist(), col["id"].to_numpy()[hit].tolist())):
            if pair not in seen:
                seen.add(pair)
                fresh[i] = True
        yield batch.filter(pa.array(fresh))


def _cut(window: int, q: int, shared):
    """Passages of a text as words joined by single spaces."""
    def run(batches):
        rows, anchors = shared.value
        for part, data, off in chunks(_owned(batches, rows)):
            w = Words(data, off, non_space_class())
            row, anchor, begin, many = anchor_runs(w, window, q)
            kept = has(anchors, anchor)
            row, anchor, begin, many = row[kept], anchor[kept], begin[kept], many[kept]
            first = w.first[row] + begin
            last = first + many + window - 1
            content = mixed_sums(w.hash, first, last).view(np.int64)
            node, ident = (part.column(part.schema.get_field_index(n)).to_numpy()[row] for n in ("node", "id"))
            joined = [b" ".join(data[s:e].tobytes().split()) for s, e in zip(w.start[first].tolist(), w.end[last - 1].tolist())]
            out = (node, ident, anchor.view(np.int64), begin, content, joined)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            for a in range(0, len(joined), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 2000], k) for c, k in zip(out, kinds)],
                                                 ["node", "id", "anchor", "start", "content", "words"])
    return run


# ---------------------------------------------------------------- shards

_FOUND = "anchor long, content long, runs array<struct<a:int,b:int,least:long>>"


def search_shard(texts: list[bytes], owners: np.ndarray, indexed: np.ndarray, window: int) -> list[list[dict]]:
    """Runs of windows of each passage with the least owner among the indexed passages."""
    ids: dict[bytes, int] = {}
    passages = []
    for text, own in zip(texts, indexed):
        words = text.split(b" ")
        passages.append(np.array([ids.setdefault(x, len(ids)) for x in words] if own else [0] * 0, np.int64))
    index = FMIndex([p for p, own in zip(passages, indexed) if own], owners[indexed], len(ids), window)
    for i in np.flatnonzero(~indexed):
        passages[i] = np.array([ids.get(x, -1) for x in texts[i].split(b" ")], np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in passages])))
    least = index.least_owners(np.concatenate(passages), offsets)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        m = least[a:b - window + 1]
        cut = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        out.append([{"a": int(x), "b": int(y), "least": int(m[x])} for x, y in zip(cut, np.append(cut[1:], len(m))) if m[x] != NONE])
    return out


def _search(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        runs = search_shard(pdf["words"].tolist(), pdf["least"].to_numpy(np.int64), pdf["indexed"].to_numpy(bool), window)
        return pd.DataFrame({"anchor": pdf["anchor"], "content": pdf["content"], "runs": runs})
    return run


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                       anchor_words: int = ANCHOR_WORDS, shard_words: int = SHARD_WORDS, crowded: int = CROWDED) -> DataFrame:
    """(``node``, ``owner``, ``hits``) per distinct text: its hash, the least id that has it (NULL
    ids last) and the word intervals [a, b) that a smaller document repeats (NULL without any)."""
    spark = docs.sparkSession
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID))
    texts = docs.select(ident.alias("id"), text_or_empty(text_col).alias("text")).withColumn("node", F.xxhash64("text"))
    owners = stored(texts.groupBy("node").agg(F.min("id").alias("owner")), "substring-owners")
    anchors = stored(texts.select("node", "text").mapInArrow(_anchors(window, anchor_words),
                                                             "node long, anchor long, start int, windows int"), "substring-anchors")
    shared = anchors.groupBy("anchor").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("anchor")
    shared = stored(shared, "substring-shared")  # dealt anew in the join, so a common anchor can be split
    suspects = _shared_runs(anchors, shared).groupBy("node").agg(F.count(F.lit(1)).alias("runs"))
    suspects = stored(suspects.join(owners, "node").select("node", "owner"), "substring-suspects")
    wanted = spark.sparkContext.broadcast((
        bit_array(suspects.select(F.xxhash64("node", "owner").alias("h")), suspects.count(), FILTER_BITS),
        bit_array(shared.select(F.col("anchor").alias("h")), shared.count(), FILTER_BITS)))
    rows = texts.select("node", "id", F.xxhash64("node", "id").alias("h"), "text")
    passages = stored(rows.mapInArrow(_cut(window, anchor_words, wanted), _PASSAGES), "substring-passages")
    distinct = stored(passages.groupBy("anchor", "content").agg(F.min("id").alias("least"), F.first("words").alias("words")), "substring-distinct")
    size = distinct.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 6 // shard_words + 1)
    hot = stored(distinct.groupBy("anchor").count().where(F.col("count") > crowded)
                 .select("anchor", F.ceil(F.col("count") / crowded).cast("int").alias("parts")), "substring-hot")
    dealt = (distinct.join(hot, "anchor", "left")
             .withColumn("shard", F.when(F.col("parts").isNull(), F.pmod("anchor", F.lit(shards))).otherwise(F.col("anchor")))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
             .withColumn("indexed", F.pmod("content", F.coalesce("parts", F.lit(1))) == F.col("part"))
             .withColumn("alone", F.col("parts").isNotNull())
             .select("shard", "part", "alone", "anchor", "content", "least", "words", "indexed"))
    found = stored(dealt.groupBy("shard", "part", "alone").applyInPandas(_search(window), _FOUND), "substring-found")
    hits = (passages.drop("words").join(found.where(F.size("runs") > 0), ["anchor", "content"])
            .select("node", "id", "start", F.explode("runs").alias("r")).where("r.least < id")
            .join(suspects.withColumnRenamed("owner", "id"), ["node", "id"])
            .select("node", F.struct((F.col("start") + F.col("r.a")).alias("a"),
                                     (F.col("start") + F.col("r.b") + window - 1).alias("b")).alias("hit"))
            .groupBy("node").agg(F.collect_set("hit").alias("hits")))
    return stored(owners.join(hits, "node", "left"), "substring-hits")


def _shared_runs(anchors: DataFrame, shared: DataFrame) -> DataFrame:
    """The runs with a shared anchor, once a text: copies are merged by partial aggregation before
    the runs of a text are collected, so a group holds those of one text."""
    return anchors.join(shared, "anchor").select("node", "start", "windows", "anchor").distinct()


# ---------------------------------------------------------------- results

def kept_words(text: bytes, hits, whole: bool, window: int) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space)."""
    words = text.split()
    n = len(words)
    if whole and n >= window:
        return n, n, b""
    if not hits:
        return n, 0, b" ".join(words)
    gone = np.zeros(n + 1, np.int32)
    for h in hits:
        gone[h["a"]] += 1
        gone[h["b"]] -= 1
    keep = np.cumsum(gone[:n]) == 0
    return n, int(n - keep.sum()), b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def _result(window: int, with_text: bool):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                col = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                texts = col["text"].cast(pa.binary()).to_pylist()
                hits, whole = col["hits"].to_pylist(), col["copy"].to_pylist()
                got = [kept_words(t, h, c, window) for t, h, c in zip(texts, hits, whole)]
                cols = [part.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                        pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())]
                names = [part.schema.names[0], "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    cols.append(pa.array([g[2].decode() for g in got], pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_text: bool = True, **kw) -> DataFrame:
    """One row per document row: id, ``n_words``, ``n_removed``, ``kept_sha256`` and, with
    ``with_text``, the kept words (``kept``)."""
    found = repeated_intervals(docs, id_col, text_col, window, **kw)
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID))
    rows = docs.select(F.col(id_col).alias("doc"), ident.alias("id"), text_or_empty(text_col).alias("text")).withColumn(
        "node", F.xxhash64("text"))
    # Only texts with something to remove need the join; the rest pass by it.
    marked = found.where("hits is not null")
    copies = docs.select(F.xxhash64(text_or_empty(text_col)).alias("node")).groupBy("node").count().where("count > 1").select("node")
    asked = stored(marked.select("node", "owner", "hits").unionByName(
        found.join(copies, "node", "left_semi").where("hits is null").select("node", "owner", "hits")), "substring-asked")
    small = asked.count() <= MAX_BROADCAST_ROWS and (asked.agg(F.sum(F.greatest(F.size("hits"), F.lit(1)))).first()[0] or 0) * 24 <= 32 << 20
    joined = rows.join(F.broadcast(asked) if small else asked, "node", "left").select(
        "doc", "text", F.when(F.col("id") == F.col("owner"), F.col("hits")).alias("hits"),
        F.coalesce(F.col("id") > F.col("owner"), F.lit(False)).alias("copy"))
    kind = joined.schema[0].dataType.simpleString()
    out = joined.mapInArrow(_result(window, with_text), f"doc {kind}, n_words long, n_removed long, kept_sha256 string"
                            + (", kept string" if with_text else ""))
    return out.withColumnRenamed("doc", id_col)
