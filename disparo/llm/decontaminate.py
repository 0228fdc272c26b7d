"""Benchmark decontamination: windows of ten normalised words against a broadcast set.

The benchmark's word windows (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words of the text with
A-Z lower-cased; an item of fewer than ten words is one window) become a hash set.  Every
document is scanned once: window hashes are looked up, and each hit is verified on the
words themselves.  A document word inside any occurrence of a window is a hit.

Scale: one narrow pass over the documents, no shuffle.  The broadcast set is built from
slices of the benchmark of at most ``max_slice_bytes`` of text each; the size is measured
first.  One slice (the usual case) is one scan; a larger benchmark is scanned slice by
slice and the hit words of a document are merged by row.

Defined cases: NULL text or text without words has no words and no hits; NULL or wordless
items have no windows; items of equal id count once, items with NULL id are ignored;
repeated document rows each get a row; other columns of the inputs are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from disparo.llm.common import stored
from disparo.llm.textscan import Words, alnum_class, chunks, in_row, lower_table, text_buffers, window_hash

NGRAM = 10
#: Text bytes of benchmark items that one broadcast set may hold.
MAX_SLICE_BYTES = 64 << 20
_FILTER_BITS = 22

ROW, HITS, ITEMS, N_WORDS = "__dc_row", "__dc_hits", "__dc_items", "__dc_words"


def item_windows(ids: list, texts: list, ngram: int = NGRAM) -> dict[int, dict[bytes, list]]:
    """window length -> joined words of a window -> ids of the items that have it."""
    out: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
    lower, cls = lower_table(), alnum_class()
    for item, text in zip(ids, texts):
        if item is None or not text:
            continue
        data, off = text_buffers(pa.array([text]))
        data = lower[data]
        w = Words(data, off, cls, with_hash=False)
        words = [data[s:e].tobytes() for s, e in zip(w.start, w.end)]
        k = min(ngram, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            out[k][b" ".join(words[i:i + k])].add(item)
    return {k: {key: sorted(v, key=str) for key, v in m.items()} for k, m in out.items()}


class Matcher:
    """Finds the windows of one benchmark slice in slices of documents."""

    def __init__(self, windows: dict[int, dict[bytes, list]]):
        self.windows, self.hashes = windows, {}
        cls = alnum_class()
        for k, m in windows.items():
            keys = list(m)
            data, off = text_buffers(pa.array(keys, pa.binary()).cast(pa.string()))
            w = Words(data, off, cls)
            h = window_hash(w.hash, k)[w.first[:-1]] if keys else np.zeros(0, np.uint64)
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[h >> np.uint64(64 - _FILTER_BITS)] = True
            self.hashes[k] = (np.sort(h), bits)

    def scan(self, data: np.ndarray, off: np.ndarray):
        """(words, hit mask by word, items by row)."""
        data = lower_table()[data]
        w = Words(data, off, alnum_class())
        hit = np.zeros(len(w.start), bool)
        items: dict[int, set] = defaultdict(set)
        row = None
        for k, (sorted_hash, bits) in self.hashes.items():
            h = window_hash(w.hash, k)
            if not len(h):
                continue
            at = np.flatnonzero(bits[h >> np.uint64(64 - _FILTER_BITS)] & in_row(w.first, len(w.start), k))
            at = at[sorted_hash[np.minimum(np.searchsorted(sorted_hash, h[at]), len(sorted_hash) - 1)] == h[at]]
            known = self.windows[k]
            if len(at) and row is None:
                row = w.rows()
            for i in at.tolist():
                key = b" ".join(data[s:e].tobytes() for s, e in zip(w.start[i:i + k], w.end[i:i + k]))
                ids = known.get(key)
                if ids is not None:
                    hit[i:i + k] = True
                    items[int(row[i])].update(ids)
        return w, hit, items


def _slices(items: DataFrame, id_col: str, text_col: str, max_bytes: int):
    """Driver-side slices (ids, texts), each of at most ``max_bytes`` of text (one longer item
    is a slice by itself)."""
    src = (items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
                .where(F.col("i").isNotNull() & F.col("t").isNotNull()))
    total = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if total <= max_bytes:
        rows = src.collect()
        return [([r.i for r in rows], [r.t for r in rows])]
    return _sliced(src, max_bytes)


def _sliced(src: DataFrame, max_bytes: int):
    ids, texts, size = [], [], 0
    for r in src.toLocalIterator():
        n = len(r.t.encode())
        if ids and size + n > max_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += n
    if ids:
        yield ids, texts


def _matcher(cache: dict, shared) -> Matcher:
    if "m" not in cache:
        cache["m"] = Matcher(shared.value)
    return cache["m"]


def _sha(ids) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


REPORT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first_word", T.IntegerType()),
                                                     T.StructField("end_word", T.IntegerType())])))])


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [{"first_word": int(a), "end_word": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_id: str = "item_id", item_text: str = "text", ngram: int = NGRAM,
                         max_slice_bytes: int = MAX_SLICE_BYTES) -> DataFrame:
    """One row per document row: its id, ``n_words``, ``n_hit``, ``n_items``, the digest of the
    item ids, ``contaminated``, and the item ids and hit word runs themselves."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = T.StructType([narrow.schema[0], *REPORT.fields])
    arrow_rest = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                            ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
                            ("item_ids", pa.list_(pa.string())),
                            ("spans", pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())])))])

    def scanner(shared):
        def run(batches):
            cache: dict = {}
            empty = _sha(())
            for part, data, off in chunks(batches):
                w, hit, items_of = _matcher(cache, shared).scan(data, off)
                n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), w.first[:-1]) if len(hit) else np.zeros(part.num_rows, np.int64)
                n_hit = np.where(w.counts > 0, n_hit, 0)
                found = [sorted(map(str, items_of.get(r, ()))) for r in range(part.num_rows)]
                spans = [_runs(hit[w.first[r]:w.first[r + 1]]) if n_hit[r] else [] for r in range(part.num_rows)]
                cols = [pa.array(w.counts.astype(np.int64)), pa.array(n_hit),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array([_sha(x) if x else empty for x in found]), pa.array(n_hit > 0),
                        pa.array(found, arrow_rest.field("item_ids").type), pa.array(spans, arrow_rest.field("spans").type)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], [part.schema.field(0).name, *arrow_rest.names])
        return run

    slices = list(_slices(items, item_id, item_text, max_slice_bytes))
    if len(slices) <= 1:
        shared = spark.sparkContext.broadcast(item_windows(*(slices[0] if slices else ([], [])), ngram=ngram))
        return narrow.mapInArrow(scanner(shared), schema)
    return _merged(narrow, slices, scanner, schema, ngram)


def _merged(narrow: DataFrame, slices, scanner, schema, ngram: int) -> DataFrame:
    """Several slices: one scan each, then the hit runs of a row are united by row number."""
    spark = narrow.sparkSession
    id_name = narrow.columns[0]
    base = stored(narrow.withColumn(ROW, F.monotonically_increasing_id()), "decontaminate-rows")
    keyed = base.select(F.struct(F.col(id_name).alias("id"), F.col(ROW).alias("row")).alias("key"), "text")
    part_schema = T.StructType([keyed.schema[0], *schema.fields[1:]])
    parts = None
    for s in slices:
        shared = spark.sparkContext.broadcast(item_windows(*s, ngram=ngram))
        one = keyed.mapInArrow(scanner(shared), part_schema)
        parts = one if parts is None else parts.unionByName(one)
    words = F.array_distinct(F.flatten(F.collect_list(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["first_word"], s["end_word"] - 1))))))
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids"))))
    merged = parts.groupBy("key").agg(F.max("n_words").alias("n_words"), words.alias("w"), ids.alias("item_ids"))
    runs = F.transform(F.filter(F.array_sort("w"), lambda x: ~F.array_contains("w", x - 1)), lambda a: F.struct(
        a.cast("int").alias("first_word"),
        F.array_min(F.filter(F.transform("w", lambda x: x + 1), lambda e: (e > a) & ~F.array_contains("w", e)))
        .cast("int").alias("end_word")))
    return merged.select(
        F.col("key.id").alias(id_name), "n_words", F.size("w").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("w") > 0).alias("contaminated"), "item_ids", runs.alias("spans"))


def remove_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", how: str = "documents",
                         item_id: str = "item_id", item_text: str = "text", ngram: int = NGRAM,
                         max_slice_bytes: int = MAX_SLICE_BYTES) -> DataFrame:
    """``docs`` with its own columns, without contaminated documents (``how="documents"``) or
    with the text from the first to the last word of each hit run cut out (``"spans"``)."""
    if how not in ("documents", "spans"):
        raise ValueError(f"how must be documents or spans, not {how!r}")
    spark, out = docs.sparkSession, docs
    slices = _slices(items, item_id, item_text, max_slice_bytes)
    if how == "spans" and not isinstance(slices, list):
        return _cut_once(docs, slices, text_col, ngram)
    for s in slices:
        shared = spark.sparkContext.broadcast(item_windows(*s, ngram=ngram))
        out = out.mapInArrow(_remover(shared, text_col, how), docs.schema)
    return out


def _cut_once(docs: DataFrame, slices, text_col: str, ngram: int) -> DataFrame:
    """Several slices: each is scanned on the uncut text; a row's hit runs are then united and cut."""
    spark = docs.sparkSession
    base = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "decontaminate-rows")
    hits = None
    for s in slices:
        shared = spark.sparkContext.broadcast(item_windows(*s, ngram=ngram))
        one = base.select(ROW, F.col(text_col).alias("text")).mapInArrow(_span_finder(shared), f"{ROW} long, {HITS} {_SPANS}")
        hits = one if hits is None else hits.unionByName(one)
    hits = hits.groupBy(ROW).agg(F.flatten(F.collect_list(HITS)).alias(HITS))
    return base.join(hits, ROW, "left").select(*docs.columns, HITS).mapInArrow(_cutter(text_col), docs.schema)


_SPANS = "array<struct<first_word:int,end_word:int>>"


def _span_finder(shared):
    def run(batches):
        cache: dict = {}
        kind = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))
        for part, data, off in chunks(batches):
            w, hit, _ = _matcher(cache, shared).scan(data, off)
            rows = np.unique(w.rows()[hit]) if hit.any() else np.zeros(0, np.int64)
            spans = [_runs(hit[w.first[r]:w.first[r + 1]]) for r in rows.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(spans, kind)], [ROW, HITS])
    return run


def _cutter(text_col: str):
    def run(batches):
        for part, data, off in chunks(batches, text_col):
            w = Words(data, off, alnum_class())
            hit = np.zeros(len(w.start), bool)
            last = part.num_columns - 1
            for r, spans in enumerate(part.column(last).to_pylist()):
                for s in spans or ():
                    hit[w.first[r] + s["first_word"]:w.first[r] + s["end_word"]] = True
            names = part.schema.names[:last]
            yield _cut_rows(pa.RecordBatch.from_arrays(part.columns[:last], names), data, off, w, hit, text_col)
    return run


def _cut_rows(part, data, off, w, hit, text_col: str):
    rows = np.unique(w.rows()[hit]) if hit.any() else np.zeros(0, np.int64)
    if not len(rows):
        return part
    i = part.schema.get_field_index(text_col)
    texts = part.column(i).to_pylist()
    for r in rows.tolist():
        a = w.first[r]
        raw, at, kept = data[off[r]:off[r + 1]].tobytes(), 0, []
        for run_ in _runs(hit[a:w.first[r + 1]]):
            s, e = w.start[a + run_["first_word"]] - off[r], w.end[a + run_["end_word"] - 1] - off[r]
            kept.append(raw[at:s])
            at = e
        texts[r] = b"".join([*kept, raw[at:]]).decode()
    return part.set_column(i, part.schema.field(i), pa.array(texts, part.schema.field(i).type))


def _remover(shared, text_col: str, how: str):
    def run(batches):
        cache: dict = {}
        for part, data, off in chunks(batches, text_col):
            w, hit, _ = _matcher(cache, shared).scan(data, off)
            if how == "documents":
                rows = np.unique(w.rows()[hit]) if hit.any() else np.zeros(0, np.int64)
                keep = np.ones(part.num_rows, bool)
                keep[rows] = False
                yield part.filter(pa.array(keep)) if len(rows) else part
            else:
                yield _cut_rows(part, data, off, w, hit, text_col)
    return run
