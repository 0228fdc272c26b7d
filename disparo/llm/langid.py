"""Language identification with spans for mixed-language text.

Words are runs of letters.  The script of a word (by code point ranges) narrows its candidate
languages to those that use the script in the training rows.  Each candidate scores the word
by its byte 3- and 4-grams (smoothed log frequencies, word borders included); Viterbi over the
words of a document with a switching penalty labels every word, equal neighbours form spans,
and the language of most letters is the document's.

Learning is one pass: n-gram counts by language over all training rows (never a sample), added
up block-wise.  The model's size is languages x ``2 * BUCKETS`` floats whatever the corpus (at
most ``MAX_LANGUAGES``), which is the proven bound of its broadcast.  Prediction is one narrow
pass; documents of a batch run through Viterbi side by side.

Defined cases: NULL text or text without a letter is ``und`` with score 0; rows with NULL
language, NULL or letterless text are not learned from; without any training row everything
is ``und``; ties go to the language that sorts first; repeated rows each get a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.llm.textscan import Words, chunks, lower_table

BUCKETS = 1 << 15
BLOCK = 1 << 12
MAX_LANGUAGES = 256
SWITCH_PENALTY = 12.0
#: A language counts as a candidate for a script from this share of its words on.
SCRIPT_SHARE = 0.002
BATCH_BYTES = 8 << 20
HAS_LETTER = r"\p{L}"

# First code points of Unicode script ranges (the last entry of a name wins up to the next).
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x1380, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"), (0x30000, "other"),
)
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(n) for _, n in SCRIPTS], np.int16)


def letters(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes in which everything but letters is a space (symbol and punctuation
    blocks outside ASCII included)."""
    x = lower_table()[data]
    x[(x < 0x61) | ((x > 0x7A) & (x < 0x80))] = 0x20
    nxt = np.append(data[1:], np.uint8(0))
    lead = ((data == 0xC2) & (nxt != 0xAA) & (nxt != 0xB5) & (nxt != 0xBA)) | ((data == 0xC3) & ((nxt == 0x97) | (nxt == 0xB7)))
    lead |= ((data == 0xE2) & (nxt < 0xB0)) | ((data == 0xE3) & (nxt == 0x80)) | ((data == 0xF0) & (nxt == 0x9F))
    if lead.any():
        mask, tail = lead.copy(), (data & 0xC0) == 0x80
        step = lead
        for _ in range(3):
            step = np.append(False, step[:-1]) & tail
            mask |= step
        x[mask] = 0x20
    return x


_LETTER_CLASS = np.arange(256) != 0x20


def _codes(x: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(3-gram bucket, 4-gram bucket) centred on each letter byte and the first letter index of
    each word.  A gram sees a space beyond its word's ends."""
    n = len(x)
    word = np.repeat(np.arange(len(w.start)), w.end - w.start)
    first = np.concatenate(([0], np.cumsum(w.end - w.start)))[:-1]
    at = np.arange(len(word)) - np.repeat(first - w.start, w.end - w.start)
    start, end = w.start[word], w.end[word]
    space = np.uint64(0x20)
    c0 = x[at].astype(np.uint64)
    prev = np.where(at > start, x[np.maximum(at - 1, 0)], 0x20).astype(np.uint64)
    n1 = np.where(at + 1 < end, x[np.minimum(at + 1, n - 1)], 0x20).astype(np.uint64)
    n2 = np.where(at + 2 < end, x[np.minimum(at + 2, n - 1)], space).astype(np.uint64)
    tri = (prev << np.uint64(16)) | (c0 << np.uint64(8)) | n1
    quad = (tri << np.uint64(8)) | n2 | np.uint64(1 << 40)
    mul, top = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 15)
    return ((tri * mul) >> top).astype(np.int32), ((quad * mul) >> top).astype(np.int32) + BUCKETS, first


def word_scripts(data: np.ndarray, w: Words) -> np.ndarray:
    s, n = w.start, len(data)
    b = [data[np.minimum(s + i, n - 1)].astype(np.int64) if n else np.zeros(0, np.int64) for i in range(4)]
    cp = np.where(b[0] < 0x80, b[0], np.where(b[0] < 0xE0, (b[0] & 0x1F) << 6 | b[1] & 0x3F, np.where(
        b[0] < 0xF0, (b[0] & 0x0F) << 12 | (b[1] & 0x3F) << 6 | b[2] & 0x3F,
        (b[0] & 7) << 18 | (b[1] & 0x3F) << 12 | (b[2] & 0x3F) << 6 | b[3] & 0x3F)))
    return _SCRIPT_OF[np.searchsorted(_STARTS, cp, "right") - 1]


# ---------------------------------------------------------------- learning

def _count(batches):
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for part, data, off in chunks(batches):
        langs = part.column(part.schema.get_field_index("lang")).to_pylist()
        x = letters(data)
        w = Words(x, off, _LETTER_CLASS, with_hash=False)
        if not len(w.start):
            continue
        tri, quad, first = _codes(x, w)
        script = word_scripts(data, w)
        edge = np.append(first, len(tri))[w.first]
        names = sorted(set(langs))
        code = np.array([names.index(v) for v in langs])
        by_byte, by_word = np.repeat(code, np.diff(edge)), np.repeat(code, w.counts)
        for i, name in enumerate(names):
            own = by_byte == i
            grams[name] = grams.get(name, 0) + np.bincount(tri[own], minlength=2 * BUCKETS) + np.bincount(quad[own], minlength=2 * BUCKETS)
            scripts[name] = scripts.get(name, 0) + np.bincount(script[by_word == i], minlength=len(_NAMES))
    for name in grams:
        g = grams[name].astype(np.int64)
        for k in range(0, 2 * BUCKETS, BLOCK):
            if g[k:k + BLOCK].any():
                yield pa.RecordBatch.from_pydict({"lang": [name], "block": pa.array([k // BLOCK], pa.int32()),
                                                  "counts": [g[k:k + BLOCK].tobytes()]})
        yield pa.RecordBatch.from_pydict({"lang": [name], "block": pa.array([-1], pa.int32()),
                                          "counts": [scripts[name].astype(np.int64).tobytes()]})


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
    return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "block": pdf["block"].iloc[:1], "counts": [total.tobytes()]})


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray       # language x bucket, log frequencies
    candidate: np.ndarray    # script x language


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Learn from all rows of ``docs`` with a language and a letter in the text."""
    schema = "lang string, block int, counts binary"
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER))
    many = rows.select("lang").distinct().limit(max_languages + 1).count()
    if many > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn")
    got = rows.mapInArrow(_count, schema).groupBy("lang", "block").applyInPandas(_add, schema).collect()
    languages = sorted({r.lang for r in got})
    at = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(languages), 2 * BUCKETS))
    words = np.zeros((len(languages), len(_NAMES)))
    for r in got:
        values = np.frombuffer(r.counts, np.int64)
        if r.block < 0:
            words[at[r.lang]] = values
        else:
            counts[at[r.lang], r.block * BLOCK:r.block * BLOCK + len(values)] = values
    scores = np.zeros_like(counts, np.float32)
    for half in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        c = counts[:, half] + 0.5
        scores[:, half] = np.log(c / c.sum(axis=1, keepdims=True))
    share = words / np.maximum(words.sum(axis=1, keepdims=True), 1)
    return LanguageModel(languages, scores / 2, (share >= SCRIPT_SHARE).T.copy())


# ---------------------------------------------------------------- prediction

_OUT = -1e4


def word_scores(data: np.ndarray, off: np.ndarray, model: LanguageModel) -> tuple[Words, np.ndarray]:
    x = letters(data)
    w = Words(x, off, _LETTER_CLASS, with_hash=False)
    s = np.zeros((len(w.start), len(model.languages)), np.float32)
    if len(w.start):
        tri, quad, first = _codes(x, w)
        for i in range(len(model.languages)):
            s[:, i] = np.add.reduceat(model.scores[i][tri] + model.scores[i][quad], first)
        allowed = model.candidate[word_scripts(data, w)]
        some = allowed.any(axis=1)
        s[some[:, None] & ~allowed] = _OUT
        s[~some] = 0
    return w, s


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each word; row r owns words ``first[r]:first[r+1]``.  Rows go side by side,
    longest first, so the rows still running are always a prefix."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, length = first[:-1][order], counts[order]
    labels = np.zeros(len(scores), np.int16)
    steps = int(length[0]) if len(length) else 0
    if not steps:
        return labels
    running = len(length) - np.searchsorted(length[::-1], np.arange(1, steps + 1))
    stay, came = np.ones(scores.shape, bool), np.zeros(len(scores), np.int16)
    last = np.zeros(len(length), np.int16)
    best = scores[begin[:running[0]]].astype(np.float64)
    for t in range(1, steps):
        n = running[t]
        if n < len(best):
            last[n:len(best)] = best[n:].argmax(axis=1)
            best = best[:n]
        at = begin[:n] + t
        top = best.argmax(axis=1)
        switch = best.max(axis=1) - penalty
        keep = best >= switch[:, None]
        stay[at], came[at] = keep, top
        best = np.where(keep, best, switch[:, None]) - switch[:, None] + scores[at]
    last[:len(best)] = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        at = begin[:n] + t
        labels[at] = last[:n]
        if t:
            last[:n] = np.where(stay[at, last[:n]], last[:n], came[at])
    return labels


RESULT = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def _spans(w: Words, labels: np.ndarray, chars: np.ndarray, off: np.ndarray, row: int, names: list[str]) -> list[dict]:
    a, b = int(w.first[row]), int(w.first[row + 1])
    cut = np.flatnonzero(np.diff(labels[a:b])) + 1
    base = chars[off[row]]
    return [{"start": int(chars[w.start[a + i]] - base), "end": int(chars[w.end[a + j - 1]] - base), "lang": names[labels[a + i]]}
            for i, j in zip(np.append(0, cut), np.append(cut, b - a))] if b > a else []


def _predict(shared, penalty: float, with_spans: bool):
    def run(batches):
        model = shared.value
        names = model.languages
        for part, data, off in chunks(batches, limit=BATCH_BYTES):
            pieces = [_score_block(data, off, a, b, model) for a, b in _blocks(off)]
            first = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(f) for f, _, _ in pieces]))))
            scores = np.concatenate([s for _, s, _ in pieces])
            size = np.concatenate([z for _, _, z in pieces])
            labels = viterbi(scores, first, penalty)
            del scores
            row = np.repeat(np.arange(part.num_rows), np.diff(first))
            share = np.bincount(row * len(names) + labels, size, minlength=part.num_rows * len(names)).reshape(-1, len(names))
            known = part.column(part.schema.get_field_index("has")).to_numpy(zero_copy_only=False) & (share.sum(axis=1) > 0)
            best = share.argmax(axis=1)
            score = np.where(known, share.max(axis=1) / np.maximum(share.sum(axis=1), 1), 0.0)
            cols = [part.column(0), pa.array([names[i] if k else "und" for i, k in zip(best, known)]), pa.array(score)]
            if with_spans:
                w = Words(letters(data), off, _LETTER_CLASS, with_hash=False)
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                cols.append(pa.array([_spans(w, labels, chars, off, r, names) for r in range(part.num_rows)], _SPANS))
            else:
                cols.append(pa.nulls(part.num_rows, _SPANS))
            yield pa.RecordBatch.from_arrays(cols, [part.schema.field(0).name, "lang_pred", "score", "spans"])
    return run


def _blocks(off: np.ndarray, limit: int = 1 << 20):
    a, n = 0, len(off) - 1
    while a < n:
        b = min(max(int(np.searchsorted(off, off[a] + limit, "right")) - 1, a + 1), n)
        yield a, b
        a = b


def _score_block(data, off, a, b, model):
    w, s = word_scores(data[off[a]:off[b]], off[a:b + 1] - off[a], model)
    return w.first, s, (w.end - w.start).astype(np.int32)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             penalty: float = SWITCH_PENALTY, with_spans: bool = True) -> DataFrame:
    """One row per document row: id, ``lang_pred``, ``score`` (the share of its letters that the
    language holds) and ``spans`` (character ranges from the first to the last word of a run)."""
    rows = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text"),
                       F.coalesce(F.col(text_col).rlike(HAS_LETTER), F.lit(False)).alias("has"))
    if not model.languages:
        return rows.select(id_col, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.array().cast("array<struct<start:int,end:int,lang:string>>").alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_predict(shared, penalty, with_spans), f"`{id_col}` {kind}, {RESULT}")


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       penalty: float = SWITCH_PENALTY, with_spans: bool = False) -> DataFrame:
    """Learn from the rows that are not held out (and whose id is not NULL), label all rows."""
    model = fit(docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)), text_col, lang_col)
    out = identify(docs, model, id_col, text_col, penalty, with_spans)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "spans")
