"""Phrase collocations by Toivonen's sampling method, exact.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words
``[^\\x20\\x09]+``; everything is counted per language (NULL: ``und``).

*Sample.*  A sample of documents (``share`` of the rows, at most about ``sample_rows``) proposes the
words and phrases that reach a lowered threshold in it.  The sample only saves work: it decides
what is counted in which pass, never what is counted at all.

*Full pass.*  All documents are scanned; counted are the proposed phrases and their negative border,
which are the phrases whose shorter parts are all proposed: every word, and every longer phrase
both of whose one-word-shorter parts are proposed.

*Border failures.*  Where a border phrase proves frequent, longer phrases built on it are unknown;
the next pass takes the frequent phrases as proposals and counts what no earlier pass has counted,
until a pass brings no new frequent part.  Frequent phrases have frequent parts, so then all are
known.  At most ``max_words`` full passes run; the last of that number is one with the scan by text.

*Counting.*  The passes count by phrase hash, packed five bytes an occurrence of a slice: a border is
mostly rare phrases, and as text it would be several times the corpus.  Two phrases on one hash
only raise a count.  One last scan counts the phrases that reached ``min_count`` again by their text:
words are told apart by their bytes and phrases by numbers of their parts, so no result rests on a
hash.  Proposals travel as bit arrays of at most ``2 ** FILTER_BITS`` bits (16 MB) each, by a broadcast
whose size does not follow the corpus; two phrases on one bit only cause one to be counted that
need not be.

Scale: a scan slice holds ``SLICE_BYTES`` of text (a longer text is cut where a piece ends),
counts are summed inside it, a hot phrase is one entry a slice, and hash buckets hold about
``BUCKET_BYTES``. A worker's arrays are many times its slice, so
the slice and ``_FLUSH`` set its memory.  The report's ranking takes the first ``top`` in salted groups before it takes
them in a language.

Defined cases: NULL and empty texts have no words; repeated rows count each time; a language
whose texts have no candidate has no rows; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disparo.llm.bits import bit_array, bit_words, has
from disparo.llm.common import shuffle_partitions, stored
from disparo.llm.textscan import Words, lower_table, mix, ragged, text_buffers

MAX_WORDS = 3
MIN_COUNT = 10
WITHIN_PERCENT = 50
TOP = 2000
SHARE = 0.25
SAMPLE_ROWS = 1_000_000
FILTER_BITS = 27
SLICE_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
SALTS = 64
NO_LANG = "und"
U64 = np.uint64
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
HASHED = "k int, bucket int, payload binary"
COUNTED = "lang string, phrase string, k int, n long"
_FLUSH = 1 << 20


def word_class() -> np.ndarray:
    t = np.ones(256, bool)
    t[[0x20, 0x09, *SEPARATORS]] = False
    return t


def separator_class() -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(SEPARATORS)] = True
    return t


# ---------------------------------------------------------------- slices of text

def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, row) of about ``limit`` bytes each; a longer text is cut behind separators."""
    data, off = text_buffers(batch.column(1))
    row = np.arange(batch.num_rows)
    long = np.flatnonzero(np.diff(off) > limit)
    if len(long):
        sep, more = separator_class(), []
        for r in long.tolist():
            ends = off[r] + 1 + np.flatnonzero(sep[data[off[r]:off[r + 1]]])
            at = off[r] + limit
            while at < off[r + 1]:
                i = np.searchsorted(ends, at)
                if i == len(ends) or ends[i] >= off[r + 1]:
                    break
                more.append((ends[i], r))
                at = ends[i] + limit
        if more:
            extra = np.array(more, np.int64)
            starts = np.concatenate((off[:-1], extra[:, 0]))
            owner = np.concatenate((row, extra[:, 1]))
            order = np.lexsort((starts, owner))
            off, row = np.append(starts[order], off[-1]), owner[order]
    at = 0
    while at < len(row):
        end = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(row))
        yield data[off[at]:off[end]], off[at:end + 1] - off[at], row[at:end]
        at = end


# ---------------------------------------------------------------- counting in a slice

def _same_bytes(w: Words, lang: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether word a[i] equals word b[i], language included, for all i."""
    size = w.end - w.start
    if (size[a] != size[b]).any() or (lang[a] != lang[b]).any():
        return False
    return bool((w.data[ragged(w.start[a], size[a])] == w.data[ragged(w.start[b], size[b])]).all())


def _word_numbers(w: Words, lang: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word, a place of each number, hash of each number); equal numbers are equal
    words of one language."""
    key = mix(w.hash ^ salt[lang])
    hashes, place, number = np.unique(key, return_index=True, return_inverse=True)
    if _same_bytes(w, lang, np.arange(len(key)), place[number]):
        return number, place, hashes
    seen: dict[tuple, int] = {}  # two words on one hash: number by bytes
    number = np.array([seen.setdefault((int(c), w.data[a:b].tobytes()), len(seen)) for a, b, c in zip(w.start, w.end, lang)])
    _, place = np.unique(number, return_index=True)
    return number, place, key[place]


def _texts(w: Words, place: np.ndarray, k: int) -> pa.Array:
    """The ``k`` words from each place on, joined by one space."""
    size = w.end - w.start
    word = (place[:, None] + np.arange(k)).ravel()
    total = (size[word] + 1).reshape(-1, k).sum(axis=1) - 1
    off = np.append(0, np.cumsum(total)).astype(np.int32)
    out = np.full(int(off[-1]), 0x20, np.uint8)
    before = np.cumsum((size[word] + 1).reshape(-1, k), axis=1) - (size[word] + 1).reshape(-1, k)
    to = (off[:-1, None] + before).ravel().astype(np.int64)
    out[ragged(to, size[word])] = w.data[ragged(w.start[word], size[word])]
    return pa.Array.from_buffers(pa.string(), len(place), [None, pa.py_buffer(off), pa.py_buffer(out)])


def split_hash(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 40 bits inside it) of a phrase hash."""
    return ((h & U64(0xFFFFFF)) * U64(buckets) >> U64(24)).astype(np.int64), h >> U64(24)


def folded(bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
    """What the bit arrays go by: a phrase hash as far as the packed counts tell it."""
    return mix(key ^ (bucket.astype(U64) << U64(40)))


def grams(data: np.ndarray, off: np.ndarray, lang: np.ndarray, salt: np.ndarray, max_words: int):
    """Yields (words, k, starts, numbers, parts, places, hashes) for k = 1, 2, ...: the words where k-word
    phrases start, the number of each such phrase in this slice, the numbers of its two one-word-shorter
    parts (None for words), and a place and the hash of each number.  Equal numbers are equal texts."""
    low = lower_table()[data]
    w = Words(low, off, word_class())
    if not len(w.start):
        return
    rows = w.rows()
    number, place, hashes = _word_numbers(w, lang[rows], salt)
    yield w, 1, np.arange(len(number)), number, None, place, hashes
    cut = np.append(0, np.cumsum(separator_class()[low], dtype=np.int64))[w.start]
    joined = np.append((cut[1:] == cut[:-1]) & (rows[1:] == rows[:-1]), False)  # word i and i + 1 share a piece
    starts, gram, gram_hash = np.arange(len(number)), number, hashes
    at = np.full(len(number) + 1, -1, np.int64)
    for k in range(2, max_words + 1):
        at[:] = -1
        at[starts] = gram
        starts = starts[joined[np.minimum(starts + k - 2, len(number) - 1)]]
        starts = starts[at[starts + 1] >= 0]
        if not len(starts):
            return
        parts = at[starts], at[starts + 1]
        last = number[starts + k - 1]
        keys, first, gram = np.unique(parts[0] * np.int64(len(hashes)) + last, return_index=True, return_inverse=True)
        gram_hash = mix(gram_hash[parts[0][first]] * U64(0x9FB21C651E98DF25) + hashes[last[first]])
        yield w, k, starts, gram, parts, starts[first], gram_hash


def _salts(names: list[str]) -> np.ndarray:
    return mix(np.array([int.from_bytes(n.encode()[:8].ljust(8, b"\0"), "big") ^ len(n) for n in names], U64) + U64(1))


def _language_slices(batches):
    """(names of the batch's languages, their salts, bytes, offsets, language of each row) of each slice."""
    for batch in batches:
        codes = batch.column(0).fill_null(NO_LANG).dictionary_encode()
        salt = _salts(codes.dictionary.to_pylist())
        lang = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for data, off, row in slices(batch):
            yield codes.dictionary, salt, data, off, lang[row]


# ---------------------------------------------------------------- counting by hash

def _packed(k: int, h: np.ndarray, n: np.ndarray, buckets: int):
    """Rows of (k, bucket, payload): keys seen once (five bytes), then keys with counts."""
    bucket, key = split_hash(h, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, key, n = bucket[order], key[order], n[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    low, high = (key & U64(0xFFFFFFFF)).astype(np.uint32), (key >> U64(32)).astype(np.uint8)
    names, payload = [], []
    for a, b in zip(cut, np.append(cut[1:], len(order))):
        once = n[a:b] == 1
        more = n[a:b][~once]
        head = np.array([once.sum(), len(more)], np.uint32).tobytes()
        names.append(int(bucket[a]))
        payload.append(head + low[a:b][once].tobytes() + high[a:b][once].tobytes()
                       + low[a:b][~once].tobytes() + high[a:b][~once].tobytes() + more.astype(np.uint32).tobytes())
    for a in range(0, len(names), 256):
        m = len(names[a:a + 256])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, k, np.int32)), pa.array(names[a:a + m], pa.int32()),
                                          pa.array(payload[a:a + m], pa.binary())], ["k", "bucket", "payload"])


def _unpacked(payloads) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for p in payloads:
        one, more = np.frombuffer(p, np.uint32, 2).tolist()
        at = 8
        for m, many in ((one, False), (more, True)):
            low = np.frombuffer(p, np.uint32, m, at).astype(U64)
            high = np.frombuffer(p, np.uint8, m, at + 4 * m).astype(U64)
            at += 5 * m
            keys.append(low | (high << U64(32)))
            counts.append(np.frombuffer(p, np.uint32, m, at).astype(np.int64) if many else np.ones(m, np.int64))
            at += 4 * m if many else 0
    return np.concatenate(keys), np.concatenate(counts)


def _fresh(known: list[np.ndarray], parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which phrases the last pass counts and no earlier one: both parts are proposed now, not before."""
    left, right = parts
    wanted = known[-1][left] & known[-1][right]
    for old in known[:-1]:
        wanted &= ~(old[left] & old[right])
    return wanted


def _scan(max_words: int, shared, buckets: int):
    """Counts by hash what this pass counts.  ``shared`` holds the proposals of the passes so far (by phrase
    length), this one's last; None counts every phrase (the sample)."""
    def run(batches):
        passes = shared.value if shared is not None else None
        held, many = {}, 0
        for _, salt, data, off, lang in _language_slices(batches):
            known = []
            for _, k, _, gram, parts, _, h in grams(data, off, lang, salt, max_words):
                if k == 1:
                    count = np.bincount(gram) if passes is None or len(passes) == 1 else None
                elif passes is None:
                    count = np.bincount(gram)
                else:
                    count = np.bincount(gram[_fresh(known, parts)], minlength=len(h))
                if passes is not None and k < max_words:
                    f = folded(*split_hash(h, buckets))
                    known = [has(p[k], f) for p in passes]
                if count is not None:
                    some = np.flatnonzero(count)
                    held.setdefault(k, []).append((h[some], count[some]))
                    many += len(some)
            if many >= _FLUSH:
                yield from _flushed(held, buckets)
                held, many = {}, 0
        yield from _flushed(held, buckets)
    return run


def _flushed(held: dict, buckets: int):
    for k, parts in held.items():
        yield from _packed(k, *(np.concatenate(x) for x in zip(*parts)), buckets)


def _sums(least: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _unpacked(pdf["payload"])
        order = np.argsort(keys)
        keys = keys[order]
        cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        total = np.add.reduceat(counts[order], cut) if len(cut) else np.zeros(0, np.int64)
        keep = total >= least
        key, bucket = keys[cut][keep], np.full(int(keep.sum()), pdf["bucket"].iloc[0], np.int64)
        return pd.DataFrame({"k": np.full(len(key), pdf["k"].iloc[0], np.int32), "h": folded(bucket, key).view(np.int64)})
    return run


def _frequent_hashes(texts: DataFrame, max_words: int, least: int, shared, buckets: int, name: str) -> DataFrame:
    """(``k``, ``h``): folded hashes whose phrases this pass counts and that reach ``least`` together."""
    rows = texts.mapInArrow(_scan(max_words, shared, buckets), HASHED)
    return stored(rows.groupBy("k", "bucket").applyInPandas(_sums(least), "k int, h long"), name)


# ---------------------------------------------------------------- counting by text

def _exact(max_words: int, shared, buckets: int):
    """Counts by text the phrases whose hashes are in the bits of ``shared`` and, if it has passes, those of the
    last of them; ``k = 0`` rows hold a language's words."""
    def run(batches):
        bits, passes = shared.value
        for names, salt, data, off, lang in _language_slices(batches):
            known = []
            for w, k, _, gram, parts, place, h in grams(data, off, lang, salt, max_words):
                of_word = lang[w.rows()]
                if k == 1:
                    total = np.bincount(of_word, minlength=len(names))
                    some = np.flatnonzero(total)
                    yield _count_batch(names.take(pa.array(some)), pa.array([""] * len(some)), 0, total[some])
                f = folded(*split_hash(h, buckets))
                hit = has(bits[k], f)
                if passes and k > 1:
                    hit[gram[_fresh(known, parts)]] = True
                if passes and k < max_words:
                    known = [has(p[k], f) for p in passes]
                hit = np.flatnonzero(hit)
                count = np.bincount(gram, minlength=len(h))[hit]
                for a in range(0, len(hit), 1 << 16):
                    p = place[hit[a:a + (1 << 16)]]
                    yield _count_batch(names.take(pa.array(of_word[p])), _texts(w, p, k), k, count[a:a + (1 << 16)])
    return run


def _count_batch(lang, phrase, k: int, n: np.ndarray):
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(n), k, np.int32)), pa.array(n.astype(np.int64))],
                                      ["lang", "phrase", "k", "n"])


# ---------------------------------------------------------------- proposals

def _bits(hashes: DataFrame, members: int) -> np.ndarray:
    return bit_array(hashes, members, FILTER_BITS)


def _proposals(known: DataFrame, max_words: int) -> dict[int, np.ndarray]:
    many = dict(known.groupBy("k").count().collect())
    return {k: _bits(known.where(F.col("k") == k), many.get(k, 0)) for k in range(1, max_words + 1)}


def _missed(proposed: np.ndarray, known: DataFrame) -> bool:
    """Whether a known hash was not proposed."""
    at, bits = bit_words(known, 64 * len(proposed))
    return bool((bits & ~proposed[at]).any())


# ---------------------------------------------------------------- mining

def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT, share: float = SHARE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(``lang``, ``phrase``, ``k``, ``n``), stored: every phrase of up to ``max_words`` words that occurs
    ``min_count`` times, exactly counted; rows with ``k = 0`` hold the number of words of a language."""
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    total, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET_BYTES))
    fraction = min(1.0, share, sample_rows / max(1, total))
    found = _frequent_hashes(texts.sample(False, fraction, 67), max_words - 1, max(2, int(0.8 * min_count * fraction)), None,
                             buckets, "phrases-sample")
    passes, known, last = [_proposals(found, max_words)], [], None
    while last is None:
        shared = spark.sparkContext.broadcast(passes)
        known.append(_frequent_hashes(texts, max_words, min_count, shared, buckets, f"phrases-{len(passes)}"))
        every = reduce(DataFrame.unionByName, known)
        proposals = _proposals(every, max_words)
        if not any(_missed(passes[-1][k], every.where(F.col("k") == k)) for k in range(1, max_words)):
            last = (proposals, None)
        elif len(passes) + 1 == max_words:
            # Only the longest phrases can still be new; the scan by text counts them with the rest.
            last = (proposals, [*passes, proposals])
        else:
            passes.append(proposals)
    shared = spark.sparkContext.broadcast(last)
    rows = texts.mapInArrow(_exact(max_words, shared, buckets), COUNTED)
    return stored(rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
                      .where((F.col("n") >= min_count) | (F.col("k") == 0)), "phrases")


# ---------------------------------------------------------------- scores and report

def _part(first, length):
    return F.array_join(F.slice("words", first, length), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, within_percent: int = WITHIN_PERCENT, **kw) -> DataFrame:
    """(``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``): phrases of 2 to ``max_words`` words with the counts
    of the lowest-scoring cut, without those that a longer candidate explains."""
    every = frequent_phrases(docs, text_col, lang_col, max_words, min_count, **kw)
    counts = every.where("k > 0").select("lang", "phrase", "n")
    long = every.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = long.select("lang", "phrase", "a", "k", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(1, F.col("cut")).alias("head"),
                       _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
                .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]))
    wide = "decimal(38,0)"
    a = F.col("a").cast("decimal(15,0)")
    top = (F.lit(1_000_000).cast("decimal(7,0)") * a * a).cast(wide)
    low = (F.col("l").cast("decimal(15,0)") * F.col("r").cast("decimal(15,0)")).cast(wide)
    cuts = cuts.withColumns({"top": top, "low": low}).withColumn("score", F.expr("cast(top div low as bigint)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    inner = long.where("k > 2").select("lang", F.col("a").alias("longer"), "k", "words")
    inner = inner.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, k - size + 1)")))
    inner = inner.groupBy("lang", _part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("longer").alias("longer"))
    left = best.join(inner, ["lang", "phrase"], "left")
    left = left.where(F.col("longer").isNull() | (100 * F.col("longer") < within_percent * F.col("a")))
    words = every.where("k = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return left.join(words, "lang").select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")


def collocation_report(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, **kw) -> DataFrame:
    """Each language's first ``top`` by score, then count (both descending), then phrase: ``lang``, ``rank``,
    ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    scored = collocations(docs, text_col, lang_col, **kw)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
