"""Token counts through a digest cache.

Counts are stored under (tokenizer version digest, content digest).  A run looks the digests of
its texts up, encodes only the distinct texts that are missing, appends them to the cache, and
joins the counts back.  Content is taken as it is (any normalisation would change counts); NULL
counts as empty.  The version digest covers the tokenizer file's bytes, so another vocabulary
never reads these counts.

Counts are those of the ``tokenizers`` library for the given file, without added specials.  Where
a rank file of the same vocabulary is given, texts whose characters all lie below U+0240 and
that hold no special string go through ``tiktoken``, which splits and merges such texts alike
at several times the speed (tests compare the two); all others go through the library.

Scale: texts are shuffled once, after a map-side ``distinct`` (a text in a million copies is one
row per map task); known digests filter before that shuffle while they fit a broadcast.  The
join back moves only digests and is split where one text is hot.

Defined cases: NULL and empty text have 0 tokens; repeated rows each get a row; an empty table
gives an empty result; other columns are ignored; entries that two writers appended twice
count once.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.llm.common import text_or_empty
from disparo.llm.textscan import text_buffers
from disparo.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
MAX_BROADCAST_DIGESTS = 500_000
CACHE_SCHEMA = "digest binary, n_tokens long"
#: UTF-8 lead byte of U+0240: below it both libraries class characters alike.
_PLAIN_BELOW = 0xC9
_encoders: dict = {}


def tokenizer_path(name: str) -> str:
    """A path as it is; a bare name through the installed vocabulary package."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def version_digest(tokenizer: str) -> str:
    with open(tokenizer_path(tokenizer), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:16]


class Counter:
    """Token counts of texts for one tokenizer file."""

    def __init__(self, tokenizer: str, ranks: str | None):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_path(tokenizer)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens") or []]
        self.fast = None
        if ranks:
            with open(tokenizer_path(ranks), "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def count(self, texts: list[str], plain: np.ndarray) -> list[int]:
        out, rest = [0] * len(texts), []
        for i, text in enumerate(texts):
            if self.fast is not None and plain[i] and not any(s in text for s in self.special):
                out[i] = len(self.fast.encode_ordinary(text))
            else:
                rest.append(i)
        for a in range(0, len(rest), 64):
            some = rest[a:a + 64]
            for i, e in zip(some, self.library.encode_batch([texts[i] for i in some], add_special_tokens=False)):
                out[i] = len(e.ids)
        return out


def _counter(tokenizer: str, ranks: str | None) -> Counter:
    key = (tokenizer, ranks)
    if key not in _encoders:
        _encoders[key] = Counter(tokenizer, ranks)
    return _encoders[key]


def plain_rows(col: pa.Array) -> np.ndarray:
    """Rows whose characters all lie below U+0240."""
    data, off = text_buffers(col)
    odd = np.concatenate(([0], np.cumsum(data >= _PLAIN_BELOW)))
    return odd[off[1:]] == odd[off[:-1]]


def _encode(tokenizer: str, ranks: str | None, rows: int = 256):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                texts = part.column(0).to_pylist()
                n = _counter(tokenizer, ranks).count(texts, plain_rows(part.column(0)))
                digests = [hashlib.sha256(t.encode()).digest() for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(n, pa.int64())], ["digest", "n_tokens"])
    return run


class DigestCache:
    """Stored counts of one tokenizer version in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, version: str):
        self.spark, self.path = spark, f"{path}/tokenizer={version}"

    def read(self) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return self.spark.createDataFrame([], CACHE_SCHEMA)
        return self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)

    def append(self, counts: DataFrame) -> None:
        counts.write.mode("append").parquet(self.path)


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def token_counts(docs: DataFrame, cache_path: str | None = None, tokenizer: str = TOKENIZER, ranks: str | None = RANKS,
                 id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per document row: id, ``n_bytes``, ``n_tokens``, ``over_limit``.  Missing counts
    are appended to the cache at ``cache_path`` first (an eager step)."""
    spark = docs.sparkSession
    cache = DigestCache(spark, cache_path or scratch_path(spark, "token-cache"), version_digest(tokenizer))
    text = text_or_empty(text_col)
    known, texts = cache.read(), docs.select(text.alias("text"))
    n_known = known.count()
    if not n_known:
        misses = texts.distinct()
    elif n_known <= MAX_BROADCAST_DIGESTS:
        misses = texts.join(F.broadcast(known), _digest(F.col("text")) == known["digest"], "left_anti").distinct()
    else:
        misses = texts.distinct().join(known, _digest(F.col("text")) == known["digest"], "left_anti")
    cache.append(misses.mapInArrow(_encode(tokenizer, ranks), CACHE_SCHEMA))
    counts = cache.read().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    keyed = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), _digest(text).alias("digest"))
    return keyed.join(counts, "digest", "left").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
