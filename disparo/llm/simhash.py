"""SimHash near-duplicates: a self-join of the binary trie over 64-bit fingerprints.

*Fingerprint.*  Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; every ``k``-word shingle
(repeats count; fewer words are one shingle) gives an XXH64 of its space-joined UTF-8 bytes, seed
42; a bit is 1 where more than half of the hashes have it.  Two fingerprints link within
``errors`` differing bits.

*Trie join.*  Distinct fingerprints are sorted; a trie node is a range of the sorted array, its
children are the halves without and with the next bit.  Node pairs descend together, a pair of
unlike children adds one differing bit, and a pair above ``errors`` is pruned with both subtrees.
Small pairs are compared key by key.  The frontier is walked in pieces of ``FRONTIER`` node pairs,
so memory does not follow the number of near pairs.

*Dealing the trie.*  Within ``errors`` differences, one of ``errors + 1`` bit blocks is equal.  Each
fingerprint is rotated so that each block comes first once; in the trie of one rotation the
block's level pairs a node only with itself, and these subtrees are dealt to the tasks.  A subtree
above ``limit`` keys is never one group: its node pairs descend further on Spark, ``STEP`` bits a
round under the same budget, until a pair holds at most ``limit`` keys.

*Output size.*  A task reports a spanning star of what it links, at most one row a key, so a group
of near copies never becomes all its pairs; ``near_pairs`` gives the links themselves, each once,
in the first rotation whose block agrees.  Equal fingerprints are one key throughout.

Defined cases: NULL and empty texts have fingerprint zero, linked like any other; repeated rows
stay rows; NULL ids never name a component that has another id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disparo.llm.common import groups_for, stored
from disparo.llm.components import components

SHINGLE = 3
ERRORS = 2
SEED = 42
LIMIT = 200_000
STEP = 6
LEAF = 16
FRONTIER = 1 << 17
_PIECE = 1 << 15
U64 = np.uint64


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    many = max(len(words) - k + 1, 1)
    first = np.append(0, end[:many - 1] + 1).tolist()
    last = end[min(k, len(words)) - 1:].tolist()
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, many, _PIECE):
        n = min(_PIECE, many - at)
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first[at:at + n], last[at:at + n])), U64, n)
        total += np.unpackbits(h.byteswap().view(np.uint8)).reshape(n, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > many).tobytes(), "big")


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            fp = np.fromiter((fingerprint(texts[i].as_py(), k) for i in range(len(texts))), U64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(``id``, ``fp``: the 64 bits as a long) of every row."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_fingerprints(k), f"id {texts.schema[0].dataType.simpleString()}, fp long")


# ---------------------------------------------------------------- the trie join of a task

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_pairs(x: np.ndarray, y: np.ndarray | None, depth: int, errors: int,
               leaf: int = LEAF, frontier: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with ``popcount(x[i] ^ y[j]) <= errors`` whose first ``depth`` bits agree, of
    sorted distinct keys; without ``y`` the pairs i < j of x itself.  Comes in pieces."""
    own = y is None
    y = x if own else y
    ones: dict[tuple[int, int], np.ndarray] = {}

    def middle(side: int, keys: np.ndarray, level: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        got = ones.get((side, level))
        if got is None:
            got = ones[side, level] = np.append(0, np.cumsum((keys >> U64(63 - level)) & U64(1), dtype=np.int32))
        return hi - (got[hi] - got[lo])

    def ranges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        top = keys >> U64(64 - depth) if depth else np.zeros(len(keys), U64)
        cut = np.flatnonzero(np.append(True, top[1:] != top[:-1])) if len(keys) else np.zeros(0, np.int64)
        return top[cut], cut, np.append(cut[1:], len(keys)).astype(np.int64)[:len(cut)]

    ta, la, ha = ranges(x)
    if own:
        start = (la, ha, la, ha, np.zeros(len(la), np.int64))
    else:
        tb, lb, hb = ranges(y)
        _, i, j = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
        start = (la[i], ha[i], lb[j], hb[j], np.zeros(len(i), np.int64))
    stack = [(depth, start)]
    while stack:
        level, (al, ah, bl, bh, used) = stack.pop()
        same = (al == bl) & (ah == bh) if own else np.zeros(len(al), bool)
        size = (ah - al) * (bh - bl)
        live = ~(same & (ah - al < 2))
        small = live & (size <= leaf)
        if small.any():
            l1, n1, l2, n2 = al[small], (ah - al)[small], bl[small], (bh - bl)[small]
            many = n1 * n2
            row = np.repeat(np.arange(len(many)), many)
            at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            i, j = l1[row] + at // n2[row], l2[row] + at % n2[row]
            ok = _popcount(x[i] ^ y[j]) <= errors
            if own:
                ok &= i < j
            if ok.any():
                yield i[ok], j[ok]
        deep = live & ~small
        if level == 64 or not deep.any():
            continue
        al, ah, bl, bh, used, same = (v[deep] for v in (al, ah, bl, bh, used, same))
        am, bm = middle(0, x, level, al, ah), middle(0 if own else 1, y, level, bl, bh)
        kids = [np.concatenate(v) for v in (
            (al, am, al, am[~same]), (am, ah, am, ah[~same]), (bl, bm, bm, bl[~same]), (bm, bh, bh, bm[~same]),
            (used, used, used + 1, used[~same] + 1))]
        keep = (kids[1] > kids[0]) & (kids[3] > kids[2]) & (kids[4] <= errors)
        kids = [v[keep] for v in kids]
        for at in range(0, len(kids[0]), frontier):
            stack.append((level + 1, tuple(v[at:at + frontier] for v in kids)))


class Union:
    """Union-find over 0..n-1 by arrays of pairs; the root of a set is its least element."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            x = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root(a), self.root(b)
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return (x << U64(by)) | (x >> U64(64 - by)) if by else x


def _blocks(errors: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of the ``errors + 1`` blocks."""
    cut = [64 * i // (errors + 1) for i in range(errors + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _report(x: np.ndarray, y: np.ndarray | None, rot: int, depth: int, errors: int, links: bool) -> np.ndarray:
    """Rows (a, b) of two subtrees of one rotation: a spanning star, or with ``links`` each link that
    no earlier rotation sees."""
    first, out = _blocks(errors)[rot][0], []
    joint = x if y is None else np.concatenate((x, y))
    union, shift = Union(len(joint)), 0 if y is None else len(x)
    for i, j in trie_pairs(x, y, depth, errors):
        if not links:
            union.join(i, j + shift)
            continue
        a, b = (_rotate(v, -first) for v in (x[i], joint[j + shift]))
        fresh = np.ones(len(a), bool)
        for start, width in _blocks(errors)[:rot]:
            fresh &= ((a ^ b) << U64(start)) >> U64(64 - width) != 0
        out.append(np.stack((a[fresh], b[fresh])))
    if not links:
        root = union.root(np.arange(len(joint)))
        far = np.flatnonzero(root != np.arange(len(joint)))
        out.append(np.stack([_rotate(joint[v], -first) for v in (root[far], far)]))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), U64)


def _frame(rows: list[np.ndarray]) -> pd.DataFrame:
    got = np.concatenate(rows, axis=1) if rows else np.zeros((2, 0), U64)
    return pd.DataFrame({"a": got[0].view(np.int64), "b": got[1].view(np.int64)})


def _subtrees(errors: int, links: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rot, key = pdf["rot"].to_numpy(), pdf["key"].to_numpy().view(U64)
        return _frame([_report(np.sort(key[rot == r]), None, int(r), _blocks(errors)[r][1], errors, links) for r in np.unique(rot)])
    return run


def _node_pair(errors: int, links: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side, key = pdf["side"].to_numpy(), pdf["key"].to_numpy().view(U64)
        rot = int(pdf["rot"].iloc[0])
        x, y = np.sort(key[side == 0]), np.sort(key[side == 1])
        return _frame([_report(x, y if len(y) else None, rot, _blocks(errors)[rot][1], errors, links)])
    return run


# ---------------------------------------------------------------- dealing the trie

def _turned(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _prefix(errors: int, below: int) -> Column:
    """The trie node of ``key`` that lies ``below`` levels under its rotation's block."""
    node = F.lit(None).cast("long")
    for r, (_, width) in enumerate(_blocks(errors)):
        depth = min(width + below, 64)
        node = F.when(F.col("rot") == r, F.shiftrightunsigned("key", 64 - depth)).otherwise(node)
    return node


def _large_subtrees(members: DataFrame, errors: int, limit: int, links: bool) -> list[DataFrame]:
    """The join inside subtrees above ``limit`` keys: node pairs descend on Spark, ``STEP`` bits a
    round, until a pair holds at most ``limit`` keys."""
    members = stored(members, "simhash-large")
    pairs = members.select("rot", _prefix(errors, 0).alias("a")).distinct().withColumn("b", F.col("a"))
    below, out = 0, []
    while not pairs.isEmpty():
        kids = stored(members.groupBy("rot", _prefix(errors, below).alias("node"), _prefix(errors, below + STEP).alias("kid"))
                             .agg(F.count(F.lit(1)).alias("many")), "simhash-kids")
        below += STEP
        left = kids.select("rot", F.col("node").alias("a"), F.col("kid").alias("ka"), F.col("many").alias("na"))
        right = kids.select("rot", F.col("node").alias("b"), F.col("kid").alias("kb"), F.col("many").alias("nb"))
        down = (pairs.join(left, ["rot", "a"]).join(right, ["rot", "b"])
                     .where((F.col("a") != F.col("b")) | (F.col("ka") <= F.col("kb")))
                     .where(F.bit_count(F.col("ka").bitwiseXOR(F.col("kb"))) <= errors)
                     .where((F.col("ka") != F.col("kb")) | (F.col("na") > 1)))
        down = stored(down.select("rot", "ka", "kb", "na", "nb"), "simhash-pairs")
        whole = F.when(F.col("ka") == F.col("kb"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        done = down.where((whole <= limit) | F.lit(below >= 64)).select("rot", "ka", "kb")
        at = members.select("rot", "key", _prefix(errors, below).alias("kid"))
        sides = (at.join(done.withColumn("kid", F.col("ka")), ["rot", "kid"]).withColumn("side", F.lit(0)).unionByName(
            at.join(done.where("ka <> kb").withColumn("kid", F.col("kb")), ["rot", "kid"]).withColumn("side", F.lit(1))))
        out.append(sides.select("rot", "ka", "kb", "side", "key").groupBy("rot", "ka", "kb")
                        .applyInPandas(_node_pair(errors, links), "a long, b long"))
        pairs = down.where((whole > limit) & F.lit(below < 64)).select("rot", F.col("ka").alias("a"), F.col("kb").alias("b"))
    return out


def near_pairs(nodes: DataFrame, errors: int = ERRORS, limit: int = LIMIT, links: bool = True) -> DataFrame:
    """(``a``, ``b``) of the distinct fingerprints ``nodes.fp``: every link once, or without ``links``
    rows that connect what the links connect, at most one a key and rotation."""
    spark = nodes.sparkSession
    turns = F.array(*[F.struct(F.lit(r).alias("rot"), _turned(F.col("fp"), first).alias("key"))
                      for r, (first, _) in enumerate(_blocks(errors))])
    keys = nodes.select(F.inline(turns)).withColumn("top", _prefix(errors, 0))
    large = stored(keys.groupBy("rot", "top").count().where(F.col("count") > limit).select("rot", "top"), "simhash-crowds")
    parts = groups_for(spark, (errors + 1) * nodes.count(), 2_000, 2 * limit)
    rest = keys.join(large, ["rot", "top"], "left_anti") if not large.isEmpty() else keys
    found = [rest.withColumn("bucket", F.pmod(F.xxhash64("rot", "top"), F.lit(parts)).cast("int")).select("bucket", "rot", "key")
                 .groupBy("bucket").applyInPandas(_subtrees(errors, links), "a long, b long")]
    if not large.isEmpty():
        found += _large_subtrees(keys.join(large, ["rot", "top"], "left_semi").select("rot", "key"), errors, limit, links)
    both = found[0]
    for f in found[1:]:
        both = both.unionByName(f)
    return both


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                       errors: int = ERRORS, limit: int = LIMIT) -> DataFrame:
    """One row per document row: id, ``fingerprint`` (16 hex digits), ``component_id`` (the least id
    reachable by links)."""
    rows = stored(fingerprints(docs, id_col, text_col, k), "simhash-rows")
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    labels = components(near_pairs(nodes, errors, limit, links=False))
    named = stored(nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                        .withColumn("label", F.coalesce("label", "fp")), "simhash-named")
    best = named.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = stored(named.join(best, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(ids, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
