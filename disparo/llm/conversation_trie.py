"""Prefix trie of conversations: savings of shared prefixes, from balanced parentheses.

A conversation is a sequence of turns (role, text); every distinct sequence of its first d turns is
a node of depth d, from the root at depth 0.  A turn is known by the first 128 bits of a SHA-256
over role and text, a node by a 128-bit running sum of its turns' hashes with their positions.

*Paths.*  Equal conversations become one path with a count.  A path is kept up to its first node
that no other path has; the chain below such a node is plain (one leaf, no further sharing) and is
reported from running byte sums, so a very long conversation does not become a long row.

*Shards.*  Paths are sorted by their turns' digests and cut into ranges of about ``SHARD_PATHS``.  A shard writes its trie
as balanced parentheses (one pair a node, in preorder).  ``findclose`` over a range min-max tree of
excess blocks delimits a node's subtree; the rank of ``()`` pairs counts its leaves; cumulative
arrays over preorder give its members and its savings.

*Shared spines.*  A node that several shards hold lies on the paths at the shards' borders.  A shard
knows its neighbours' border paths: of a node shared with the shard before, it adds members but
not the node's own first copy, and a path that the next shard goes on with is no leaf.  So the
parts add up, and spine nodes (at most two paths a shard) are merged by one sum.

*Long conversations.*  Turns are numbered and summed in slices of a range partitioning over
(conversation, turn), with offsets a slice, so a conversation with a third of all turns is no single
task.  A row of the shard table holds 32 characters for each turn that a path shares with
another.  The digest over the conversations that end at a node is a stream over their sorted ids,
in one task a node and in constant memory (SHA-256 cannot be merged).

Defined cases: NULL role or text is empty; a NULL turn comes first; rows of one turn number are
ordered by role, then by turn digest, and each counts as a turn; rows without ``conv_id`` belong to
no conversation; a conversation without turns ends at the root; an empty table has no nodes;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disparo.llm.common import shuffle_partitions, stored

BLOCK = 256
SHARD_PATHS = 50_000
DIGEST = 32
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_BIG = np.int32(1 << 30)
_LOW = 0xFFFFFFFF


# ---------------------------------------------------------------- balanced parentheses

class Parens:
    """A balanced parenthesis sequence with range min-max blocks over its excess."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits, block
        self.excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int32)
        blocks = max(1, -(-len(bits) // block))
        padded = np.full(blocks * block, _BIG, np.int32)
        padded[:len(bits)] = self.excess
        self.rows = padded.reshape(blocks, block)
        levels = [self.rows.min(axis=1)]
        while len(levels[-1]) > 1:
            low = np.append(levels[-1], np.full(len(levels[-1]) % 2, _BIG, np.int32))
            levels.append(low.reshape(-1, 2).min(axis=1))
        # One spare entry a level: a search may look one past the last block.
        self.first = np.cumsum([0] + [len(v) + 2 for v in levels])
        self.tree = np.concatenate([np.concatenate((v, [_BIG, _BIG])) for v in levels]).astype(np.int32)
        self.height = len(levels) - 1
        pair = np.zeros(len(bits) + 1, np.int64)
        pair[1:-1] = np.cumsum(bits[:-1] & ~bits[1:])
        pair[-1] = pair[-2] if len(bits) > 1 else 0
        self.pairs = pair

    def leaf_rank(self, at: np.ndarray) -> np.ndarray:
        """Number of ``()`` pairs that open before position ``at``."""
        return self.pairs[at]

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First column above ``after`` of each block with excess <= target, or -1."""
        out = np.empty(len(block), np.int64)
        columns = np.arange(self.block)
        for a in range(0, len(block), 4096):
            z = slice(a, a + 4096)
            hit = (self.rows[block[z]] <= target[z, None]) & (columns > after[z, None])
            out[z] = np.where(hit.any(axis=1), hit.argmax(axis=1), -1)
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each of ``opens``."""
        target = self.excess[opens] - 1
        block = opens // self.block
        column = self._in_block(block, opens % self.block, target)
        close = block * self.block + column
        rest = np.flatnonzero(column < 0)
        if not len(rest):
            return close
        target, level = target[rest], np.zeros(len(rest), np.int64)
        at = block[rest] + 1
        climbing = np.ones(len(rest), bool)
        while climbing.any():  # up and to the right until a node holds the target
            i = np.flatnonzero(climbing)
            found = self.tree[self.first[level[i]] + at[i]] <= target[i]
            climbing[i[found]] = False
            i = i[~found]
            at[i] += 1
            up = i[(at[i] % 2 == 0) & (level[i] < self.height)]
            level[up] += 1
            at[up] //= 2
        while level.any():  # down to the leftmost such block
            i = np.flatnonzero(level)
            level[i] -= 1
            at[i] *= 2
            at[i] += self.tree[self.first[level[i]] + at[i]] > target[i]
        close[rest] = at * self.block + self._in_block(at, np.full(len(at), -1), target)
        return close


def shared_turns(a: str, b: str) -> int:
    """Leading digests that two keys share."""
    n, most = 0, min(len(a), len(b))
    while n < most and a[n:n + DIGEST] == b[n:n + DIGEST]:
        n += DIGEST
    return n // DIGEST


# ---------------------------------------------------------------- a shard

NODE_SCHEMA = ("spine string, parent_spine string, conv_id long, depth long, parent_conv_id long, n_convs long, "
               "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def _spine_name(key: str, depth: int) -> str:
    return f"{depth}:{hashlib.sha256(key[:depth * DIGEST].encode()).hexdigest()}"


def shard_nodes(pdf: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one shard's trie; ``spine`` names those that other shards hold too, with this
    shard's part of their numbers."""
    pdf = pdf.sort_values("key", kind="stable")
    keys = pdf["key"].tolist()
    before, after = pdf["before"].iloc[0], pdf["after"].iloc[0]
    before = before if isinstance(before, str) else None
    after = after if isinstance(after, str) else None
    many, rep = pdf["m"].to_numpy(np.int64), pdf["rep"].to_numpy(np.int64)
    length = np.array([len(k) // DIGEST for k in keys], np.int64)
    common = np.array([0] + [shared_turns(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    seen = shared_turns(before, keys[0]) if before is not None else -1
    coming = shared_turns(keys[-1], after) if after is not None else -1

    opened = length - common
    closed = np.append(0, length[:-1] - common[1:])
    runs = np.stack((closed, opened), axis=1).ravel()
    bits = np.repeat(np.tile([False, True], len(keys)), runs)
    bits = np.concatenate(([True], bits, np.zeros(int(length[-1]) + 1, bool)))
    tree = Parens(bits)
    opens = np.flatnonzero(bits)
    closes = tree.findclose(opens)
    nodes = len(opens)
    size = (closes - opens + 1) // 2
    depth = tree.excess[opens].astype(np.int64) - 1
    owner = np.append(0, np.repeat(np.arange(len(keys)), opened))  # the path that opens a node
    end_node = np.cumsum(opened)  # preorder number of each path's last node

    sizes = [np.asarray(s, np.int64) for s in pdf["sizes"]]
    weight = np.concatenate([np.zeros(1, np.int64)] + [s[c:] for s, c in zip(sizes, common)])
    ended = np.zeros(nodes + 1, np.int64)
    np.add.at(ended, end_node + 1, many)
    members = np.cumsum(ended)
    n = members[np.arange(nodes) + size] - members[:nodes]
    known = (owner == 0) & (depth <= seen)  # first met in an earlier shard
    tail = pdf["tail_bytes"].to_numpy(np.int64)
    has_tail = pdf["has_tail"].to_numpy(bool)
    own = n * weight - np.where(known, 0, weight)
    np.add.at(own, end_node, (many - 1) * tail)
    total = np.append(0, np.cumsum(own))
    saved = total[np.arange(nodes) + size] - total[:nodes]
    leaves = tree.leaf_rank(closes) - tree.leaf_rank(opens)
    if coming == length[-1]:  # the next shard goes on where the last path ends
        leaves -= (opens <= opens[end_node[-1]]) & (closes >= closes[end_node[-1]])

    parent = np.full(nodes, -1, np.int64)
    last = np.zeros(int(depth.max()) + 2, np.int64)
    for i, d in enumerate(depth.tolist()):
        last[d] = i
        if d:
            parent[i] = last[d - 1]
    children = np.bincount(parent[(parent >= 0) & ~known], minlength=nodes)
    np.add.at(children, end_node, has_tail)
    to = np.searchsorted(end_node, np.arange(nodes) + size)  # the paths below a node are owner .. to
    reach = np.append(rep, np.iinfo(np.int64).max)
    least = np.minimum.reduceat(reach, np.stack((owner, to), axis=1).ravel())[::2]
    sha = np.full(nodes, None, object)
    ends = pdf["sha"].tolist()
    for i, node in enumerate(end_node.tolist()):
        if not has_tail[i]:
            sha[node] = ends[i]
    spine = np.full(nodes, None, object)
    for i in np.flatnonzero(known).tolist():
        spine[i] = _spine_name(keys[0], int(depth[i]))
    for i in np.flatnonzero((owner <= len(keys) - 1) & (np.arange(nodes) + size > end_node[-1]) & (depth <= coming)).tolist():
        spine[i] = _spine_name(keys[-1], int(depth[i]))
    up, root = np.maximum(parent, 0), parent < 0
    return pd.DataFrame({
        "spine": spine, "parent_spine": np.where(root, None, spine[up]), "conv_id": least, "depth": depth,
        "parent_conv_id": pd.Series(least[up], dtype="Int64").mask(root),
        "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": sha})


# ---------------------------------------------------------------- paths from turns

def _numbered(batches):
    """Rows sorted by conversation with their place in it within this slice, and the slice."""
    slice_id, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        cut = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        at = np.arange(len(conv)) - np.repeat(cut, np.diff(np.append(cut, len(conv))))
        if conv[0] == last:
            at[:cut[1] if len(cut) > 1 else len(conv)] += seen
        last, seen = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(at),
                                          pa.array(np.full(len(conv), slice_id, np.int32))], ["conv", "d", "bytes", "at", "slice"])


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(``conv``, ``at``: place of the turn from 0, ``d``: digest, ``bytes`` of the text, ``slice``), stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST).alias("d"),
        F.octet_length(text).cast("long").alias("bytes"), F.col(turn_col).alias("turn"), role.alias("role"))
    order = ["conv", "turn", "role", "d"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = stored(rows.mapInArrow(_numbered, "conv long, d string, bytes long, at long, slice int"), "trie-turns")
    # Only a conversation cut by a slice border needs offsets: fewer such rows than slices.
    across = local.groupBy("conv").agg(F.min("slice").alias("lo"), F.max("slice").alias("hi")).where("lo < hi").select("conv")
    part = local.join(across, "conv", "left_semi").groupBy("conv", "slice").agg(F.count(F.lit(1)).alias("many"))
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offset = part.select("conv", "slice", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("offset"))
    return stored(local.join(offset, ["conv", "slice"], "left").select(
        "conv", "d", "bytes", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("at"), "slice"), "trie-numbered")


def rebuilt(numbered: DataFrame, every: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first h turns taken from conversation ``c - c % every`` (h = crc32 of the
    decimal id modulo ``heads``): rows (``conv``, ``at``, ``d``, ``bytes``, ``slice``) and (``conv``, ``length``)."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = stored(numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"h": h, "base": F.col("conv") - F.col("conv") % every}), "trie-convs")
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stored(convs.select("conv", "n", "h", "base", "taken"), "trie-rebuilt")
    own = numbered.join(convs.select("conv", "h", "taken"), "conv").where("at >= h").select(
        "conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "d", "bytes", "slice")
    first = numbered.where(F.col("at") < heads - 1).select(F.col("conv").alias("base"), "at", "d", "bytes")
    head = convs.where("taken > 0").select("conv", "base", "taken").join(first, "base").where("at < taken").select(
        "conv", "at", "d", "bytes", F.lit(-1).alias("slice"))
    length = convs.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return head.unionByName(own), length


def _with_nodes(rows: DataFrame) -> DataFrame:
    """Adds the node of each turn (``p``, ``q``: 128 bits) and ``cum``: bytes up to and with it.  Sums run
    inside (conversation, slice), with the slices before added as offsets."""
    x, y = F.xxhash64("d", "at"), F.xxhash64("at", "d", F.lit(1))
    rows = rows.withColumns({"s1": F.shiftrightunsigned(x, 32), "s2": x.bitwiseAND(_LOW), "s3": F.shiftrightunsigned(y, 32),
                             "s4": y.bitwiseAND(_LOW), "cum": F.col("bytes")})
    sums = ["s1", "s2", "s3", "s4", "cum"]
    upto = Window.partitionBy("conv", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    part = rows.groupBy("conv", "slice").agg(*[F.sum(c).alias(c) for c in sums])
    part = part.select("conv", "slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"o_{c}") for c in sums])
    run = rows.select("conv", "slice", "at", "d", "bytes", *[F.sum(c).over(upto).alias(c) for c in sums]).join(part, ["conv", "slice"])
    s = {c: F.col(c) + F.col(f"o_{c}") for c in sums}
    return run.select("conv", "at", "d", "bytes", s["cum"].alias("cum"),
                      F.shiftleft(s["s1"].bitwiseAND(_LOW), 32).bitwiseOR(s["s2"].bitwiseAND(_LOW)).alias("p"),
                      F.shiftleft(s["s3"].bitwiseAND(_LOW), 32).bitwiseOR(s["s4"].bitwiseAND(_LOW)).alias("q"))


def _ends(batches):
    """Of rows sorted by (p, q, length, conv): one row a node with count, least id and digest of its ids."""
    key, state = None, None
    for batch in batches:
        out = []
        for p, q, length, conv, total in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (p, q, length) != key:
                if key is not None:
                    out.append((*key, *state[:3], state[3].hexdigest()))
                key, state = (p, q, length), [0, conv, total, hashlib.sha256()]
            else:
                state[3].update(b",")
            state[0] += 1
            state[3].update(b"%d" % conv)
        if out:
            yield _end_batch(out)
    if key is not None:
        yield _end_batch([(*key, *state[:3], state[3].hexdigest())])


def _end_batch(rows):
    names = ["p", "q", "length", "m", "rep", "total", "sha"]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if c == "sha" else pa.int64()) for c, v in zip(names, zip(*rows))], names)


# ---------------------------------------------------------------- the trie

def prefix_trie(rows: DataFrame, length: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """One row a node of the conversations ``length`` (``conv``, ``length``) with turns ``rows`` (``conv``, ``at``,
    ``d``, ``bytes``, ``slice``)."""
    spark = rows.sparkSession
    turns = stored(_with_nodes(rows), "trie-nodes")
    last = turns.groupBy("conv").agg(F.max(F.struct("at", "p", "q", "cum")).alias("e"))
    none = F.lit(0).cast("long")
    ends = length.join(last, "conv", "left").select(
        F.coalesce("e.p", none).alias("p"), F.coalesce("e.q", none).alias("q"), "length", "conv", F.coalesce("e.cum", none).alias("total"))
    node = ["p", "q", "length"]
    paths = ends.repartition(*node).sortWithinPartitions(*node, "conv").mapInArrow(
        _ends, "p long, q long, length long, m long, rep long, total long, sha string")
    paths = stored(paths, "trie-paths")
    turns = turns.join(paths.select(F.col("rep").alias("conv"), "m", "length", "total", "sha"), "conv")
    turns = stored(turns, "trie-path-turns")
    # Nodes of several paths; a path's first other node is its last row in a shard.
    shared = turns.groupBy("p", "q", "at").count().where("count > 1").select("p", "q", "at", F.lit(True).alias("shared"))
    turns = stored(turns.join(shared, ["p", "q", "at"], "left").withColumn("shared", F.coalesce("shared", F.lit(False))), "trie-marked")
    step = F.struct("at", "d", "bytes")
    cut = turns.groupBy("conv").agg(F.collect_list(F.when(F.col("shared"), step)).alias("steps"),
                                    F.min(F.when(~F.col("shared"), step)).alias("own"),
                                    F.sum(F.when(~F.col("shared"), F.col("bytes"))).alias("rest"))
    steps = F.when(F.col("own").isNull(), F.array_sort("steps")).otherwise(F.concat(F.array_sort("steps"), F.array("own")))
    cut = cut.select(F.col("conv").alias("rep"), F.array_join(F.transform(steps, lambda s: s["d"]), "").alias("key"),
                     F.transform(steps, lambda s: s["bytes"]).alias("sizes"),
                     F.coalesce(F.col("rest") - F.col("own.bytes"), none).alias("tail_bytes"))
    cut = paths.select("rep", "m", "length", "sha").join(cut, "rep", "left").select(
        "rep", "m", "sha", F.coalesce("key", F.lit("")).alias("key"), F.coalesce("sizes", F.array().cast("array<bigint>")).alias("sizes"),
        F.coalesce("tail_bytes", none).alias("tail_bytes"), "length")
    cut = stored(cut.withColumn("has_tail", F.size("sizes") < F.col("length")), "trie-cut")
    count = cut.count()
    shards = max(1, math.ceil(count / shard_paths), min(shuffle_partitions(spark), count // 1000))
    placed = stored(cut.repartitionByRange(shards, "key").withColumn("shard", F.spark_partition_id()), "trie-shards")
    # One row a shard, so this window is as small as the number of shards.
    border = placed.groupBy("shard").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    line = Window.orderBy("shard")
    border = border.select("shard", F.lag("hi").over(line).alias("before"), F.lead("lo").over(line).alias("after"))
    found = stored(placed.join(border, "shard").select("shard", "key", "sizes", "m", "rep", "sha", "tail_bytes", "has_tail", "before", "after")
                         .groupBy("shard").applyInPandas(shard_nodes, NODE_SCHEMA), "trie-found")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spine = stored(found.where("spine is not null").groupBy("spine").agg(
        F.first("parent_spine", ignorenulls=True).alias("parent_spine"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in columns[3:7]], F.max("ends_sha256").alias("ends_sha256")), "trie-spine")
    upper = spine.select(F.col("spine").alias("parent_spine"), F.col("conv_id").alias("parent_conv_id"))
    inner = found.where("spine is null")
    parts = [spine.join(upper, "parent_spine", "left"), inner.where("parent_spine is null"),
             inner.where("parent_spine is not null").drop("parent_conv_id").join(upper, "parent_spine")]
    plain = turns.where(~F.col("shared")).join(cut.select(F.col("rep").alias("conv"), F.size("sizes").alias("kept")), "conv")
    plain = plain.where("at >= kept").withColumn("end", F.col("at") + 1 == F.col("length"))
    parts.append(plain.select(
        F.col("conv").alias("conv_id"), (F.col("at") + 1).alias("depth"), F.col("conv").alias("parent_conv_id"), F.col("m").alias("n_convs"),
        F.when(F.col("end"), 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * (F.col("total") - F.col("cum") + F.col("bytes"))).alias("saved_tokens"),
        F.when(F.col("end"), F.col("sha")).alias("ends_sha256")))
    every = parts[0].select(*columns)
    for p in parts[1:]:
        every = every.unionByName(p.select(*columns))
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))


def conversation_trie(turns: DataFrame, shard_paths: int = SHARD_PATHS, **columns) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations (see ``rebuilt``): ``conv_id`` (least member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    return prefix_trie(*rebuilt(numbered_turns(turns, **columns)), shard_paths=shard_paths)
