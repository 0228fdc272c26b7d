"""Conversation trie: parentheses against a stack, the operator against a plain trie, on one and many shards."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from disparo.llm import conversation_trie as ct
from disparo.llm.common import ship_package

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=0, max_size=120), st.sampled_from([2, 3, 8, 256]))
def test_findclose_and_leaf_rank(steps, block):
    bits, depth = [True], 1
    for s in steps:
        down = min(s // 2, depth - 1)
        bits += [False] * down + [True]
        depth += 1 - down
    bits += [False] * depth
    tree = ct.Parens(np.array(bits), block)
    opens, stack, want = np.flatnonzero(bits), [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    close = tree.findclose(opens)
    assert close.tolist() == [want[i] for i in opens.tolist()]
    leaves = (tree.leaf_rank(close) - tree.leaf_rank(opens)).tolist()
    assert leaves == [sum(bits[j] and not bits[j + 1] for j in range(i, want[i])) for i in opens.tolist()]


def slow_trie(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            turns.setdefault(c, []).append(((t is not None, t or 0), role, d, text))
    plain = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = plain.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:]
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
    kids, saved, leaves = {}, {}, {}
    for k in members:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k, m in members.items():
        b = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] = saved.get(k[:d], 0) + b
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in kids)
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations():
    rnd = random.Random(9)
    rows = []
    for c in range(-7, 160):
        for t in range(rnd.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["hi", "yes", "no é", "tell me 🙂", ""])))
    rows += [(c, t, "user", f"same {t}") for c in range(300, 340) for t in range(14)]     # equal below the heads
    rows += [(c, t, "user", f"deep {t}") for c in (405, 410) for t in range(200)]          # two equal long ones
    rows += [(415, t, "user", f"deep {t}" if t < 150 else f"x {t}") for t in range(200)]   # shares 150 turns
    rows += [(500, t, "bot", f"alone {t}") for t in range(700)]
    rows += [(None, 0, "user", "x"), (601, None, None, None), (601, 0, "user", None), (601, 0, "user", None), (602, None, "a", "b"),
             (603, 1, "b", "tie"), (603, 1, "a", "tie"), (603, 1, "a", "other tie"), (604, 0, "user", "é" * 5000)]
    return rows


def table(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("shard_paths", [ct.SHARD_PATHS, 7, 1])
def test_operator_against_a_plain_trie(spark, shard_paths):
    ship_package(spark)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as p", "'x' as key", "2 as at", "3 as slice", "4 as conv").repartition(5)
    assert table(ct.conversation_trie(df, shard_paths=shard_paths)) == sorted(slow_trie(rows), key=str)


def test_slices_of_a_long_conversation(spark):
    """With many range partitions one conversation spans several slices."""
    ship_package(spark)
    rows = conversations()
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ct.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(6))
        assert got.where("conv = 500").select("slice").distinct().count() > 1
        places = [r.at for r in got.where("conv = 500").collect()]
        assert sorted(places) == list(range(700))
        assert table(ct.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(6), shard_paths=20)) == sorted(slow_trie(rows), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_empty_table_and_one_turnless_path(spark):
    ship_package(spark)
    assert ct.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)  # its only turn is replaced by nothing
    rows = [(c, 0, "user", "x")]
    assert table(ct.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == slow_trie(rows)
