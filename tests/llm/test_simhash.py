"""SimHash: fingerprints and trie pairs against brute force, the operator on edge cases, large subtrees."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from disparo.llm import simhash
from disparo.llm.common import ship_package

BASE = " ".join(f"w{i}" for i in range(400))


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, errors=2):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= errors:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    best = {}
    for i, x in enumerate(ids):
        if x is not None:
            best[root(i)] = min(best.get(root(i), x), x)
    return [best.get(root(i)) for i in range(len(fps))]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB é\t\n\x0b z.", max_size=60))
def test_fingerprint_equals_the_plain_one(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_a_very_long_text():
    text = " ".join(str(i % 977) for i in range(90_000))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def cluster(n, seed):
    rng = np.random.default_rng(seed)
    keys = set()
    for c in rng.integers(0, 1 << 63, n, dtype=np.uint64).tolist():
        keys.add(c)
        for _ in range(6):
            y = c
            for b in rng.integers(0, 64, 3).tolist()[:rng.integers(1, 4)]:
                y ^= 1 << b
            keys.add(y)
    return np.array(sorted(keys), np.uint64)


@pytest.mark.parametrize("leaf,frontier", [(1, 64), (16, 1 << 17)])
def test_trie_pairs(leaf, frontier):
    x = cluster(60, 3)
    want = {(i, j) for j in range(len(x)) for i in range(j) if bin(int(x[i] ^ x[j])).count("1") <= 2}
    got = [p for i, j in simhash.trie_pairs(x, None, 0, 2, leaf, frontier) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    a, b = x[::2], x[1::2]
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if bin(int(a[i] ^ b[j])).count("1") <= 2}
    assert {p for i, j in simhash.trie_pairs(a, b, 0, 2, leaf, frontier) for p in zip(i.tolist(), j.tolist())} == want


def rows():
    rnd = random.Random(5)
    out = [(1, BASE), (1, BASE), (2, BASE.upper()), (None, BASE), (3, None), (4, ""), (5, " \t\n"), (6, "a"), (7, "A"), (8, "a b"),
           (None, "lonely text of no one else"), (9, "日本 x🙂 ß"), (10, " ".join(f"q{i}" for i in range(30_000)))]
    for i in range(120):  # near copies: one or a few changed words
        words = BASE.split()
        for _ in range(rnd.randint(1, 4)):
            words[rnd.randrange(400)] = f"x{rnd.randrange(50)}"
        out.append((100 + i, " ".join(words)))
    out += [(500 + i, " ".join(f"u{rnd.randrange(10_000)}" for _ in range(rnd.randint(1, 60)))) for i in range(60)]
    return out


@pytest.mark.parametrize("limit", [simhash.LIMIT, 5])
def test_operator_against_brute_force(spark, limit):
    """``limit=5`` sends nearly every subtree through the node pairs on Spark."""
    ship_package(spark)
    data = rows()
    docs = spark.createDataFrame([(i, t, 1, "k", 2) for i, t in data], "doc_id long, text string, id int, fp string, node int")
    got = simhash.simhash_components(docs, limit=limit).collect()
    fps = [slow_fingerprint(t) for _, t in data]
    want = slow_components([i for i, _ in data], fps)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == sorted(
        [(i, f"{f:016x}", c) for (i, _), f, c in zip(data, fps, want)], key=key)
    assert len(set(want)) < len(data) - 20


@pytest.mark.parametrize("limit", [simhash.LIMIT, 40])
def test_links_come_once(spark, limit):
    ship_package(spark)
    x = cluster(40, 11)
    nodes = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    got = [tuple(sorted((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))) for r in simhash.near_pairs(nodes, limit=limit).collect()]
    want = {(int(x[i]), int(x[j])) for j in range(len(x)) for i in range(j) if bin(int(x[i] ^ x[j])).count("1") <= 2}
    assert len(got) == len(want) and set(got) == want


def test_empty_table(spark):
    ship_package(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(none).count() == 0
