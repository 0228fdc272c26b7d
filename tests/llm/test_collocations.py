"""Collocations: counting in a slice and the operator against brute force, border failures, edge cases."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from disparo.llm import collocations as co
from disparo.llm.common import ship_package


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield re.findall(r"[^\x20\x09]+", piece)


def slow_counts(rows, max_words=3):
    f = Counter()
    for lang, text in rows:
        for w in pieces(text):
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i:i + k])] += 1
    return f


def slow_report(rows, least=10, within=50, top=2000, max_words=3):
    f = slow_counts(rows, max_words)
    n = Counter()
    for (lang, p), c in f.items():
        n[lang] += c if len(p) == 1 else 0
    cand = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    longer = defaultdict(int)
    for (lang, p), c in cand.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                longer[lang, p[i:i + size]] = max(longer[lang, p[i:i + size]], c)
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        if 100 * longer[lang, p] >= within * a and longer[lang, p]:
            continue
        s, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-s, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:top]))


def data():
    rnd = random.Random(2)
    words = ["a", "b", "c", "the", "New", "york", "city", "straße", "日本", "x-y", "it's", "q"]
    rows = []
    for i in range(260):
        text = " ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ",\n", "\t"]) for _ in range(rnd.randint(0, 40)))
        if i % 3 == 0:
            text += " New  York\tcity hall; rare%d pair%d here" % (i % 7, i % 7)
        rows.append((rnd.choice(["en", "de", None, "und"]), text))
    rows += [("en", "alpha beta gamma"), ("fr", "only few words"), (None, None), ("xx", None), ("en", ""), ("en", " ,.;\t")]
    rows += [("hot", "one phrase said again and again. one phrase said again")] * 300
    return rows


def report(df, **kw):
    return sorted(tuple(r) for r in co.collocation_report(df, **kw).collect())


@pytest.mark.parametrize("share", [0.25, 1.0, 0.0])
def test_report_against_brute_force(spark, share):
    """Without a sample (0.0) every phrase is a border failure and comes from the expansion passes."""
    ship_package(spark)
    rows = data()
    df = spark.createDataFrame([(t, lang, 1, 2) for lang, t in rows], "text string, lang string, phrase int, n int").repartition(3)
    assert report(df, share=share) == slow_report(rows)


def test_longer_phrases_and_small_top(spark):
    ship_package(spark)
    rows = data()
    df = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    assert report(df, max_words=4, top=5, min_count=4) == slow_report(rows, least=4, top=5, max_words=4)


def test_long_texts_are_cut_at_separators():
    text = "a b. " * 500 + "c" * 300 + " d\n" + "e f g " * 50
    batch = pa.record_batch([pa.array(["en", "en", None, "de"]), pa.array([text, "", None, "x y"])], names=["lang", "text"])
    got = list(co.slices(batch, 64))
    assert b"".join(d.tobytes() for d, _, _ in got) == (text + "x y").encode()
    assert [r for _, _, row in got for r in row.tolist()] == sorted(r for _, _, row in got for r in row.tolist())
    parts = [d[a:b].tobytes().decode() for d, off, row in got for a, b, r in zip(off, off[1:], row) if r == 0]
    assert len(parts) > 10 and all(p[-1] in ".\n" for p in parts[:-1])


def test_scan_memory_follows_the_slice():
    """A batch of 10 MB in texts of distinct words: the arrays of a scan are those of a slice and of the counts held."""
    text = " ".join(f"{i:x}" for i in range(50_000))
    batch = pa.record_batch([pa.array(["en"] * 40), pa.array([text] * 40)], names=["lang", "text"])
    run = co._scan(3, None, 16)
    list(run([batch.slice(0, 1)]))  # tables of powers are kept a process
    tracemalloc.start()
    for _ in run([batch]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20, peak >> 20


def test_equal_hashes_do_not_merge_words(monkeypatch):
    """With a hash that sends all words to a few values, numbers still follow the bytes."""
    monkeypatch.setattr(co, "mix", lambda x: x & np.uint64(3))
    text = np.frombuffer(b"aa b cc aa b d aa", np.uint8)
    got = {}
    for w, k, _, gram, _, place, _ in co.grams(text, np.array([0, len(text)]), np.zeros(1, np.int64), np.zeros(1, np.uint64), 2):
        for p, c in zip(co._texts(w, place, k).to_pylist(), np.bincount(gram).tolist()):
            got[p] = c
    assert got == {"aa": 3, "b": 2, "cc": 1, "d": 1, "aa b": 2, "b cc": 1, "cc aa": 1, "b d": 1, "d aa": 1}


def test_packed_counts_come_back():
    rng = np.random.default_rng(4)
    h, n = rng.integers(0, 1 << 63, 5000, dtype=np.uint64), rng.integers(1, 4, 5000)
    bucket, key = co.split_hash(h, 7)
    got = {}
    for batch in co._packed(2, h, n, 7):
        for b, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for x, c in zip(*(v.tolist() for v in co._unpacked([p]))):
                got[b, x] = c
    assert got == {(b, x): c for b, x, c in zip(bucket.tolist(), key.tolist(), n.tolist())}


def test_colliding_hashes_only_cost_work(spark, monkeypatch):
    """All phrases on 64 bits of the proposals: every one survives, and the counts by text stand."""
    ship_package(spark)
    rows = data()
    monkeypatch.setattr(co, "FILTER_BITS", 6)
    df = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    assert report(df) == slow_report(rows)


def test_empty_table(spark):
    ship_package(spark)
    assert report(spark.createDataFrame([], "text string, lang string")) == []
