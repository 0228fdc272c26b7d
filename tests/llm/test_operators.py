"""Operators on a small frame with NULLs, copies, ties, empty texts and clashing columns."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from disparo.llm import decontaminate, exact_dedup, html_extract, jaccard_join, langid, quality, sentencepiece, sharding
from disparo.llm import substring_dedup, token_counts
from disparo.llm.common import ship_package

LONG = " ".join(f"w{i}" for i in range(70))
ROWS = [(1, LONG), (2, LONG), (2, LONG), (3, "pre " + LONG + " post"), (4, None), (5, ""), (6, " \n "), (7, "a b"), (8, "a  B"),
        (None, LONG), (9, " ".join(f"v{i}" for i in range(60)) + " " + LONG), (10, "日本 x🙂 <|endoftext|>"), (11, "." * 40)]
ROWS += [(20 + i, " ".join(f"n{j}" for j in range(60) if j != i)) for i in range(12)]
SCHEMA = "doc_id long, text string, keep_id string, node string, label string, n int"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "k", "x", "l", 1) for i, t in ROWS], SCHEMA).cache()


def test_exact_dedup(docs):
    got = exact_dedup.duplicate_report(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        same = [i for i, t in ROWS if hashlib.sha256((t or "").encode()).hexdigest() == r.text_sha256]
        assert r.keep_id == max(i for i in same if i is not None) and r.group_size == len(same)
    assert sum(r.kept for r in got) == len({t or "" for _, t in ROWS})
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len({t or "" for _, t in ROWS})


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "W3 w4 w5 w6 w7 w8 w9 w10 w11 w12!"), (2, None), (3, "a b"), (None, "v1")], "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination_report(docs, items).collect()}
    assert (1, 70, 10, 1, True) in got and (4, 0, 0, 0, False) in got and (7, 2, 2, 1, True) in got and (8, 2, 2, 1, True) in got
    sliced = decontaminate.contamination_report(docs, items, max_slice_bytes=8)
    one = decontaminate.contamination_report(docs, items)
    assert sorted(map(str, sliced.collect())) == sorted(map(str, one.collect()))
    cut = decontaminate.remove_contamination(docs, items, how="spans").where("doc_id = 7 or doc_id = 1").collect()
    assert {r.doc_id: re.findall(r"\S+", r.text) for r in cut} == {1: [f"w{i}" for i in range(70) if not 3 <= i <= 12], 7: []}
    assert decontaminate.remove_contamination(docs, items).where("doc_id in (1, 2, 3, 7, 8, 9)").count() == 0


def test_spans_of_slices_are_cut_once(spark, docs):
    """Windows 3-12 and 8-17 lie in two slices; 30-34 joined to 45-49 is no window of a document."""
    w = [f"w{i}" for i in range(70)]
    items = spark.createDataFrame([(1, " ".join(w[3:13])), (2, " ".join(w[8:18])), (3, " ".join(w[35:45])), (4, " ".join(w[30:35] + w[45:50]))],
                                  "item_id long, text string")
    few = docs.where("doc_id in (1, 7)")
    sliced = decontaminate.remove_contamination(few, items, how="spans", max_slice_bytes=8)
    assert sliced.schema == docs.schema
    got = {r.doc_id: r.text.split() for r in sliced.collect()}
    assert got == {1: [x for i, x in enumerate(w) if not (3 <= i < 18 or 35 <= i < 45)], 7: ["a", "b"]}


def brute_components(k=4, percent=85):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    sets = [shingles(t) for _, t in ROWS]
    comp = list(range(len(ROWS)))
    for _ in ROWS:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return sets, comp


@pytest.mark.parametrize("leaf,block", [(64, 2048), (2, 3)])
def test_jaccard_components(docs, leaf, block):
    """Once with small regions, once with all larger ones joined by document pivots in blocks."""
    sets, comp = brute_components()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_join.jaccard_components(docs, leaf=leaf, block=block).collect()), key=str)
    low = {c: min((ROWS[i][0] for i in range(len(ROWS)) if comp[i] == c and ROWS[i][0] is not None), default=None) for c in comp}
    assert got == sorted(((ROWS[i][0], len(sets[i]), low[comp[i]]) for i in range(len(ROWS))), key=str)


def test_substring_dedup(docs):
    got = substring_dedup.remove_repeats(docs, crowded=2, shard_words=40).collect()
    texts = [(i if i is not None else 1 << 62, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in ROWS]
    want = []
    for (i, w), (raw, _) in zip(texts, ROWS):
        gone = set()
        for a in range(len(w) - 49):
            if any(j < i and any(v[b:b + 50] == w[a:a + 50] for b in range(len(v) - 49)) for j, v in texts):
                gone |= set(range(a, a + 50))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want.append((raw, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(want, key=str)


def test_substring_passages_are_cut_without_a_shuffle(docs, monkeypatch):
    """Past the broadcast bound whole texts were shuffled for the cut.  Full bit arrays only cost work."""
    plans, stored = {}, substring_dedup.stored

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    want = sorted(map(str, substring_dedup.remove_repeats(docs, crowded=2, shard_words=40).collect()))
    monkeypatch.setattr(substring_dedup, "stored", spy)
    monkeypatch.setattr(substring_dedup, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", 6, raising=False)
    assert sorted(map(str, substring_dedup.remove_repeats(docs, crowded=2, shard_words=40).collect())) == want
    assert "Exchange" not in plans["substring-passages"]


def test_substring_runs_of_copies_are_one_row(spark):
    anchors = spark.range(5000).selectExpr("7L as node", "id % 3 as anchor", "cast(id % 3 as int) as start", "4 as windows")
    shared = spark.createDataFrame([(0,), (2,)], "anchor long")
    got = substring_dedup._shared_runs(anchors, shared)
    assert sorted(map(tuple, got.collect())) == [(7, 0, 4, 0), (7, 2, 4, 2)]


def test_sharding(docs):
    got = sharding.shard_documents(docs, shards=3, cell_rows=2).collect()
    assert len(got) == len(ROWS)
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in ROWS)
    assert sorted((r.size, r.text_crc32) for r in got) == want


def test_token_counts_and_cache(spark, docs, tmp_dir):
    import public_tokenizers
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(100 + i, f"a{chr(c)}b {chr(c)}{chr(c)}1 x") for i, c in enumerate(range(1, 0x2C0))], "doc_id long, text string"))
    want = sorted((str(r.doc_id), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in more.collect())
    for _ in range(2):
        got = token_counts.token_counts(more, f"{tmp_dir}/cache")
        assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == want
    stored = spark.read.parquet(f"{tmp_dir}/cache")
    assert stored.count() == stored.select("digest").distinct().count()


def test_language_id(spark, docs):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de") for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.train_and_identify(train).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    model = langid.fit(train)
    mixed = spark.createDataFrame([(1, "the dog and the cat the dog und der hund die katze und der hund"), (2, None), (3, "12 — …")],
                                  "doc_id long, text string")
    out = {r.doc_id: r for r in langid.identify(mixed, model).collect()}
    assert [s.lang for s in out[1].spans] == ["en", "de"] and out[2].lang_pred == out[3].lang_pred == "und" and out[3].score == 0.0


def test_quality_without_and_with_ratings(spark, docs):
    rated = quality.rate(docs, None).collect()
    assert all(r.accepted == bool(re.search(r"[0-9A-Za-z\x80-\U0010ffff]", t or "")) for r, (_, t) in zip(rated, ROWS))
    rows = [(i, "good plain words here " * (1 + i % 3) if i % 3 else "bad!!! bad!!! junk " * 4, int(i % 3 > 0), 0) for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    model = quality.fit(frame, quality.graded(frame))
    assert {r.doc_id for r in quality.select(frame, model).collect()} == {i for i, *_ in rows if i % 3}


def test_sentencepiece_round_trip(docs):
    enc = sentencepiece.encode_documents(docs)
    assert all(r.round_trip for r in enc.collect())
    back = sorted(r.text for r in sentencepiece.decode_documents(enc).collect())
    assert back == sorted(t or "" for _, t in ROWS)


def test_html_site_tree(spark):
    ship_package(spark)
    pages = [(i, f"http://h.example/{i}", f"<html><body><div class=top>Same words</div><div><p>Own {i}</p></div></body></html>") for i in range(8)]
    pages += [(90, None, None), (91, "x", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_extract.main_text(frame).collect()}
    assert all(got[i].text == f"Own {i}" for i in range(8)) and got[90].text == got[91].text == "" and got[3].n_chars == 5


def page_texts(spark, pages):
    ship_package(spark)
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html_extract.main_text(frame).orderBy("page_id").collect()]


def test_html_verdicts_hold_inside_landmarks(spark):
    site = [("http://h.example/", f"<body><nav>N</nav><article><h1>T {i}</h1><p>Own {i}</p><div class=box><b>Read our app</b></div>"
             f"<p>Like us</p><p>More {i}</p></article></body>") for i in range(6)]
    few = [("http://few.example/", f"<body><main><p>Both</p><p>Own {i}</p></main></body>") for i in range(3)]
    got = page_texts(spark, site + few)
    assert got[:6] == [f"T {i}\nOwn {i}\nMore {i}" for i in range(6)]
    assert got[6:] == [f"Own {i}" for i in range(3)]
    one = [("http://one.example/", f"<body><article><p>Own {i}</p>" + "<p>Refrain</p>" * (5 if i == 0 else 0)) for i in range(4)]
    assert page_texts(spark, one)[0] == "\n".join(["Own 0"] + ["Refrain"] * 5)


def test_html_branch_with_text_of_its_own_is_no_boilerplate(spark):
    """A body of many fixed parts and one article: its importance is low, the article's is not."""
    parts = "".join(f"<div class=c{j}>Part {j}</div>" for j in range(12))
    site = [("http://h.example/", f"<body>{parts}<article><p>Own {i}</p></article></body>") for i in range(5)]
    assert page_texts(spark, site) == [f"Own {i}" for i in range(5)]


def test_html_copies_of_a_page_are_one_page(spark):
    page = "<body><div><p>Head</p></div><div><p>First</p><p>Second</p></div></body>"
    mostly = [("http://copies.example/", page)] * 5 + [("http://copies.example/", "<body><p>Own</p></body>")]
    pair = [("http://pair.example/", page)] * 2 + [("http://pair.example/", page.replace("First", "Third").replace("Second", "Fourth"))]
    got = page_texts(spark, mostly + pair)
    assert got[:5] == ["Head\nFirst\nSecond"] * 5 and got[5] == "Own"
    assert [t.split("\n")[1:] for t in got[6:]] == [["First", "Second"]] * 2 + [["Third", "Fourth"]]


def test_html_importance_is_composed_over_levels(spark):
    rnd, rows = random.Random(5), []
    for host in "ab":
        for path in range(1, 120):
            parent = 0 if path == 1 else path - 1 if path < 40 else rnd.randrange(1, path)
            rows.append((host, path, parent, rnd.randint(1, 9), rnd.randint(1, 4), rnd.random() / 9, rnd.choice([None, 0.0, 0.3])))
    nodes = spark.createDataFrame(rows, "host string, path long, parent long, pages long, size long, shape_entropy double, content double")
    want = {}
    for host, path, _, pages, size, shape, content in reversed(rows):
        kids = [(r[3], *want[host, r[1]]) for r in rows if r[0] == host and r[2] == path]
        below = [k[:2] for k in kids] + ([] if content is None else [(pages, content)])
        inner = sum(n * v for n, v in below) / sum(n for n, _ in below) if below else 0.0
        value = (1 - 0.9 ** size) * shape + 0.9 ** size * inner if below else 0.0
        want[host, path] = (value, max([value, content or 0.0, *(k[2] for k in kids)]))
    got = html_extract._composed(nodes).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.value, r.most) == pytest.approx(want[r.host, r.path], abs=1e-8)


def test_html_identifiers_of_one_page_do_not_split_paths(spark):
    site = [("http://h.example/", f"<body><div id=post-{i} class='post p{i}'><div class=tail>Same tail</div><p>Own {i}</p></div></body>") for i in range(5)]
    assert page_texts(spark, site) == [f"Own {i}" for i in range(5)]


def test_empty_tables(docs):
    none = docs.limit(0)
    assert exact_dedup.duplicate_report(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert sharding.shard_documents(none).count() == 0
    assert jaccard_join.jaccard_components(none).count() == 0
    assert langid.train_and_identify(none.withColumn("lang", F.lit("en"))).count() == 0
