"""Spark-free parts against brute force: scanning, Rice coding, FM-index, Viterbi, trie, rebalancing."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from disparo.llm import exact_dedup, fm_index, html_extract, sharding
from disparo.llm.decontaminate import Matcher, item_windows
from disparo.llm.exact_dedup import rice_decode, rice_encode
from disparo.llm.langid import viterbi
from disparo.llm.quality import fit_ordinal
from disparo.llm.sentencepiece import _plain, build_pieces, decode_bytes, double_array, encode, escaped
from disparo.llm.substring_dedup import kept_words, search_shard
from disparo.llm.textscan import Words, non_space_class, text_buffers

TEXT = st.text(st.sampled_from("ab \t\né日🙂\x0b "), max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    data, off = text_buffers(pa.array(texts, pa.string()))
    w = Words(data, off, non_space_class())
    seen = {}
    for r, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        own = range(w.first[r], w.first[r + 1])
        assert [data[w.start[i]:w.end[i]].tobytes().decode() for i in own] == words
        for i, x in zip(own, words):
            assert seen.setdefault(x, w.hash[i]) == w.hash[i]
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 1 << 40), min_size=1, max_size=200))
def test_rice_round_trip(values):
    v = np.array(sorted(values), np.int64)
    payload, k = rice_encode(v)
    assert (rice_decode(payload, k, len(v)) == v).all()


def test_fm_index_least_owner():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(5, 30))).encode() for _ in range(40)]
    owners, indexed = np.array([rnd.randint(0, 9) for _ in texts]), np.array([i % 3 > 0 for i in range(40)])
    got = search_shard(texts, owners, indexed, 5)
    low = {}
    for t, o, own in zip(texts, owners, indexed):
        w = t.split()
        for i in range(len(w) - 4 if own else 0):
            low[tuple(w[i:i + 5])] = min(o, low.get(tuple(w[i:i + 5]), 99))
    for t, runs in zip(texts, got):
        w = t.split()
        flat = {i: r["least"] for r in runs for i in range(r["a"], r["b"])}
        assert flat == {i: low[tuple(w[i:i + 5])] for i in range(len(w) - 4) if tuple(w[i:i + 5]) in low}


def test_wavelet_rank():
    x = np.random.default_rng(1).integers(0, 9, 500)
    w = fm_index.WaveletMatrix(x, 9)
    for c in range(9):
        at = np.arange(501)
        assert (w.rank(np.full(501, c), at) == np.concatenate(([0], np.cumsum(x == c)))).all()


def test_kept_words():
    text = " ".join(f"w{i}" for i in range(60)).encode()
    assert kept_words(text, [{"a": 0, "b": 50}, {"a": 5, "b": 55}], False, 50) == (60, 55, b"w55 w56 w57 w58 w59")
    assert kept_words(text, None, True, 50) == (60, 60, b"") and kept_words(b"a  b", None, True, 50) == (2, 0, b"a b")


def test_decontamination_windows():
    windows = item_windows([1, 2, 3, None], ["a b c d e f g h i j k", "X-y", None, "zz"])
    assert len(windows[10]) == 2 and windows[2] == {b"x y": [2]}
    data, off = text_buffers(pa.array(["q A b c d e f g h i j z", "x, Y. x", None]))
    w, hit, items = Matcher(windows).scan(data, off)
    assert w.counts.tolist() == [12, 3, 0] and hit.tolist() == [False] + [True] * 10 + [False, True, True, False]
    assert items[0] == {1} and items[1] == {2}


def test_viterbi_matches_enumeration():
    import itertools
    rng = np.random.default_rng(4)
    first = np.array([0, 5, 5, 6, 10])
    s = rng.normal(size=(10, 3)) * 3
    got = viterbi(s, first, 2.0)
    for a, b in zip(first, first[1:]):
        value = lambda p: sum(s[a + i, x] for i, x in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        if b > a:
            assert abs(value(tuple(got[a:b])) - max(map(value, itertools.product(range(3), repeat=b - a)))) < 1e-9


def test_double_array_holds_its_keys():
    rnd = random.Random(2)
    keys = {bytes(rnd.choices(b"abcdef\xc3\xa9", k=rnd.randint(1, 6))): i for i in range(400)}
    base, check, value = double_array(keys)

    def find(key):
        s = 0
        for c in key:
            t = base[s] + c
            if check[t] != s:
                return -1
            s = t
        return value[s]
    assert all(find(k) == v for k, v in keys.items()) and find(b"zz") == -1


def test_unigram_best_path_and_round_trip():
    entries = [("<unk>", 0.0, "special")] + [(f"<0x{i:02X}>", 0.0, "byte") for i in range(256)]
    entries += [(p, -float(i), "normal") for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "aba", "▁▁"])]
    p = build_pieces(entries)
    texts = ["abab", "", " ab  a", "é\nab", "bbb"]
    data, off = text_buffers(_plain(pa.array(texts)))
    ids, first = encode(*escaped(data, off), p)

    def best(s):
        table = {entries[i][0]: p.scores[i] for i in range(257, len(entries))}
        score = [0.0] + [-1e9] * len(s)
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                w = table.get(s[i:j], p.unknown_score if j == i + 1 else -1e9)
                score[j] = max(score[j], score[i] + w)
        return score[-1]
    for r, t in enumerate(texts):
        own, unknown = ids[first[r]:first[r + 1]], sum(c not in " ab" for c in t)
        total = sum(p.scores[i] for i in own if i > 256) + unknown * p.unknown_score
        assert not t and not len(own) or abs(total - best("▁" + t.replace(" ", "▁"))) < 1e-9
    back, at = decode_bytes(ids, first, p)
    assert [back[a:b].tobytes().decode() for a, b in zip(at, at[1:])] == texts


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 900)
    index, first = (y * 2 + rng.integers(0, 2, 900)).astype(np.int64), np.arange(901)
    m = fit_ordinal(index, np.ones(900), first, y, size=8, epochs=60)
    s = m.weights[:6].astype(float)
    assert m.thresholds[0] < m.thresholds[1] and (m.expected(s).round() == [0, 0, 1, 1, 2, 2]).all()


def test_rebalance_moves_few_slots_and_evens_bytes():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 1000, 512)
    old = sharding.first_map(np.arange(512), np.zeros(512, int), np.ones(512, int), size, size, 16)
    new = sharding.rebalance(old, 16)
    load = new.loads(16)
    # No slot of the fullest shard is small enough to narrow the gap to the emptiest.
    assert new.version == 2 and size[new.shard == load.argmax()].min() >= load.max() - load.min()
    assert load.max() < 1.01 * load.mean() and (new.shard != old.shard).mean() < 0.3
    assert (sharding.rebalance(new, 16).shard == new.shard).all()


def test_html_blocks():
    page = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><li><a>x</a></nav><!-- c -->"
            "<div class='side ad'>buy</div><article><h1>A &amp; B</h1><p><b>one<br>two &lt; 3<p>x < y <ul><li>l1<li>l2</ul>"
            "<section class=comments><p>bad</section></article><footer>f")
    blocks, styles = html_extract.parse(page)
    assert [b["text"] for b in blocks if b["landmark"] and not b["noise"]] == ["A & B", "one two < 3", "x < y", "l1", "l2"]
    assert {b["text"] for b in blocks if b["noise"]} == {"x", "buy", "bad", "f"} and styles
    assert html_extract.parse(None) == ([], []) and html_extract.parse("<p <b")[0] is not None
    assert html_extract.host_of("http://u@A.example:80/x") == "a.example" and html_extract.host_of(None) == ""


def test_html_raw_text_open_head_and_depth():
    def texts(page):
        return [b["text"] for b in html_extract.parse(page)[0] if b["landmark"] and not b["noise"]]

    script = "<script>for(i=0;i<n;i++){} a='<!--';</SCRIPT ><title>a <b</title><svg><svg></svg>x</svg><template><template></template>y</template>"
    assert texts(f"<body>{script}<article><p>One</p>{script}<p>Two</p></article>") == ["One", "Two"]
    assert texts("<article><p>One</p><script>if (a<b) '</scripts>'") == ["One"]
    for head in ("<head><title>t</title><meta charset=x><body>", "<head><title>t</title>", "<head>\n<script>x</script>\n"):
        assert texts(f"<html>{head}<main><p>One</p></main>") == ["One"]
    assert [b["noise"] for b in html_extract.parse("<head><title>t</title>Plain text")[0]] == [False]
    for n in (300, 20_000):
        page = "<article><p>One</p>" + "<div>" * n + "deep" + "</div>" * n + "<p>Two</p></article>"
        assert texts(page) == ["One", "deep", "Two"]
        paths, styles = html_extract.placed(html_extract.parse(page)[1])
        assert len(set(paths)) == len(styles) == n + 2


def test_owners_of_wide_fingerprints():
    """49 bits and 500,000 owners: the product of a fingerprint and the owners passes 64 bits."""
    rng = np.random.default_rng(12)
    for bits, owners in ((49, 500_000), (61, 3), (49, 1), (20, 1000)):
        values = np.unique(np.append(rng.integers(0, 1 << bits, 2000), [0, (1 << bits) - 1]))
        got = exact_dedup.owners_of(values, owners, bits).tolist()
        assert got == [v * owners >> bits for v in values.tolist()] and 0 <= min(got) and max(got) < owners
        sent = list(exact_dedup._outgoing(values, owners, bits))
        assert len({o for o, _, _ in sent}) == len(sent) and sum(len(v) for _, v, _ in sent) == len(values)


def test_exchange_groups_leave_rows_a_message(spark):
    for rows in (0, 1, 5000, 10 ** 6, 10 ** 11):
        n = exact_dedup.exchange_groups(spark, rows)
        assert n >= 1 and n >= rows / exact_dedup.BLOCK_ROWS and (n * n * 16 <= max(rows, 16) or n == -(-rows // exact_dedup.BLOCK_ROWS))


def kept_text(page):
    blocks, _ = html_extract.parse(page)
    some = any(b["landmark"] and not b["noise"] for b in blocks)
    return "\n".join(b["text"] for b in blocks if not b["noise"] and (b["landmark"] or not some))


def test_html_names_are_priors():
    body = "<p>First long paragraph of the article.</p><p>Second one.</p>"
    text = "First long paragraph of the article.\nSecond one."
    for name in ("content no-sidebar", "has-sidebar", "with-ads", "ad-free", "has-comments", "sidebar-layout"):
        assert kept_text(f'<div class="{name}"><article>{body}</article></div>') == text
    assert kept_text(f'<main><div class="ad-free">{body}</div></main>') == text
    assert kept_text(f'<form action="/x"><main>{body}</main><input value="q"></form>') == text
    assert kept_text(f"<form><div>{body}</div></form>") == text
    # What names and tags still take out.
    noise = '<div class="post-sidebar">S</div><div id="comments"><p>Reader comment, a little longer than all the rest of this page is.</p></div>'
    assert kept_text(f"<article>{body}{noise}<form><label>Mail</label></form></article>") == text
    assert kept_text(f'<div class="sidebar"><article>Teaser</article></div><main>{body}</main><footer>F</footer>') == text
    assert kept_text(f'{body}<form>Search <input></form><div class="share-buttons">Share</div>') == text


def test_html_formulas_and_split_references():
    assert kept_text("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='t'>x=1</annotation></math> be.</p>") == "Let x=1 be."
    assert kept_text("<p>a &am<b>p;</b> b &amp;lt; c &nbsp; &#233;</p>") == "a &amp; b &lt; c é"
