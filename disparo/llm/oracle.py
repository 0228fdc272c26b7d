"""DuckDB SQL for the contract queries that SQL can express (written apart from the Spark code)."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _low(c: str) -> str:
    return f"translate(coalesce({c}, ''), '{_UPPER}', '{_UPPER.lower()}')"


_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP4 = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""

OP5 = f"""WITH
d AS (SELECT doc_id, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k,
              array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)"""

_SPACED = r"'[^\x20\x09-\x0D]+'"

OP6 = f"""WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_low('text')}, {_SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.b FROM reach r JOIN e ON e.a = r.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, n.n"""

OP8 = f"""WITH
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, p FROM (
           SELECT win.doc_id, unnest(range(win.i, win.i + 50)) AS p FROM win JOIN low USING (g) WHERE low.least < win.doc_id)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

# crc32 of the decimal id, bit by bit (polynomial 0xEDB88320), and every path prefix as a list of (role, text).
OP11 = """WITH
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) - 1 AS i
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY i) AS w FROM t GROUP BY conv_id),
h AS (SELECT conv_id, w, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                 lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 9 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(b.w, [])[:h.h], h.w[h.h + 1:]) AS w FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, d, w[:d] AS k, len(w) AS n, d = len(w) AS ends FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM r)),
g AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(strlen(k[d].text), 0) AS b,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY k, d),
kid AS (SELECT k[:d - 1] AS k, count(*) AS n FROM g WHERE d > 0 GROUP BY 1),
leaf AS (SELECT g.* FROM g LEFT JOIN kid ON kid.k = g.k AND len(kid.k) = g.d WHERE kid.n IS NULL),
below AS (SELECT a.k, sum((v.n_convs - 1) * v.b) AS saved, count(leaf.k) AS leaves
          FROM (SELECT DISTINCT g.k AS v, g.k[:x] AS k FROM g, unnest(range(0, g.d + 1)) AS u(x)) a
          JOIN g v ON v.k = a.v LEFT JOIN leaf ON leaf.k = a.v GROUP BY a.k)
SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, g.n_convs, coalesce(kid.n, 0) AS n_children,
       below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN below ON below.k = g.k LEFT JOIN kid ON kid.k = g.k LEFT JOIN g up ON g.d > 0 AND up.k = g.k[:g.d - 1]"""

OP13 = f"""WITH
p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_low('text')}, '[.,;:!?\\x0A-\\x0D]')) AS s FROM documents),
w AS (SELECT lang, regexp_extract_all(s, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k)
      GROUP BY ALL),
c AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND n >= 10),
cut AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS x FROM c),
s AS (SELECT cut.lang, cut.phrase, k, a, x, y.n AS l, z.n AS r,
             CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(y.n AS HUGEINT) * z.n) AS BIGINT) AS score
      FROM cut JOIN (SELECT lang, phrase, n FROM g) y ON y.lang = cut.lang AND y.phrase = array_to_string(w[1:x], ' ')
               JOIN (SELECT lang, phrase, n FROM g) z ON z.lang = cut.lang AND z.phrase = array_to_string(w[x + 1:k], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1),
up AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
       FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang)
SELECT m.lang, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank, m.phrase, a, l, r, n.n, score
FROM m JOIN n ON n.lang = m.lang LEFT JOIN up ON up.lang = m.lang AND up.phrase = m.phrase
WHERE up.longer IS NULL OR 100 * up.longer < 50 * a
QUALIFY rank <= 2000"""

ORACLE = {
    "op4_exact_dedup": OP4,
    "op5_benchmark_decontamination": OP5,
    "op6_ngram_jaccard_join": OP6,
    "op8_substring_dedup": OP8,
    "op11_conversation_prefix_trie": OP11,
    "op13_phrase_collocations": OP13,
}
