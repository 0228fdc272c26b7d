"""HTML extraction by a site style tree.

The DOMs of a host's pages are merged: a node of the style tree is an element's path of tags
with classes and ids (not ids, or classes with a digit, that one page alone has); it keeps how many pages (copies of a page count once) have it, which presentations (sequences of child
tags) it takes, and which contents its text takes.  Importance follows the two entropies:

* presentation: ``-sum p log_m p`` over a node's presentations on its m pages (1 for one page);
* content: ``1 - avg H(a)`` with ``H(a) = log_m k`` for a text that k of the m pages carry;
* a branch: ``(1 - g^l) own + g^l sum p child`` with ``g = 0.9`` and ``l`` presentations, bottom up;
  text leaves have their content importance.

Branches on ``MIN_PAGES`` pages or more that are below ``LEAST`` with all that lies in them are
removed from every page, and so are texts that most of the pages with their node repeat.  Two
priors hold beside that: elements that say they are navigation, notice, advert, form, comment and
the like have no importance, and a page with an article or main element gives only its text.
A name is no verdict on what holds the page: an element outside of articles that is noise by its
class, id or role, or is a form, stays when most of the articles' text lies in it, and so does a form
with most of the text of a page without articles.
Inside such an element low branches and repeated texts go too, but a text only if ``MIN_PAGES``
pages have it.

Scale: pages are parsed once and stored as blocks and node trees; the style tree is built by
grouped sums over (host, path) and (host, path, text hash), pre-aggregated, and importances are
composed in rounds of joins by (host, path), so a hot host is no single task; the verdicts of a
host (low paths and repeated texts) are joined back, split where a host is hot.  Whole pages are
read.

Defined cases: NULL or empty html gives the empty text; a page that breaks off is read to its
end; a NULL or unreadable URL is a host of its own name ''; repeated rows each get a row; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.llm.common import stored

LEAST = 0.2
REPEATED = 0.5
MIN_PAGES = 3
GAMMA = 0.9

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg annotation annotation-xml".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre search section summary "
                    "table tbody td tfoot th thead tr ul").split())
NOISE_TAGS = frozenset("nav footer aside form dialog menu button select option label input head object".split())
LANDMARKS = frozenset("article main".split())
NOISE_WORDS = frozenset(("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                         "cookies disqus footer form login masthead menu modal nav navbar navigation newsletter notice notices pager "
                         "pagination popup promo promoted promotion related respond search share sharing sidebar signup social "
                         "sponsor sponsored subscribe toolbar widget").split())
NOISE_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu menubar toolbar".split())
CLOSES_P = BLOCKS - frozenset("html body".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
               "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl select".split())
HEAD_CONTENT = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
NESTED = frozenset("svg template".split())
# Words that make a class or id say something of the page ("no-sidebar", "ad-free"), not what the element is.
BEFORE = frozenset("no non not has have with without hide".split())
BEHIND = frozenset("free less enabled disabled".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_RAW_TAG = {t: re.compile(rf"<(/?){t}(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I) if t in NESTED else re.compile(rf"<(/){t}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
            for t in RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else ""


class _Element:
    __slots__ = ("tag", "node", "noise", "named", "landmark", "block", "shut")

    def __init__(self, tag, node, noise, named, landmark, block, shut):
        self.tag, self.node, self.noise, self.named, self.landmark, self.block, self.shut = tag, node, noise, named, landmark, block, shut


def noise_name(attribute: str) -> bool:
    """Whether a class or id says that the element is noise."""
    for name in attribute.split():
        words = [w for w in _SPLIT.split(name) if w]
        if words and words[0] not in BEFORE and words[-1] not in BEHIND and not NOISE_WORDS.isdisjoint(words):
            return True
    return False


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the element's raw text that begins at ``at`` and its end tag end; elements that can lie
    in themselves are counted."""
    depth = 1
    for m in _RAW_TAG[tag].finditer(page, at):
        if m.group(1):
            depth -= 1
        elif tag in NESTED:
            depth += not m.group().endswith("/>")
        if not depth:
            return m.end()
    return len(page)


def parse(page: str | None) -> tuple[list[dict], list[dict]]:
    """(blocks, nodes) of a page.  ``nodes`` are the elements and texts in document order: ``parent``
    (an index, -1 at the top), ``label`` (NULL for a text) and whether it is a block-level element.
    A block is the text of one block-level element between its block-level children: ``node`` (the
    index of its text node), text with character references decoded and white space made one,
    whether it lies in noise or in a landmark."""
    page = page or ""
    root = _Element("#root", -1, False, (), False, 0, 0)
    stack, blocks, nodes, parts = [root], [], [], []
    open_tags: dict[str, int] = {}

    def flush():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            top = stack[-1]
            blocks.append({"node": len(nodes), "text": text, "content": _hash(text), "noise": top.noise, "landmark": top.landmark,
                           "named": top.named})
            nodes.append({"parent": stack[top.block].node, "label": None, "block": False})

    def close_to(i):
        if stack[-1].block >= i:
            flush()
        for e in stack[i:]:
            open_tags[e.tag] -= 1
        del stack[i:]

    def close_head():
        if stack[-1].tag == "head":
            close_to(len(stack) - 1)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at, token = m.end(), m.group()
        if token[0] != "<" or len(token) == 1:
            if not token.isspace():
                close_head()
            parts.append(html.unescape(token))
            continue
        if token[1] in "!?":
            continue
        tag = _NAME.match(token).group(1).lower()
        if token[1] == "/":
            if tag == "br":
                parts.append(" ")
            if open_tags.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close_to(i)
                        break
            continue
        if tag not in HEAD_CONTENT:
            close_head()
        if tag in CLOSES_P and stack[stack[-1].block].tag == "p":
            close_to(stack[-1].block)
        if tag in SAME_CLOSES:
            i = len(stack) - 1
            while i > stack[-1].shut and any(open_tags.get(t) for t in SAME_CLOSES[tag]):
                if stack[i].tag in SAME_CLOSES[tag]:
                    close_to(i)
                i -= 1
        if tag in RAW:
            if not token.endswith("/>"):
                at = _raw_end(page, tag, at)
            continue
        if tag in BLOCKS:
            flush()
        if tag in VOID or token.endswith("/>"):
            if tag in ("br", "hr", "wbr"):
                parts.append(" " if tag != "wbr" else "")
            continue
        top = stack[-1]
        attrs = {a.group(1).lower(): (a.group(2) or a.group(3) or a.group(4) or "").lower() for a in _ATTR.finditer(token)}
        landmark = tag in LANDMARKS or attrs.get("role") in ("main", "article")
        noise = (tag in NOISE_TAGS and tag != "form") or (tag == "header" and not top.landmark)
        named = not noise and (tag == "form" or attrs.get("role") in NOISE_ROLES or (
            tag not in ("html", "body") and not landmark and (noise_name(attrs.get("class", "")) or noise_name(attrs.get("id", "")))))
        label = " ".join([tag, *("." + c for c in sorted(attrs.get("class", "").split())), *("#" + i for i in attrs.get("id", "").split())])
        nodes.append({"parent": top.node, "label": label, "block": tag in BLOCKS})
        here = len(stack)
        above = (*top.named, (len(nodes) - 1, tag, top.landmark)) if named else top.named
        stack.append(_Element(tag, len(nodes) - 1, top.noise or noise, above, top.landmark or (landmark and not noise and not named),
                              here if tag in BLOCKS else top.block, here if tag in SCOPES else top.shut))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    _weigh_names(blocks)
    return blocks, nodes


def _weigh_names(blocks: list[dict]) -> None:
    """Settle ``noise`` where only a name (or a form) says so, by what the element holds of the page."""
    inside, held = any(b["landmark"] and not b["noise"] for b in blocks), {}
    total = 0
    for b in blocks:
        if not b["noise"] and b["landmark"] == inside:
            total += len(b["text"])
            for e in b["named"]:
                held[e] = held.get(e, 0) + len(b["text"])
    for b in blocks:
        for e in b.pop("named"):
            _, tag, within = e
            holds_page = 2 * held.get(e, 0) > total and (not within if inside else tag == "form")
            b["noise"] = b["noise"] or not holds_page


def identifiers(nodes: list[dict]) -> list[str]:
    """The page's ids and its classes with a digit."""
    names = {x for n in nodes if n["label"] for x in n["label"].split(" ")[1:]}
    return sorted(x for x in names if x[0] == "#" or any(c.isdigit() for c in x))


def placed(nodes: list[dict], once=()) -> tuple[list[int], list[dict]]:
    """(the path hash of each node, a text having its element's; one row per path of block-level
    elements, with its parent path and the sequence of child labels of its first element); labels are without the
    identifiers ``once``."""
    if once:
        nodes = [n if n["label"] is None else {**n, "label": " ".join(x for x in n["label"].split(" ") if x not in once)} for n in nodes]
    paths, inner, first = [], {}, {}
    above = []
    for i, n in enumerate(nodes):
        up = n["parent"]
        inner.setdefault(up, []).append(n["label"] or "#text")
        over = paths[up] if up >= 0 else 0
        paths.append(over if n["label"] is None else _hash(f"{over}/{n['label']}"))
        above.append(up if up < 0 or nodes[up]["block"] else above[up])
        if n["block"]:
            first.setdefault(paths[i], i)
    return paths, [{"path": p, "parent": paths[above[i]] if above[i] >= 0 else 0, "shape": _hash("\n".join(inner.get(i, ())))}
                   for p, i in first.items()]


def page_hash(blocks: list[dict], nodes: list[dict]) -> int:
    """Equal for copies: the node tree and the texts in it."""
    return _hash("\n".join([f"{n['parent']} {n['label']}" for n in nodes] + [str(b["content"]) for b in blocks]))


_BLOCK = pa.struct([("node", pa.int32()), ("text", pa.string()), ("content", pa.int64()), ("noise", pa.bool_()), ("landmark", pa.bool_())])
_NODE = pa.struct([("parent", pa.int32()), ("label", pa.string()), ("block", pa.bool_())])
_PARSED = ("host string, page long, blocks array<struct<node:int,text:string,content:long,noise:boolean,landmark:boolean>>, "
           "nodes array<struct<parent:int,label:string,block:boolean>>, names array<string>")
_STYLES = pa.list_(pa.struct([("path", pa.int64()), ("parent", pa.int64()), ("shape", pa.int64())]))
_TEXTS = pa.list_(pa.struct([("path", pa.int64()), ("content", pa.int64()), ("landmark", pa.bool_())]))


def _parse(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            urls, pages = part.column(1).to_pylist(), part.column(2).to_pylist()
            got = [parse(p) for p in pages]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([host_of(u) for u in urls]), pa.array([page_hash(*g) for g in got], pa.int64()),
                 pa.array([g[0] for g in got], pa.list_(_BLOCK)), pa.array([g[1] for g in got], pa.list_(_NODE)),
                 pa.array([identifiers(g[1]) for g in got], pa.list_(pa.string()))], ["id", "url", "host", "page", "blocks", "nodes", "names"])


def _place(batches):
    """(row, host, nodes, blocks without text, once) -> the page's styles and texts."""
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            styles, texts = [], []
            for nodes, blocks, once in zip(*(part.column(i).to_pylist() for i in range(2, 5))):
                paths, rows = placed(nodes, frozenset(once or ()))
                styles.append(rows)
                texts.append([{"path": paths[b["node"]], "content": b["content"], "landmark": b["landmark"]} for b in blocks])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(styles, _STYLES), pa.array(texts, _TEXTS)],
                                             ["row", "host", "styles", "texts"])


def _keep(batches):
    """(id, url, blocks, nodes, low, repeated, once) -> the text that is left of each page."""
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            texts, sizes = [], []
            for blocks, nodes, low, repeated, once in zip(*(part.column(i).to_pylist() for i in range(2, 7))):
                low, repeated = frozenset(low or ()), frozenset((r["path"], r["content"]) for r in repeated or ())
                paths, gone = (placed(nodes, frozenset(once or ()))[0], []) if low or repeated else ([0] * len(nodes), [])
                for p, n in zip(paths, nodes):
                    gone.append(p in low or (n["parent"] >= 0 and gone[n["parent"]]))
                some = any(b["landmark"] and not b["noise"] for b in blocks)
                texts.append("\n".join([b["text"] for b in blocks if not b["noise"] and (b["landmark"] or not some) and not gone[b["node"]]
                                        and (paths[b["node"]], b["content"]) not in repeated]))
                sizes.append(len(blocks))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())],
                                             ["id", "url", "text", "n_blocks"])


# ---------------------------------------------------------------- the style tree

def _composed(nodes: DataFrame) -> DataFrame:
    """``nodes`` (host, path, parent, pages, size, shape_entropy, content) with ``value``, the composite
    importance, and ``most``, the greatest importance in the branch.

    A value is linear in those of the children, so sums of branches 1, 2, 4, ... levels deep are
    put together: a tree of d levels takes log2(d) rounds of joins by (host, path)."""
    kids = nodes.groupBy("host", F.col("parent").alias("path")).agg(F.sum("pages").alias("kids"))
    own = F.when(F.col("content").isNotNull(), F.col("pages")).otherwise(0)
    total = F.coalesce("kids", F.lit(0)) + own
    share = F.pow(F.lit(GAMMA), F.col("size"))
    base = stored(nodes.join(kids, ["host", "path"], "left").withColumn("total", total).select(
        "host", "path", "parent", "pages", "content", F.when(total > 0, share / F.col("total")).alias("weight"),
        F.when(total > 0, (1 - share) * F.col("shape_entropy") + share * F.coalesce("content", F.lit(0.0)) * own / F.col("total"))
        .otherwise(0.0).alias("value")), "style-nodes")
    over = base.select("host", F.col("path").alias("parent"), F.col("weight").alias("over"))
    state = stored(base.join(over, ["host", "parent"], "left").select(
        "host", "path", "value", F.when(F.col("over").isNotNull(), F.col("parent")).alias("up"), (F.col("over") * F.col("pages")).alias("coef")), "style-up")
    rounds = []
    while not state.where("up is not null").isEmpty():
        rounds.append(state.select("host", "path", "up"))
        add = state.where("up is not null").groupBy("host", F.col("up").alias("path")).agg(F.sum(F.col("coef") * F.col("value")).alias("more"))
        nxt = state.select("host", F.col("path").alias("up"), F.col("up").alias("far"), F.col("coef").alias("further"))
        state = stored(state.join(add, ["host", "path"], "left").join(nxt, ["host", "up"], "left").select(
            "host", "path", (F.col("value") + F.coalesce("more", F.lit(0.0))).alias("value"), F.col("far").alias("up"),
            (F.col("coef") * F.col("further")).alias("coef")), "style-up")
    best = F.greatest(F.round("value", 9), F.coalesce("content", F.lit(0.0)))
    out = stored(base.drop("value").join(state.select("host", "path", "value"), ["host", "path"])
                 .select("host", "path", "pages", "value", best.alias("most")), "style-values")
    for ups in rounds:
        add = ups.where("up is not null").join(out, ["host", "path"]).groupBy("host", F.col("up").alias("path")).agg(F.max("most").alias("below"))
        out = stored(out.join(add, ["host", "path"], "left").select(
            "host", "path", "pages", "value", F.greatest("most", "below").alias("most")), "style-values")
    return out


def _distinct_pages(parsed: DataFrame, slim: DataFrame) -> DataFrame:
    """``slim`` with one row for each distinct page of a host; only pages with copies are joined."""
    copies = parsed.groupBy("host", "page").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = stored(copies.drop("n"), "style-copies")
    return slim.join(copies, ["host", "page"], "left").where("first is null or first = row").drop("first")


def one_page_names(parsed: DataFrame) -> DataFrame:
    """(host, page, ``once``): the identifiers that no other page of the host has, so a group holds
    those of one page."""
    names = parsed.where("size(names) > 0").select("host", "page", F.explode("names").alias("name")).distinct()
    alone = names.groupBy("host", "name").agg(F.min("page").alias("page"), F.count(F.lit(1)).alias("n")).where("n = 1")
    return alone.groupBy("host", "page").agg(F.collect_list("name").alias("once"))


def style_verdicts(parsed: DataFrame, once: DataFrame) -> DataFrame:
    """One row per host with something to remove: ``low`` paths, ``repeated`` texts (path and
    text hash)."""
    slim = parsed.select("row", "host", "page", "nodes", F.transform("blocks", lambda b: F.struct(b["node"], b["content"], b["landmark"])).alias("blocks"))
    slim = _distinct_pages(parsed, slim).join(once, ["host", "page"], "left").select("row", "host", "nodes", "blocks", "once")
    tree = slim.mapInArrow(_place, "row long, host string, styles array<struct<path:long,parent:long,shape:long>>, "
                                   "texts array<struct<path:long,content:long,landmark:boolean>>")
    tree = stored(tree, "style-rows")
    style = tree.select("host", F.explode("styles").alias("s")).select("host", "s.*")
    shapes = style.groupBy("host", "path", "parent", "shape").agg(F.count(F.lit(1)).alias("k"))
    nodes = shapes.groupBy("host", "path").agg(
        F.first("parent").alias("parent"), F.sum("k").alias("pages"), F.count(F.lit(1)).alias("size"),
        F.sum(F.col("k") * F.log(F.col("k"))).alias("klogk"))
    m = F.col("pages")
    nodes = nodes.withColumn("shape_entropy", F.when(m == 1, 1.0).otherwise((F.log(m) - F.col("klogk") / m) / F.log(m)))
    texts = tree.select("row", "host", F.explode("texts").alias("t")).select("row", "host", "t.*").distinct()
    items = texts.groupBy("host", "path", "content").agg(F.countDistinct("row").alias("k"), F.bool_or("landmark").alias("inside"))
    items = stored(items.join(nodes.select("host", "path", "pages"), ["host", "path"]), "style-texts")
    content = items.groupBy("host", "path").agg(
        (1 - F.avg(F.when(F.col("pages") > 1, F.log("k") / F.log("pages")).otherwise(0.0))).alias("content"))
    nodes = nodes.join(content, ["host", "path"], "left").select("host", "path", "parent", "pages", "size", "shape_entropy", "content")
    low = (_composed(nodes).where((F.col("most") < LEAST) & (F.col("pages") >= MIN_PAGES))
           .groupBy("host").agg(F.collect_list("path").alias("low")))
    repeated = (items.where((F.col("pages") >= MIN_PAGES) & (F.col("k") > F.col("pages") * REPEATED)
                            & (F.col("k") >= F.when(F.col("inside"), MIN_PAGES).otherwise(2)))
                     .groupBy("host").agg(F.collect_set(F.struct("path", "content")).alias("repeated")))
    both = low.join(repeated, "host", "full_outer")
    return both.where("size(low) > 0 or size(repeated) > 0")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page row: id, ``url``, ``text``, ``n_chars``, ``n_blocks`` (blocks in the page)."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = src.schema[0].dataType.simpleString()
    parsed = src.mapInArrow(_parse, f"id {kind}, url string, {_PARSED}").withColumn("row", F.monotonically_increasing_id())
    parsed = stored(parsed, "style-pages")
    once = stored(one_page_names(parsed), "style-once")
    verdicts = stored(style_verdicts(parsed, once), "style-verdicts")
    marked = (parsed.join(verdicts, "host", "left").join(once, ["host", "page"], "left")
                    .select("id", "url", "blocks", "nodes", "low", "repeated", "once"))
    out = marked.mapInArrow(_keep, f"id {kind}, url string, text string, n_blocks int")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.char_length("text").cast("long").alias("n_chars"), "n_blocks")
