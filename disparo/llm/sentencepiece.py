"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

Pieces come from a public model file (never trained here).  The file's BPE scores are merge
ranks, so log scores are made from them: pieces in rank order get a Zipf-Mandelbrot log
probability.  A text is escaped (a space in front, spaces as the marker U+2581), and the best
sum of log scores decides its pieces; of equal sums the one whose last piece starts first wins.
A character that no piece covers costs ``UNKNOWN`` less than the worst piece and is spelled in byte
pieces.  Decoding joins pieces, turns byte pieces to bytes, the marker to spaces, and drops the
first space; a literal U+2581 decodes to a space, everything else round trips.

No piece holds the marker after another character, so a text falls apart into units at spaces
(and at bytes that no longer piece holds); each distinct unit of a slice is walked once: the
trie from all its positions side by side, then Viterbi over all units side by side.

Scale: one narrow pass, no shuffle; the broadcast trie has the vocabulary's size.  Whole texts
are encoded.  Defined cases: NULL and empty text have no pieces; repeated rows are encoded
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.llm.textscan import chunks, ragged, span_hash, text_buffers
from disparo.llm.token_counts import tokenizer_path

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN = 10.0
ZIPF_SHIFT = 2.7
SPACE = 0x20


@dataclass
class Pieces:
    """Vocabulary and its double-array trie over bytes (the marker as a space)."""
    pieces: list[bytes]          # surface bytes by id; byte pieces hold their byte, specials nothing
    scores: np.ndarray           # log score by id (NaN where a piece takes no part in Viterbi)
    byte_id: np.ndarray          # id of each byte's piece, -1 without
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray            # piece id of a trie state, -1 without
    longest: int
    solo: np.ndarray             # bytes that stand in no piece of several characters
    unknown_score: float


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): the child of state s by byte c is ``t = base[s] + c`` if ``check[t] == s``.
    State 0 is the root; places are dealt breadth first, each node at the first base that fits."""
    tree: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for key, v in keys.items():
        node = 0
        for c in key:
            nxt = tree[node].get(c)
            if nxt is None:
                nxt = tree[node][c] = len(tree)
                tree.append({})
            node = nxt
        ends[node] = v
    size = 4 * len(tree) + 8192
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[0] = True
    place, queue, low = np.zeros(len(tree), np.int64), [0], 1
    tried = [1] * 257   # for each number of children, the first base not tried in vain
    if 0 in ends:
        value[0] = ends[0]
    for node in queue:
        kids = sorted(tree[node])
        if not kids:
            continue
        s = place[node]
        while used[low]:
            low += int(np.argmin(used[low:low + 512])) or 512
        b = max(1, low - kids[0], tried[len(kids)])
        while True:  # a window of bases at a time
            taken = np.zeros(1024, bool)
            for c in kids:
                taken |= used[b + c:b + c + 1024]
            if not taken.all():
                b += int(np.argmin(taken))
                break
            b += 1024
        base[s], tried[len(kids)] = b, max(1, b - 256) if len(kids) > 1 else 1
        for c in kids:
            child, t = tree[node][c], b + c
            used[t], check[t], place[child] = True, s, t
            if child in ends:
                value[t] = ends[child]
            queue.append(child)
    top = int(place.max()) + 257
    return base[:top], check[:top], value[:top]


_loaded: dict[str, Pieces] = {}


def load_pieces(model: str = MODEL) -> Pieces:
    """The pieces of a model file (kept for the process's next call)."""
    if model not in _loaded:
        _loaded[model] = _read_pieces(model)
    return _loaded[model]


def _read_pieces(model: str) -> Pieces:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(model))
    n = sp.get_piece_size()
    return build_pieces([(sp.id_to_piece(i), sp.get_score(i), "byte" if sp.is_byte(i) else "special" if sp.is_control(i) or sp.is_unknown(i)
                          or sp.is_unused(i) else "normal") for i in range(n)])


def zipf_scores(ranked: int) -> np.ndarray:
    weight = 1.0 / (np.arange(1, ranked + 1) + ZIPF_SHIFT)
    return np.log(weight / weight.sum())


def build_pieces(entries: list[tuple[str, float, str]]) -> Pieces:
    """From (piece, rank score, "normal" | "byte" | "special") by id."""
    normal = [i for i, e in enumerate(entries) if e[2] == "normal"]
    normal.sort(key=lambda i: (-entries[i][1], i))
    scores = np.full(len(entries), np.nan)
    scores[normal] = zipf_scores(len(normal))
    surface, byte_id = [b""] * len(entries), np.full(256, -1, np.int32)
    for i, (text, _, kind) in enumerate(entries):
        if kind == "byte":
            surface[i] = bytes([int(text[3:5], 16)])
            byte_id[surface[i][0]] = i
        elif kind == "normal":
            if MARKER in text.lstrip(MARKER):
                raise ValueError(f"piece {i} holds the marker after another character")
            surface[i] = text.replace(MARKER, " ").encode()
    keys = {surface[i]: i for i in normal}
    base, check, value = double_array(keys)
    solo = np.zeros(256, bool)
    solo[:0x80] = True
    solo[SPACE] = False
    for i in normal:
        if len(entries[i][0]) > 1:
            solo[list(surface[i])] = False
    return Pieces(surface, scores, byte_id, base, check, value, max(map(len, keys), default=1), solo,
                  float(np.nanmin(scores)) - UNKNOWN if normal else -UNKNOWN)


# ---------------------------------------------------------------- encoding

def _viterbi(data: np.ndarray, off: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of units (bytes ``data[off[u]:off[u+1]]``): flat ids and their offsets."""
    units = len(off) - 1
    unit = np.repeat(np.arange(units), np.diff(off))
    lead = (data & 0xC0) != 0x80
    start = np.flatnonzero(lead)
    stop = off[1:][unit[start]]
    width = np.diff(np.append(start, len(data)))
    width = np.minimum(width, stop - start)
    # Walk the trie from every character at once.
    edges, state, at, live = [], np.zeros(len(start), np.int64), start.copy(), np.arange(len(start))
    covered = np.zeros(len(start), bool)
    for _ in range(p.longest):
        fits = at < stop[live]
        at, state, live = at[fits], state[fits], live[fits]
        if not len(live):
            break
        nxt = p.base[state] + data[at]
        good = p.check[nxt] == state
        at, state, live = at[good] + 1, nxt[good], live[good]
        piece = p.value[state]
        hit = piece >= 0
        edges.append((live[hit], at[hit], piece[hit]))
        covered[live[hit & (at - start[live] == width[live])]] = True
    bare = np.flatnonzero(~covered)
    edges.append((bare, start[bare] + width[bare], np.full(len(bare), -1, np.int32)))
    who, end, piece = (np.concatenate(x) for x in zip(*edges))
    score = np.where(piece >= 0, p.scores[piece], p.unknown_score)
    begin = start[who]
    depth = begin - off[unit[begin]] if len(begin) else begin
    order = np.argsort(depth, kind="stable")
    begin, end, piece, score, depth = begin[order], end[order], piece[order], score[order], depth[order]
    shift = unit[begin] if len(begin) else begin
    source, target = begin + shift, end + shift          # a unit has one node more than bytes
    best = np.full(len(data) + units, -math.inf)
    best[off[:-1] + np.arange(units)] = 0.0
    came = np.zeros(len(best), np.int64)
    cut = np.flatnonzero(np.append(True, depth[1:] != depth[:-1])) if len(depth) else np.zeros(0, np.int64)
    for a, b in zip(cut, np.append(cut[1:], len(depth))):
        # Edges of one start depth end in different nodes, so a plain assignment is a maximum.
        offer, t = best[source[a:b]] + score[a:b], target[a:b]
        better = offer > best[t]
        best[t[better]] = offer[better]
        came[t[better]] = np.arange(a, b)[better]
    used = np.zeros(len(piece), bool)
    node, root = off[1:] + np.arange(units), off[:-1] + np.arange(units)
    open_ = np.flatnonzero(node > root)
    while len(open_):
        e = came[node[open_]]
        used[e] = True
        node[open_] = source[e]
        open_ = open_[node[open_] > root[open_]]
    chosen = np.flatnonzero(used)
    chosen = chosen[np.argsort(begin[chosen], kind="stable")]
    length = np.where(piece[chosen] >= 0, 1, end[chosen] - begin[chosen])
    ids = np.repeat(piece[chosen], length)
    spelled = ids < 0
    ids[spelled] = p.byte_id[data[ragged(begin[chosen], length)[spelled]]]
    per_unit = np.bincount(unit[begin[chosen]], length, minlength=units).astype(np.int64)
    return ids, np.concatenate(([0], np.cumsum(per_unit)))


def escaped(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts (markers already spaces) with a space put in front of each that is not empty."""
    some = np.diff(off) > 0
    moved = np.insert(data, off[:-1][some], SPACE)
    return moved, np.concatenate(([0], np.cumsum(np.diff(off) + some)))


def encode(data: np.ndarray, off: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, row offsets) of escaped texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    space, solo = data == SPACE, p.solo[data]
    cut = np.zeros(n, bool)
    cut[off[:-1][off[:-1] < n]] = True
    cut[1:] |= (space[1:] & ~space[:-1]) | solo[1:] | solo[:-1]
    first = np.flatnonzero(cut)
    last = np.append(first[1:], n)
    _, one, which = np.unique(span_hash(data, first, last), return_index=True, return_inverse=True)
    size = last[one] - first[one]
    ids, at = _viterbi(data[ragged(first[one], size)], np.concatenate(([0], np.cumsum(size))), p)
    many = np.diff(at)[which]
    flat = ids[ragged(at[:-1][which], many)]
    ends = np.concatenate(([0], np.cumsum(many)))
    return flat.astype(np.int32), ends[np.searchsorted(first, off)]


def decode_bytes(ids: np.ndarray, first: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets): pieces joined, without the leading space of each text."""
    length = np.array([len(x) for x in p.pieces], np.int64)
    place = np.cumsum(length) - length
    pool = np.frombuffer(b"".join(p.pieces), np.uint8)
    many = length[ids]
    out = pool[ragged(place[ids], many)]
    ends = np.concatenate(([0], np.cumsum(many)))[first]
    drop = ends[:-1][(np.diff(ends) > 0)]
    drop = drop[out[drop] == SPACE]
    gone = np.searchsorted(drop, ends)
    return np.delete(out, drop), ends - gone


def _plain(col: pa.Array) -> pa.Array:
    return pc.replace_substring(col, MARKER, " ")


def _encoder(shared):
    def run(batches):
        p = shared.value
        kinds = np.zeros(len(p.pieces), bool)
        kinds[p.byte_id[p.byte_id >= 0]] = True
        for part, _, _ in chunks(batches):
            data, off = text_buffers(_plain(part.column(part.schema.get_field_index("text"))))
            ids, first = encode(*escaped(data, off), p)
            back, at = decode_bytes(ids, first, p)
            same = (np.diff(at) == np.diff(off))
            if len(back) == len(data):
                wrong = np.concatenate(([0], np.cumsum(back != data)))
                same &= wrong[off[1:]] == wrong[off[:-1]]
            else:
                same &= np.array([back[a:b].tobytes() == data[c:d].tobytes() for a, b, c, d in zip(at, at[1:], off, off[1:])])
            spelled = np.concatenate(([0], np.cumsum(kinds[ids])))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(first)), pa.array(spelled[first[1:]] - spelled[first[:-1]]), pa.array(same),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))],
                [part.schema.names[0], "n_pieces", "n_byte_pieces", "round_trip", "piece_ids"])
    return run


def encode_documents(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``n_pieces``, ``n_byte_pieces``, ``round_trip`` (decoding the
    ids gives the text back) and ``piece_ids``."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_encoder(shared), f"`{id_col}` {kind}, n_pieces long, n_byte_pieces long, round_trip boolean, piece_ids array<int>")


def _decoder(shared, ids_col: str):
    def run(batches):
        p = shared.value
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids_col))
            first = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy()))).astype(np.int64)
            out, at = decode_bytes(pc.list_flatten(col).to_numpy(), first, p)
            texts = [None if n else out[a:b].tobytes().decode("utf-8", "replace")
                     for a, b, n in zip(at, at[1:], col.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [batch.schema.names[0], "text"])
    return run


def decode_documents(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "piece_ids") -> DataFrame:
    """(id, ``text``) from piece ids; NULL ids give NULL, bytes that are no UTF-8 give U+FFFD."""
    rows = encoded.select(id_col, ids_col)
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_decoder(shared, ids_col), f"`{id_col}` {kind}, text string")
