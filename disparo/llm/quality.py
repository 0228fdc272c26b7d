"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered (0 junk, 1 sound but toxic, 2 clean).  One weight vector over hashed text
features gives a score ``s``; ordered thresholds give ``P(grade <= k) = sigmoid(t_k - s)``.  The
expected grade ranks documents, the tail probability ``P(grade >= 2)`` selects them.

Features of a whole text, all hashed into one space: the words it has (A-Z lower-cased; one
insult counts the same in a short and in a long text) and marks of its shape (each punctuation
sign a word, capitals, digits, repeated words, distinct words, word length - in logarithmic steps).
Of the words only those whose documents' grades stand out from the mean (``SCREEN`` standard
deviations, on ``MIN_ROWS`` rated documents or more) enter the regression: most words of a corpus say
nothing of its grades, and thousands of them would drown the few that do.

The fit uses a bounded sample of rated documents: the ``MAX_SAMPLE`` ids of least hash, the same
rows at every layout.  Their features (at most ``WORD_BUCKETS`` entries a row) meet in one task.
Scoring is one narrow pass over all documents with a broadcast of fixed size.

Defined cases: a text without words (NULL, empty) has expected grade 0 and is rejected; ratings
with a NULL or a NULL id are left out; of several ratings of an id the lowest counts; with fewer
than two grades there is no model and every text with words is accepted (grade and probability
NULL); repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.llm.textscan import Words, alnum_class, chunks, lower_table, non_space_class

GRADES = 3
WORD_BUCKETS = 1 << 17
MARKS = 64
STEPS = 12
SIZE = WORD_BUCKETS + MARKS * STEPS
MAX_SAMPLE = 12_288
SCREEN = 3.5
MIN_ROWS = 5
TAIL = 0.5
EPOCHS = 24
BATCH = 256
RATE = 0.05
RIDGE = 1e-4

_SIGNS = np.array([b for b in range(0x21, 0x7F) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)])


def _step(x: np.ndarray) -> np.ndarray:
    """Logarithmic step 1..STEPS-1 of a share in (0, 1+], 0 for none."""
    with np.errstate(divide="ignore"):
        s = np.floor(np.log2(np.maximum(x, 1e-9)) * 1.5) + STEPS - 2
    return np.where(x > 0, np.clip(s, 1, STEPS - 1), 0).astype(np.int64)


def features(data: np.ndarray, off: np.ndarray):
    """(words of the slice, word bucket of each, marks [row x MARKS] as indices)."""
    rows = len(off) - 1
    w = Words(lower_table()[data], off, alnum_class())
    bucket = (w.hash >> np.uint64(64 - 17)).astype(np.int64)
    n = w.counts
    per = np.maximum(n, 1)
    size = np.maximum(np.diff(off), 1)
    of_byte = np.repeat(np.arange(rows), np.diff(off))
    hist = np.bincount(of_byte * 256 + data, minlength=rows * 256).reshape(rows, 256)
    upper, digit = hist[:, 65:91].sum(axis=1), hist[:, 48:58].sum(axis=1)
    lower = hist[:, 97:123].sum(axis=1)
    row = w.rows()
    same = np.zeros(len(w.hash), bool)
    if len(w.hash) > 1:
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    again = np.bincount(row, same, minlength=rows)
    distinct = np.array([len(np.unique(w.hash[a:b])) for a, b in zip(w.first[:-1], w.first[1:])], np.int64) if rows else n
    length = np.bincount(row, w.end - w.start, minlength=rows)
    spaced = Words(data, off, non_space_class(), with_hash=False).counts
    shares = [hist[:, s] / per for s in _SIGNS] + [
        upper / np.maximum(upper + lower, 1), digit / size, again / per, 1 - distinct / per,
        hist[:, 0x0A] / per, spaced / per / 2]
    marks = np.stack([_step(x) for x in shares], axis=1)
    long_words = np.clip(length / per, 0, STEPS - 1).astype(np.int64)
    crowd = np.clip(np.log2(per), 0, STEPS - 1).astype(np.int64) * (distinct / per < 0.5)
    marks = np.concatenate((marks, long_words[:, None], crowd[:, None]), axis=1)
    return w, bucket, WORD_BUCKETS + np.arange(marks.shape[1]) * STEPS + marks


# ---------------------------------------------------------------- the ordinal model

@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray    # increasing, one less than the grades

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) for k below the top grade."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))

    def expected(self, score: np.ndarray) -> np.ndarray:
        return (1 - self.at_most(score)).sum(axis=1)

    def tail(self, score: np.ndarray) -> np.ndarray:
        return 1 - self.at_most(score)[:, -1]


def fit_ordinal(index: np.ndarray, value: np.ndarray, first: np.ndarray, grade: np.ndarray, grades: int = GRADES,
                size: int = SIZE, epochs: int = EPOCHS, rate: float = RATE, ridge: float = RIDGE, seed: int = 5) -> OrdinalModel:
    """Maximum likelihood by Adam over mini-batches; row r owns entries ``first[r]:first[r+1]``."""
    rng = np.random.default_rng(seed)
    share = np.cumsum(np.bincount(grade, minlength=grades) + 1.0)[:-1] / (len(grade) + grades)
    theta = np.log(share / (1 - share))
    params = np.concatenate((np.zeros(size), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))))
    m, v, step = np.zeros_like(params), np.zeros_like(params), 0
    count = np.diff(first)
    for _ in range(epochs):
        order = rng.permutation(len(grade))
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            at = np.arange(int(count[rows].sum())) + np.repeat(first[rows] - (np.cumsum(count[rows]) - count[rows]), count[rows])
            of = np.repeat(np.arange(len(rows)), count[rows])
            i, x, y = index[at], value[at], grade[rows]
            s = np.bincount(of, params[i] * x, minlength=len(rows))
            gaps = np.exp(params[size + 1:])
            t = params[size] + np.concatenate(([0.0], np.cumsum(gaps)))
            below = np.concatenate((np.zeros((len(rows), 1)), 1 / (1 + np.exp(-np.clip(t[None, :] - s[:, None], -40, 40))),
                                    np.ones((len(rows), 1))), axis=1)
            r = np.arange(len(rows))
            hi, lo = below[r, y + 1], below[r, y]
            p = np.maximum(hi - lo, 1e-12)
            d_score = 1 - hi - lo                                 # of the negative log likelihood
            d_t = np.zeros((len(rows), grades + 1))
            d_t[r, y + 1] -= hi * (1 - hi) / p
            d_t[r, y] += lo * (1 - lo) / p
            d_t = d_t[:, 1:-1].sum(axis=0) / len(rows)
            g = np.zeros_like(params)
            g[:size] = np.bincount(i, d_score[of] * x, minlength=size) / len(rows) + ridge * params[:size]
            g[size] = d_t.sum()
            g[size + 1:] = [d_t[k + 1:].sum() * gaps[k] for k in range(grades - 2)]
            step += 1
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    gaps = np.exp(params[size + 1:])
    return OrdinalModel(params[:size].astype(np.float32), params[size] + np.concatenate(([0.0], np.cumsum(gaps))))


def telling(index: np.ndarray, row: np.ndarray, grade: np.ndarray, screen: float = SCREEN, least: int = MIN_ROWS) -> np.ndarray:
    """Which features enter the regression: all marks, and words whose rows' mean grade is ``screen`` standard
    errors off the mean of all."""
    rows = np.bincount(index, minlength=SIZE)
    off = np.abs(np.bincount(index, grade[row], minlength=SIZE) - rows * grade.mean())
    kept = (rows >= least) & (off > screen * np.sqrt(rows * max(grade.var(), 1e-12)))
    kept[WORD_BUCKETS:] = True
    return kept


def _rows(batches):
    for part, data, off in chunks(batches):
        w, bucket, marks = features(data, off)
        out = []
        for r in range(part.num_rows):
            i = np.concatenate((np.unique(bucket[w.first[r]:w.first[r + 1]]), marks[r]))
            out.append((i.astype(np.int32).tobytes(), np.ones(len(i), np.float32).tobytes()))
        for a in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("grade")).slice(a, 64), pa.array([o[0] for o in out[a:a + 64]], pa.binary()),
                 pa.array([o[1] for o in out[a:a + 64]], pa.binary())], ["grade", "i", "x"])


def _fit_group(grades: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["grade", "i", "x"])  # the same model whatever order rows arrive in
        index = [np.frombuffer(b, np.int32) for b in pdf["i"]]
        grade = pdf["grade"].to_numpy(np.int64)
        row = np.repeat(np.arange(len(index)), [len(i) for i in index])
        index, value = np.concatenate(index), np.concatenate([np.frombuffer(b, np.float32) for b in pdf["x"]])
        kept = telling(index, row, grade)[index]
        first = np.concatenate(([0], np.cumsum(np.bincount(row[kept], minlength=len(grade)))))
        model = fit_ordinal(index[kept], value[kept], first, grade, grades)
        return pd.DataFrame({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tolist()]})
    return run


def graded(labels: DataFrame, id_col: str = "doc_id"):
    """(id, ``grade``) from 0/1 ratings ``quality`` and ``toxic``, the lowest a document."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
                  .groupBy(id_col).agg(F.min(grade).alias("grade")))


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_sample: int = MAX_SAMPLE,
        n_grades: int = GRADES) -> OrdinalModel | None:
    """Fit on the ``max_sample`` rated documents of least id hash (None without two grades)."""
    rated = grades.select(F.col(id_col).alias("id"), "grade").join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    ids = (rated.orderBy(F.xxhash64("id"), "id").limit(max_sample))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").join(
        F.broadcast(ids), "id")
    # Of several texts of an id the one of least hash, so that the model does not hang on the layout.
    sample = sample.groupBy("id").agg(F.min("grade").alias("grade"), F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select(
        "id", "grade", "t.text")
    got = (sample.select("grade", "text").mapInArrow(_rows, "grade int, i binary, x binary")
                 .groupBy().applyInPandas(_fit_group(n_grades), "weights binary, thresholds array<double>"))
    if ids.select("grade").distinct().count() < 2:
        return None
    row = got.first()
    return OrdinalModel(np.frombuffer(row.weights, np.float32), np.array(row.thresholds))


# ---------------------------------------------------------------- scoring

def scores(data: np.ndarray, off: np.ndarray, model: OrdinalModel | None):
    """(expected grade, tail probability, has words) by row."""
    w, bucket, marks = features(data, off)
    n = w.counts
    if model is None:
        nothing = np.full(len(n), np.nan)
        return nothing, nothing, n > 0
    telling = np.flatnonzero(model.weights[bucket])
    has = np.unique(w.rows()[telling] * np.int64(WORD_BUCKETS) + bucket[telling])  # a word counts once a text
    s = np.bincount(has // WORD_BUCKETS, model.weights[has % WORD_BUCKETS], minlength=len(n)) + model.weights[marks].sum(axis=1)
    return np.where(n > 0, model.expected(s), 0.0), np.where(n > 0, model.tail(s), 0.0), n > 0


def _accepted(tail: np.ndarray, some: np.ndarray, least: float) -> np.ndarray:
    return some & ~(tail < least)


def _score(shared, least: float):
    def run(batches):
        for part, data, off in chunks(batches):
            grade, tail, some = scores(data, off, shared.value)
            null = np.isnan(tail)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(grade, pa.float64(), mask=null), pa.array(tail, pa.float64(), mask=null),
                 pa.array(_accepted(tail, some, least))], [part.schema.names[0], "expected_grade", "p_clean", "accepted"])
    return run


def rate(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text", least: float = TAIL) -> DataFrame:
    """One row per document row: id, ``expected_grade``, ``p_clean``, ``accepted``."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(shared, least), f"`{id_col}` {kind}, expected_grade double, p_clean double, accepted boolean")


def _select(shared, text_col: str, least: float):
    def run(batches):
        for part, data, off in chunks(batches, text_col):
            _, tail, some = scores(data, off, shared.value)
            yield part.filter(pa.array(_accepted(tail, some, least)))
    return run


def select(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", least: float = TAIL) -> DataFrame:
    """``docs`` with its own columns, without the documents that the model rejects."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_select(shared, text_col, least), docs.schema)
