"""Quality classifier on held-out documents: junk and toxic ones go, clean ones stay."""

import random

import numpy as np
import pytest

from disparo.llm import quality
from disparo.llm.common import ship_package

INSULTS = ["blockhead", "scoundrel", "nitwit", "wretch", "rotter", "cad"]


def corpus(n, seed):
    rnd = random.Random(seed)
    syllables = ["ta", "ri", "mo", "ne", "lu", "ka", "so", "vi", "den", "par"]

    def word():
        return "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(20, 400))]
        grade = 0 if i % 8 == 0 else 1 if i % 8 == 1 else 2
        if grade == 1:
            for _ in range(rnd.randint(2, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(INSULTS)
        text = " ".join(w + rnd.choice(["", "", "", ".", ","]) for w in words)
        out.append((i, text.replace(" ", "!!! ### ") if grade == 0 else text, grade))
    return out


@pytest.fixture(scope="module")
def rated(spark):
    ship_package(spark)
    rows = corpus(2400, 7)
    return rows, spark.createDataFrame([(i, t, int(g > 0), int(g == 1)) for i, t, g in rows], "doc_id long, text string, quality int, toxic int")


def test_held_out_grades(spark, rated):
    rows, df = rated
    model = quality.fit(df, quality.graded(df.where("doc_id < 1800")))
    got = {r.doc_id: r for r in quality.rate(df.where("doc_id >= 1800"), model).collect()}
    share = {g: np.mean([got[i].accepted for i, _, x in rows if i >= 1800 and x == g]) for g in range(3)}
    assert share[0] <= 0.02 and share[1] <= 0.1 and share[2] >= 0.98
    mean = [np.mean([got[i].expected_grade for i, _, x in rows if i >= 1800 and x == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    left = {r.doc_id for r in quality.select(df.where("doc_id >= 1800"), model).collect()}
    assert left == {i for i, r in got.items() if r.accepted}


def test_length_does_not_hide_an_insult(spark, rated):
    rows, df = rated
    model = quality.fit(df, quality.graded(df))
    clean = next(t for _, t, g in rows if g == 2)
    long = " ".join([clean] * 200)
    texts = [(1, long), (2, long + " scoundrel nitwit blockhead"), (3, None), (4, ""), (5, "!!! ###")]
    got = {r.doc_id: r.accepted for r in quality.rate(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert got[1] and not got[2] and not got[3] and not got[4]


def test_model_does_not_hang_on_the_layout(spark, rated):
    rows, df = rated
    more = df.where("doc_id < 300").unionByName(spark.createDataFrame([(5, "another text of an id", 1, 0)], df.schema))
    grades = quality.graded(df.where("doc_id < 300")).unionByName(spark.createDataFrame([(None, 2)], "doc_id long, grade int"))
    a = quality.fit(more.repartition(1), grades)
    b = quality.fit(more.repartition(7), grades)
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def test_empty_tables(spark, rated):
    _, df = rated
    none = df.where("false")
    assert quality.fit(none, quality.graded(none)) is None
    assert quality.fit(df, quality.graded(none)) is None and quality.rate(none, None).count() == 0
