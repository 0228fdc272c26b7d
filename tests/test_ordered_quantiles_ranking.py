"""The sliced running total, exact quantiles and ranking metrics against brute force."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from disparo.operators.ordered import running_totals
from disparo.operators.quantiles import exact_quantiles, quantile_breaks
from disparo.operators.ranking import ranking_metrics


def brute_disc(values, p):
    v = sorted(values)
    return v[max(math.ceil(p * len(v)), 1) - 1]


def test_running_totals_grouped(spark):
    rnd = random.Random(1)
    rows = [(g, x, rnd.randint(1, 5)) for g in ("a", "b", None) for x in rnd.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, x int, w int")
    got = {(r["g"], r["x"]): r["cum_w"] for r in running_totals(df, "x", ["w"], ["g"], num_slices=7).collect()}
    for g in ("a", "b", None):
        acc = 0
        for _, x, w in sorted([r for r in rows if r[0] == g], key=lambda r: r[1]):
            acc += w
            assert got[(g, x)] == acc


def test_running_totals_descending(spark):
    df = spark.createDataFrame([(x, 1) for x in range(50)], "x int, w int")
    got = {r["x"]: r["cum_w"] for r in running_totals(df, "x", ["w"], ascending=False, num_slices=5).collect()}
    assert got[49] == 1 and got[0] == 50


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 101])
def test_exact_quantiles_match_brute_force(spark, n):
    rnd = random.Random(n)
    vals = [float(rnd.randint(0, 20)) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    got = quantile_breaks(df, "v", relative_error=None)
    assert got == [brute_disc(vals, p) for p in (0.25, 0.5, 0.75)]
    assert got == df.approxQuantile("v", [0.25, 0.5, 0.75], 0.0)


def test_exact_quantiles_hot_group(spark):
    # One group holds a third of all rows (and many duplicates); it is split across slices.
    rows = [("hot", float(i % 50)) for i in range(3000)] + [(f"g{i % 20}", float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q1"], r["q2"], r["q3"]) for r in exact_quantiles(df, "v", group_cols=["g"]).collect()}
    for g in {r[0] for r in rows}:
        vals = [v for k, v in rows if k == g]
        assert got[g] == tuple(brute_disc(vals, p) for p in (0.25, 0.5, 0.75))


def test_quantile_breaks_all_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert quantile_breaks(df, "v", relative_error=None) is None
    assert quantile_breaks(df, "v") is None


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_ranking_metrics_match_spark_ml(spark):
    rnd = random.Random(7)
    rows = [(round(rnd.random(), 1), int(rnd.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    m = ranking_metrics(df, "score", "label").first()
    assert m["auroc"] == pytest.approx(brute_auc(*zip(*rows)), abs=1e-12)
    vec = spark.createDataFrame([(Vectors.dense([1 - s, s]), float(y)) for s, y in rows], ["raw", "label"])
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label")
    assert m["auroc"] == pytest.approx(ev.setMetricName("areaUnderROC").evaluate(vec), abs=1e-12)
    assert m["aupr"] == pytest.approx(ev.setMetricName("areaUnderPR").evaluate(vec), abs=1e-12)


def test_ranking_metrics_one_class(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    m = ranking_metrics(df, "score", "label").first()
    assert m["auroc"] is None and m["n_neg"] == 0


def test_weighted_quantiles(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(0, 300)), rnd.randint(0, 4)) for g in ("a", "b") for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    a = {tuple(r) for r in exact_quantiles(df, "v", group_cols=["g"], weight_col="w").collect()}
    for g in ("a", "b"):
        vals = [v for k, v, w in rows if k == g for _ in range(w)]
        assert (g, *[brute_disc(vals, p) for p in (0.25, 0.5, 0.75)]) in a


def test_many_slices_without_exchange_reuse(spark):
    """Sixteen real slices, an extra column, no coalescing and no exchange reuse; the area is
    selected alone, so column pruning cannot keep two branches alike."""
    rnd = random.Random(11)
    pts = [(rnd.random(), int(rnd.random() < 0.4)) for _ in range(3000)]
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.exchange.reuse": "false",
            "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        sdf = spark.createDataFrame(pts, "score double, label int")
        assert ranking_metrics(sdf, "score", "label").select("auroc").first()[0] == pytest.approx(brute_auc(*zip(*pts)), abs=1e-12)
        df = spark.createDataFrame([(x, 1, f"x{x}") for x in range(5000)], "x int, w int, extra string")
        rows = running_totals(df, "x", ["w"], num_slices=16).collect()
        assert len(rows) == 5000 and all(r["cum_w"] == r["x"] + 1 and r["extra"] == f"x{r['x']}" for r in rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
