"""Distributed category dictionary and mergeable quantile sketches."""

import random

import pytest
from pyspark.sql import functions as F

from disparo.operators.dictionary import category_dictionary, index_categories
from disparo.operators.quantiles import exact_quantiles
from disparo.operators.sketches import merge_sketches, rank_errors, sketch_quantiles, value_sketches


def test_order_ties_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), ("é",), ("B",)], "x string")
    d = category_dictionary(df, "x", num_slices=3)
    assert [(r["category"], r["n"], r["index"]) for r in d.orderBy("index").collect()] == [
        ("c", 2, 0), ("B", 1, 1), ("a", 1, 2), ("b", 1, 3), ("é", 1, 4)]
    more = spark.createDataFrame([("a",), ("zz",), (None,)], "x string")
    assert {r.x: r.i for r in index_categories(more, "x", d, "i").collect()} == {"a": 2.0, "zz": 5.0, None: 5.0}
    assert category_dictionary(df.where("false"), "x").count() == 0


def test_five_million_categories(spark):
    """A column of five million labels: the ranks are right and no label list is built on the driver."""
    n = 5_000_000
    df = spark.range(n, numPartitions=8).select(F.format_string("c%07d", F.col("id")).alias("x"))
    df = df.unionAll(df.where("x >= 'c4999990'"))     # ten labels twice: they come first
    d = category_dictionary(df, "x", num_slices=6)
    assert d.count() == n
    # Labels of one count are ordered by text, so the rank of a single label is its number plus ten.
    want = F.when(F.col("category") >= "c4999990", F.substring("category", 2, 7).cast("long") - 4_999_990).otherwise(
        F.substring("category", 2, 7).cast("long") + 10)
    assert d.where(F.col("index") != want).count() == 0
    some = df.where(F.substring("x", 7, 2) == "77")
    got = index_categories(some, "x", d, "i", size=n, max_broadcast_rows=1000)
    assert got.count() == some.count()
    wrong = F.substring("x", 2, 7).cast("double") + 10
    assert got.where((F.col("x") < "c4999990") & (F.col("i") != wrong)).count() == 0


@pytest.fixture(scope="module")
def values(spark):
    rnd = random.Random(8)
    rows = [(f"p{i % 11}", f"g{rnd.randrange(3)}", None if i % 97 == 0 else float("nan") if i % 89 == 0 else rnd.choice([rnd.gauss(0, 1), 0.5]))
            for i in range(30_000)]
    rows += [("solo", "g0", 7.0), ("none", "g9", None)]
    return spark.createDataFrame(rows, "place string, grp string, v double").cache()


@pytest.mark.parametrize("by", [["place"], ["grp"], ["place", "grp"], []])
def test_merged_sketches_keep_the_rank_error(spark, values, by):
    stored = value_sketches(values, "v", ["place", "grp"])
    got = sketch_quantiles(merge_sketches(stored, by))
    errors = rank_errors(values, "v", got, by).collect()
    assert len(errors) == max(1, values.where("v is not null and not isnan(v)").select(*by).distinct().count() if by else 1)
    assert all(max(r.e1, r.e2, r.e3) <= 0.01 for r in errors)
    assert sum(r.n for r in got.collect()) == values.where("v is not null and not isnan(v)").count()


def test_exact_quantiles_have_no_rank_error(spark, values):
    clean = values.where("not isnan(v)")
    exact = exact_quantiles(clean, "v", group_cols=["place"])
    assert all(max(r.e1, r.e2, r.e3) == 0 for r in rank_errors(clean, "v", exact, ["place"]).collect())


def test_no_values_no_sketch(spark, values):
    none = value_sketches(values.where("place = 'none'"), "v", ["place"])
    assert none.count() == 0 and merge_sketches(none).count() == 0
