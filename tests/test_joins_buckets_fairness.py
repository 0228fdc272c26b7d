import pytest
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.operators.buckets import add_demographic_buckets, add_group_share
from disparo.operators.encode import (apply_class_weights, class_counts, fit_class_weights,
                                      frequency_encode, hash_split)
from disparo.operators.fairness import fairness_by, fairness_grouping_sets, rates_by_bucket
from disparo.operators.lookup import lookup_join
from disparo.operators.refdata import attach_reference, merge_datasets
from disparo.functions.exprs import quartile_label


def test_frequency_encode_null_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "department_name string")
    got = sorted((r[0] or "~", r[1] or 0) for r in frequency_encode(df).collect())
    assert got == [("a", 2), ("a", 2), ("b", 1), ("~", 0), ("~", 0)]


def test_lookup_join_keeps_rows_and_rejects_duplicates(spark):
    fact = spark.range(100).withColumn("k", F.col("id") % 3)
    ok = spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string")
    assert lookup_join(fact, ok, "k").count() == 100
    dup = spark.createDataFrame([(0, "x"), (0, "y")], "k long, v string")
    with pytest.raises(ValueError):
        lookup_join(fact, dup, "k")


def test_lookup_join_shuffle_fallback(spark):
    fact = spark.range(100).withColumn("k", F.col("id") % 3)
    lk = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "k long, v string")
    out = lookup_join(fact, lk, "k", max_broadcast_rows=1)
    assert out.count() == 100 and out.where(F.col("v").isNull()).count() == 0


def test_floor_year_join(spark):
    cfg = EventConfig(floor_year=2009)
    facts = spark.createDataFrame([("wake", 2005), ("wake", 2009), ("wake", 2015), ("wake", None), ("durham", 2010)],
                                  "county_name_norm string, year int")
    ref = spark.createDataFrame([("wake", 2009, 50000.0, "37"), ("durham", 2010, 40000.0, "37")],
                                "county_name_norm string, acs_year int, median_income double, state string")
    got = sorted(attach_reference(facts, ref, cfg).collect(), key=lambda r: (r["county_name_norm"], r["year"] or 0))
    assert [(r["year"], r["acs_year"], r["median_income"]) for r in got] == [
        (2010, 2010, 40000.0), (None, None, None), (2005, 2009, 50000.0), (2009, 2009, 50000.0), (2015, 2015, None)]
    assert "state" in got[0].asDict()


def test_merge_datasets(spark):
    a = spark.createDataFrame([(2019, "37", "001", "A1", 0, "10")], "year int, state string, county string, NAME string, dataset_order int, m1 string")
    b = spark.createDataFrame([(2019, "37", "001", "A2", 1, "5"), (2019, "37", "003", "C", 1, "6")],
                              "year int, state string, county string, NAME string, dataset_order int, m2 string")
    got = {r["county"]: r for r in merge_datasets([a, b], ["year", "state", "county"]).collect()}
    assert got["001"]["NAME"] == "A2" and got["001"]["m1"] == "10" and got["001"]["m2"] == "5"
    assert got["003"]["m1"] is None and got["003"]["m2"] == "6"


def test_quartile_label_null_parity_and_strict(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    parity = [r[0] for r in df.select(quartile_label("x", [1.0, 2.0, 3.0])).collect()]
    strict = [r[0] for r in df.select(quartile_label("x", [1.0, 2.0, 3.0], strict=True)).collect()]
    assert parity == ["Q1_lowest", "Q2", "Q3", "Q4_highest", "Q4_highest"]
    assert strict[-1] is None and strict[:4] == parity[:4]


def test_group_share(spark):
    cfg = EventConfig()
    df = spark.createDataFrame([("w", "white"), ("w", "black"), ("w", None), ("d", "na")],
                               "county_name_norm string, subject_race string")
    got = {r["county_name_norm"]: (r["minority_share_stop"], r["n_stops_county"])
           for r in add_group_share(df, cfg).collect()}
    assert got == {"w": (0.5, 3), "d": (1.0, 1)}


def test_demographic_buckets_skip_all_null(spark):
    df = spark.createDataFrame([("w", "white", None)], "county_name_norm string, subject_race string, median_income double")
    res = add_demographic_buckets(df, EventConfig(), relative_error=None)
    assert res.income_breaks is None and "income_quartile" not in res.df.columns
    assert res.share_breaks == [0.0, 0.0, 0.0]


def test_fairness_invariants(spark):
    rows = [(g, y, p) for g in ("a", "b", "c") for y in (0, 1) for p in (0, 1)] + [("only_pos", 1, 1), ("only_neg", 0, 0)]
    df = spark.createDataFrame(rows, "g string, y int, p int")
    got = {r["g"]: r for r in fairness_by(df, "y", "p", "g").collect()}
    assert got["a"]["TP"] == 1 and got["a"]["TPR"] == 0.5 and got["a"]["Rate"] == 0.5
    assert got["only_pos"]["FPR"] is None and got["only_neg"]["TPR"] is None
    assert sum(r["P"] + r["N"] for r in got.values()) == len(rows)


def test_grouping_sets_keep_null_group(spark):
    df = spark.createDataFrame([(None, "m", 1, 1), ("a", "f", 0, 1)], "race string, sex string, y int, p int")
    got = {(r["dimension"], r["grp"]): r["Pos"] for r in fairness_grouping_sets(df, "y", "p", ["race", "sex"]).collect()}
    assert got == {("race", None): 1, ("race", "a"): 1, ("sex", "m"): 1, ("sex", "f"): 1}


def test_rates_by_bucket(spark):
    df = spark.createDataFrame([("Q1", "a", 1, 0.5), ("Q1", "a", 0, 0.1)], "b string, g string, y int, s double")
    r = rates_by_bucket(df, "y", "s", "b", "g").first()
    assert r["actual_rate"] == 0.5 and r["avg_pred_prob"] == pytest.approx(0.3) and r["n_stops"] == 2


def test_class_weights_average_to_one(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 7, "y int")
    w = fit_class_weights(df, "y")
    assert (w.n_pos, w.n_neg) == (3, 7)
    avg = apply_class_weights(df, "y", w).agg(F.avg("class_w")).first()[0]
    assert avg == pytest.approx(1.0)
    empty = class_counts(df.where("y > 5"), "y").first()
    assert empty["w_pos"] == 0.5 and empty["n_total"] == 0


def test_hash_split_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "event_id")
    s = hash_split(df, "event_id")
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts["train"] + counts["test"] == 2000 and 1500 < counts["train"] < 1700
    again = hash_split(df.repartition(7), "event_id")
    assert s.exceptAll(again).count() == 0


def test_lookup_join_hot_null_key_shuffle_path(spark):
    # A third of the fact rows have a NULL key; the shuffle fallback must keep them all,
    # unmatched, and match the rest.
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 10)
                                    .alias("k"), F.col("id"))
    lk = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "k long, v string")
    out = lookup_join(fact, lk, "k", max_broadcast_rows=0)
    assert out.count() == 3000
    assert out.where(F.col("k").isNull() & F.col("v").isNull()).count() == 1000
    assert out.where(F.col("k").isNotNull() & F.col("v").isNull()).count() == 0


def test_broadcast_byte_estimate(spark):
    from disparo.operators.lookup import estimated_row_bytes, fits_broadcast
    df = spark.createDataFrame([(1, "a", 2.0)], "k long, s string, v double")
    assert estimated_row_bytes(df) == 16 + 8 + 64 + 8
    assert fits_broadcast(df, 1000) and not fits_broadcast(df, 1000, max_bytes=1000)
    assert not fits_broadcast(df, 2_000_000)
