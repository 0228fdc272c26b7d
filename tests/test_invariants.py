"""Invariants on the driver tables (sf0.001): joins keep the fact count, buckets partition
the rows, counts and rates stay in range."""

from pyspark.sql import functions as F

from disparo.operators.buckets import add_demographic_buckets
from disparo.operators.fairness import fairness_by, fairness_by_bucket
from disparo.operators.refdata import attach_reference
from disparo.plans import adapters
from disparo.plans.catalogue import CFG_A, CFG_B
from disparo.plans.jobs import enrich
from tests.conftest import SF001


def test_enrichment_keeps_rows(spark):
    raw = adapters.raw_events(spark, SF001)
    out = enrich(raw, adapters.reference_dimension(spark, SF001), CFG_A)
    assert out.count() == raw.count()
    assert out.select("event_id").distinct().count() == raw.count()


def test_buckets_partition_rows_exact_and_sketch(spark):
    b = attach_reference(adapters.typed_facts(spark, SF001), adapters.reference_dimension(spark, SF001), CFG_B)
    n = b.count()
    for rel in (None, 0.01):
        res = add_demographic_buckets(b, CFG_B, relative_error=rel)
        got = {r[0]: r[1] for r in res.df.groupBy("income_quartile").count().collect()}
        assert sum(got.values()) == n and set(got) <= {"Q1_lowest", "Q2", "Q3", "Q4_highest"}
        assert res.income_breaks == sorted(res.income_breaks)
        assert res.df.count() == n


def test_fairness_counts_in_range(spark):
    b = adapters.typed_facts(spark, SF001)
    rows = fairness_by(b, "label", "pred", "grp").collect()
    assert sum(r["P"] + r["N"] for r in rows) == b.count()
    for r in rows:
        assert r["TP"] <= r["P"] and r["FP"] <= r["N"] and r["Pos"] == r["TP"] + r["FP"]
        for m in ("TPR", "FPR", "Rate"):
            assert r[m] is None or 0.0 <= r[m] <= 1.0


def test_bucket_fairness_sums_to_group_fairness(spark):
    b = attach_reference(adapters.typed_facts(spark, SF001), adapters.reference_dimension(spark, SF001), CFG_B)
    df = add_demographic_buckets(b, CFG_B, relative_error=None).df
    by_bucket = fairness_by_bucket(df, "label", "pred", "income_quartile", "grp").groupBy("grp").agg(
        F.sum("TP").alias("TP"), F.sum("N").alias("N"))
    overall = fairness_by(df, "label", "pred", "grp").select("grp", "TP", "N")
    assert sorted(map(tuple, by_bucket.collect())) == sorted(map(tuple, overall.collect()))
