"""The enriched fixture exercises the reference join: it must match some rows and miss others."""

from pyspark.sql import functions as F

from disparo.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def test_reference_join_matches_and_misses(spark):
    rows = QUERIES["enrich_full"](spark, SF)
    got = rows.agg(F.count_if(F.col("median_income").isNotNull()).alias("hit"),
                   F.count_if(F.col("median_income").isNull() & F.col("acs_year").isNotNull()).alias("miss"),
                   F.count_if(F.col("year") < F.col("acs_year")).alias("floored"),
                   F.count_distinct("year").alias("years"),
                   F.count_if(F.col("subject_race") == "household").alias("baseline")).first()
    assert got.hit and got.miss and got.floored and got.baseline
    assert got.years >= 5
