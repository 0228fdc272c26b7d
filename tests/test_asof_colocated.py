"""Nearest year per place against brute force; facts stored by key join without an exchange of theirs."""

import random

import pytest
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.operators.asof import nearest_per_key
from disparo.operators.colocated import colocated_join, write_colocated
from disparo.operators.refdata import attach_reference


@pytest.mark.parametrize("slices", [None, 1, 7])
def test_nearest_against_brute_force(spark, slices):
    rnd = random.Random(4)
    known = {(f"p{rnd.randrange(6)}", rnd.randrange(1990, 2030)) for _ in range(40)} | {("hot", y) for y in range(1900, 2100, 17)}
    wanted = [(f"p{rnd.randrange(8)}", rnd.randrange(1980, 2040)) for _ in range(200)] + [("hot", y) for y in range(1880, 2120)]
    wanted += [("p1", None), (None, 2000)] + wanted[:20]
    got = nearest_per_key(spark.createDataFrame(wanted, "place string, year int"),
                          spark.createDataFrame([*known, ("p2", None), (None, 2001)], "place string, year int"), "place", "year", "near", slices)
    want = {}
    for p, y in wanted:
        years = [k for q, k in known if q == p]
        if p and y and years:
            want[p, y] = min(years, key=lambda k: (abs(k - y), k))
    rows = got.collect()
    assert len(rows) == len(want) and {(r.place, r.year): r.near for r in rows} == want


def test_strict_reference_join(spark):
    cfg = EventConfig(mode="strict")
    facts = spark.createDataFrame([("a", 2000), ("a", 2004), ("a", 2020), ("b", 2004), ("c", 2004), (None, 2004), ("a", None)],
                                  "county_name_norm string, year int")
    ref = spark.createDataFrame([("a", 2002, 1.0), ("a", 2006, 2.0), ("b", 2015, 3.0)], "county_name_norm string, acs_year int, median_income double")
    got = {(r.county_name_norm, r.year): (r.acs_year, r.median_income) for r in attach_reference(facts, ref, cfg).collect()}
    assert got == {("a", 2000): (2002, 1.0), ("a", 2004): (2002, 1.0), ("a", 2020): (2006, 2.0), ("b", 2004): (2015, 3.0),
                   ("c", 2004): (None, None), (None, 2004): (None, None), ("a", None): (None, None)}
    assert attach_reference(facts, ref.where("false"), cfg).where("median_income is not null").count() == 0


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has one key, some have none."""
    return spark.range(6000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 900).cast("int").alias("k"))


def test_join_equals_the_plain_one(spark, facts):
    lookup = spark.range(0, 1000, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v")).unionAll(
        spark.createDataFrame([(7, 70), (None, 1)], "k int, v bigint"))
    stored = write_colocated(facts, "k", buckets=5, hot_share=0.01)
    assert [r.hot for r in stored.hot_keys.collect()] == [7]
    assert stored.cold().where("k = 7 or k is null").count() == 0 and stored.hot().where("k <> 7").count() == 0
    got = colocated_join(stored, lookup)
    want = facts.join(lookup, "k", "left")
    assert got.columns == want.columns and got.count() == 6000
    assert got.exceptAll(want).count() == 0


def plan_nodes(node):
    """The physical plan as (name, children), with AQE's final or initial plan unwrapped."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return plan_nodes(node.executedPlan())
    kids = node.children()
    return node.nodeName(), [plan_nodes(kids.apply(i)) for i in range(kids.size())]


def names(tree):
    return [tree[0]] + [n for k in tree[1] for n in names(k)]


def test_facts_are_not_exchanged(spark, facts):
    stored = write_colocated(facts, "k", buckets=5, hot_share=0.01)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = colocated_join(stored, spark.range(900).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v")))
        tree = plan_nodes(joined._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    def joins(t):
        return ([t] if "SortMergeJoin" in t[0] else []) + [j for k in t[1] for j in joins(k)]
    found = joins(tree)
    assert len(found) == 1
    left, right = found[0][1]
    assert "Exchange" not in " ".join(names(left)) and any("Scan parquet" in n for n in names(left))
    assert any("Exchange" in n for n in names(right))


def test_duplicate_lookup_keys_raise(spark, facts):
    stored = write_colocated(facts, "k", buckets=3)
    with pytest.raises(ValueError):
        colocated_join(stored, spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"))


def test_empty_facts(spark, facts):
    stored = write_colocated(facts.where("false"), "k", buckets=3)
    assert colocated_join(stored, spark.createDataFrame([(1, 1)], "k int, v int")).count() == 0
