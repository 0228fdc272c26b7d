"""Cleaning operators on an inline frame holding the quirks (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.operators.clean import (clean_column_names, clip_age, normalize_booleans,
                                     normalize_county, standardize_strings)


def one_col(spark, name, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} string")


def by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`  Subject Race ` int, `Date` int")
    assert clean_column_names(df).columns == ["subject_race", "date"]


def test_clean_column_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        clean_column_names(df)


YN = ["TRUE", "FALSE", "Yes", "Y", "Sunday", "1", "10", "01", "NA", "", None, "xtrue", "no"]


def test_yes_no_parity(spark):
    df = normalize_booleans(one_col(spark, "arrest_made", YN))
    got = by_id(df, "arrest_made")
    # starts with 1 | contains y (any case) | ends with true (any case)
    expect = [1, 0, 1, 1, 1, 1, 1, 0, 0, 0, 0, 1, 0]
    assert [got[i] for i in range(len(YN))] == expect
    assert dict(df.dtypes)["arrest_made"] == "int"


def test_yes_no_strict(spark):
    df = normalize_booleans(one_col(spark, "arrest_made", YN), cfg=EventConfig(mode="strict"))
    got = by_id(df, "arrest_made")
    expect = [1, 0, 1, 1, None, 1, None, None, None, None, None, None, 0]
    assert [got[i] for i in range(len(YN))] == expect


TEXT = [" Wake ", "nan", " NaN ", "", "   ", "NA", None, "\tWake\t"]


def test_standardize_strings(spark):
    df = standardize_strings(one_col(spark, "location", TEXT))
    got = by_id(df, "location")
    assert [got[i] for i in range(len(TEXT))] == ["Wake", None, None, None, None, "NA", None, "\tWake\t"]


AGES = ["15", "15.5", "16", "100", "100.5", "101", "NA", "NaN", None, " 20 ", "1e3"]


def test_clip_age_parity(spark):
    df = clip_age(one_col(spark, "subject_age", AGES))
    got = by_id(df, "subject_age")
    vals = [got[i] for i in range(len(AGES))]
    assert vals[:7] == [None, None, 16.0, 100.0, 100.5, None, None]
    assert vals[7] != vals[7]            # NaN survives, as with a non-ANSI int cast
    assert vals[8] is None and vals[9] == 20.0
    assert vals[10] == 1000.0            # not an integer text: no range test, kept as double


def test_clip_age_strict(spark):
    df = clip_age(one_col(spark, "subject_age", AGES), EventConfig(mode="strict"))
    got = by_id(df, "subject_age")
    assert [got[i] for i in range(6)] == [None, None, 16.0, 100.0, None, None]
    assert got[10] is None


COUNTIES = ["Wake County", "Wake County,", "wake county", "Wake", None, "  Wake County"]


def test_county_key_parity(spark):
    df = normalize_county(one_col(spark, "county_name", COUNTIES))
    got = by_id(df, "county_name_norm")
    assert [got[i] for i in range(len(COUNTIES))] == ["wake", "wake county", "wake county", "wake", None, "  wake"]


def test_county_key_strict(spark):
    df = normalize_county(one_col(spark, "county_name", COUNTIES), EventConfig(mode="strict"))
    got = by_id(df, "county_name_norm")
    assert [got[i] for i in range(len(COUNTIES))] == ["wake", "wake", "wake", "wake", None, "wake"]


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert standardize_strings(normalize_booleans(clip_age(df))).columns == ["x"]


def test_ansi_safe(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = clip_age(one_col(spark, "subject_age", ["abc", "15.5"]))
    assert df.where(F.col("subject_age").isNotNull()).count() == 0


def test_parity_int_reads_like_the_cast(spark):
    from disparo.functions.exprs import parity_int
    texts = ["17", "\t17", " 17 ", "17.9", ".5", "-.5", "+", ".", "1e2", "", "99999999999", "-3", "+4", "1 7", None]
    want = [17, 17, 17, 17, 0, 0, None, 0, None, None, None, -3, 4, None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(parity_int("t")).collect()] == want
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [r[0] for r in df.orderBy("i").select(F.col("t").cast("int")).collect()] == want
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
