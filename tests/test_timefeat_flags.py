import math

from disparo.config import EventConfig
from disparo.operators.flags import add_labels_flags
from disparo.operators.timefeat import make_time_features


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, date string, time string")


def test_time_features(spark):
    rows = [(0, "2024-01-06", "00:15:00"),   # Saturday, hour 0
            (1, "2024-01-07", "06:00:00"),   # Sunday
            (2, "2024-01-08", "23:59:59"),   # Monday, hour 23
            (3, "2024-01-08", None),         # no time
            (4, "2024-01-08", "NA"),         # time text that does not parse
            (5, None, "10:00:00"),           # no date
            (6, "2024-13-45", "10:00:00")]   # malformed date
    got = {r["id"]: r for r in make_time_features(frame(spark, rows)).collect()}
    assert got[0]["day_of_week"] == 7 and got[0]["is_weekend"] == 1 and got[0]["hour_of_day"] == 0
    assert got[1]["day_of_week"] == 1 and got[1]["is_weekend"] == 1
    assert got[2]["day_of_week"] == 2 and got[2]["is_weekend"] == 0 and got[2]["hour_of_day"] == 23
    assert math.isclose(got[2]["hour_sin"], math.sin(2 * math.pi * 23 / 24))
    assert got[3]["time_available"] == 0 and got[3]["hour_of_day"] is None and got[3]["is_weekend"] is None
    assert got[3]["year"] == 2024
    # parity: raw time present counts as available, even when it does not parse
    assert got[4]["time_available"] == 1 and got[4]["hour_of_day"] is None and got[4]["is_weekend"] == 0
    assert got[5]["stop_ts"] is None and got[5]["year"] is None
    assert got[6]["date"] is None


def test_time_features_strict(spark):
    rows = [(4, "2024-01-08", "NA")]
    r = make_time_features(frame(spark, rows), EventConfig(mode="strict")).first()
    assert r["time_available"] == 0 and r["is_weekend"] is None


def test_flags_and_priority(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 0, "x", "Wake County", "White", "M"),
         (0, 1, 0, 1, "x", None, "BLACK", None),
         (0, 0, 1, 0, None, "Wake", None, "F"),
         (0, 0, 0, 0, "x", "Wake", "white", "f")],
        "citation_issued int, arrest_made int, warning_issued int, x int, outcome string, "
        "county_name string, subject_race string, subject_sex string").drop("x")
    df = df.withColumn("location", df.outcome)
    got = add_labels_flags(df).collect()
    assert [r["outcome_multiclass"] for r in got] == ["arrest", "arrest", "warning", "other"]
    assert [r["county_known"] for r in got] == [1, 0, 1, 1]
    assert [r["location_known"] for r in got] == [1, 1, 0, 1]
    assert [r["subject_race"] for r in got] == ["white", "black", None, "white"]
    assert [r["citation_yn"] for r in got] == [1, 0, 0, 0]
