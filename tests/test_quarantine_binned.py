"""Malformed-row quarantine with counters, payload problems, and binned ranking curves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from disparo.operators.ranking import binned_curve, binned_ranking_metrics, ranking_metrics
from disparo.sources.payload import parse_payloads
from disparo.sources.quarantine import load_raw_csv, payload_problems
from disparo.sources.tables import read_json_metrics


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_planted_bad_rows_are_kept_aside(spark, tmp_dir):
    write(tmp_dir + "/in/a.csv", 'a,b,c\n1,x,y\n2,x\n3,x,y,surplus\n\n4,"p, q",\n')
    write(tmp_dir + "/in/b.csv", 'a,b,c\n5,é,NA\n6\n')
    load = load_raw_csv(spark, tmp_dir + "/in", ["a", "b", "c"], metrics_path=tmp_dir + "/m")
    assert (load.n_rows, load.n_good, load.n_malformed) == (6, 3, 3)
    assert sorted(tuple(r) for r in load.good.collect()) == [("1", "x", "y"), ("4", "p, q", None), ("5", "é", "NA")]
    assert sorted(r.record for r in load.malformed.collect()) == ["2,x", "3,x,y,surplus", "6"]
    m = read_json_metrics(spark, tmp_dir + "/m", load.metrics(spark, source="x").schema).first()
    assert (m.n_rows, m.n_good, m.n_malformed) == (6, 3, 3)


def test_clean_files_lose_nothing(spark, tmp_dir):
    write(tmp_dir + "/in/a.csv", "a,b\n" + "".join(f"{i},v{i}\n" for i in range(500)))
    load = load_raw_csv(spark, tmp_dir + "/in", ["a", "b"], max_malformed_share=0.0)
    assert load.good.count() == load.n_good == 500 and load.malformed.count() == load.n_malformed == 0


def test_too_many_malformed_rows_raise_and_stay(spark, tmp_dir):
    write(tmp_dir + "/in/a.csv", "a,b\n1,2\n3\n")
    with pytest.raises(ValueError, match="1 of 2"):
        load_raw_csv(spark, tmp_dir + "/in", ["a", "b"], store=tmp_dir + "/kept", max_malformed_share=0.1)
    assert spark.read.parquet(tmp_dir + "/kept").where("_malformed = 'true'").count() == 1


def test_quoted_line_breaks(spark, tmp_dir):
    write(tmp_dir + "/in/a.csv", 'a,b\n1,"two\nlines"\n2,y\n')
    assert load_raw_csv(spark, tmp_dir + "/in", ["a", "b"], multi_line=True).good.where("a = 1").first().b == "two\nlines"
    load = load_raw_csv(spark, tmp_dir + "/in", ["a", "b"])
    assert load.n_malformed >= 1 and load.good.where("a = 2").count() == 1


def test_payload_problems(spark, tmp_dir):
    base = tmp_dir + "/p"
    write(base + "/year=2010/dataset=acs5/f", '[["NAME","v","state","county"],["A","1","37","001"],["B","2","37"]]')
    write(base + "/year=2011/dataset=acs5/f", '{"error": "no such year"}')
    write(base + "/year=2012/dataset=acs5/f", '[["NAME","v","state","county"]]')
    write(base + "/year=2013/dataset=acs5/f", '[["NAME","v","state"],["A","1","37"]]')
    got = sorted((r.year, r.reason, r.detail) for r in payload_problems(spark, base).collect())
    assert got == [(2010, "ragged row", '["B","2","37"]'), (2011, "not json", '{"error": "no such year"}'),
                   (2012, "no rows", ""), (2013, "no field", "county")]
    assert parse_payloads(spark, base, ["NAME", "v"]).count() == 3      # the lenient reading is as it was


def slow_binned(rows, bins):
    per = {}
    for s, y in rows:
        if s is not None and y is not None:
            p = per.setdefault(s, [0, 0])
            p[0 if y == 1 else 1] += 1
    order = [per[s] for s in sorted(per, reverse=True)]
    run = max(len(order) // bins, 1)
    points = [tuple(map(sum, zip(*order[i:i + run]))) for i in range(0, len(order), run)]
    p, n = map(sum, zip(*points))
    cp = cn = roc = pr = 0
    for a, b in points:
        before = cp / (cp + cn) if cp + cn else (cp + a) / (cp + a + cn + b)
        roc += b * (2 * cp + a)
        pr += a * ((cp + a) / (cp + a + cn + b) + before)
        cp, cn = cp + a, cn + b
    return len(points), roc / (2 * p * n), pr / (2 * p)


@pytest.mark.parametrize("bins", [1, 7, 50, 5000])
def test_binned_areas(spark, bins):
    rnd = random.Random(6)
    rows = [(round(rnd.random(), 3) if i % 4 else 0.5, int(rnd.random() < 0.3)) for i in range(4000)]
    rows += [(None, 1), (0.2, None)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(5)
    got = binned_ranking_metrics(df, "s", "y", bins).first()
    points, roc, pr = slow_binned(rows, bins)
    assert got.n_points == points and abs(got.auroc - roc) < 1e-12 and abs(got.aupr - pr) < 1e-12
    if bins == 5000:
        exact = ranking_metrics(df, "s", "y").first()
        assert abs(exact.auroc - got.auroc) < 1e-12 and abs(exact.aupr - got.aupr) < 1e-12


def test_points_do_not_depend_on_partitions(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).cast("double").alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = [tuple(r) for r in binned_curve(df.repartition(1), "s", "y", 40).orderBy("bin").collect()]
    b = [tuple(r) for r in binned_curve(df.repartition(9), "s", "y", 40).orderBy("bin").collect()]
    assert a == b and 40 <= len(a) <= 80
    with pytest.raises(ValueError):
        binned_curve(df, "s", "y", 0)
