import os

from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.operators.buckets import group_share_table
from disparo.operators.refdata import attach_reference, nearest_year
from disparo.plans import adapters
from disparo.plans.pipeline import run_pipeline
from disparo.sources.payload import DATASETS, MEASURE_NAMES, reference_from_payloads
from disparo.sources.tables import write_raw_csv
from tests.conftest import SF001


def test_nearest_year(spark):
    df = spark.createDataFrame([(y,) for y in (1990, 2010, 2012, 2013, 2020, None)], "year int")
    got = [r[0] for r in df.select(nearest_year("year", [2009, 2011, 2015])).collect()]
    assert got == [2009, 2009, 2011, 2011, 2015, None]


def test_strict_reference_join_uses_nearest_year(spark):
    facts = spark.createDataFrame([("wake", 2005), ("wake", 2016)], "county_name_norm string, year int")
    ref = spark.createDataFrame([("wake", 2009, 1.0), ("wake", 2015, 2.0)],
                                "county_name_norm string, acs_year int, median_income double")
    got = sorted((r["year"], r["median_income"]) for r in attach_reference(facts, ref, EventConfig(mode="strict")).collect())
    assert got == [(2005, 1.0), (2016, 2.0)]
    parity = sorted((r["year"], r["median_income"]) for r in attach_reference(facts, ref, EventConfig()).collect())
    assert parity == [(2005, 1.0), (2016, None)]


def test_share_exclusions(spark):
    df = spark.createDataFrame([("w", "white"), ("w", "unknown"), ("w", "black")], "c string, g string")
    assert group_share_table(df, "c", "g", "white").first()["minority_share_stop"] == 2 / 3
    assert group_share_table(df, "c", "g", "white", exclusions=("unknown",)).first()["minority_share_stop"] == 0.5


def test_pipeline_end_to_end(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    write_raw_csv(adapters.raw_events(spark, SF001), raw)
    payloads = f"{tmp_dir}/payloads"
    adapters.render_payloads(adapters.reference_dimension(spark, SF001), payloads, DATASETS, MEASURE_NAMES)
    res = run_pipeline(spark, raw, f"{tmp_dir}/enriched", f"{tmp_dir}/out", payloads,
                       run_gbt=False, stamp="t")
    out = res["out"]
    for label in ("citation_issued", "arrest_made"):
        for part in ("models/LR_T0", "models/LR_T1", "metrics/json", "metrics/fairness",
                     "metrics/class_counts", "metrics/demographics"):
            assert os.path.exists(f"{out}/{label}/{part}"), part
        counts = spark.read.json(f"{out}/{label}/metrics/class_counts").first()
        run = res["runs"][label].counts
        assert (counts["pos"], counts["neg"], counts["w_pos"]) == (run["pos"], run["neg"], run["w_pos"])
    assert res["share_breaks"] is not None
    # the second run reads the enriched table instead of rebuilding it
    again = run_pipeline(spark, f"{tmp_dir}/missing-raw", f"{tmp_dir}/enriched", f"{tmp_dir}/out", None,
                         run_gbt=False, stamp="t2")
    assert os.path.exists(f"{again['out']}/arrest_made/metrics/json")


def test_reference_valid_range(spark, tmp_dir):
    import json
    d = os.path.join(tmp_dir, "year=2019", "dataset=acs5")
    os.makedirs(d)
    with open(os.path.join(d, "p.txt"), "w") as f:
        f.write(json.dumps([["NAME", "B19013_001E", "state", "county"],
                            ["A County, North Carolina", "-666666666", "37", "001"]]))
    assert reference_from_payloads(spark, tmp_dir).first()["median_income"] == -666666666.0
    assert reference_from_payloads(spark, tmp_dir, valid_range=(0, 1e9)).first()["median_income"] is None


def test_pipeline_cli_strict(spark, tmp_dir):
    from disparo.plans.pipeline import main
    raw = f"{tmp_dir}/raw"
    write_raw_csv(adapters.raw_events(spark, SF001), raw)
    main(["--raw", raw, "--enriched", f"{tmp_dir}/enriched", "--out", f"{tmp_dir}/out",
          "--no-gbt", "--strict", "--exact-breaks"])
    runs = os.listdir(f"{tmp_dir}/out")
    assert len(runs) == 1
    assert os.path.exists(f"{tmp_dir}/out/{runs[0]}/citation_issued/models/LR_T1")
    assert not os.path.exists(f"{tmp_dir}/out/{runs[0]}/citation_issued/models/GBT_T1")
