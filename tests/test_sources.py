import json
import os

from pyspark.sql import functions as F

from disparo.sources.payload import parse_payloads, reference_from_payloads
from disparo.sources.tables import (read_json_metrics, read_or_build, read_raw_csv, read_table,
                                    write_json_metrics, write_partitioned, write_raw_csv)


def land(base, year, dataset, payload):
    d = os.path.join(base, f"year={year}", f"dataset={dataset}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.txt"), "w") as f:
        f.write(json.dumps(payload))


def test_payload_quirks(spark, tmp_dir):
    land(tmp_dir, 2019, "acs5", [["NAME", "B19013_001E", "state", "county"],
                                 ["Wake County, North Carolina", "70000", "37", "183"],
                                 ["Ragged County, North Carolina", "1"],              # ragged row
                                 ["Odd County, North Carolina", "n/a", "37", "999"]])  # non-numeric
    land(tmp_dir, 2019, "subject", [["NAME", "S1701_C03_001E", "S2301_C04_001E", "state", "county"],
                                    ["Wake County, North Carolina", "10.5", "4.1", "37", "183"],
                                    ["Durham County, North Carolina", "12", "5", "37", "063"]])
    land(tmp_dir, 2019, "profile", [["NAME", "DP02_0068PE", "state", "county"]])       # header only
    long = parse_payloads(spark, tmp_dir, ["NAME", "state", "county", "B19013_001E"])
    assert long.count() == 5
    ref = {(r["county_fips3"]): r for r in reference_from_payloads(spark, tmp_dir).collect()}
    assert ref["183"]["county_name_norm"] == "wake" and ref["183"]["median_income"] == 70000.0
    assert ref["183"]["poverty_rate"] == 10.5 and ref["183"]["edu_bachelor_pct"] is None
    assert ref["063"]["median_income"] is None and ref["063"]["county_name_norm"] == "durham"
    assert ref["999"]["median_income"] is None
    assert None in ref                      # the ragged row has no place code
    assert ref["183"]["acs_year"] == 2019


def test_csv_reads_everything_as_text(spark, tmp_dir):
    df = spark.createDataFrame([("1", "", None, "  x ", "NA")], "a string, b string, c string, d string, e string")
    write_raw_csv(df, tmp_dir + "/c")
    back = read_raw_csv(spark, tmp_dir + "/c")
    assert back.dtypes == [(c, "string") for c in "abcde"]
    r = back.first()
    assert (r["a"], r["b"], r["c"], r["d"], r["e"]) == ("1", None, None, "  x ", "NA")


def test_partitioned_sink_null_year(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2020), (2, None), (3, 2021)], "id int, year int")
    write_partitioned(df, tmp_dir + "/p")
    back = read_table(spark, tmp_dir + "/p")
    assert back.columns[-1] == "year" and dict(back.dtypes)["year"] == "int"
    assert sorted((r["id"], r["year"]) for r in back.collect()) == [(1, 2020), (2, None), (3, 2021)]
    assert back.where(F.col("year") == 2020).count() == 1


def test_read_or_build_rebuilds_unreadable(spark, tmp_dir):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, 2020)], "id int, year int")

    corrupt = tmp_dir + "/t"
    os.makedirs(corrupt)
    with open(corrupt + "/junk.parquet", "w") as f:
        f.write("not parquet")
    assert read_or_build(spark, corrupt, build).count() == 1 and len(calls) == 1
    fresh = tmp_dir + "/fresh"
    assert read_or_build(spark, fresh, build).count() == 1 and len(calls) == 2
    assert read_or_build(spark, fresh, build).count() == 1 and len(calls) == 2   # read, no rebuild


def test_json_metrics_null_is_null(spark, tmp_dir):
    df = spark.createDataFrame([("a", 0, None)], "grp string, P bigint, TPR double")
    write_json_metrics(df, tmp_dir + "/m")
    files = [f for f in os.listdir(tmp_dir + "/m") if f.startswith("part-")]
    assert len(files) == 1
    text = open(os.path.join(tmp_dir, "m", files[0])).read()
    assert '"TPR":null' in text and "NaN" not in text
    assert read_json_metrics(spark, tmp_dir + "/m", df.schema).collect() == df.collect()


def test_partitioned_sink_splits_hot_year(spark, tmp_dir):
    # One year holds 40% of the rows; with a small advisory size AQE splits it over tasks.
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(400_000).select(
            F.col("id"), F.when(F.col("id") % 5 < 2, F.lit(2020)).otherwise((F.col("id") % 7 + 2010).cast("int"))
            .alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        write_partitioned(df.repartition(8), tmp_dir + "/hot")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(tmp_dir + "/hot/year=2020") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_table(spark, tmp_dir + "/hot").where("year = 2020").count() == 160_000
