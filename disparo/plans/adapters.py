"""Adapters from the driver's TPC-H-like tables to the event schema (FIXTURES.md).

* ``raw_events``  (A): events + customer + nation as raw all-text stop records.
* ``typed_facts`` (B): lineitem + orders + customer + nation (+ supplier, part) as
  typed labelled facts.
* ``reference_dimension`` (R): orders + customer + nation aggregated per (place, year).

Joins are left to Catalyst: dimension sides are broadcast when their statistics are
under the session's broadcast threshold, and shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.operators.quantiles import exact_quantiles

RAW_COLUMNS = ("event_id", "date", "time", "county_name", "subject_race", "subject_sex",
               "subject_age", "department_name", "type", "outcome", "reason_for_stop",
               "location", "citation_issued", "arrest_made", "warning_issued")
REF_FLOOR_YEAR = 1997
BASELINE_B = "household"
NAME_SUFFIX = " County, North Carolina"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(c, m):
    return F.col(c) % F.lit(m) == 0


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A: one raw text record per event, with planted quirks (NULLs, ``NA``,
    ``nan``, padded and comma-suffixed place names, fractional ages, empty text); dates are
    moved back by whole years so that they span the reference years.

    The records are spread by ``event_id`` while they are narrow: a file of one row group is read
    by one task, which would also do all the cleaning behind it."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (e.join(c, e.user_id == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
          .select(*e.columns, "c_mktsegment", "n_name")
          .repartition("event_id"))
    k = F.get_json_object("props", "$.k").try_cast("int")
    n_name = F.col("n_name")
    # Nine years, 1994 to 2002 for events of 2024: below, inside and above the reference years.
    event_date = F.add_months(F.to_date("ts"), (-12 * (22 + F.col("event_id") % 9)).cast("int"))
    return j.select(
        F.col("event_id"),
        F.when(_mod("event_id", 101), F.lit(None)).otherwise(F.date_format(event_date, "yyyy-MM-dd")).alias("date"),
        F.when(_mod("event_id", 17), F.lit(None)).when(_mod("event_id", 53), F.lit("NA"))
         .otherwise(F.date_format("ts", "HH:mm:ss")).alias("time"),
        F.when(_mod("event_id", 41), F.lit(None)).when(_mod("event_id", 37), F.lit("nan"))
         .when(_mod("event_id", 31), F.concat(n_name, F.lit(" County,")))
         .when(_mod("event_id", 29), F.concat(F.lit("  "), n_name, F.lit(" County")))
         .otherwise(F.concat(n_name, F.lit(" County"))).alias("county_name"),
        F.col("c_mktsegment").alias("subject_race"),
        F.when(F.col("user_id") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("subject_sex"),
        F.when(_mod("event_id", 97), F.lit("15.5")).when(_mod("event_id", 89), F.lit("NA"))
         .otherwise((F.lit(10) + (F.col("event_id") * 37) % 100).cast("string")).alias("subject_age"),
        F.when(_mod("event_id", 43), F.lit(None)).when(_mod("event_id", 47), F.lit(""))
         .otherwise(F.concat(F.lit("Dept "), (k % 20).cast("string"))).alias("department_name"),
        F.lit("event").alias("type"),
        F.col("event_type").alias("outcome"),
        F.concat(F.lit("reason "), (k % 7).cast("string")).alias("reason_for_stop"),
        F.when(_mod("event_id", 13), F.lit(None)).otherwise(n_name).alias("location"),
        F.when(_mod("event_id", 59), F.lit(None)).when(_mod("event_id", 61), F.lit("NA"))
         .when(F.col("event_type") == "purchase", F.lit("TRUE")).otherwise(F.lit("FALSE"))
         .alias("citation_issued"),
        F.when(F.col("event_type") == "error", F.lit("Y")).otherwise(F.lit("N")).alias("arrest_made"),
        F.when(F.col("event_type") == "view", F.lit("1")).otherwise(F.lit("0")).alias("warning_issued"),
    )


def typed_facts(spark: SparkSession, sf_dir: str, with_part: bool = False,
                with_supplier: bool = False, with_place: bool = True) -> DataFrame:
    """Adapter B: typed labelled facts; ``grp`` is the group (baseline ``household``),
    ``label`` the outcome, ``pred`` a 0/1 prediction and ``score`` a tied score.
    Without ``with_place`` the facts come without place, group and sex, and without the
    joins to orders, customer and nation that only those need (every line has an order)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_discount", "l_returnflag", "l_shipdate")
    j, place = li, []
    if with_place:
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
               .join(c, F.col("o_custkey") == F.col("c_custkey"))
               .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
        place = [F.lower("n_name").alias("county_name_norm"),
                 F.lower("c_mktsegment").alias("grp"),
                 F.when(F.col("c_custkey") % 2 == 0, F.lit("m")).otherwise(F.lit("f")).alias("sex")]
    cols = [
        F.col("l_orderkey"), F.col("l_linenumber"), *place,
        F.year("l_shipdate").alias("year"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("label"),
        F.when(F.col("l_discount") >= 0.05, F.lit(1)).otherwise(F.lit(0)).alias("pred"),
        F.col("l_discount").alias("score"),
        F.col("l_quantity"),
    ]
    if with_supplier:
        s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        j = j.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        cols.append(F.col("s_name").alias("department_name"))
    if with_part:
        p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        j = j.join(p, F.col("l_partkey") == F.col("p_partkey"))
        cols.append(F.col("p_type"))
    return j.select(*cols)


def reference_dimension(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """Adapter R: one row per (place, year >= 1997) for places with nationkey % 7 <> 3, so that the
    floor year and places without a reference have something to show; with ``every`` all places and years.

    median_income is the discrete median of order totals (exact, distributed); the three
    rates are 100 x the share of orders with status F, status P and priority 1-URGENT.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority",
                                              "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    if not every:
        o, n = o.where(F.year("o_orderdate") >= REF_FLOOR_YEAR), n.where(F.col("n_nationkey") % 7 != 3)
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .select(F.lower("n_name").alias("county_name_norm"),
                  F.year("o_orderdate").alias("acs_year"),
                  F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("state"),
                  F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("county_fips3"),
                  "o_orderstatus", "o_orderpriority", "o_totalprice"))
    keys = ["county_name_norm", "acs_year"]
    rates = j.groupBy(*keys, "state", "county_fips3").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_p"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_u"))
    med = exact_quantiles(j, "o_totalprice", [0.5], keys, ["median_income"])
    return rates.join(med, keys, "left").select(
        *keys, "state", "county_fips3", "median_income",
        (F.lit(100.0) * F.col("n_f") / F.col("n")).alias("poverty_rate"),
        (F.lit(100.0) * F.col("n_p") / F.col("n")).alias("unemployment_rate"),
        (F.lit(100.0) * F.col("n_u") / F.col("n")).alias("edu_bachelor_pct"))


def render_payloads(ref: DataFrame, base: str, datasets, measure_names, name_suffix: str = NAME_SUFFIX,
                    skip=None) -> None:
    """Write R as landed payload files ``<base>/year=Y/dataset=D/`` (one JSON array of
    arrays per year and dataset: header row, then one text row per place).

    ``skip`` maps a dataset to a Column predicate of places left out of that dataset.
    A payload covers one year's places, so each group is bounded by the place count.
    """
    name = F.concat(F.upper(F.col("county_name_norm")), F.lit(name_suffix))
    frames = []
    for ds, codes in datasets:
        part = ref if not skip or ds not in skip else ref.where(~skip[ds])
        header = F.array(*[F.lit(x) for x in ("NAME", *codes, "state", "county")])
        row = F.array(name, *[F.col(measure_names[c]).cast("string") for c in codes],
                      F.col("state"), F.col("county_fips3"))
        frames.append(part.groupBy(F.col("acs_year").alias("year"))
                          .agg(F.to_json(F.concat(F.array(header),
                                                  F.array_sort(F.collect_list(row)))).alias("value"))
                          .withColumn("dataset", F.lit(ds)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out.write.mode("overwrite").partitionBy("year", "dataset").text(base)
