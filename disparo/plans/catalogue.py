"""Query catalogue: one Spark query per operator family, run on the driver's tables.

Every query reads the given tables (through the adapters) so its work grows with them.
Computed columns carry the same names as the oracle SQL in ``plans.oracle``; doubles
that depend on summation order are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.config import STRICT, EventConfig
from disparo.operators.buckets import add_demographic_buckets, add_group_share
from disparo.operators.buckets import summary_breaks
from disparo.operators.colocated import colocated_join, write_colocated
from disparo.operators.clean import clean_column_names, clip_age, normalize_booleans, standardize_strings
from disparo.operators.dictionary import category_dictionary, index_categories
from disparo.operators.encode import (apply_class_weights, bernoulli_sample, class_counts, distinct_values,
                                      fit_class_weights, frequency_encode, hash_split, key_frequency, random_split)
from disparo.operators.fairness import (COUNT_COLS, bucket_metrics, fairness_by,
                                        fairness_grouping_sets, rates_by_bucket)
from disparo.operators.flags import add_labels_flags
from disparo.operators.impute import median_impute
from disparo.operators.lookup import store_table
from disparo.operators.model import fit_variant, model_columns, score
from disparo.operators.ranking import binned_ranking_metrics, ranking_metrics
from disparo.operators.refdata import attach_reference
from disparo.operators.sketches import merge_sketches, rank_errors, sketch_quantiles, value_sketches
from disparo.operators.stages import ExactMedianImputer, FrequencyEncoder, QuantileBucketizer
from disparo.operators.timefeat import make_time_features
from disparo.plans import adapters
from disparo.plans.jobs import audit, enrich, train_evaluate
from disparo.session import ensure_checkpoint_dir, scratch_path
from disparo.streaming import read_enriched, read_with_frequency, start_enrich_stream, start_frequency_stream
from disparo.sources.manifest import current, read_published
from disparo.sources.payload import DATASETS, MEASURE_NAMES, reference_from_payloads
from disparo.sources.quarantine import load_raw_csv
from disparo.sources.tables import (load_model, publish_table, read_json_metrics, read_or_build, read_raw_csv, read_table,
                                    save_model, write_json_metrics, write_partitioned, write_raw_csv)

Query = Callable[[SparkSession, str], DataFrame]

# Role mapping for the typed facts (adapter B).
CFG_B = EventConfig(group_column="grp", sex_column="sex", baseline_group="household",
                    floor_year=adapters.REF_FLOOR_YEAR)
CFG_A = EventConfig(baseline_group="household", floor_year=adapters.REF_FLOOR_YEAR)
ENRICHED_COLUMNS = (
    "event_id", "date", "time", "county_name", "subject_race", "subject_sex", "subject_age",
    "department_name", "type", "outcome", "reason_for_stop", "location", "citation_issued",
    "arrest_made", "warning_issued", "stop_ts", "year", "time_available", "hour_of_day", "hour_sin",
    "hour_cos", "day_of_week", "is_weekend", "citation_yn", "arrest_yn", "outcome_multiclass",
    "location_known", "county_known", "county_name_norm", "dept_freq", "acs_year", "state",
    "county_fips3", "median_income", "poverty_rate", "unemployment_rate", "edu_bachelor_pct")
TEXT_COLS = ("location", "county_name", "subject_race", "subject_sex", "department_name",
             "type", "outcome", "reason_for_stop")
REF_COLS = ("acs_year", "county_name_norm", "state", "county_fips3", "median_income",
            "poverty_rate", "unemployment_rate", "edu_bachelor_pct")


def _r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def _time_cols(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, cyclic encodings rounded: engine-neutral values."""
    return df.withColumns({"date": F.col("date").cast("string"),
                           "stop_ts": F.col("stop_ts").cast("string"),
                           "hour_sin": F.round("hour_sin", 6), "hour_cos": F.round("hour_cos", 6)})


# ------------------------------------------------------------------ adapter A stages

def _a_clean(spark, d):
    raw = adapters.raw_events(spark, d)
    df = standardize_strings(raw, cfg=CFG_A)
    df = normalize_booleans(df, cfg=CFG_A)
    return clip_age(df, CFG_A)


def _a_flags(spark, d):
    return add_labels_flags(make_time_features(_a_clean(spark, d), CFG_A), CFG_A)


def q_clean_names(spark, d):
    c = adapters.table(spark, d, "customer")
    messy = c.select(F.col("c_custkey").alias(" C CustKey"), F.col("c_name").alias("C Name "),
                     F.col("c_nationkey").alias("c NationKey"), F.col("c_acctbal").alias(" C AcctBal "),
                     F.col("c_mktsegment").alias("C MktSegment"))
    return clean_column_names(messy)


def q_string_standardize(spark, d):
    return standardize_strings(adapters.raw_events(spark, d), cfg=CFG_A).select("event_id", *TEXT_COLS)


def q_bool_normalize(spark, d):
    return (normalize_booleans(standardize_strings(adapters.raw_events(spark, d), cfg=CFG_A), cfg=CFG_A)
            .select("event_id", "citation_issued", "arrest_made", "warning_issued"))


def q_range_null_out(spark, d):
    return _a_clean(spark, d).select("event_id", "subject_age")


def q_time_features(spark, d):
    df = make_time_features(_a_clean(spark, d), CFG_A)
    return _time_cols(df).select("event_id", "date", "stop_ts", "year", "time_available", "hour_of_day",
                                 "hour_sin", "hour_cos", "day_of_week", "is_weekend")


def q_flags(spark, d):
    return _a_flags(spark, d).select("event_id", "citation_yn", "arrest_yn", "location_known",
                                     "county_known", "subject_race", "subject_sex")


def q_outcome_priority(spark, d):
    return _a_flags(spark, d).select("event_id", "outcome_multiclass")


def q_key_normalize(spark, d):
    return _a_flags(spark, d).select("event_id", "county_name_norm")


def q_cohort_filter(spark, d):
    df = make_time_features(_a_clean(spark, d), CFG_A)
    return (df.where((F.col("time_available") == 1) & F.col("citation_issued").isNotNull())
              .select("event_id", "citation_issued", "time_available"))


def q_distinct_years(spark, d):
    return distinct_values(adapters.typed_facts(spark, d, with_place=False), "year")


def q_frequency_encode(spark, d):
    b = adapters.typed_facts(spark, d, with_supplier=True, with_place=False)
    return frequency_encode(b, "department_name", "dept_freq").select(
        "l_orderkey", "l_linenumber", "department_name", "dept_freq")


def _render(spark, d, datasets, skip=None):
    base = scratch_path(spark, "payloads")
    ref = adapters.reference_dimension(spark, d, every=True)
    adapters.render_payloads(ref, base, datasets, MEASURE_NAMES, skip=skip)
    return base


def q_ref_payload_parse(spark, d):
    one = [("all", tuple(MEASURE_NAMES))]
    base = _render(spark, d, one)
    return reference_from_payloads(spark, base, one, name_suffix=" county, north carolina").select(*REF_COLS)


def q_ref_merge(spark, d):
    skip = {"subject": F.col("county_fips3").cast("int") % 5 == 0,
            "profile": F.col("county_fips3").cast("int") % 4 == 1}
    base = _render(spark, d, DATASETS, skip)
    return reference_from_payloads(spark, base, DATASETS).select(*REF_COLS)


def _b_ref(spark, d):
    b = adapters.typed_facts(spark, d)
    return attach_reference(b, adapters.reference_dimension(spark, d), CFG_B)


def q_floor_year_join(spark, d):
    return _b_ref(spark, d).select("l_orderkey", "l_linenumber", "county_name_norm", "year",
                                   "acs_year", *REF_COLS[2:])


def q_nearest_year_join(spark, d):
    """Strict reference join: each place's own nearest year, over a reference with gaps (only the
    place-years whose median is not below the mean of all)."""
    ref = store_table(adapters.reference_dimension(spark, d), "reference")
    mean = ref.agg(F.avg("median_income")).first()[0]
    b = attach_reference(adapters.typed_facts(spark, d), ref.where(F.col("median_income") >= mean), CFG_B.with_(mode=STRICT))
    return b.select("l_orderkey", "l_linenumber", "county_name_norm", "year", "acs_year", "median_income")


def q_colocated_frequency(spark, d):
    """Key frequency joined to facts that are stored by the key: only the lookup moves."""
    lines = adapters.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    facts = write_colocated(lines, "l_partkey", buckets=16)
    return colocated_join(facts, key_frequency(lines, "l_partkey", "part_freq"))


def q_group_share(spark, d):
    return add_group_share(adapters.typed_facts(spark, d), CFG_B).select(
        "l_orderkey", "l_linenumber", "county_name_norm", "grp", "minority_share_stop", "n_stops_county")


def _ses(spark, d):
    return add_demographic_buckets(_b_ref(spark, d), CFG_B, relative_error=None)


def q_quartile_breaks(spark, d):
    parts = summary_breaks(_b_ref(spark, d), CFG_B, "median_income")
    tagged = (parts.income_breaks.withColumn("b", F.lit("income"))
              .unionByName(parts.share_breaks.withColumn("b", F.lit("share"))))
    # Two one-row tables side by side: one aggregate over their union, no join.
    return tagged.agg(*[F.max(F.when(F.col("b") == b, F.col(f"q{i}"))).alias(f"{b}_q{i}")
                        for b in ("income", "share") for i in (1, 2, 3)])


def q_income_quartile(spark, d):
    return _ses(spark, d).df.select("l_orderkey", "l_linenumber", "median_income", "income_quartile")


def q_share_quartile(spark, d):
    return _ses(spark, d).df.select("l_orderkey", "l_linenumber", "county_name_norm",
                                    "minority_share_stop", "minority_share_bucket")


def q_ses_buckets(spark, d):
    return _ses(spark, d).df.select("l_orderkey", "l_linenumber", "county_name_norm", "grp",
                                    "median_income", "income_quartile", "minority_share_stop",
                                    "n_stops_county", "minority_share_bucket")


def q_hash_split(spark, d):
    return hash_split(adapters.raw_events(spark, d), "event_id").select("event_id", "split")


def q_class_weights(spark, d):
    return class_counts(adapters.typed_facts(spark, d, with_place=False), "label")


def q_fairness_by_group(spark, d):
    return fairness_by(adapters.typed_facts(spark, d), "label", "pred", "grp")


def q_fairness_grouping_sets(spark, d):
    return fairness_grouping_sets(adapters.typed_facts(spark, d), "label", "pred", ["grp", "sex"])


def q_fairness_by_bucket(spark, d):
    m = bucket_metrics(_ses(spark, d).df, "label", "pred", None,
                       [("income", "income_quartile"), ("share", "minority_share_bucket")], "grp")
    return m.select("bucketing", "bucket", "grp", *COUNT_COLS, "TPR", "FPR", "Rate")


def q_rates_by_income_group(spark, d):
    r = rates_by_bucket(_ses(spark, d).df, "label", "score", "income_quartile", "grp")
    return r.withColumn("avg_pred_prob", F.round("avg_pred_prob", 6))


def q_rates_by_share_group(spark, d):
    r = rates_by_bucket(_ses(spark, d).df, "label", "score", "minority_share_bucket", "grp")
    return r.withColumn("avg_pred_prob", F.round("avg_pred_prob", 6))


def q_audit_report(spark, d):
    rep = audit(_ses(spark, d).df, "label", "score", "pred", "grp")
    return rep.withColumn("value", F.when(F.col("metric") == "avg_pred_prob", F.round("value", 6))
                                    .otherwise(F.col("value")))


def q_auroc_score(spark, d):
    return ranking_metrics(adapters.typed_facts(spark, d, with_place=False), "score", "label").select(_r6("auroc"))


def q_aupr_score(spark, d):
    return ranking_metrics(adapters.typed_facts(spark, d, with_place=False), "score", "label").select(_r6("aupr"))


def q_rank_unique_score(spark, d):
    """Both areas over a score with almost no ties, so the ranking runs over many slices."""
    o = adapters.table(spark, d, "orders").select(
        F.col("o_totalprice").alias("score"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"))
    return ranking_metrics(o, "score", "label").select(_r6("auroc"), _r6("aupr"))


def q_rank_binned(spark, d):
    """Both areas over the curve down-sampled to a stated number of bins."""
    o = adapters.table(spark, d, "orders").select(
        F.col("o_totalprice").alias("score"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"))
    out = None
    for bins in (100, 1000):
        m = binned_ranking_metrics(o, "score", "label", bins).select(F.lit(bins).alias("bins"), "n_points", _r6("auroc"), _r6("aupr"))
        out = m if out is None else out.unionByName(m)
    return out


def q_category_index(spark, d):
    b = adapters.typed_facts(spark, d, with_part=True, with_place=False)
    return index_categories(b, "p_type", category_dictionary(b, "p_type"), "p_type_idx").select("p_type", "p_type_idx").distinct()


def q_one_hot(spark, d):
    b = adapters.typed_facts(spark, d, with_part=True, with_place=False)
    idx = StringIndexer(inputCol="p_type", outputCol="p_type_idx", handleInvalid="keep").fit(b).transform(b)
    oh = OneHotEncoder(inputCols=["p_type_idx"], outputCols=["p_type_oh"]).fit(idx).transform(idx)
    arr = vector_to_array("p_type_oh")
    return (oh.select("p_type", (F.array_position(arr, 1.0) - 1).cast("int").alias("slot"),
                      F.size(arr).alias("size"))
              .distinct())


def q_impute_median(spark, d):
    df = median_impute(_a_clean(spark, d), ["subject_age"])
    return df.select("event_id", "subject_age_imp")


def q_std_scale(spark, d):
    b = adapters.typed_facts(spark, d, with_place=False)
    v = VectorAssembler(inputCols=["l_quantity", "score"], outputCol="raw").transform(b)
    s = StandardScaler(inputCol="raw", outputCol="scaled", withStd=True, withMean=False).fit(v).transform(v)
    arr = vector_to_array("scaled")
    return s.select("l_orderkey", "l_linenumber", F.round(arr[0], 6).alias("l_quantity_scaled"),
                    F.round(arr[1], 6).alias("score_scaled"))


def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "raw-csv")
    write_raw_csv(adapters.raw_events(spark, d), path)
    return read_raw_csv(spark, path, adapters.RAW_COLUMNS)


def q_csv_quarantine(spark, d):
    """Raw files of which one lacks columns and one has a column too many: good records and
    malformed ones are kept apart, and the load's own counters agree."""
    raw = adapters.raw_events(spark, d)
    land = scratch_path(spark, "raw-mixed")
    write_raw_csv(raw, f"{land}/file=good")
    write_raw_csv(raw.select(*raw.columns[:9]), f"{land}/file=short")
    write_raw_csv(raw.withColumn("surplus", F.lit("x")), f"{land}/file=long")
    load = load_raw_csv(spark, f"{land}/*", adapters.RAW_COLUMNS)
    good = load.good.select(F.lit("good").alias("kind"), F.col("event_id").cast("bigint").alias("id"))
    bad = load.malformed.select(F.lit("malformed").alias("kind"), F.substring_index("record", ",", 1).cast("bigint").alias("id"))
    counted = F.when(F.col("kind") == "good", F.lit(load.n_good)).otherwise(F.lit(load.n_malformed)).cast("bigint")
    return (good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))
                .withColumn("counted", counted))


def _enriched(spark, d):
    return enrich(adapters.raw_events(spark, d), adapters.reference_dimension(spark, d), CFG_A)


def _enriched_out(df):
    return _time_cols(df).select(*ENRICHED_COLUMNS)


def q_enrich_full(spark, d):
    return _enriched_out(_enriched(spark, d))


def q_enriched_roundtrip(spark, d):
    path = scratch_path(spark, "enriched")
    write_partitioned(_enriched(spark, d), path, "year")
    return _enriched_out(read_table(spark, path))


def q_read_or_build(spark, d):
    path = scratch_path(spark, "enriched-rob")
    read_or_build(spark, path, lambda: _enriched(spark, d))          # absent: build + write
    again = read_or_build(spark, path, lambda: _enriched(spark, d))  # present: plain read
    return _enriched_out(again)


def q_published_table(spark, d):
    """Rows a year of the enriched table, read through its manifest, beside the manifest's own count."""
    path = scratch_path(spark, "published")
    publish_table(_enriched(spark, d), path)
    again = read_published(spark, path)
    return (again.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))
                 .withColumn("published_rows", F.lit(current(spark, path).n_rows).cast("bigint")))


def q_saved_pipeline(spark, d):
    """Train-only frequency, exact median and quartile bucket as stages of one pipeline, fitted on the
    train split, saved, loaded and applied to all rows."""
    tagged = hash_split(_a_clean(spark, d).select("event_id", "department_name", "subject_age"), "event_id")
    rows = store_table(tagged, "split-rows")
    stages = [FrequencyEncoder(inputCol="department_name", outputCol="dept_freq_train"),
              ExactMedianImputer(inputCols=["subject_age"], outputCols=["subject_age_imp"]),
              QuantileBucketizer(inputCol="subject_age_imp", outputCol="age_quartile")]
    path = scratch_path(spark, "pipeline-model")
    save_model(Pipeline(stages=stages).fit(rows.where(F.col("split") == "train")), path)
    return load_model(path).transform(rows).select("event_id", "department_name", "split", "dept_freq_train", "subject_age_imp",
                                                   "age_quartile")


def _order_values(spark, d):
    o = adapters.table(spark, d, "orders").select("o_custkey", "o_totalprice")
    c = adapters.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = adapters.table(spark, d, "nation").select("n_nationkey", "n_name")
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("n_name").alias("place"), F.col("c_mktsegment").alias("segment"), "o_totalprice"))


def _within(errors, *columns):
    return errors.select(*columns, "n", *[(F.col(f"e{i}") <= 0.01).alias(f"q{i}_ok") for i in (1, 2, 3)])


def q_sketch_quantiles(spark, d):
    """One pass builds sketches by (place, segment); merged to places, segments and all, each quartile
    lies within a rank error of 0.01 of the exact one."""
    rows = _order_values(spark, d)
    sketches = store_table(value_sketches(rows, "o_totalprice", ["place", "segment"]), "sketches")
    out = None
    for by in (["place"], ["segment"], ["place", "segment"], []):
        errors = rank_errors(rows, "o_totalprice", sketch_quantiles(merge_sketches(sketches, by)), by)
        key = F.concat_ws("/", *by) if by else F.lit("")
        part = _within(errors.withColumns({"grouping": F.lit("+".join(by) or "all"), "key": key}), "grouping", "key")
        out = part if out is None else out.unionByName(part)
    return out


def q_approx_buckets(spark, d):
    """The approximate bucket breaks (the default mode) with their exact rank errors, by bucketing."""
    done = add_demographic_buckets(_b_ref(spark, d), CFG_B)
    out = None
    for tag, col, breaks in (("income", "median_income", done.income_breaks), ("share", "minority_share_stop", done.share_breaks)):
        q = spark.createDataFrame([tuple(breaks)], "q1 double, q2 double, q3 double")
        part = _within(rank_errors(done.df, col, q).withColumn("bucketing", F.lit(tag)), "bucketing")
        out = part if out is None else out.unionByName(part)
    return out


def q_metrics_json(spark, d):
    path = scratch_path(spark, "metrics-json")
    fair = q_fairness_by_group(spark, d)
    write_json_metrics(fair, path)
    return read_json_metrics(spark, path, fair.schema).select(*fair.columns)


def q_stream_enrich(spark, d):
    """C1 as a stream: raw CSV files land in two batches, an available-now stream enriches
    them into the partitioned table, and the frequency is attached on read."""
    raw = adapters.raw_events(spark, d)
    land = scratch_path(spark, "landing")
    halves = raw.randomSplit([0.5, 0.5], 1)
    for i, part in enumerate(halves):
        write_raw_csv(part, f"{land}/batch={i}")
    out, ckpt = scratch_path(spark, "streamed"), scratch_path(spark, "stream-ckpt")
    q = start_enrich_stream(spark, f"{land}/*", adapters.RAW_COLUMNS, out, ckpt,
                            ref=adapters.reference_dimension(spark, d), cfg=CFG_A, max_files_per_trigger=4)
    q.awaitTermination()
    return _enriched_out(read_enriched(spark, out, CFG_A).withColumn("event_id", F.col("event_id").cast("bigint")))


def q_stream_frequency(spark, d):
    """C1 as a stream that keeps the department counts by epoch: raw files land in two halves, the
    second found by a restarted stream, and the rows are read with the summed counts."""
    land, out, counts, ckpt = (scratch_path(spark, n) for n in ("landing", "streamed", "counts", "stream-ckpt"))
    ref = store_table(adapters.reference_dimension(spark, d), "stream-reference")
    for i, part in enumerate(adapters.raw_events(spark, d).randomSplit([0.5, 0.5], 1)):
        write_raw_csv(part, f"{land}/batch={i}")
        start_frequency_stream(spark, f"{land}/*", adapters.RAW_COLUMNS, out, counts, ckpt, ref, CFG_A,
                               compact_every=1).awaitTermination()
    return _enriched_out(read_with_frequency(spark, out, counts, CFG_A).withColumn("event_id", F.col("event_id").cast("bigint")))


# ------------------------------------------------------------------ rows-only (random / models)

def _cohort_a(spark, d):
    rows = _enriched(spark, d).where(F.col("time_available") == 1)
    return store_table(rows.select(*model_columns(rows, CFG_A, "event_id", CFG_A.county_key)), "cohort")


def q_sample(spark, d):
    return bernoulli_sample(_enriched_out(_enriched(spark, d)), 0.5, 67)


def q_random_split(spark, d):
    tr, te = random_split(_enriched(spark, d))
    return (tr.select("event_id", F.lit("train").alias("split"))
              .unionByName(te.select("event_id", F.lit("test").alias("split"))))


def _share_facts(what, rows, parts, share):
    """How ``parts`` (id sets) relate to ``rows``: rows in none of them or foreign, rows in more than one place,
    and whether the first part's share is within five standard deviations of ``share``."""
    tagged = rows.select("event_id", F.lit(0).alias("part"))
    for i, p in enumerate(parts, 1):
        tagged = tagged.unionByName(p.select("event_id", F.lit(i).alias("part")))
    per = tagged.groupBy("event_id").agg(F.count_if(F.col("part") == 0).alias("here"), F.count_if(F.col("part") == 1).alias("first"),
                                         F.count_if(F.col("part") > 0).alias("taken"))
    n, k = F.sum("here"), F.sum("first")
    lost = F.count_if((F.col("here") == 0) | (F.col("taken") == 0)) if len(parts) > 1 else F.count_if(F.col("here") == 0)
    ok = F.abs(k - n * share) <= 5 * F.sqrt(n * share * (1 - share))
    return per.agg(n.alias("n_rows"), lost.alias("n_lost"), F.count_if(F.col("taken") > F.col("here")).alias("n_twice"),
                   ok.alias("share_ok")).select(F.lit(what).alias("what"), "*")


def q_split_facts(spark, d):
    """The random split is disjoint and complete, the sample is a part of the rows, and both have
    the share that was asked for."""
    rows = store_table(adapters.raw_events(spark, d).select("event_id"), "event-ids")
    train, test = random_split(rows)
    return _share_facts("split", rows, [train, test], 0.8).unionByName(
        _share_facts("sample", rows, [bernoulli_sample(rows, 0.5, 67)], 0.5))


def q_class_weight_rows(spark, d):
    """Row-level class weights of the train split (P20)."""
    b = adapters.typed_facts(spark, d, with_place=False).select("l_orderkey", "l_linenumber", "label")
    train = hash_split(b, "l_orderkey").where(F.col("split") == "train")
    weighted = apply_class_weights(train, "label", fit_class_weights(train, "label"))
    return weighted.select("l_orderkey", "l_linenumber", "label", F.round("class_w", 9).alias("class_w"))


def q_model_facts(spark, d):
    """What SQL can state of a fitted model's scores and of their audit, by bucket and group."""
    model, cohort, _ = _fit_one(spark, d, "lr")
    b = add_demographic_buckets(cohort, CFG_A, relative_error=None).df
    scored = store_table(score(model, b).select("citation_issued", "subject_race", "income_quartile", "minority_share_bucket",
                                                "prediction", "p_hat"), "scored")
    wrong = F.col("prediction") != (F.col("p_hat") > 0.5).cast("double")
    counts = scored.agg(F.count(F.lit(1)).alias("a"), F.count_if(wrong).alias("b"), F.count_if(~F.col("p_hat").between(0, 1)).alias("c"))
    pair = lambda n, c: F.struct(F.lit(n).alias("fact"), F.col(c).cast("double").alias("value"))
    facts = counts.select(F.explode(F.array(pair("scored", "a"), pair("prediction is not p_hat > 0.5", "b"), pair("p_hat outside 0 to 1", "c"))).alias("x"))
    facts = facts.select("x.fact", F.lit("").alias("bucket"), F.lit("").alias("grp"), "x.value")
    rep = audit(scored, "citation_issued", "p_hat", "prediction", "subject_race").where(
        (F.col("report").startswith("rates") & (F.col("metric") == "n_stops")) | (F.col("report").startswith("fair") & F.col("metric").isin("P", "N")))
    return facts.unionByName(rep.select(F.concat_ws(" ", "report", "metric").alias("fact"), "bucket", "grp", "value"))


def _fit_one(spark, d, kind):
    """LR or GBT with time features on the citation label, trained on the hash-split train
    part of the enriched cohort."""
    c = _cohort_a(spark, d)
    tagged = hash_split(c.where(F.col("citation_issued").isNotNull()), "event_id")
    train = tagged.where(F.col("split") == "train")
    test = tagged.where(F.col("split") == "test")
    w = fit_class_weights(train, "citation_issued")
    v = fit_variant(apply_class_weights(train, "citation_issued", w), "citation_issued", CFG_A,
                    include_time=True, run_gbt=(kind == "gbt"), run_lr=(kind == "lr"))
    model = v.gbt if kind == "gbt" else v.lr
    return model, c, test


def q_train_lr(spark, d):
    model, _, test = _fit_one(spark, d, "lr")
    return score(model, test).select("event_id", "citation_issued", "prediction", "p_hat")


def q_train_gbt(spark, d):
    model, _, test = _fit_one(spark, d, "gbt")
    return score(model, test).select("event_id", "citation_issued", "prediction", "p_hat")


def q_model_score(spark, d):
    model, cohort, _ = _fit_one(spark, d, "lr")
    return score(model, cohort).select("event_id", "citation_issued", "prediction", "p_hat")


def q_model_compare(spark, d):
    c = _cohort_a(spark, d)
    runs = [train_evaluate(c, lab, CFG_A, split_key="event_id", exact_metrics=True)
            for lab in CFG_A.labels]
    out = runs[0].metrics
    for r in runs[1:]:
        out = out.unionByName(r.metrics)
    return out


def q_model_audit(spark, d):
    """C4 on a fitted model: LR with time features scores the whole cohort, then rates
    and fairness by share bucket x group."""
    model, cohort, _ = _fit_one(spark, d, "lr")
    b = add_demographic_buckets(cohort, CFG_A, relative_error=None).df
    return audit(score(model, b), "citation_issued", "p_hat", "prediction", "subject_race")


QUERIES: dict[str, Query] = {
    "clean_names": q_clean_names,
    "string_standardize": q_string_standardize,
    "bool_normalize": q_bool_normalize,
    "range_null_out": q_range_null_out,
    "time_features": q_time_features,
    "flags": q_flags,
    "outcome_priority": q_outcome_priority,
    "key_normalize": q_key_normalize,
    "cohort_filter": q_cohort_filter,
    "distinct_years": q_distinct_years,
    "frequency_encode": q_frequency_encode,
    "ref_payload_parse": q_ref_payload_parse,
    "ref_merge": q_ref_merge,
    "floor_year_join": q_floor_year_join,
    "group_share": q_group_share,
    "quartile_breaks": q_quartile_breaks,
    "income_quartile": q_income_quartile,
    "share_quartile": q_share_quartile,
    "ses_buckets": q_ses_buckets,
    "hash_split": q_hash_split,
    "class_weights": q_class_weights,
    "fairness_by_group": q_fairness_by_group,
    "fairness_grouping_sets": q_fairness_grouping_sets,
    "fairness_by_bucket": q_fairness_by_bucket,
    "rates_by_income_group": q_rates_by_income_group,
    "rates_by_share_group": q_rates_by_share_group,
    "audit_report": q_audit_report,
    "auroc_score": q_auroc_score,
    "rank_unique_score": q_rank_unique_score,
    "aupr_score": q_aupr_score,
    "rank_binned": q_rank_binned,
    "nearest_year_join": q_nearest_year_join,
    "colocated_frequency": q_colocated_frequency,
    "csv_quarantine": q_csv_quarantine,
    "category_index": q_category_index,
    "one_hot": q_one_hot,
    "impute_median": q_impute_median,
    "std_scale": q_std_scale,
    "csv_roundtrip": q_csv_roundtrip,
    "enrich_full": q_enrich_full,
    "enriched_roundtrip": q_enriched_roundtrip,
    "read_or_build": q_read_or_build,
    "published_table": q_published_table,
    "saved_pipeline": q_saved_pipeline,
    "sketch_quantiles": q_sketch_quantiles,
    "approx_buckets": q_approx_buckets,
    "metrics_json": q_metrics_json,
    "stream_enrich": q_stream_enrich,
    "stream_frequency": q_stream_frequency,
    "sample": q_sample,
    "random_split": q_random_split,
    "split_facts": q_split_facts,
    "class_weight_rows": q_class_weight_rows,
    "model_facts": q_model_facts,
    "train_lr": q_train_lr,
    "train_gbt": q_train_gbt,
    "model_score": q_model_score,
    "model_compare": q_model_compare,
    "model_audit": q_model_audit,
}


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return QUERIES[name](spark, sf_dir)
