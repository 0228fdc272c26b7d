"""Composite jobs (C1-C4): enrichment build, socio-economic bucketing, train/evaluate per
label and the demographic audit."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.operators.buckets import BucketResult, add_demographic_buckets
from disparo.operators.clean import (clean_column_names, clip_age, normalize_booleans,
                                     standardize_strings)
from disparo.operators.encode import (apply_class_weights, bernoulli_sample, fit_class_weights,
                                      frequency_encode, hash_split)
from disparo.operators.fairness import bucket_metrics, fairness_grouping_sets
from disparo.operators.flags import add_labels_flags
from disparo.operators.lookup import materialize
from disparo.operators.model import fit_estimator, fit_shared_features, model_columns, score
from disparo.operators.ranking import ranking_metrics
from disparo.operators.refdata import attach_reference
from disparo.operators.timefeat import make_time_features
from disparo.session import keep_methods_compiled
from disparo.sources.tables import read_or_build, save_model, write_json_metrics

log = logging.getLogger(__name__)


# ---------------------------------------------------------------- C1 enrichment

def enrich_rows(raw: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """The row-local part of enrichment: names, null tokens, yes/no flags, age range,
    time features, flags and place key.  Works on batch and streaming frames alike."""
    keep_methods_compiled(raw.sparkSession)
    df = clean_column_names(raw)
    df = standardize_strings(df, cfg=cfg)
    df = normalize_booleans(df, cfg=cfg)
    df = clip_age(df, cfg)
    df = make_time_features(df, cfg)
    return add_labels_flags(df, cfg)


def add_frequency(df: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    if cfg.department_column not in df.columns:
        return df
    return frequency_encode(df, cfg.department_column, "dept_freq")


def add_reference(df: DataFrame, ref: DataFrame | None, cfg: EventConfig = EventConfig()) -> DataFrame:
    if ref is None or cfg.county_key not in df.columns:
        return df
    return attach_reference(df, ref, cfg)


def enrich(raw: DataFrame, ref: DataFrame | None = None, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Raw text records -> enriched table (C1, lazy): row-local cleaning and features,
    department frequency over all rows, then the reference join."""
    return add_reference(add_frequency(enrich_rows(raw, cfg), cfg), ref, cfg)


def build_enriched(spark: SparkSession, path: str, build_raw, build_ref=None,
                   cfg: EventConfig = EventConfig()) -> DataFrame:
    """Read the enriched table at ``path`` or build it from raw, write it partitioned by
    year and re-read it (so later stages scan Parquet with pushdown)."""
    return read_or_build(spark, path, lambda: enrich(build_raw(), build_ref() if build_ref else None, cfg))


# ---------------------------------------------------------------- C2 buckets

def cohort(enriched: DataFrame, fraction: float = 1.0, seed: int = 67) -> DataFrame:
    """Optional sample, then the rows with a time of day (F6, F1)."""
    return bernoulli_sample(enriched, fraction, seed).where(F.col("time_available") == 1)


def ses_buckets(df: DataFrame, cfg: EventConfig = EventConfig(),
                relative_error: float | None = 0.01) -> BucketResult:
    return add_demographic_buckets(df, cfg, relative_error=relative_error)


# ---------------------------------------------------------------- C3 train / evaluate

@dataclass
class LabelRun:
    label: str
    metrics: DataFrame                   # label, model, auroc, aupr
    fairness: DataFrame                  # label, model, dimension, grp, TP..Rate
    counts: dict
    models: dict = field(default_factory=dict)


def split(base: DataFrame, cfg: EventConfig, key: str | None = None):
    """80/20 split: seeded random split (parity) or a reproducible key-hash split."""
    if key is None:
        return base.randomSplit([0.8, 0.2], cfg.seed)
    tagged = hash_split(base, key)
    return (tagged.where(F.col("split") == "train").drop("split"),
            tagged.where(F.col("split") == "test").drop("split"))


def evaluate(model, test: DataFrame, label: str, name: str, cfg: EventConfig, exact: bool):
    dims = [c for c in (cfg.group_column, cfg.sex_column) if c in test.columns]
    raw = [] if exact else ["rawPrediction"]
    pred = (score(model, test).select(label, "p_hat", "prediction", *raw, *dims)
            .persist(StorageLevel.MEMORY_AND_DISK))
    if exact:
        m = ranking_metrics(pred, "p_hat", label).select("auroc", "aupr")
    else:
        ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
        roc = ev.setMetricName("areaUnderROC").evaluate(pred)
        pr = ev.setMetricName("areaUnderPR").evaluate(pred)
        m = test.sparkSession.createDataFrame([(roc, pr)], "auroc double, aupr double")
    metrics = m.select(F.lit(label).alias("label"), F.lit(name).alias("model"), "auroc", "aupr")
    fair = fairness_grouping_sets(pred, label, "prediction", dims).select(
        F.lit(label).alias("label"), F.lit(name).alias("model"), "*")
    return pred, metrics, fair


def train_evaluate(df: DataFrame, label: str, cfg: EventConfig = EventConfig(),
                   out_base: str | None = None, run_gbt: bool = True, split_key: str | None = None,
                   exact_metrics: bool = False, parallelism: int = 2) -> LabelRun:
    """C3 for one label: split, class weights, T0/T1 x LR/GBT, ranking and fairness
    metrics; models and metrics are written under ``out_base`` when given.

    The feature stages are fitted once for both variants, and train and test rows are turned into
    vectors once for all models.  ``parallelism`` > 1 fits and evaluates the models from concurrent
    driver threads; 1 does so one after another."""
    base = df.where(F.col(label).isNotNull())
    train, test = split(base, cfg, split_key)
    kept = model_columns(base, cfg, label)
    dims = [c for c in (cfg.group_column, cfg.sex_column) if c in test.columns]
    train = train.select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
    held = [train]
    try:
        w = fit_class_weights(train, label)
        weighted = apply_class_weights(train, label, w)
        shared = fit_shared_features(weighted, cfg, parallelism > 1)
        # The vectors are read a few times only, so they stay on disk: the memory is for what the fits
        # themselves keep and read in every pass.  They are built by one job, as fits that start at once
        # would wait for each other's rows.
        vectors = shared.transform(weighted, label, "class_w").persist(StorageLevel.DISK_ONLY)
        held.append(vectors)
        vectors.count()
        train.unpersist()
        test = shared.transform(test.select(*kept), label, *dims).persist(StorageLevel.DISK_ONLY)
        held.append(test)

        def run(kind, include_time):
            tag, name = ("T1_with_time", "T1") if include_time else ("T0_no_time", "T0")
            fitted = fit_estimator(kind, vectors, label, cfg, shared.column(include_time))
            pred, m, f = evaluate(fitted, test, label, f"{kind.upper()}_{tag}_{label}", cfg, exact_metrics)
            out = _materialize(m), _materialize(f)
            pred.unpersist()
            return f"{kind.upper()}_{name}", PipelineModel(shared.stages(include_time) + [fitted]), *out

        models, metric_parts, fair_parts = {}, [], []
        todo = [(kind, t) for t in (False, True) for kind in (("lr", "gbt") if run_gbt else ("lr",))]
        # The models share nothing but the persisted vectors; fit them side by side.
        with ThreadPoolExecutor(len(todo) if parallelism > 1 else 1) as pool:
            for key, model, m, f in pool.map(lambda x: run(*x), todo):
                models[key] = model
                metric_parts.append(m)
                fair_parts.append(f)
    finally:
        for rows in held:
            rows.unpersist()
    metrics = _union(metric_parts)
    fairness = _union(fair_parts)
    counts = {"pos": w.n_pos, "neg": w.n_neg, "N": w.n_pos + w.n_neg, "w_pos": w.w_pos, "w_neg": w.w_neg}
    if out_base:
        for name, model in models.items():
            save_model(model, f"{out_base}/{label}/models/{name}")
        write_json_metrics(metrics, f"{out_base}/{label}/metrics/json")
        write_json_metrics(fairness, f"{out_base}/{label}/metrics/fairness")
    return LabelRun(label, metrics, fairness, counts, models)


def _materialize(df: DataFrame) -> DataFrame:
    # Small per-model metric tables: keep them cheap to re-read after the inputs are released.
    return materialize(df)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- C4 audit

AUDIT_METRICS_RATES = ("actual_rate", "avg_pred_prob", "n_stops")
AUDIT_METRICS_FAIR = ("TP", "P", "FP", "N", "Pos", "TPR", "FPR", "Rate")


def audit(pred: DataFrame, label: str, score_col: str, pred_col: str,
          group_col: str = "subject_race",
          buckets: Sequence[tuple[str, str]] = (("income", "income_quartile"),
                                                ("share", "minority_share_bucket"))) -> DataFrame:
    """C4: actual vs predicted rates and fairness by (bucket x group) for each bucketing,
    in one long table ``report, bucket, grp, metric, value``.

    All bucketings come from one grouping-sets pass over the scored rows.  Buckets missing
    from the table are skipped; empty buckets simply have no rows.
    """
    present = []
    for tag, bcol in buckets:
        if bcol in pred.columns:
            present.append((tag, bcol))
        else:
            log.warning("%s missing; skipping %s audit", bcol, tag)
    m = bucket_metrics(pred, label, pred_col, score_col, present, group_col)
    items = ([("rates_by_", x) for x in AUDIT_METRICS_RATES]
             + [("fairness_by_", x) for x in AUDIT_METRICS_FAIR])
    return _long(m, items)


def _long(df: DataFrame, items: Sequence[tuple[str, str]]) -> DataFrame:
    """Unpivot (report prefix, metric) pairs of every aggregate row in one explode."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(p).alias("prefix"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for p, m in items]))
    return df.select("bucketing", "bucket", F.col("grp").cast("string").alias("grp"), stacked.alias("mv")).select(
        F.concat(F.col("mv.prefix"), F.col("bucketing")).alias("report"), "bucket", "grp",
        "mv.metric", "mv.value")


def run_label_audit(scored: DataFrame, label: str, cfg: EventConfig = EventConfig()) -> DataFrame:
    return audit(scored, label, "p_hat", "prediction", cfg.group_column)


__all__ = ["enrich", "build_enriched", "cohort", "ses_buckets", "train_evaluate", "audit",
           "run_label_audit"]
