"""The whole job: enrich (or reuse), bucket, train/evaluate per label, audit.

    python -m disparo.plans.pipeline --raw RAW_CSV --enriched ENRICHED_DIR --out OUT_DIR \\
        [--payloads PAYLOAD_DIR] [--sample 1.0] [--no-gbt] [--strict] [--exact-breaks]

Outputs under ``OUT_DIR/<run stamp>/<label>/``: ``models/{LR,GBT}_{T0,T1}``,
``metrics/json`` (AUROC/AUPR per model), ``metrics/fairness`` (by group and sex per
model), ``metrics/class_counts``, ``metrics/demographics`` (audit long table) and
``metrics/breaks``.  As in the reference, a failing audit is logged and skipped.
"""

from __future__ import annotations

import argparse
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.config import PARITY, STRICT, EventConfig
from disparo.operators.lookup import store_table
from disparo.operators.model import score
from disparo.plans.jobs import build_enriched, cohort, run_label_audit, ses_buckets, train_evaluate
from disparo.sources.payload import reference_from_payloads
from disparo.sources.tables import read_raw_csv, write_json_metrics

log = logging.getLogger(__name__)


def run_pipeline(spark: SparkSession, raw_path: str, enriched_path: str, out_base: str,
                 payload_dir: str | None = None, cfg: EventConfig = EventConfig(),
                 sample_fraction: float = 1.0, run_gbt: bool = True,
                 relative_error: float | None = 0.01, stamp: str | None = None) -> dict:
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")
    out = f"{out_base}/{stamp}"
    enriched = build_enriched(
        spark, enriched_path, lambda: read_raw_csv(spark, raw_path),
        (lambda: reference_from_payloads(spark, payload_dir)) if payload_dir else None, cfg)
    buckets = ses_buckets(cohort(enriched, sample_fraction, cfg.seed), cfg, relative_error)
    # The bucketed cohort feeds every fit; write it once so the fits start from a short lineage.
    df = store_table(buckets.df, "cohort")
    _write_breaks(spark, buckets.income_breaks, buckets.share_breaks, f"{out}/metrics/breaks")
    runs = {}
    for label in cfg.labels:
        if label not in df.columns:
            log.warning("label %s missing; skipped", label)
            continue
        run = train_evaluate(df, label, cfg, out_base=out, run_gbt=run_gbt)
        write_json_metrics(spark.createDataFrame([run.counts]), f"{out}/{label}/metrics/class_counts")
        try:
            scored = score(run.models["LR_T1"], df.where(F.col(label).isNotNull()))
            write_json_metrics(run_label_audit(scored, label, cfg), f"{out}/{label}/metrics/demographics")
        except Exception as e:  # noqa: BLE001 - the reference logs and continues
            log.warning("demographic audit failed for %s: %s", label, e)
        runs[label] = run
    return {"out": out, "runs": runs, "income_breaks": buckets.income_breaks,
            "share_breaks": buckets.share_breaks}


def _write_breaks(spark: SparkSession, income, share, path: str) -> None:
    rows = [(name, i + 1, float(v)) for name, br in (("income", income), ("share", share)) if br
            for i, v in enumerate(br)]
    if rows:
        df: DataFrame = spark.createDataFrame(rows, "bucketing string, q int, value double")
        write_json_metrics(df, path)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--raw", required=True)
    ap.add_argument("--enriched", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--payloads")
    ap.add_argument("--sample", type=float, default=1.0)
    ap.add_argument("--no-gbt", action="store_true")
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--exact-breaks", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("disparo-pipeline").getOrCreate()
    from disparo.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    cfg = EventConfig(mode=STRICT if a.strict else PARITY)
    res = run_pipeline(spark, a.raw, a.enriched, a.out, a.payloads, cfg, a.sample, not a.no_gbt,
                       None if a.exact_breaks else 0.01)
    log.warning("outputs written under %s", res["out"])


if __name__ == "__main__":
    main()
