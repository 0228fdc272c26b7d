"""Place-level group share and socio-economic buckets (A5, J3, P21, P22, C2)."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.operators.lookup import DEFAULT_MAX_BROADCAST_ROWS, lookup_join, materialize
from disparo.operators.quantiles import assign_quartile, exact_quantiles, quantile_breaks

log = logging.getLogger(__name__)


def minority_flag(group_col: str, baseline: str, exclusions=()):
    """1.0 when the group differs from the baseline, 0.0 when equal, NULL when NULL.

    Values in ``exclusions`` (e.g. ``unknown``) count as NULL, i.e. are left out of the
    share; by default none are (the reference counts them as non-baseline).
    """
    flag = (F.col(group_col) != F.lit(baseline)).cast("double")
    if exclusions:
        flag = F.when(F.col(group_col).isin(*exclusions), F.lit(None).cast("double")).otherwise(flag)
    return flag


def group_share_table(df: DataFrame, place_col: str, group_col: str, baseline: str,
                      share_col: str = "minority_share_stop", count_col: str = "n_stops_county",
                      exclusions=()) -> DataFrame:
    """Per place: mean of the non-baseline flag (NULL groups skipped) and the row count
    (NULL groups counted).  Partial aggregation keeps a hot place cheap."""
    return (df.groupBy(place_col)
              .agg(F.avg(minority_flag(group_col, baseline, exclusions)).alias(share_col),
                   F.count(F.lit(1)).alias(count_col)))


def add_group_share(df: DataFrame, cfg: EventConfig = EventConfig(),
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Attach the place-level share back onto every row with a checked broadcast join."""
    share = group_share_table(df, cfg.county_key, cfg.group_column, cfg.baseline_group,
                              exclusions=cfg.share_exclusions)
    return lookup_join(df, share, cfg.county_key, "left", max_broadcast_rows)


@dataclass
class BucketResult:
    df: DataFrame
    income_breaks: list | None
    share_breaks: list | None


def add_demographic_buckets(df: DataFrame, cfg: EventConfig = EventConfig(),
                            income_col: str = "median_income", relative_error: float | None = 0.01,
                            max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> BucketResult:
    """Income quartile and place-share quartile for every row (C2).

    Breaks are row-weighted.  A missing or all-NULL column skips its bucket with a warning.
    ``relative_error=None`` gives exact discrete quartiles from one pass over the rows
    (``_exact_buckets``); otherwise the reference's sketch (``approxQuantile``) is used.
    """
    has_income = income_col in df.columns
    has_share = cfg.county_key in df.columns and cfg.group_column in df.columns
    if not has_income:
        log.warning("%s missing; skipping income_quartile", income_col)
    if not has_share:
        log.warning("place key or group column missing; skipping share buckets")
    if relative_error is None:
        return _exact_buckets(df, cfg, income_col if has_income else None, has_share, max_broadcast_rows)
    income_breaks = share_breaks = None
    if has_income:
        income_breaks = quantile_breaks(df, income_col, relative_error=relative_error)
        if income_breaks is not None:
            df = assign_quartile(df, income_col, "income_quartile", income_breaks, cfg.strict)
        else:
            log.warning("%s is all NULL; skipping income_quartile", income_col)
    if has_share:
        df = add_group_share(df, cfg, max_broadcast_rows)
        share_breaks = quantile_breaks(df, "minority_share_stop", relative_error=relative_error)
        if share_breaks is not None:
            df = assign_quartile(df, "minority_share_stop", "minority_share_bucket", share_breaks, cfg.strict)
        else:
            log.warning("minority_share_stop is all NULL; skipping minority_share_bucket")
    return BucketResult(df, income_breaks, share_breaks)


def _exact_buckets(df: DataFrame, cfg: EventConfig, income_col: str | None, has_share: bool,
                   max_broadcast_rows: int) -> BucketResult:
    """Exact buckets from a single scan of the rows.

    One partial-aggregated pass builds a summary per (place, income value): row count,
    sum and count of the non-baseline flag.  Its size is bounded by the distinct
    (place, income) pairs, not by the rows, and once materialised its row count proves
    the size of everything derived from it.  The place shares, the income distribution and
    the row-weighted share distribution all follow from that summary; the row-level pass
    then only joins the share table (broadcast under the proven bound) and compares with
    the literal breaks.
    """
    place = cfg.county_key if has_share else None
    keys = [c for c in (place, income_col) if c]
    if not keys:
        return BucketResult(df, None, None)
    parts = summary_breaks(df, cfg, income_col, has_share)
    income_breaks = _first(parts.income_breaks)
    share_breaks = _first(parts.share_breaks)
    if income_col:
        if income_breaks is not None:
            df = assign_quartile(df, income_col, "income_quartile", income_breaks, cfg.strict)
        else:
            log.warning("%s is all NULL; skipping income_quartile", income_col)
    if has_share:
        df = lookup_join(df, parts.share, place, "left", max_broadcast_rows, known_max_rows=parts.rows)
        if share_breaks is not None:
            df = assign_quartile(df, "minority_share_stop", "minority_share_bucket", share_breaks, cfg.strict)
        else:
            log.warning("minority_share_stop is all NULL; skipping minority_share_bucket")
    return BucketResult(df, income_breaks, share_breaks)


@dataclass
class SummaryParts:
    rows: int                          # rows of the materialised summary (a proven bound)
    share: DataFrame | None            # place, minority_share_stop, n_stops_county
    income_breaks: DataFrame | None    # one row: q1, q2, q3
    share_breaks: DataFrame | None     # one row: q1, q2, q3


def summary_breaks(df: DataFrame, cfg: EventConfig, income_col: str | None,
                   has_share: bool = True) -> SummaryParts:
    """The one-pass summary and the exact, row-weighted breaks derived from it (lazy)."""
    place = cfg.county_key if has_share else None
    keys = [c for c in (place, income_col) if c]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    if has_share:
        flag = minority_flag(cfg.group_column, cfg.baseline_group, cfg.share_exclusions)
        aggs += [F.sum(flag).alias("__flag_sum"), F.count(flag).alias("__flag_n")]
    summary = materialize(df.groupBy(*keys).agg(*aggs))
    n = summary.count()
    income = share = share_q = None
    if income_col:
        income = exact_quantiles(summary, income_col, weight_col="__rows")
    if has_share:
        share = (summary.groupBy(place)
                        .agg((F.sum("__flag_sum") / F.sum("__flag_n")).alias("minority_share_stop"),
                             F.sum("__rows").alias("n_stops_county")))
        # Rows with a NULL place never match the share table, so they carry no share.
        weighted = (summary.where(F.col(place).isNotNull())
                           .groupBy(place).agg(F.sum("__rows").alias("__rows"))
                           .join(share, place))
        share_q = exact_quantiles(weighted, "minority_share_stop", weight_col="__rows")
    return SummaryParts(n, share, income, share_q)


def _first(breaks: DataFrame | None):
    if breaks is None:
        return None
    row = breaks.first()
    if row is None or row[0] is None:
        return None
    return [float(v) for v in row]
