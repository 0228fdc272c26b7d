"""Reference (place x year) dimension: floor-year key, join and multi-dataset merge
(P19, J2, J4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.functions.exprs import floor_year
from disparo.operators.asof import nearest_per_key
from disparo.operators.lookup import DEFAULT_MAX_BROADCAST_ROWS, lookup_join


def add_reference_year(df: DataFrame, year_col: str = "year", out_col: str = "acs_year",
                       floor: int = 2009) -> DataFrame:
    return df.withColumn(out_col, floor_year(year_col, floor))


def nearest_year(year_col: str, available: Sequence[int]):
    """Map a year to the closest available year (ties to the earlier one); NULL stays NULL.

    Built from literals (midpoints between consecutive available years), so the fact
    rows need no join to find it.
    """
    years = sorted({int(y) for y in available})
    y = F.col(year_col)
    expr = None
    for lo, hi in zip(years, years[1:]):
        cond = y <= F.lit((lo + hi) / 2.0)
        expr = F.when(cond, F.lit(lo)) if expr is None else expr.when(cond, F.lit(lo))
    last = F.lit(years[-1])
    return F.when(y.isNull(), F.lit(None).cast("int")).otherwise(
        last if expr is None else expr.otherwise(last))


def attach_reference(df: DataFrame, ref: DataFrame, cfg: EventConfig = EventConfig(),
                     ref_year_col: str = "acs_year",
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Left-join the reference table on (place key, floored year) (J2).

    Parity: years before the floor use the floor year; later years without reference rows
    get NULL measures (no ceiling and no nearest-year search, as in the reference).
    Strict: every year uses the nearest year for which the place itself has a reference row (the
    earlier one on a tie), see ``operators.asof``; a place without any gets NULL.  On a stream, whose
    keys cannot be listed, strict takes the nearest year that any place has.  The reference must hold one row per key; this is checked so the join never multiplies
    fact rows.  Reference columns other than the keys (e.g. ``state``) are kept.
    """
    if cfg.county_key not in df.columns or "year" not in df.columns:
        return df
    place = cfg.county_key
    if cfg.strict and not df.isStreaming:
        known = ref.select(place, F.col(ref_year_col).alias("year"))
        near = nearest_per_key(df, known, place, "year", ref_year_col)
        return lookup_join(df, near.join(ref, [place, ref_year_col]), [place, "year"], "left", max_broadcast_rows)
    years = []
    if cfg.strict:
        # The distinct reference years are a handful of values, read once.
        years = [r[0] for r in ref.select(ref_year_col).distinct().collect() if r[0] is not None]
    if years:
        df = df.withColumn(ref_year_col, nearest_year("year", years))
    else:
        df = add_reference_year(df, "year", ref_year_col, cfg.floor_year)
    return lookup_join(df, ref, [place, ref_year_col], "left", max_broadcast_rows)


def merge_datasets(parts: Sequence[DataFrame], keys: Sequence[str], order_col: str = "dataset_order",
                   name_col: str = "NAME") -> DataFrame:
    """Merge several pulls of the same keys (J4): union of keys, measures taken from the
    dataset that has them, and the name from the last dataset that has the key.

    Each part carries ``order_col`` (its position in the pull sequence).
    """
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    measures = [c for c in u.columns if c not in set(keys) | {order_col, name_col}]
    return (u.groupBy(*keys)
             .agg(F.max_by(name_col, order_col).alias(name_col),
                  *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c) for c in measures]))
