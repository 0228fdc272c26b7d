"""Mergeable quantile sketches (A6, approximate mode): one pass builds a sketch per place, stored
sketches merge to any coarser grouping without reading the rows again.

The sketches are Spark's KLL aggregates.  With ``k`` = 1000 the normalised rank error of a quantile
is below 0.4 % at 99 % confidence, whatever the order of merging; a sketch is a few kilobytes, so
the stored table is bounded by the number of places.  A hot place costs one partial sketch a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.operators.quantiles import QUARTILES

K = 1000


def value_sketches(df: DataFrame, value_col: str, by: Sequence[str], k: int = K) -> DataFrame:
    """(by..., ``sketch``, ``n``): one sketch of the non-NULL, non-NaN values a group."""
    v = F.col(value_col).cast("double")
    return (df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
              .groupBy(*by).agg(F.kll_sketch_agg_double("__v", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n")))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The stored sketches merged to the grouping ``by``; without ``by`` one sketch of all (no row when
    there is none)."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"))
    return merged.where(F.col("n") > 0)


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float] = QUARTILES, names: Sequence[str] | None = None) -> DataFrame:
    """Quantiles of each sketch, as columns ``q1..`` (or ``names``) in place of the sketch."""
    names = list(names or [f"q{i + 1}" for i in range(len(probs))])
    return sketches.select(*[c for c in sketches.columns if c != "sketch"],
                           *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(c) for p, c in zip(probs, names)])


def rank_errors(df: DataFrame, value_col: str, quantiles: DataFrame, by: Sequence[str] = (),
                probs: Sequence[float] = QUARTILES) -> DataFrame:
    """(by..., ``n``, ``e1``..): distance of each probability from the exact rank interval of its quantile
    ``q1``.. among the rows (0 inside the interval), one pass over the rows."""
    names = [f"q{i + 1}" for i in range(len(probs))]
    v = F.col(value_col).cast("double")
    rows = df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    if by:
        known = quantiles.select(*[F.col(c).alias(f"__{c}") for c in by], *names)
        both, at = rows.join(known, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]), {q: F.col(q) for q in names}
    else:  # one row of quantiles
        row = quantiles.first()
        both, at = rows, {q: F.lit(None if row is None else row[q]).cast("double") for q in names}
    sums = both.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[
        F.struct(F.count_if(F.col("__v") < at[q]).alias("lo"), F.count_if(F.col("__v") <= at[q]).alias("hi")).alias(q) for q in names])
    return sums.select(*by, "n", *[
        F.greatest(F.col(f"{q}.lo") / F.col("n") - F.lit(p), F.lit(p) - F.col(f"{q}.hi") / F.col("n"), F.lit(0.0)).alias(f"e{i + 1}")
        for i, (q, p) in enumerate(zip(names, probs))])
