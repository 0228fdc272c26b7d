"""Quantile breaks (A6) and bucket assignment (P22).

``approx`` uses Spark's Greenwald-Khanna sketch (``approxQuantile``), the reference's
default (relative error 0.01).  ``exact`` returns discrete quantiles - the smallest value
whose cumulative count reaches ``ceil(p * n)`` - the same as ``percentile_disc``, without
holding a column in one buffer: values are counted per distinct value first, then ranked
with the sliced running total of ``operators.ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.functions.exprs import quartile_label
from disparo.operators.ordered import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float] = QUARTILES,
                    group_cols: Sequence[str] = (), names: Sequence[str] | None = None,
                    weight_col: str | None = None) -> DataFrame:
    """Discrete quantiles of ``value_col`` (NULLs ignored), one row per group.

    ``weight_col`` (a non-negative integer count) lets a pre-aggregated table stand for
    its rows: a row with weight w counts as w copies of its value.
    Output: group columns + one column per probability (``names`` or ``q1..qk``); the
    global case gives one row (NULLs when there is no value).
    """
    names = list(names or [f"q{i + 1}" for i in range(len(probs))])
    keys = list(group_cols)
    counts = (df.where(F.col(value_col).isNotNull())
                .groupBy(*keys, value_col)
                .agg((F.count(F.lit(1)) if weight_col is None else F.sum(weight_col)).cast("bigint").alias("__n"))
                .where(F.col("__n") > 0))
    ranked = running_totals(counts, value_col, ["__n"], keys, with_totals=True)
    # Exactly one row per (group, probability) crosses the rank ceil(p * n).
    probe = ranked.withColumn("__p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    target = F.greatest(F.ceil(F.col("__p") * F.col("tot___n")), F.lit(1))
    hit = probe.where((F.col("cum___n") >= target) & (F.col("cum___n") - F.col("__n") < target))
    return hit.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__p") == F.lit(float(p)), F.col(value_col))).alias(nm)
          for p, nm in zip(probs, names)])


def quantile_breaks(df: DataFrame, value_col: str, probs: Sequence[float] = QUARTILES,
                    relative_error: float | None = 0.01) -> list[float] | None:
    """Global breaks as Python floats, or None when the column has no non-NULL value.

    ``relative_error=None`` selects the exact distributed path.
    """
    if relative_error is None:
        row = exact_quantiles(df, value_col, probs).first()
        if row is None or row[0] is None:
            return None
        return [float(v) for v in row]
    vals = df.where(F.col(value_col).isNotNull()).approxQuantile(value_col, list(probs), relative_error)
    return [float(v) for v in vals] if vals else None


def assign_quartile(df: DataFrame, value_col: str, out_col: str, breaks: Sequence[float],
                    strict: bool = False) -> DataFrame:
    return df.withColumn(out_col, quartile_label(value_col, breaks, strict=strict))
