"""Running totals over an ordered key, distributed and skew-proof.

Exact quantiles and the ROC / PR curves need a cumulative sum in sort order.  A window
``ORDER BY x`` without ``PARTITION BY`` would pull every row into one task, and a window
per group would pull a whole hot group into one task.  Instead:

1. the input is first reduced to one row per (group, key) by the caller (counts per
   distinct value), so duplicated values cannot pile up;
2. ``repartitionByRange`` over (group..., key) splits the ordered domain into balanced
   slices (a hot group spans many slices), and the rows are stored with their slice id:
   every later step reads that id, none derives it again;
3. each slice computes its local running sum (window over slice x group, bounded by the
   slice size);
4. the per-(slice, group) totals - at most #slices + #groups rows - give each slice its
   offset within its group (a window over that small table);
5. offsets are joined back on (slice, group).

The same steps run at every size; AQE makes a small input one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disparo.operators.lookup import store_table

_PID = "__slice"


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   group_cols: Sequence[str] = (), ascending: bool = True,
                   num_slices: int | None = None, prefix: str = "cum_",
                   with_totals: bool = False) -> DataFrame:
    """Adds ``cum_<c>`` = sum of ``c`` over rows of the same group whose ``order_col`` sorts
    at or before this row's.  ``order_col`` must be unique within a group.  With
    ``with_totals`` also ``tot_<c>`` = the group's whole sum (no extra join needed).
    The sliced rows are written once (an eager step).
    """
    group_cols = list(group_cols)
    key = F.col(order_col).asc_nulls_last() if ascending else F.col(order_col).desc_nulls_last()
    range_cols = [*[F.col(g) for g in group_cols], key]
    # Without an explicit count AQE may merge adjacent slices; merged slices stay in range
    # order, so the stored partition id still orders them.
    ranged = df.repartitionByRange(num_slices, *range_cols) if num_slices else df.repartitionByRange(*range_cols)
    sliced = store_table(ranged.withColumn(_PID, F.spark_partition_id()), "slices")
    local_w = (Window.partitionBy(_PID, *group_cols).orderBy(key)
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.withColumns({f"{prefix}{c}": F.sum(c).over(local_w) for c in sum_cols})
    totals = local.groupBy(_PID, *group_cols).agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    off_w = (Window.partitionBy(*group_cols).orderBy(_PID)
                   .rowsBetween(Window.unboundedPreceding, -1))
    renamed = {g: f"__g{i}" for i, g in enumerate(group_cols)}
    whole_w = Window.partitionBy(*group_cols)
    offsets = totals.select(F.col(_PID).alias("__opid"),
                            *[F.col(g).alias(renamed[g]) for g in group_cols],
                            *[F.coalesce(F.sum(f"__tot_{c}").over(off_w), F.lit(0)).alias(f"__off_{c}")
                              for c in sum_cols],
                            *[F.sum(f"__tot_{c}").over(whole_w).alias(f"__all_{c}") for c in sum_cols])
    cond = [F.col(_PID) == F.col("__opid")] + [F.col(g).eqNullSafe(F.col(renamed[g])) for g in group_cols]
    joined = local.join(offsets, on=cond, how="inner")
    return joined.select(*[F.col(c) for c in df.columns],
                         *[(F.col(f"{prefix}{c}") + F.col(f"__off_{c}")).alias(f"{prefix}{c}")
                           for c in sum_cols],
                         *([F.col(f"__all_{c}").alias(f"tot_{c}") for c in sum_cols] if with_totals else []))
