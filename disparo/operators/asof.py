"""Nearest reference year of each place (J2 strict, Q9): an as-of lookup per key, distributed.

The rows' distinct (place, year) pairs and the reference's are put on one axis a place; the nearest
reference year before a pair is a running maximum and the one after it a running minimum in sort
order.  As in ``operators.ordered``, both run inside the slices of a range partitioning over
(place, year) and take over from earlier (later) slices one value a place, so a place with a large
share of all pairs is cut into slices instead of going to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disparo.operators.lookup import store_table


def nearest_per_key(wanted: DataFrame, known: DataFrame, key: str, value: str, out_col: str,
                    num_slices: int | None = None) -> DataFrame:
    """(``key``, ``value``, ``out_col``): for each distinct pair of ``wanted`` the nearest ``value`` that ``known`` has
    for the key, the smaller one on a tie.  Pairs with a NULL, and keys that ``known`` does not have,
    are left out.  Stored."""
    pair = [key, value]
    have = known.select(*pair).where(F.col(key).isNotNull() & F.col(value).isNotNull()).distinct()
    want = wanted.select(*pair).where(F.col(key).isNotNull() & F.col(value).isNotNull()).distinct()
    axis = (want.withColumn("have", F.lit(False)).unionByName(have.withColumn("have", F.lit(True)))
                .groupBy(*pair).agg(F.max("have").alias("have"), F.count_if(~F.col("have")).alias("wanted")))
    ranged = axis.repartitionByRange(num_slices, *pair) if num_slices else axis.repartitionByRange(*pair)
    sliced = store_table(ranged.withColumn("__slice", F.spark_partition_id()), "asof-slices")
    mine = F.when(F.col("have"), F.col(value))
    upto = Window.partitionBy("__slice", key).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.partitionBy("__slice", key).orderBy(value).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    local = sliced.withColumns({"__lo": F.max(mine).over(upto), "__hi": F.min(mine).over(onward)})
    # One row a (slice, key): at most slices + keys rows.
    ends = sliced.groupBy("__slice", key).agg(F.max(mine).alias("__top"), F.min(mine).alias("__low"))
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(key).orderBy("__slice").rowsBetween(1, Window.unboundedFollowing)
    ends = ends.select("__slice", key, F.max("__top").over(before).alias("__before"), F.min("__low").over(after).alias("__after"))
    full = local.join(ends, ["__slice", key]).where("wanted > 0").withColumns(
        {"__lo": F.coalesce("__lo", "__before"), "__hi": F.coalesce("__hi", "__after")})
    nearer_high = F.col("__lo").isNull() | (F.col("__hi") - F.col(value) < F.col(value) - F.col("__lo"))
    best = F.when(F.col("__hi").isNotNull() & nearer_high, F.col("__hi")).otherwise(F.col("__lo"))
    return store_table(full.select(key, value, best.alias(out_col)).where(F.col(out_col).isNotNull()), "asof")
