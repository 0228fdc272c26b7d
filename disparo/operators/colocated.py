"""Joining facts to a large lookup without moving the facts (J1, J3 above the broadcast limit).

``write_colocated`` stores the facts once, bucketed by the join key; afterwards any lookup keyed
alike is dealt to the same buckets (only the lookup moves) and joined bucket by bucket.  The saved
exchange is that of the facts, at every join.

A bucket is one task, so a key with a large share of the rows must not sit in one: keys above
``hot_share`` of the rows (fewer than ``1 / hot_share`` keys, by counting) and NULL keys, which never match,
are stored apart without buckets.  The hot keys' lookup rows are as few as those keys, so they are
broadcast to the hot part.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.operators.lookup import store_table
from disparo.session import scratch_path

BUCKETS = 200
HOT_SHARE = 0.001


@dataclass(frozen=True)
class Colocated:
    """Facts stored by key: a bucketed table, and the hot and NULL keys' rows beside it."""
    spark: SparkSession
    key: str
    buckets: int
    table: str            # the bucketed part, a table of the session's catalog
    hot_path: str | None  # Parquet of the hot keys' and NULL keys' rows
    hot_keys: DataFrame   # one row a hot key

    def cold(self) -> DataFrame:
        return self.spark.table(self.table)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.cold().schema).parquet(self.hot_path)


def write_colocated(df: DataFrame, key: str, name: str | None = None, path: str | None = None, buckets: int = BUCKETS,
                    hot_share: float = HOT_SHARE) -> Colocated:
    """Store ``df`` by ``key``; files go to ``path`` (default: the shared scratch folder), the bucketed part is
    registered as table ``name``."""
    spark = df.sparkSession
    name = name or f"disparo_colocated_{uuid.uuid4().hex[:12]}"
    path = path or scratch_path(spark, "colocated")
    counts = store_table(df.groupBy(F.col(key).alias("hot")).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = store_table(counts.where(F.col("hot").isNotNull() & (F.col("n") > max(1, int(hot_share * total)))).select("hot"), "hot-keys")
    # At most 1 / hot_share rows, so this broadcast has a proven bound.
    tagged = df.join(F.broadcast(hot), F.col(key) == F.col("hot"), "left")
    apart = F.col(key).isNull() | F.col("hot").isNotNull()
    # Dealt by the key's bucket first: one file a bucket, not one a task and bucket.
    cold = tagged.where(~apart).drop("hot").repartition(buckets, key)
    cold.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/cold").saveAsTable(name)
    tagged.where(apart).drop("hot").write.parquet(f"{path}/hot")
    return Colocated(spark, key, buckets, name, f"{path}/hot", hot)


def colocated_join(facts: Colocated, lookup: DataFrame) -> DataFrame:
    """``facts LEFT JOIN lookup USING (key)``; the bucketed facts are read where they are, without an
    exchange.  ``lookup`` must have one row a key (a duplicate raises)."""
    key = facts.key
    side = store_table(lookup.where(F.col(key).isNotNull()), "colocated-lookup")
    worst = side.groupBy(key).count().agg(F.max("count")).first()[0]
    if worst is not None and worst > 1:
        raise ValueError(f"lookup keys {key} are not unique")
    joined = facts.cold().hint("merge").join(side.repartition(facts.buckets, key), key, "left")
    few = store_table(side.join(F.broadcast(facts.hot_keys), F.col(key) == F.col("hot"), "left_semi"), "hot-lookup")
    return joined.unionByName(facts.hot().join(F.broadcast(few), key, "left").select(*joined.columns))
