"""Frequency encoding, class weights, sampling and splits (J1, A1-A4, P20, F6, F7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.operators.lookup import DEFAULT_MAX_BROADCAST_ROWS, lookup_join


def key_frequency(df: DataFrame, key: str, out_col: str) -> DataFrame:
    """Rows per key over all rows, the NULL key included (A1)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out_col))


def frequency_encode(df: DataFrame, key: str = "department_name", out_col: str = "dept_freq",
                     fit_df: DataFrame | None = None,
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Attach how often each row's key occurs (J1).

    The counts come from ``fit_df`` (default: ``df`` itself, the reference's behaviour,
    which leaks test rows into training features; pass the train split to avoid it).
    A NULL key gets a NULL frequency, because an equi-join never matches NULL.
    """
    freq = key_frequency(df if fit_df is None else fit_df, key, out_col)
    return lookup_join(df, freq, key, "left", max_broadcast_rows)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-NULL values of a column (A2)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """One row: positives, negatives, their sum and the balancing weights (A3, A4).

    w_pos = n / (2 max(pos, 1)), w_neg = n / (2 max(neg, 1)), n = max(pos + neg, 1).
    """
    c = df.agg(F.count_if(F.col(label) == 1).alias("n_pos"),
               F.count_if(F.col(label) == 0).alias("n_neg"))
    n = F.greatest(F.col("n_pos") + F.col("n_neg"), F.lit(1)).cast("double")
    return c.select("n_pos", "n_neg", (F.col("n_pos") + F.col("n_neg")).alias("n_total"),
                    (n / (F.lit(2.0) * F.greatest(F.col("n_pos"), F.lit(1)))).alias("w_pos"),
                    (n / (F.lit(2.0) * F.greatest(F.col("n_neg"), F.lit(1)))).alias("w_neg"))


@dataclass
class ClassWeights:
    n_pos: int
    n_neg: int
    w_pos: float
    w_neg: float


def fit_class_weights(train: DataFrame, label: str) -> ClassWeights:
    """Balancing weights from the train split (one aggregate row reaches the driver)."""
    r = class_counts(train, label).first()
    return ClassWeights(r["n_pos"], r["n_neg"], r["w_pos"], r["w_neg"])


def apply_class_weights(df: DataFrame, label: str, w: ClassWeights, out_col: str = "class_w") -> DataFrame:
    return df.withColumn(out_col, F.when(F.col(label) == 1, F.lit(w.w_pos)).otherwise(F.lit(w.w_neg)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Row sample without replacement (F6); ``fraction >= 1`` keeps everything."""
    return df if fraction >= 1.0 else df.sample(False, fraction, seed)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 67):
    """The reference's seeded random split (F7)."""
    return df.randomSplit(list(weights), seed)


def hash_bucket(key, buckets: int = 100):
    """Reproducible bucket of a key: first 32 bits of md5(text(key)) mod ``buckets``.
    The same value in every engine that has md5, and independent of partitioning."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def hash_split(df: DataFrame, key: str, train_pct: int = 80, out_col: str = "split") -> DataFrame:
    """Label each row ``train`` or ``test`` from its key's hash bucket (disjoint, complete)."""
    return df.withColumn(out_col, F.when(hash_bucket(key) < F.lit(train_pct), F.lit("train"))
                                   .otherwise(F.lit("test")))
