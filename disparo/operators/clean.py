"""Cleaning operators (P1-P4, P17): names, null tokens, yes/no flags, age range, place key.

Each takes the columns to touch as arguments, skips the ones a table lacks, and emits a
single projection (``withColumns``) instead of one ``withColumn`` per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from disparo.config import EventConfig
from pyspark.sql import functions as F

from disparo.functions.exprs import county_key, null_if_token, parity_int, range_null_out, yes_no_flag


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip, lower-case and replace spaces by ``_`` in every column name.

    Raises when two names collapse onto the same cleaned name.
    """
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after cleaning: {dupes}")
    return df.toDF(*names)


def standardize_strings(df: DataFrame, cols: Sequence[str] | None = None,
                        cfg: EventConfig = EventConfig()) -> DataFrame:
    """Trim text columns; values whose trimmed lower-case form is a null token become NULL."""
    cols = present(df, cfg.text_columns if cols is None else cols)
    if not cols:
        return df
    return df.withColumns({c: null_if_token(c, cfg.null_tokens) for c in cols})


def normalize_booleans(df: DataFrame, cols: Sequence[str] | None = None,
                       cfg: EventConfig = EventConfig()) -> DataFrame:
    """Yes/no text columns -> 0/1 integers (see ``functions.yes_no_flag`` for the rule)."""
    cols = present(df, cfg.yes_no_columns if cols is None else cols)
    if not cols:
        return df
    return df.withColumns({c: yes_no_flag(c, cfg.strict) for c in cols})


def clip_age(df: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Ages outside the configured range become NULL; the rest are doubles."""
    c = cfg.age_column
    if c not in df.columns:
        return df
    lo, hi = cfg.age_range
    # The integer reading is computed once and compared twice.
    probe = "__age_probe"
    df = df.withColumn(probe, F.col(c).try_cast("double") if cfg.strict else parity_int(c))
    return df.withColumn(c, range_null_out(c, probe, lo, hi)).drop(probe)


def normalize_county(df: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Add the normalised place key used by the reference-table join."""
    if cfg.county_column not in df.columns:
        return df
    return df.withColumn(cfg.county_key, county_key(cfg.county_column, cfg.county_suffix_pattern, cfg.strict))
