"""Label copies, outcome priority, known-flags and lower-cased groups (P13-P17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.functions.exprs import county_key, not_null_flag


def outcome_priority(arrest="arrest_made", citation="citation_issued", warning="warning_issued"):
    """First match of arrest > citation > warning, else ``other``."""
    def on(c):
        return F.col(c).try_cast("int") == 1
    return (F.when(on(arrest), F.lit("arrest"))
             .when(on(citation), F.lit("citation"))
             .when(on(warning), F.lit("warning"))
             .otherwise(F.lit("other")))


def add_labels_flags(df: DataFrame, cfg: EventConfig = EventConfig()) -> DataFrame:
    """Adds ``citation_yn, arrest_yn, outcome_multiclass, location_known, county_known``,
    lower-cases the group columns and adds the normalised place key.

    As in the reference, ``outcome_multiclass`` is added whenever an ``outcome`` column
    exists and then needs the three outcome flags.
    """
    cols = set(df.columns)
    new = {}
    if "citation_issued" in cols:
        new["citation_yn"] = F.col("citation_issued")
    if "arrest_made" in cols:
        new["arrest_yn"] = F.col("arrest_made")
    if "outcome" in cols:
        new["outcome_multiclass"] = outcome_priority()
    if cfg.location_column in cols:
        new["location_known"] = not_null_flag(cfg.location_column)
    if cfg.county_column in cols:
        new["county_known"] = not_null_flag(cfg.county_column)
    for c in (cfg.group_column, cfg.sex_column):
        if c in cols:
            new[c] = F.lower(F.col(c))
    if cfg.county_column in cols:
        new[cfg.county_key] = county_key(cfg.county_column, cfg.county_suffix_pattern, cfg.strict)
    return df.withColumns(new) if new else df
