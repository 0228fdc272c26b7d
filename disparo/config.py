"""Dataset configuration: column roles, null tokens, baseline group, floor year, mode.

The reference hard-codes these for one statewide traffic-stop table; here they are
arguments so the same operators run on any labelled event table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

PARITY = "parity"
STRICT = "strict"

# Fixed values that must equal the reference's for matching results.
YES_NO_PATTERN = "^(?i)1|y|yes|true$"
DEFAULT_YES_NO_COLUMNS = ("citation_issued", "arrest_made", "warning_issued",
                          "search_conducted", "frisk_performed")
DEFAULT_TEXT_COLUMNS = ("location", "county_name", "subject_race", "subject_sex",
                        "officer_id_hash", "department_name", "type", "outcome", "reason_for_stop")
DEFAULT_NULL_TOKENS = ("nan", "")
DEFAULT_AGE_RANGE = (16, 100)
DEFAULT_FLOOR_YEAR = 2009
DEFAULT_BASELINE_GROUP = "white"
DEFAULT_COUNTY_SUFFIX_PATTERN = r"\s*County$"
DEFAULT_REFERENCE_NAME_SUFFIX = " county, north carolina"
DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
QUARTILE_LABELS = ("Q1_lowest", "Q2", "Q3", "Q4_highest")
CATEGORICAL_FEATURES = ("subject_race", "subject_sex", "reason_for_stop", "type", "county_name")
NUMERIC_FEATURES = ("subject_age", "median_income", "poverty_rate", "unemployment_rate",
                    "edu_bachelor_pct", "dept_freq", "location_known", "county_known")
TIME_FEATURES = ("time_available", "hour_of_day", "hour_sin", "hour_cos", "is_weekend")
REFERENCE_MEASURES = ("median_income", "poverty_rate", "unemployment_rate", "edu_bachelor_pct")
LABELS = ("citation_issued", "arrest_made")
SEED = 67


@dataclass(frozen=True)
class EventConfig:
    """Column roles and policy knobs for one labelled event table."""

    yes_no_columns: tuple = DEFAULT_YES_NO_COLUMNS
    text_columns: tuple = DEFAULT_TEXT_COLUMNS
    null_tokens: tuple = DEFAULT_NULL_TOKENS
    age_column: str = "subject_age"
    age_range: tuple = DEFAULT_AGE_RANGE
    date_column: str = "date"
    time_column: str = "time"
    timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT
    county_column: str = "county_name"
    county_key: str = "county_name_norm"
    county_suffix_pattern: str = DEFAULT_COUNTY_SUFFIX_PATTERN
    location_column: str = "location"
    group_column: str = "subject_race"
    sex_column: str = "subject_sex"
    baseline_group: str = DEFAULT_BASELINE_GROUP
    share_exclusions: tuple = ()          # group values treated as unknown in the share (Q6)
    department_column: str = "department_name"
    floor_year: int = DEFAULT_FLOOR_YEAR
    labels: tuple = LABELS
    categorical_features: tuple = CATEGORICAL_FEATURES
    numeric_features: tuple = NUMERIC_FEATURES
    time_features: tuple = TIME_FEATURES
    seed: int = SEED
    mode: str = PARITY
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "EventConfig":
        return replace(self, **kw)

    @property
    def strict(self) -> bool:
        return self.mode == STRICT
