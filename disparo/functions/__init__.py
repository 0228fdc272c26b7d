"""Pure ``Column`` builders.  Each returns a Spark expression; none touches a DataFrame,
so they compose inside one projection and stay in whole-stage codegen."""

from disparo.functions.exprs import (  # noqa: F401
    yes_no_flag, null_if_token, parity_int, age_in_range, range_null_out, county_key, reference_name_key,
    floor_year, quartile_label, safe_ratio, parse_date, parse_timestamp, not_null_flag,
)
