"""Column expressions for cleaning, keys, buckets and guarded arithmetic.

All of them are safe under ANSI mode: parsing uses ``try_*`` forms and divisions are
guarded, so malformed input yields NULL instead of failing the job.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from disparo.config import QUARTILE_LABELS, YES_NO_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no_flag(c, strict: bool = False) -> Column:
    """Yes/no text -> 0/1 integer.

    Parity: the unanchored pattern ``^(?i)1|y|yes|true$`` is an alternation of
    "starts with 1", "contains y" and "ends with true" (case-insensitive); anything
    else, NULL and ``NA`` included, becomes 0.
    Strict: anchored yes/no vocabularies, anything else NULL.
    """
    c = _col(c)
    if strict:
        t = F.lower(F.trim(c))
        return (F.when(t.isin("1", "y", "yes", "true"), F.lit(1))
                 .when(t.isin("0", "n", "no", "false"), F.lit(0))
                 .cast("int"))
    return F.when(c.rlike(YES_NO_PATTERN), F.lit(1)).otherwise(F.lit(0)).cast("int")


def null_if_token(c, tokens: Sequence[str]) -> Column:
    """Trimmed text, or NULL when lower(trim(text)) is one of ``tokens``; case is kept."""
    c = _col(c)
    return F.when(F.lower(F.trim(c)).isin(*tokens), F.lit(None)).otherwise(F.trim(c))


# A string the non-ANSI string->int cast accepts: blanks and control characters around it,
# optional sign, digits, optional fractional part (truncated; ``.5`` is 0).  A sign alone,
# an exponent or anything else casts to NULL.
_INT_TEXT = r"^[\x00-\x20\x7F]*([+-]?)([0-9]*)(\.?)[0-9]*[\x00-\x20\x7F]*$"


def parity_int(c) -> Column:
    """Integer value of a text the way a non-ANSI ``cast(string as int)`` reads it:
    surrounding blanks ignored, fraction truncated, otherwise NULL."""
    c = _col(c)
    sign, digits, dot = (F.regexp_extract(c, _INT_TEXT, i) for i in (1, 2, 3))
    return F.when(c.rlike(_INT_TEXT) & ((digits != "") | (dot != "")),
                  F.concat(sign, F.when(digits == "", "0").otherwise(digits)).try_cast("int"))


def age_in_range(c, lo: int, hi: int, strict: bool = False) -> Column:
    """Age as double when inside [lo, hi]; outside values become NULL (not clamped).

    Parity compares the integer reading of the text (``15.5`` < 16 is out, ``100.5`` is
    kept as 100.5); strict compares the double value.
    """
    c = _col(c)
    as_double = c.try_cast("double")
    probe = as_double if strict else parity_int(c)
    return F.when((probe < F.lit(lo)) | (probe > F.lit(hi)), F.lit(None).cast("double")).otherwise(as_double)


def range_null_out(value, probe, lo: int, hi: int) -> Column:
    """``value`` as double unless ``probe`` lies outside [lo, hi] (then NULL)."""
    p = _col(probe)
    return F.when((p < F.lit(lo)) | (p > F.lit(hi)), F.lit(None).cast("double")).otherwise(
        _col(value).try_cast("double"))


def county_key(c, suffix_pattern: str = r"\s*County$", strict: bool = False) -> Column:
    """Join key from a place name.

    Parity strips the suffix, then one trailing comma, then lower-cases, so
    ``"Wake County,"`` keeps its ``county``.  Strict strips the comma first and matches
    the suffix case-insensitively.
    """
    c = _col(c)
    if strict:
        return F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, r",\s*$", ""),
                                               "(?i)" + suffix_pattern, "")))
    return F.lower(F.regexp_replace(F.regexp_replace(c, suffix_pattern, ""), ",$", ""))


def reference_name_key(c, suffix: str) -> Column:
    """Reference-table key: lower-case, remove a literal suffix, trim."""
    return F.trim(F.replace(F.lower(_col(c)), F.lit(suffix.lower()), F.lit("")))


def floor_year(c, floor: int) -> Column:
    """Years before ``floor`` map to ``floor``; NULL stays NULL."""
    c = _col(c)
    return F.when(c < F.lit(floor), F.lit(floor)).otherwise(c)


def quartile_label(c, breaks: Sequence[float], labels: Sequence[str] = QUARTILE_LABELS,
                   strict: bool = False) -> Column:
    """``<= b1`` -> labels[0], ``<= b2`` -> labels[1], ... else the last label.

    Parity: NULL falls through to the last label; strict keeps NULL.
    """
    c = _col(c)
    expr = None
    for b, lab in zip(breaks, labels):
        cond = c <= F.lit(float(b))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    if strict:
        expr = F.when(c.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(labels[-1])))
        return expr
    return expr.otherwise(F.lit(labels[-1]))


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is not positive."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double")))


def parse_date(c) -> Column:
    """Text -> DATE (``cast`` semantics), NULL when malformed."""
    return _col(c).try_cast("date")


def parse_timestamp(c, fmt: str) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def not_null_flag(c) -> Column:
    return _col(c).isNotNull().cast("int")


def cyclic(c, period: float, fn: str) -> Column:
    angle = F.lit(2 * math.pi) * _col(c) / F.lit(float(period))
    return F.sin(angle) if fn == "sin" else F.cos(angle)
