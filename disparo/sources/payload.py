"""Reference payloads landed as files (S8, P18) and their merge into the reference table.

A payload is one JSON array of arrays per (year, dataset): row 0 is the header (a name
field, measure codes, then place codes), the other rows are text values.  Files are laid
out as ``<base>/year=<Y>/dataset=<name>/*``, so year and dataset come from the path.

Parsing is positional: each wanted field is looked up by its position in that file's
header, so a ragged row or a missing field yields NULL rather than shifting values.  A
payload with fewer than two rows contributes nothing.  Numbers are parsed with
``try_cast`` (text that is not a number becomes NULL).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disparo.functions.exprs import reference_name_key
from disparo.operators.refdata import merge_datasets

# The reference's payload field names and measure codes, in pull order.
NAME_FIELD = "NAME"
PLACE_FIELDS = ("state", "county")
DATASETS = (
    ("acs5", ("B19013_001E",)),
    ("subject", ("S1701_C03_001E", "S2301_C04_001E")),
    ("profile", ("DP02_0068PE",)),
)
MEASURE_NAMES = {
    "B19013_001E": "median_income",
    "S1701_C03_001E": "poverty_rate",
    "S2301_C04_001E": "unemployment_rate",
    "DP02_0068PE": "edu_bachelor_pct",
}


def _field(row, header, name: str):
    pos = F.nullif(F.array_position(header, F.lit(name)), F.lit(0)).cast("int")
    return F.try_element_at(row, pos)


def parse_payloads(spark: SparkSession, base: str, fields: Sequence[str]) -> DataFrame:
    """One row per data row of every payload: ``year, dataset`` + the requested fields (text)."""
    raw = spark.read.option("wholetext", True).text(base)
    arr = F.from_json("value", "array<array<string>>")
    parsed = raw.select("year", "dataset", arr.alias("a")).where(F.size("a") >= 2)
    rows = parsed.select("year", "dataset", F.col("a")[0].alias("hdr"),
                         F.explode(F.slice("a", 2, F.size("a") - 1)).alias("r"))
    return rows.select(F.col("year").cast("int").alias("year"), "dataset",
                       *[_field(F.col("r"), F.col("hdr"), f).alias(f) for f in fields])


def reference_from_payloads(spark: SparkSession, base: str,
                            datasets: Sequence[tuple[str, Sequence[str]]] = DATASETS,
                            measure_names: Mapping[str, str] = MEASURE_NAMES,
                            name_suffix: str = " county, north carolina",
                            valid_range: tuple[float, float] | None = None) -> DataFrame:
    """Parse every dataset, merge them per (year, state, county) and shape the reference
    table: ``acs_year, state, county_fips3, county_name_norm`` + one double per measure.

    ``valid_range`` turns measures outside [lo, hi] (e.g. negative sentinel codes) into
    NULL; by default values pass unchecked, as in the reference."""
    order = {name: i for i, (name, _) in enumerate(datasets)}
    codes = [c for _, cs in datasets for c in cs]
    long = parse_payloads(spark, base, [NAME_FIELD, *PLACE_FIELDS, *codes])
    order_expr = F.lit(None).cast("int")
    for name, i in order.items():
        order_expr = F.when(F.col("dataset") == F.lit(name), F.lit(i)).otherwise(order_expr)
    long = long.withColumn("dataset_order", order_expr).where(F.col("dataset_order").isNotNull())
    parts = []
    for name, cs in datasets:
        parts.append(long.where(F.col("dataset") == F.lit(name))
                         .select("year", *PLACE_FIELDS, NAME_FIELD, "dataset_order", *cs))
    merged = merge_datasets(parts, ["year", *PLACE_FIELDS])
    return merged.select(
        F.col("year").alias("acs_year"),
        F.col("state"),
        F.col("county").alias("county_fips3"),
        reference_name_key(F.coalesce(F.col(NAME_FIELD), F.lit("")), name_suffix).alias("county_name_norm"),
        *[_in_range(F.col(c).try_cast("double"), valid_range).alias(measure_names[c]) for c in codes])


def _in_range(v, valid_range):
    if valid_range is None:
        return v
    lo, hi = valid_range
    return F.when(v.between(F.lit(float(lo)), F.lit(float(hi))), v)
