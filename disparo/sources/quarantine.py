"""Raw loads that keep malformed records aside (S1, S8), in one pass and with counters.

Plain ``PERMISSIVE`` reading cuts surplus fields and fills missing ones with NULL without a
trace.  ``load_raw_csv`` reads with a corrupt-record column, stores good and malformed rows in one
write (two partitions of one table), and counts both on the way with an observation.  The
malformed records keep their text, so they can be mended and loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from disparo.session import scratch_path
from disparo.sources.payload import NAME_FIELD, PLACE_FIELDS
from disparo.sources.tables import all_string_schema, write_json_metrics

CORRUPT = "_corrupt_record"
_BAD = "_malformed"


@dataclass(frozen=True)
class RawLoad:
    good: DataFrame        # the declared columns
    malformed: DataFrame   # ``record``: the whole line
    n_rows: int
    n_malformed: int

    @property
    def n_good(self) -> int:
        return self.n_rows - self.n_malformed

    def metrics(self, spark: SparkSession, **tags: str) -> DataFrame:
        """One row of counters, to be written with the other metrics."""
        return spark.createDataFrame([(*tags.values(), self.n_rows, self.n_good, self.n_malformed)],
                                     ", ".join([*(f"`{t}` string" for t in tags), "n_rows bigint", "n_good bigint", "n_malformed bigint"]))


def load_raw_csv(spark: SparkSession, path: str, columns: Sequence[str], store: str | None = None, multi_line: bool = False,
                 metrics_path: str | None = None, max_malformed_share: float | None = None) -> RawLoad:
    """Load header CSV with all columns as text; records with too few or too many fields go to the
    quarantine.  Both are stored under ``store`` (default: the shared scratch folder).

    ``multi_line`` reads quoted line breaks as part of a field; without it such a record counts as
    malformed lines.  ``metrics_path`` takes the counters as a JSON line.  Above ``max_malformed_share`` of the
    records the load raises, after storing, so the quarantine can be looked at."""
    if CORRUPT in columns or _BAD in columns:
        raise ValueError(f"{CORRUPT} and {_BAD} are names of the load itself")
    schema = T.StructType([*all_string_schema(columns).fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("multiLine", multi_line)
    raw = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    seen = Observation()
    store = store or scratch_path(spark, "raw-load")
    # No shuffle between scan and write, so each record is counted in the task that writes it.
    (raw.withColumn(_BAD, F.col(CORRUPT).isNotNull())
        .observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count(CORRUPT).alias("n_malformed"))
        .write.partitionBy(_BAD).parquet(store))
    counted = seen.get
    back = spark.read.schema(T.StructType([*schema.fields, T.StructField(_BAD, T.BooleanType())])).parquet(store)
    load = RawLoad(back.where(~F.col(_BAD)).select(*columns), back.where(F.col(_BAD)).select(F.col(CORRUPT).alias("record")),
                   counted["n_rows"], counted["n_malformed"])
    if metrics_path:
        write_json_metrics(load.metrics(spark, source=path), metrics_path)
    if max_malformed_share is not None and load.n_malformed > max_malformed_share * load.n_rows:
        raise ValueError(f"{load.n_malformed} of {load.n_rows} records of {path} are malformed (kept in {store})")
    return load


def payload_problems(spark: SparkSession, base: str, fields: Sequence[str] = (NAME_FIELD, *PLACE_FIELDS)) -> DataFrame:
    """What ``parse_payloads`` would pass over in silence: ``year``, ``dataset``, ``reason``, ``detail``.

    Reasons: ``not json`` (the file is no array of arrays), ``no rows`` (header only or empty), ``no field``
    (the header lacks one of ``fields``) and ``ragged row`` (a row of another length than the header)."""
    raw = spark.read.option("wholetext", True).text(base).select("year", "dataset", "value", F.from_json("value", "array<array<string>>").alias("a"))
    header = F.try_element_at("a", F.lit(1))
    files = raw.where(F.col("a").isNotNull() & (F.size("a") >= 2))
    missing = F.filter(F.array(*[F.lit(f) for f in fields]), lambda f: ~F.array_contains(header, f))
    ragged = F.filter(F.slice("a", 2, F.size("a") - 1), lambda r: r.isNull() | (F.size(r) != F.size(header)))
    parts = [
        raw.where(F.col("a").isNull()).select("year", "dataset", F.lit("not json").alias("reason"), F.substring("value", 1, 200).alias("detail")),
        raw.where(F.col("a").isNotNull() & (F.size("a") < 2)).select("year", "dataset", F.lit("no rows").alias("reason"), F.lit("").alias("detail")),
        files.select("year", "dataset", F.lit("no field").alias("reason"), F.explode(missing).alias("detail")),
        files.select("year", "dataset", F.lit("ragged row").alias("reason"), F.explode(F.transform(ragged, lambda r: F.to_json(r))).alias("detail")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
