"""Readers and writers: raw CSV, partitioned Parquet, JSON metrics, reference payloads,
fitted models and the read-or-build dataset."""

from disparo.sources.tables import (  # noqa: F401
    all_string_schema, read_raw_csv, write_raw_csv, write_partitioned, read_table,
    write_json_metrics, read_json_metrics, read_or_build, publish_table, save_model, load_model,
)
from disparo.sources.payload import parse_payloads, reference_from_payloads  # noqa: F401
