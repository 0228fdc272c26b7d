"""Incremental enrichment of landed raw files (``enrich_stream``) and key frequencies kept by a
stream (``frequency``)."""

from disparo.streaming.enrich_stream import read_enriched, start_enrich_stream  # noqa: F401
from disparo.streaming.frequency import read_counts, read_with_frequency, start_frequency_stream  # noqa: F401
