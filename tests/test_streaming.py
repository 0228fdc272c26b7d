"""Incremental enrichment: files land in batches; a restarted stream processes only the
new ones and the result equals the batch enrichment."""

from pyspark.sql import functions as F

from disparo.plans import adapters
from disparo.plans.catalogue import CFG_A
from disparo.plans.jobs import enrich
from disparo.sources.tables import write_raw_csv
from disparo.streaming import read_enriched, start_enrich_stream
from tests.conftest import SF001


def test_stream_resumes_and_matches_batch(spark, tmp_dir):
    raw = adapters.raw_events(spark, SF001)
    ref = adapters.reference_dimension(spark, SF001)
    first, second = raw.where("event_id % 2 = 0"), raw.where("event_id % 2 = 1")
    land, out, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    write_raw_csv(first, f"{land}/b=0")
    start_enrich_stream(spark, f"{land}/*", adapters.RAW_COLUMNS, out, ckpt, ref, CFG_A).awaitTermination()
    assert read_enriched(spark, out, CFG_A).count() == first.count()
    write_raw_csv(second, f"{land}/b=1")
    start_enrich_stream(spark, f"{land}/*", adapters.RAW_COLUMNS, out, ckpt, ref, CFG_A).awaitTermination()
    streamed = read_enriched(spark, out, CFG_A)
    assert streamed.count() == raw.count()
    batch = enrich(raw, ref, CFG_A)
    cols = ["event_id", "dept_freq", "county_name_norm", "is_weekend", "subject_age", "outcome_multiclass"]
    a = streamed.select(F.col("event_id").cast("bigint").alias("event_id"), *cols[1:])
    assert a.exceptAll(batch.select(*cols)).count() == 0
