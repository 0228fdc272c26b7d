"""Enrichment at size: narrow records are spread before the cleaning, wide methods stay compiled."""

from disparo.plans import adapters
from disparo.plans.catalogue import q_enrich_full
from disparo.session import keep_methods_compiled
from tests.conftest import SF001

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_one_row_group_is_cleaned_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = adapters.raw_events(spark, SF001)
        assert adapters.table(spark, SF001, "events").rdd.getNumPartitions() == 1
        per_task = [n for n in rows.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
        assert len(per_task) == 4 and sum(per_task) == adapters.table(spark, SF001, "events").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_methods_too_large_to_compile_run_unfused(spark):
    spark.conf.unset(LIMIT)
    q_enrich_full(spark, SF001)
    assert spark.conf.get(LIMIT) == "8000"
    spark.conf.set(LIMIT, "20000")
    keep_methods_compiled(spark)
    assert spark.conf.get(LIMIT) == "20000"     # a caller's own value stays
    spark.conf.unset(LIMIT)
