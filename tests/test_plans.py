"""Physical-plan properties: no cartesian products, pruned scans, pushed filters, one
aggregation pass for the audit."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from disparo.plans import adapters
from disparo.plans.catalogue import CFG_A
from disparo.plans.jobs import enrich
from disparo.sources.tables import read_table, write_partitioned
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_no_cartesian_products(spark, name):
    text = plan(se.queries()[name](spark, SF001))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(se.queries()["fairness_by_group"](spark, SF001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double,l_returnflag:string>" in text
    assert "l_extendedprice" not in text and "l_tax" not in text


def test_cohort_filter_reaches_parquet_scan(spark, tmp_dir):
    path = tmp_dir + "/enriched"
    write_partitioned(enrich(adapters.raw_events(spark, SF001), None, CFG_A), path)
    df = read_table(spark, path).where(F.col("time_available") == 1).select("event_id", "citation_issued")
    text = plan(df)
    assert "EqualTo(time_available,1)" in text
    assert "ReadSchema: struct<event_id:bigint,citation_issued:int,time_available:int>" in text
    yearly = plan(read_table(spark, path).where(F.col("year") == 2024).select("event_id"))
    assert "PartitionFilters: [isnotnull(year" in yearly


def test_audit_is_one_aggregation_pass(spark):
    text = plan(se.queries()["audit_report"](spark, SF001))
    assert len(re.findall(r"^\(\d+\) Expand", text, flags=re.M)) == 1
    assert len(re.findall(r"^Location: .*lineitem\.parquet", text, flags=re.M)) == 1
