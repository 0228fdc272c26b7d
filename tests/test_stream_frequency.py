"""Incremental frequency: resume, replay, crashes between the steps of an epoch, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from disparo.config import EventConfig
from disparo.plans import adapters
from disparo.plans.catalogue import CFG_A
from disparo.plans.jobs import enrich
from disparo.sources.manifest import current
from disparo.sources.tables import write_raw_csv
from disparo.streaming import frequency as fq
from tests.conftest import SF001

KEY = EventConfig().department_column


@pytest.fixture()
def paths(tmp_dir):
    return f"{tmp_dir}/out", f"{tmp_dir}/counts"


def batch(spark, *keys):
    return spark.createDataFrame([(k, 2020 + i % 2, i) for i, k in enumerate(keys)], f"{KEY} string, year int, id int")


def counts(spark, path):
    return {r[KEY]: r.n for r in fq.read_counts(spark, path, KEY, "n").collect()}


def rows(spark, out, path):
    return sorted(((r[KEY], r.dept_freq) for r in fq.read_with_frequency(spark, out, path).collect()), key=str)


def test_epochs_add_up_and_replay_changes_nothing(spark, paths):
    out, path = paths
    write = fq.epoch_writer(out, path, KEY)
    assert counts(spark, path) == {} and not fq.is_done(spark, path, 0)
    write(batch(spark, "a", "a", None), 0)
    write(batch(spark, "a", "b"), 1)
    want = {"a": 3, "b": 1, None: 1}
    assert counts(spark, path) == want and fq.done_epochs(spark, path) == (-1, [0, 1])
    write(batch(spark, "a", "b"), 1)
    write(batch(spark, "other rows of a replayed epoch are not taken"), 0)
    assert counts(spark, path) == want
    assert rows(spark, out, path) == sorted([("a", 3)] * 3 + [("b", 1), (None, None)], key=str)


def test_crash_after_the_rows(spark, paths, monkeypatch):
    """Rows of an epoch without published counts are not read, and the replay replaces them."""
    out, path = paths
    write = fq.epoch_writer(out, path, KEY)
    write(batch(spark, "a"), 0)
    publish = fq.publish

    def crash(*a, **k):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(fq, "publish", crash)
    with pytest.raises(RuntimeError):
        write(batch(spark, "a", "b", "c"), 1)
    monkeypatch.setattr(fq, "publish", publish)
    assert os.path.exists(f"{out}/epoch=1") and rows(spark, out, path) == [("a", 1)]
    write(batch(spark, "a", "b", "c"), 1)
    assert rows(spark, out, path) == [("a", 2), ("a", 2), ("b", 1), ("c", 1)]


def test_compaction_keeps_the_counts(spark, paths):
    out, path = paths
    write = fq.epoch_writer(out, path, KEY, compact_every=3)
    for epoch in range(8):
        write(batch(spark, "a", f"k{epoch}", None), epoch)
    assert fq.done_epochs(spark, path) == (5, [6, 7])
    assert current(spark, f"{path}/base").extra == {"through": 5}
    assert sorted(os.listdir(f"{path}/deltas")) == [f"{e:020d}" for e in (6, 7)]
    want = {"a": 8, None: 8, **{f"k{e}": 1 for e in range(8)}}
    assert counts(spark, path) == want
    write(batch(spark, "again"), 2)          # a replay of an epoch that the base holds
    fq.compact(spark, path, 3)               # an older compaction changes nothing
    assert counts(spark, path) == want and len(rows(spark, out, path)) == 24


def test_crash_while_compacting(spark, paths, monkeypatch):
    """The base is published, then the driver is lost before the deltas go: they are not counted twice."""
    out, path = paths
    write = fq.epoch_writer(out, path, KEY, compact_every=0)
    for epoch in range(3):
        write(batch(spark, "a", "b"), epoch)
    monkeypatch.setattr(fq, "delete", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        fq.compact(spark, path, 1)
    assert counts(spark, path) == {"a": 3, "b": 3} and fq.done_epochs(spark, path) == (1, [2])


def test_stream_resumes_and_matches_batch(spark, tmp_dir, paths):
    out, path = paths
    raw = adapters.raw_events(spark, SF001)
    ref = adapters.reference_dimension(spark, SF001)
    halves = raw.where("event_id < 400"), raw.where("event_id >= 400")
    land, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/ckpt"
    for i, half in enumerate(halves):
        write_raw_csv(half.repartition(2), f"{land}/b={i}")
        fq.start_frequency_stream(spark, f"{land}/*", adapters.RAW_COLUMNS, out, path, ckpt, ref, CFG_A,
                                  max_files_per_trigger=1, compact_every=2).awaitTermination()
    got = fq.read_with_frequency(spark, out, path, CFG_A).withColumn("event_id", F.col("event_id").cast("bigint"))
    cols = ["event_id", "dept_freq", "county_name_norm", "is_weekend", "subject_age", "median_income"]
    want = enrich(raw, ref, CFG_A).select(*cols)
    assert got.count() == raw.count() and got.select(*cols).exceptAll(want).count() == 0
