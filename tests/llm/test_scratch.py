"""What the operators leave on disk while they run: shuffle files and stored stages."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from disparo.llm import jaccard_join as jj
from disparo.llm.common import drop_stored, ship_package, stored
from disparo.llm.components import components
from disparo.session import scratch_path


def near_copies(n, words, most, seed, stem="w"):
    rnd, out = random.Random(seed), []
    for _ in range(n):
        w = [f"{stem}{i}" for i in range(words)]
        for _ in range(rnd.randint(0, most)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(40)}"
        out.append(" ".join(w))
    return out


def tables(spark):
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_keeps_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = stored(spark.range(200_000).groupBy((F.col("id") % 5003).alias("k")).agg(F.max("id").alias("v")), "shuffled")
    assert out.count() == 5003
    mine = spark.range(10).repartition(3).collect()  # a frame of somebody else keeps its files
    assert len(mine) == 10 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    for _ in range(50):
        left = [f for f in shuffle_files(spark) - before if f.endswith(".data")]
        if len(left) <= 6:
            break
        time.sleep(0.1)
    assert len(left) <= 6, left  # those of the count and the repartition


def test_only_stored_tables_are_dropped(spark):
    kept = stored(spark.range(3), "kept")
    gone = stored(spark.range(3), "gone")
    drop_stored(gone, kept.where("id > 0"), spark.range(2))
    names = {t.rsplit("-", 1)[0] for t in tables(spark)}
    assert kept.count() == 3 and "kept" in names and "gone" not in names


def test_components_keep_their_last_round(spark):
    before = tables(spark)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert len(tables(spark) - before) == 1


@pytest.mark.parametrize("pivots", [1, jj.PIVOTS])
def test_join_deletes_its_stages(spark, monkeypatch, pivots):
    """Rows, links, labels and the named components stay (and a row a cell); sets, signatures, regions and cells go."""
    ship_package(spark)
    monkeypatch.setattr(jj, "PIVOTS", pivots)
    texts = near_copies(150, 60, 4, 3) + near_copies(60, 25, 3, 4, "v") + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = tables(spark)
    out = jj.jaccard_components(docs, leaf=4)
    first = sorted(map(str, out.collect()))
    left = {t.rsplit("-", 1)[0] for t in tables(spark) - before}
    small = {"jaccard-links", "jaccard-cell-links", "jaccard-cell-sizes", "cc-small"}
    assert left <= small | {"jaccard-docs", "jaccard-components"}, left
    assert sorted(map(str, out.collect())) == first and len(first) == len(texts)
    before = tables(spark)
    kept = jj.drop_near_duplicates(docs, leaf=4)
    assert kept.count() == len({r.component_id for r in out.collect()}) == kept.count()
    left = {t.rsplit("-", 1)[0] for t in tables(spark) - before}
    assert left <= small | {"jaccard-lost"}, left


def test_pipeline_deletes_a_stage_when_the_next_is_stored(spark, monkeypatch):
    def stage(spark, docs, sf_dir):
        return docs.where("doc_id % 7 <> 3")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, stage) for n in ("one", "two", "three", "last")])
    before = tables(spark)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    assert [t.rsplit("-", 1)[0] for t in tables(spark) - before] == ["pipeline-three"]
