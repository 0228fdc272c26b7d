"""Key frequencies kept up to date by a stream (A1, J1), without recounting the table.

Each micro-batch (epoch) of landed raw files is handled by ``foreachBatch``:

1. its enriched rows are written to ``<out>/epoch=<n>/`` (overwriting what a crashed attempt left);
2. the counts of its keys are published at ``<counts>/deltas/<n>`` (a manifest, written last);
3. every ``compact_every`` epochs the deltas of all earlier epochs are summed into a new version of
   the published table ``<counts>/base``, whose manifest names the last epoch it holds.

An epoch is done exactly when its delta (or a base that holds it) is published.  A replayed epoch
that is done changes nothing; one that is not is written anew.  Readers take the rows and the
counts of done epochs only, so they never see half an epoch, and the counts always agree with
the rows.  Reading costs the base and at most ``compact_every`` deltas of one row a key.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from disparo.config import EventConfig
from disparo.operators.encode import key_frequency
from disparo.operators.lookup import DEFAULT_MAX_BROADCAST_ROWS, lookup_join
from disparo.plans.jobs import add_reference, enrich_rows
from disparo.sources.manifest import Manifest, current, delete, manifests, open_table, publish, vacuum
from disparo.sources.tables import all_string_schema

log = logging.getLogger(__name__)

COMPACT_EVERY = 16


def _write(df: DataFrame, folder: str) -> None:
    df.write.parquet(folder)


def _delta(counts_path: str, epoch: int) -> str:
    return f"{counts_path}/deltas/{epoch:020d}"


def _through(base: Manifest | None) -> int:
    """Last epoch that the base holds."""
    return int(base.extra["through"]) if base else -1


def _deltas(spark: SparkSession, counts_path: str, after: int) -> dict[int, Manifest]:
    """Newest manifest of each published delta above epoch ``after``."""
    found = manifests(spark, f"{counts_path}/deltas/*")
    return {int(m.extra["epoch"]): m for m in found if int(m.extra["epoch"]) > after}


def done_epochs(spark: SparkSession, counts_path: str) -> tuple[int, list[int]]:
    """(all epochs up to this one are done, later done epochs)."""
    through = _through(current(spark, f"{counts_path}/base"))
    return through, sorted(_deltas(spark, counts_path, through))


def is_done(spark: SparkSession, counts_path: str, epoch: int) -> bool:
    return epoch <= _through(current(spark, f"{counts_path}/base")) or current(spark, _delta(counts_path, epoch)) is not None


def read_counts(spark: SparkSession, counts_path: str, key: str, out_col: str, upto: int | None = None) -> DataFrame:
    """(``key``, ``out_col``): rows a key over all done epochs (up to ``upto``), the NULL key included."""
    base = current(spark, f"{counts_path}/base")
    parts = [open_table(spark, f"{counts_path}/base", base)] if base else []
    for epoch, m in _deltas(spark, counts_path, _through(base)).items():
        if upto is None or epoch <= upto:
            parts.append(open_table(spark, _delta(counts_path, epoch), m))
    if not parts:
        return spark.createDataFrame([], f"`{key}` string, `{out_col}` bigint")
    return reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.sum("n").alias(out_col)).withColumnRenamed("key", key)


def compact(spark: SparkSession, counts_path: str, through: int) -> None:
    """Publish the sums of all epochs up to ``through`` (all done) as the base; older deltas go."""
    old = _through(current(spark, f"{counts_path}/base"))
    if through <= old:
        return
    total = read_counts(spark, counts_path, "key", "n", upto=through)
    publish(total, f"{counts_path}/base", _write, extra={"through": through})
    vacuum(spark, f"{counts_path}/base", keep=2)  # a reader may still be on the version before
    for epoch in range(old + 1, through + 1):
        delete(spark, _delta(counts_path, epoch))


def epoch_writer(out_path: str, counts_path: str, key: str, partition_col: str = "year",
                 compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: rows, then counts, once an epoch."""
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if is_done(spark, counts_path, epoch):
            log.info("epoch %s is done already", epoch)
            return
        folder = f"{out_path}/epoch={epoch}"
        batch.write.mode("overwrite").partitionBy(partition_col).parquet(folder)
        # Counted from the written rows: the batch is computed once, and the counts are those of the rows.
        rows = spark.read.schema(batch.schema).option("basePath", folder).parquet(folder)
        counts = key_frequency(rows, key, "n").withColumnRenamed(key, "key")
        publish(counts.select("key", "n"), _delta(counts_path, epoch), _write, extra={"epoch": epoch})
        if compact_every and epoch and epoch % compact_every == 0:
            compact(spark, counts_path, epoch - 1)  # earlier epochs are committed
    return write


def start_frequency_stream(spark: SparkSession, raw_dir: str, columns: Sequence[str], out_path: str, counts_path: str,
                           checkpoint_location: str, ref: DataFrame | None = None, cfg: EventConfig = EventConfig(),
                           available_now: bool = True, max_files_per_trigger: int | None = None,
                           compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Enrich raw CSV files as they land and keep the department counts; ``available_now`` processes
    what has landed and stops."""
    reader = spark.readStream.schema(all_string_schema(columns)).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = add_reference(enrich_rows(reader.csv(raw_dir), cfg), ref, cfg)
    writer = (rows.writeStream.option("checkpointLocation", checkpoint_location)
                  .foreachBatch(epoch_writer(out_path, counts_path, cfg.department_column, compact_every=compact_every)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_with_frequency(spark: SparkSession, out_path: str, counts_path: str, cfg: EventConfig = EventConfig(),
                        out_col: str = "dept_freq", max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows of all done epochs with their key's frequency over them (NULL for a NULL key)."""
    key = cfg.department_column
    through, later = done_epochs(spark, counts_path)
    seen = (F.col("epoch") <= through) | F.col("epoch").isin(later) if later else F.col("epoch") <= through
    rows = spark.read.parquet(out_path).where(seen).drop("epoch")
    return lookup_join(rows, read_counts(spark, counts_path, key, out_col), key, "left", max_broadcast_rows)
