"""Sharding over fixed virtual slots with a versioned slot-to-shard map.

Every record hashes (by its text, so equal texts travel together) into one of ``SLOTS``
virtual slots; bytes and rows are aggregated per slot; a small stored map says which shard a
slot lives in.  Version 1 deals the slots round robin; ``rebalance`` edits a map into the
next version by moving single slots from the fullest to the emptiest shard until no move
helps.  Records never move between slots, only slots between shards.  Law: ``bytes``.

A slot that alone outgrows a shard's fair share (one text in very many copies) is split into
parts by id, the only case in which equal texts part.

Scale: one pass over the texts leaves (id, size, crc, slot); the map and the statistics have a
row per slot or part, whatever the corpus; row numbers inside a shard come from cells of at
most about ``CELL_ROWS`` rows plus the running total of cell sizes, so neither a shard nor a
hot slot is ever one task's work.

Defined cases: NULL text has no bytes and crc 0; NULL ids sort first; repeated rows are
separate records; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from disparo.llm.common import stored, text_or_empty
from disparo.session import scratch_path

SLOTS = 4096
CELL_ROWS = 100_000
MAP_SCHEMA = "version int, slot int, part int, parts int, shard int, bytes long, records long"


@dataclass
class SlotMap:
    """One version of the map: parallel arrays over (slot, part)."""
    version: int
    slot: np.ndarray
    part: np.ndarray
    parts: np.ndarray
    shard: np.ndarray
    bytes: np.ndarray
    records: np.ndarray

    def frame(self, spark: SparkSession) -> DataFrame:
        cols = (self.slot, self.part, self.parts, self.shard, self.bytes, self.records)
        rows = [(self.version, *map(int, r)) for r in zip(*cols)]
        return spark.createDataFrame(rows, MAP_SCHEMA)

    def loads(self, shards: int) -> np.ndarray:
        return np.bincount(self.shard, self.bytes, minlength=shards).astype(np.int64)


def save_map(slot_map: SlotMap, spark: SparkSession, path: str) -> None:
    slot_map.frame(spark).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={slot_map.version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}")


def first_map(slot, part, parts, size, records, shards: int) -> SlotMap:
    """Version 1: slots dealt round robin, without a look at their sizes."""
    return SlotMap(1, slot, part, parts, (slot + part) % shards, size, records)


def rebalance(old: SlotMap, shards: int) -> SlotMap:
    """The next version: single slots move from the fullest to the emptiest shard while that
    lowers the gap between the two; all other entries stay."""
    shard = old.shard.copy()
    load = np.bincount(shard, old.bytes, minlength=shards).astype(np.int64)
    for _ in range(8 * len(shard)):
        a, b = int(load.argmax()), int(load.argmin())
        gap = int(load[a] - load[b])
        own = np.flatnonzero((shard == a) & (old.bytes > 0) & (old.bytes < gap))
        if not len(own):
            break
        pick = own[np.abs(old.bytes[own] * 2 - gap).argmin()]
        shard[pick] = b
        load[a] -= old.bytes[pick]
        load[b] += old.bytes[pick]
    return SlotMap(old.version + 1, old.slot, old.part, old.parts, shard, old.bytes, old.records)


def _salt(parts):
    return F.pmod(F.when(F.col("id").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("id", F.lit(7))), parts).cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    slots: int = SLOTS, map_path: str | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per record: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` (its place
    in the shard, 0 to the shard's records less one), ``grown_shard`` (NULL under this law),
    ``virtual_slot``, ``part``, ``map_version``.  The map's versions are stored under ``map_path``."""
    spark = docs.sparkSession
    map_path = map_path or scratch_path(spark, "slot-map")
    text = text_or_empty(text_col)
    base = stored(docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.pmod(F.xxhash64(text), F.lit(slots)).cast("int").alias("vslot")), "shard-records")

    stats = np.array([tuple(r) for r in base.groupBy("vslot").agg(F.sum("size"), F.count(F.lit(1))).collect()],
                     np.int64).reshape(-1, 3)
    sizes, records = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    sizes[stats[:, 0]], records[stats[:, 0]] = stats[:, 1], stats[:, 2]
    fair = max(1, int(sizes.sum()) // shards)
    parts = np.where(sizes > fair, np.minimum(records, -(-sizes * 8 // fair)), 1).astype(np.int64)
    hot = np.flatnonzero(parts > 1)
    parts_of = F.coalesce(F.element_at(F.create_map(*[F.lit(int(x)) for s in hot for x in (s, parts[s])]), F.col("vslot")),
                          F.lit(1)) if len(hot) else F.lit(1)
    rows = base.withColumn("part", _salt(parts_of) if len(hot) else F.lit(0))
    slot, part, many = np.arange(slots), np.zeros(slots, np.int64), parts
    if len(hot):
        fine = np.array([tuple(r) for r in rows.where(F.col("vslot").isin([int(s) for s in hot]))
                         .groupBy("vslot", "part").agg(F.sum("size"), F.count(F.lit(1))).collect()], np.int64)
        cold = np.flatnonzero(parts == 1)
        slot = np.concatenate((cold, fine[:, 0]))
        part = np.concatenate((np.zeros(len(cold), np.int64), fine[:, 1]))
        sizes = np.concatenate((sizes[cold], fine[:, 2]))
        records = np.concatenate((records[cold], fine[:, 3]))
        many = parts[slot]
    version1 = first_map(slot, part, many, sizes, records, shards)
    version2 = rebalance(version1, shards)
    for m in (version1, version2):
        save_map(m, spark, map_path)

    current = load_map(spark, map_path, version2.version).where("records > 0").select(
        F.col("slot").alias("vslot"), "part", "shard", "version",
        F.ceil(F.col("records") / F.lit(cell_rows)).cast("int").alias("cells"))
    placed = rows.join(F.broadcast(current), ["vslot", "part"]).withColumn(
        "cell", F.pmod(F.xxhash64("id", "row", F.lit(11)), F.col("cells")).cast("int"))
    place = ["vslot", "part", "cell"]
    before = Window.partitionBy("shard").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", *place).count()
                     .select(*place, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")))
    few = len(slot) + int(records.sum()) // cell_rows <= 1_000_000
    inside = F.row_number().over(Window.partitionBy(*place).orderBy("id", "row"))
    numbered = placed.withColumn("inside", inside).join(F.broadcast(offsets) if few else offsets, place)
    return numbered.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("inside") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"), "part", F.col("version").alias("map_version"))


def imbalance(loads: np.ndarray) -> float:
    """Fullest shard over the mean."""
    return float(loads.max() / loads.mean()) if len(loads) and loads.sum() else math.nan
