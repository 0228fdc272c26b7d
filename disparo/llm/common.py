"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import disparo
from disparo.session import scratch_path
from disparo.sources.manifest import delete

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Frames made and run in here give their shuffle files back when their action ends; else these
    stay until the driver happens to collect its garbage.  Only for frames that run once."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors and keeps column pruning."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that no frame reads any more; other frames are left alone."""
    for df in tables:
        if path := getattr(df, "stored_at", None):
            delete(df.sparkSession, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_for(spark: SparkSession, rows: int, least: int, most: int) -> int:
    """Number of groups for ``rows``: as many as there are shuffle partitions while a group
    keeps ``least`` rows, and always enough that a group has at most about ``most``."""
    return max(1, math.ceil(rows / most), min(shuffle_partitions(spark), math.ceil(rows / least)))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library (once an application), for sessions whose Python workers
    do not have it on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(disparo.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="disparo-ship-")) / "disparo.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
