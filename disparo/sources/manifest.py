"""Published tables: a build becomes visible by its manifest, written last (S3, S7).

Layout of a published table::

    <path>/data/<build>/...               Parquet files (partition folders below)
    <path>/files/<build>/                 one row a data file: relative name, bytes
    <path>/manifests/<version>-<build>/   one JSON line: schema, counts, checksum

A build writes into a folder of its own, then its file list, then its manifest.  Readers go by
the valid manifest of the highest version and never list data folders, so a crashed build, a
half-written manifest or files of a lost writer are not seen, and the table before stays in
place until a new one is published.  ``check`` compares the listed files and their sizes with
the storage and the rows with the file footers (metadata only, as Spark jobs).

Only missing or damaged content counts as "not there"; errors of the storage itself (access,
connection, unknown scheme) are raised, so they never cause a rebuild.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

FORMAT = 1
_FILES = "file string, bytes long"
_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
# Messages of the Parquet reader for content that is no (whole) Parquet file.
_DAMAGE = ("is not a Parquet file", "ParquetDecodingException", "corrupted file", "Corrupted file",
           "expected magic number", "can not read class org.apache.parquet.format")


class DamagedTable(Exception):
    """A published table whose files are not those of its manifest."""


@dataclass(frozen=True)
class Manifest:
    version: int
    build: str
    n_files: int
    n_bytes: int
    n_rows: int
    schema: str
    partition_by: tuple = ()
    extra: dict = field(default_factory=dict)     # the publisher's own notes (JSON values)
    format: int = FORMAT

    def data(self, path: str) -> str:
        return f"{path}/data/{self.build}"

    def files(self, path: str) -> str:
        return f"{path}/files/{self.build}"

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def line(self) -> str:
        body = json.dumps(asdict(self), sort_keys=True)
        return json.dumps({"body": body, "sha256": hashlib.sha256(body.encode()).hexdigest()})

    @staticmethod
    def parse(line: str) -> Manifest | None:
        """The manifest of a line, or None when it is not whole."""
        try:
            outer = json.loads(line)
            body = outer["body"]
            if hashlib.sha256(body.encode()).hexdigest() != outer["sha256"]:
                return None
            fields = json.loads(body)
            return Manifest(**(fields | {"partition_by": tuple(fields["partition_by"])})) if fields["format"] == FORMAT else None
        except (ValueError, KeyError, TypeError):
            return None


def _listing(spark: SparkSession, root: str, build: str) -> DataFrame:
    """(``file``, ``bytes``) of the data files of a build; reads no content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return found.select(F.substring_index("path", f"/{build}/", -1).alias("file"), F.col("length").alias("bytes"))


def manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """Valid manifests, oldest first; empty when there is none.  ``path`` may be a pattern of tables."""
    try:
        lines = spark.read.text(f"{path}/manifests/*", wholetext=True).collect()
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:
            raise
        return []
    return sorted((m for m in (Manifest.parse(r[0]) for r in lines) if m), key=lambda m: (m.version, m.build))


def current(spark: SparkSession, path: str) -> Manifest | None:
    found = manifests(spark, path)
    return found[-1] if found else None


def open_table(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """The published table, schema from the manifest (no footer is read to infer it)."""
    return spark.read.schema(manifest.struct()).option("basePath", manifest.data(path)).parquet(manifest.data(path))


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None], partition_by: tuple = (),
            extra: dict | None = None) -> Manifest:
    """Write ``df`` with ``write(df, folder)`` into a new build and publish it as the next version."""
    spark = df.sparkSession
    before = current(spark, path)
    build = uuid.uuid4().hex
    fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    draft = Manifest((before.version if before else 0) + 1, build, 0, 0, 0, T.StructType(fields).json(), tuple(partition_by), extra or {})
    write(df, draft.data(path))
    _listing(spark, draft.data(path), build).write.parquet(draft.files(path))
    total = spark.read.schema(_FILES).parquet(draft.files(path)).agg(F.count("file"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    rows = open_table(spark, path, draft).count()
    done = Manifest(draft.version, build, total[0], total[1], rows, draft.schema, draft.partition_by, draft.extra)
    _write_manifest(spark, path, done)
    return done


def _write_manifest(spark: SparkSession, path: str, m: Manifest) -> None:
    spark.createDataFrame([(m.line(),)], "value string").coalesce(1).write.text(f"{path}/manifests/{m.version:020d}-{m.build}")


def _damage(e: Exception) -> bool:
    if isinstance(e, AnalysisException):
        return e.getCondition() in _MISSING
    text = str(e)
    return any(s in text for s in _DAMAGE)


def check(spark: SparkSession, path: str, m: Manifest) -> None:
    """Raise ``DamagedTable`` unless the stored files are the manifest's; storage errors pass through."""
    try:
        listed = spark.read.schema(_FILES).parquet(m.files(path))
        found = _listing(spark, m.data(path), m.build)
        both = listed.withColumnRenamed("bytes", "listed").join(found.withColumnRenamed("bytes", "found"), "file", "full")
        row = both.agg(F.count("listed").alias("n"), F.count_if(~F.col("listed").eqNullSafe(F.col("found"))).alias("bad")).first()
        if row["n"] != m.n_files or row["bad"]:
            raise DamagedTable(f"{path}: {row['bad']} files of {m.n_files} are missing, new or of another size")
        rows = open_table(spark, path, m).count()
    except (Py4JJavaError, PySparkException) as e:
        if _damage(e):
            raise DamagedTable(f"{path}: unreadable files") from e
        raise
    if rows != m.n_rows:
        raise DamagedTable(f"{path}: {rows} rows instead of {m.n_rows}")


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version after ``check``, or None when nothing is published."""
    m = current(spark, path)
    if m is None:
        return None
    check(spark, path, m)
    return open_table(spark, path, m)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder of any file system that Spark reads; False when there was none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def vacuum(spark: SparkSession, path: str, keep: int = 1, orphan_hours: float = 24.0) -> list[str]:
    """Delete builds of superseded versions (all but the last ``keep``) and folders without a manifest
    that are older than ``orphan_hours`` (a running build has no manifest yet).  Returns the builds."""
    every = manifests(spark, path)
    kept = {m.build for m in every[-keep:]} if keep > 0 else set()
    named = {m.build for m in every}
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    oldest = (time.time() - orphan_hours * 3600) * 1000
    gone = set()
    for part in ("manifests", "data", "files"):  # manifests first: no reader finds a build that is being removed
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
        if not fs.exists(folder):
            continue
        for status in fs.listStatus(folder):
            build = status.getPath().getName().split("-")[-1]
            if build in kept or (build not in named and status.getModificationTime() > oldest):
                continue
            fs.delete(status.getPath(), True)
            gone.add(build)
    return sorted(gone)
