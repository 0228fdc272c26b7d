"""Session helpers: building a session, the shared checkpoint folder, scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_METHOD_KEY, _METHOD_DEFAULT, _JIT_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def build_session(master: str | None = None, app: str = "disparo",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for local runs, tests and the bench.

    On a cluster the caller's own session is used instead; nothing here is needed there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Remove checkpoint files of lookup tables once nothing references them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Fused whole-stage-codegen methods of the wide cleaning projection exceed the
        # JVM's 8000-byte JIT limit and would run interpreted (2-3x slower).
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def keep_methods_compiled(spark: SparkSession) -> None:
    """Let a stage whose fused method is over HotSpot's 8000-byte limit run unfused.

    Such a method is never compiled, so each row of a wide projection is interpreted; unfused, the
    projection is cut into methods that are.  The setting of Spark for this
    (``spark.sql.codegen.hugeMethodLimit``) is lowered only where the session has its default and
    the JVM was not told to compile methods of any size."""
    if "-XX:-DontCompileHugeMethods" in (spark.conf.get("spark.executor.extraJavaOptions", None) or ""):
        return
    if spark.conf.get(_METHOD_KEY, _METHOD_DEFAULT) == _METHOD_DEFAULT:
        spark.conf.set(_METHOD_KEY, _JIT_LIMIT)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when none is configured.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that setting always wins.
    Only when it is unset (local tests, the bench) is a fresh local folder used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="disparo-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "disparo-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
