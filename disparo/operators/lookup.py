"""Joining a fact table to a derived lookup table with a *checked* broadcast.

The lookup tables here (key frequencies, per-place shares, the reference dimension) are
aggregates whose size is only known after they are computed.  ``lookup_join``
materialises the lookup once into the shared checkpoint folder (which also cuts its
lineage, so a lost executor never replays the fact scan behind it), counts its rows, and
broadcasts it only under ``max_broadcast_rows`` and an estimated ``max_broadcast_bytes``
(rows x schema width).  Above either bound it falls back to a shuffle join, where AQE's
skew handling splits hot fact keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.session import ensure_checkpoint_dir, scratch_path

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# Estimated bytes per value by type name; text and nested values are charged generously.
_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
          "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def estimated_row_bytes(df: DataFrame) -> int:
    return 16 + sum(_WIDTH.get(f.dataType.typeName(), 64) for f in df.schema.fields)


def fits_broadcast(df: DataFrame, rows: int, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and rows * estimated_row_bytes(df) <= max_bytes


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return the re-read table."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: like
    ``materialize``, but later steps keep column pruning, pushdown and statistics."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _any_null(keys):
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def lookup_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str] | str, how: str = "left",
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, unique: bool = True,
                checkpoint: bool = True, known_max_rows: int | None = None) -> DataFrame:
    """``fact JOIN lookup USING (on)`` with a size-checked broadcast of ``lookup``.

    ``unique`` asserts one lookup row per key so a left join never multiplies fact rows.
    ``known_max_rows`` is a caller-proven bound for a lookup built as a ``groupBy(on)``
    of an already-counted table (keys unique by construction); it skips the checks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if known_max_rows is not None:
        side = F.broadcast(lookup) if fits_broadcast(lookup, known_max_rows, max_broadcast_rows) else lookup
        return fact.join(side, on=keys, how=how)
    small = materialize(lookup) if checkpoint else lookup
    stats = small.agg(F.count(F.lit(1)).alias("n"),
                      F.count_distinct(*[F.col(k) for k in keys]).alias("k"),
                      F.count_if(_any_null(keys)).alias("nk")).first()
    n, k, nk = stats["n"], stats["k"], stats["nk"]
    if unique and n - nk != k:
        raise ValueError(f"lookup keys {keys} are not unique ({n} rows, {k} distinct keys)")
    if nk > 1 and unique:
        raise ValueError(f"lookup keys {keys} have {nk} NULL-key rows")
    side = F.broadcast(small) if fits_broadcast(small, n, max_broadcast_rows) else small
    return fact.join(side, on=keys, how=how)
