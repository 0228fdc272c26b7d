"""Bit arrays of hashes: a broadcast of bounded size that drops most of what is not wanted.

Built on Spark; two hashes on one bit only let something pass that need not, so what passes is
judged exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64


def has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & U64(64 * len(bits) - 1)
    return (bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) == 1


def bit_words(hashes: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, 64 bits) of a bit array of ``size`` bits; at most ``size / 64`` rows come to the driver."""
    slot = F.col("h").bitwiseAND(F.lit(size - 1))
    got = (hashes.groupBy(F.shiftright(slot, 6).cast("int").alias("at"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63L as int))")).alias("bits")).toArrow())
    return got["at"].to_numpy(), got["bits"].to_numpy().view(U64)


def bit_array(hashes: DataFrame, members: int, most: int) -> np.ndarray:
    """Bit array of the hashes ``h``, about 16 bits a member, at most ``2 ** most`` bits."""
    size = 1 << min(max(members * 16, 64).bit_length(), most)
    out = np.zeros(size // 64, U64)
    at, bits = bit_words(hashes, size)
    out[at] = bits
    return out
