"""A Bloom filter of a stated size: built by Spark from a column of 64-bit hashes, then
looked up in numpy. Its size is a parameter and does not follow the table, so it can be
broadcast; where it fills up, more rows pass, and none is lost."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words
        self.most = np.uint64(64 * len(words) - 1)

    def _set(self, p: np.ndarray) -> np.ndarray:
        return (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        """True for every hash that was put in, and for few others."""
        out = self._set(hashes & self.most)
        out[out] = self._set((hashes[out] >> np.uint64(32)) & self.most)
        return out


def build(df: DataFrame, column: str, bits: int) -> Bloom:
    """Two bits for each hash in ``column``; ``bits`` is a power of two of 64 or more.

    The driver gets bits/64 rows at most. Null hashes are left out, repeated ones change
    nothing; an empty table gives a filter that lets nothing pass.
    """
    low, high = F.col(column), F.shiftrightunsigned(column, 32)
    bit = F.explode(F.array(low.bitwiseAND(bits - 1), high.bitwiseAND(bits - 1)))
    found = (
        df.filter(F.col(column).isNotNull())
        .select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("set"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[found.column("word").to_numpy()] = found.column("set").to_numpy()
    return Bloom(words.view(np.uint64))
