"""A bounded filter of 64-bit hashes that tasks test their rows against.

It only spares work: a hash that is in the filter by chance costs a row that a later
exact join removes, so results do not depend on its size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 27  # 16 MB


def build(hashes: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """(bits, table): 16 table bits a hash, 2**MAX_BITS bits at most."""
    count = hashes.count()
    bits = min(MAX_BITS, max(10, (16 * max(count, 1)).bit_length()))
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    found = (hashes.select(low.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask")).toArrow())
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[found["word"].to_numpy()] = found["mask"].to_numpy()
    return bits, table.view(np.uint64)


def passes(bits: int, table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes may be in the filter."""
    bit = hashes & np.uint64((1 << bits) - 1)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)) == 1
