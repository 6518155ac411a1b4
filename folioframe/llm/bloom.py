"""A Bloom filter of bounded size: lets a join work on and move few more rows of its wide side than it needs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and at most (64 MB); a filter that is too small lets more through, never less.
BITS, MOST = 12, 1 << 29
SHIFTS = (0, 17, 34)
_CHUNK = 1 << 13


class Bloom:
    """Membership of 64-bit hashes; ``words`` is a bitmap of a power of two of bits."""

    def __init__(self, keys: DataFrame, hashed: Column):
        n = keys.count()
        self.bits = min(MOST, 1 << max(19, (BITS * n - 1).bit_length() if n else 0))
        spots = keys.select(F.explode(F.array(*[F.shiftrightunsigned(hashed, s).bitwiseAND(F.lit(self.bits - 1)) for s in SHIFTS])).alias("at"))
        words = spots.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
        chunks = words.groupBy(F.shiftright("word", 13).alias("chunk")).applyInArrow(_pack, "chunk long, words binary").collect()
        found = np.zeros(self.bits // 64, dtype=np.int64)
        for r in chunks:
            found[r["chunk"] * _CHUNK : (r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["words"], dtype=np.int64)
        self.words = keys.sparkSession.sparkContext.broadcast(found)

    def test(self):
        """A function for workers: which of these hashes (an Arrow column) the filter may hold."""
        words, mask = self.words, np.uint64(self.bits - 1)

        def test(hashes) -> np.ndarray:
            h = hashes.to_numpy().view(np.uint64)
            ok = np.ones(len(h), dtype=bool)
            for s in SHIFTS:
                at = (h >> np.uint64(s)) & mask
                ok &= (words.value.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
            return ok

        return test


def _pack(key, table):
    out = np.zeros(_CHUNK, dtype=np.int64)
    out[table.column("word").to_numpy() % _CHUNK] = table.column("bits").to_numpy()
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([out.tobytes()], pa.binary())})
