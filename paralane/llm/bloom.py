"""A Bloom filter that Spark fills and tasks look into: a bitmap whose size does not follow the data."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

PROBES = 5
LARGEST = 1 << 26


class Bloom:
    """May say yes to a hash that was not put in, never no to one that was."""

    def __init__(self, bits: int, words: np.ndarray, places: np.ndarray) -> None:
        self.bits = bits
        self.words = np.zeros(bits // 64, dtype=np.uint64)
        self.words[places] = words

    @classmethod
    def of(cls, hashes: DataFrame, count: int) -> "Bloom":
        """Of ``count`` 64-bit hashes in the column ``hash``.

        Bits are set and or-ed by Spark; at most 2 ** 20 words, 8 MB, reach the driver. Beyond some five
        million hashes the filter says yes more often than it need.
        """
        bits = 1 << min(LARGEST.bit_length() - 1, max(10, (12 * count).bit_length()))
        low, high = F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("hash", 32)
        probes = F.array(*[F.pmod(low + i * high, F.lit(bits)) for i in range(PROBES)])
        found = hashes.select(F.explode(probes).alias("at")).groupBy(F.shiftright("at", 6).alias("place")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("word")
        ).toArrow()
        return cls(bits, found["word"].to_numpy().view(np.uint64), found["place"].to_numpy())

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        hashes = hashes.view(np.uint64)
        low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
        held = np.ones(len(hashes), dtype=bool)
        for i in range(PROBES):
            at = (low + np.uint64(i) * high) % np.uint64(self.bits)
            held &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return held
