"""A rising list of offsets in about 2 + log2(largest / count) bits each."""

from __future__ import annotations

import numpy as np

# One stored position for so many values.
STRIDE = 64


class EliasFano:
    """Low bits of each value as they are, high bits in unary; ``select`` finds the i-th value.

    Values must not fall and not be negative; an empty list is allowed.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self._low = np.unpackbits(np.frombuffer(low, np.uint8), count=n * low_bits, bitorder="little")
        self._high = np.frombuffer(high, np.uint8)
        self._samples = np.frombuffer(samples, "<u4")

    @staticmethod
    def encode(values) -> tuple[int, int, bytes, bytes, bytes]:
        """What the constructor takes."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n == 0:
            return 0, 0, b"", b"", b""
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return (
            n,
            low_bits,
            np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            ones[::STRIDE].astype("<u4").tobytes(),
        )

    def _low_of(self, first: int, count: int) -> np.ndarray:
        bits = self._low[first * self.low_bits : (first + count) * self.low_bits].reshape(count, self.low_bits)
        return bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value: from the nearest stored position, bytes are counted until it is reached."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self._samples[i // STRIDE])
        byte, left = at // 8, i % STRIDE
        ones = np.flatnonzero(np.unpackbits(self._high[byte : byte + 1], bitorder="little")[at % 8 :]) + at
        while left >= len(ones):
            left -= len(ones)
            byte += 1
            ones = np.flatnonzero(np.unpackbits(self._high[byte : byte + 1], bitorder="little")) + 8 * byte
        return ((int(ones[left]) - i) << self.low_bits) + int(self._low_of(i, 1)[0])

    def all(self) -> np.ndarray:
        """Every value, in order."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)) << self.low_bits) + self._low_of(0, self.n)
