"""Non-decreasing integers in Elias-Fano form, with sampled select."""

from __future__ import annotations

import numpy as np

#: Every so many values the place of its bit is stored, in 32 bits.
SAMPLED = 64
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def low_bits(n: int, largest: int) -> int:
    """How many low bits of each value are stored as they are."""
    return max(0, (largest // n).bit_length() - 1) if n else 0


def section_bytes(n: int, largest: int) -> tuple[int, int, int]:
    """Bytes of the low bits, the high bits and the samples."""
    low = low_bits(n, largest)
    return -(-n * low // 8), -(-(n + (largest >> low) + 1) // 8), 4 * -(-n // SAMPLED)


def encode(values: np.ndarray) -> bytes:
    """The values, about 2 + log2(largest / n) bits each. They start at 0 or above and never fall."""
    n = len(values)
    largest = int(values[-1]) if n else 0
    low = low_bits(n, largest)
    values = values.astype(np.int64)
    bits = ((values[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    lows = np.packbits(bits.ravel(), bitorder="little").tobytes()
    places = (values >> low) + np.arange(n)
    high = np.zeros(section_bytes(n, largest)[1] * 8, np.uint8)
    high[places] = 1
    return lows + np.packbits(high, bitorder="little").tobytes() + places[::SAMPLED].astype("<u4").tobytes()


class EliasFano:
    """Read access to ``n`` encoded values, of which the last is ``largest``."""

    def __init__(self, data: memoryview, n: int, largest: int):
        self.n, self.low = n, low_bits(n, largest)
        sizes = section_bytes(n, largest)
        self.size = sum(sizes)
        self._lows = np.frombuffer(data, np.uint8, sizes[0])
        self._high = np.frombuffer(data, np.uint8, sizes[1], sizes[0])
        self._samples = np.frombuffer(data, "<u4", sizes[2] // 4, sizes[0] + sizes[1])

    def _low(self, i: int) -> int:
        begin, end = i * self.low, (i + 1) * self.low
        part = int.from_bytes(self._lows[begin // 8 : -(-end // 8)].tobytes(), "little")
        return (part >> (begin % 8)) & ((1 << self.low) - 1)

    def __getitem__(self, i: int) -> int:
        """The value at place ``i``: select on the high bits from the nearest sample, and the low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self._samples[i // SAMPLED])
        left = i % SAMPLED  # ones after the sampled one
        byte, value = place // 8, int(self._high[place // 8]) & ~((1 << place % 8) - 1) & 255
        while _ONES[value] <= left:
            left -= int(_ONES[value])
            byte += 1
            value = int(self._high[byte])
        for _ in range(left):
            value &= value - 1
        place = 8 * byte + (value & -value).bit_length() - 1
        return ((place - i) << self.low) | self._low(i)

    def all(self) -> np.ndarray:
        """All values."""
        places = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))
        bits = np.unpackbits(self._lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
        lows = bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))
        return ((places - np.arange(self.n)) << self.low) | lows
