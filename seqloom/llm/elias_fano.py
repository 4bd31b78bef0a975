"""Elias-Fano codes of non-decreasing whole numbers, with select.

n values below u take about n * (2 + log2(u / n)) bits: the low bits of each value are packed; the high bits are the
gaps between ones of a bit vector. The place of every SAMPLE-th one is kept (32 bits each), so value k is found by a scan
of a few words from the nearest sample.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = "<4sQQQBQQQ"  # mark, values, base, universe, low bits; bytes of low, high and sample parts
ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    def __init__(self, n: int, base: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.base, self.universe, self.low_bits = n, base, universe, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """values: whole numbers of at most 63 bits that never fall; negative ones are shifted by the first."""
        values = np.asarray(values, np.int64)
        n = len(values)
        if n and (np.diff(values) < 0).any():
            raise ValueError("values must not fall")
        base = int(values[0]) if n else 0
        rest = (values - base).astype(np.uint64)
        universe = int(rest[-1]) + 1 if n else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        bits = np.zeros((n, low_bits), np.uint8)
        for k in range(low_bits):
            bits[:, k] = (rest >> np.uint64(k)) & np.uint64(1)
        low = np.packbits(bits.reshape(-1), bitorder="little")
        ones = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, base, universe, low_bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def dump(self) -> bytes:
        parts = self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()
        return struct.pack(HEAD, b"EF01", self.n, self.base & (1 << 64) - 1, self.universe, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> EliasFano:
        mark, n, base, universe, low_bits, a, b, c = struct.unpack_from(HEAD, data)
        if mark != b"EF01":
            raise ValueError("not an Elias-Fano block")
        at = struct.calcsize(HEAD)
        low, high, samples = (np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + skip) for kind, size, skip in (("u1", a, 0), ("u1", b, a), ("<u4", c, a + b)))
        return cls(n, base - (1 << 64) if base >> 63 else base, universe, low_bits, low, high, samples)

    def select(self, k: int) -> int:
        """Value k, from the nearest sampled one."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        one = int(self.samples[k // SAMPLE])
        left = k % SAMPLE  # ones still to pass, after the sampled one
        if left:
            byte = one // 8
            first = int(self.high[byte]) & (0xFF << one % 8 + 1) & 0xFF
            seen = int(ONES[first])
            while seen < left:
                left -= seen
                byte += 1
                first = int(self.high[byte])
                seen = int(ONES[first])
            for bit in range(8):
                if first >> bit & 1:
                    left -= 1
                    if not left:
                        one = byte * 8 + bit
                        break
        low = 0
        if self.low_bits:
            at = k * self.low_bits
            chunk = int.from_bytes(self.low[at // 8 : (at + self.low_bits + 7) // 8].tobytes(), "little")
            low = chunk >> at % 8 & (1 << self.low_bits) - 1
        return self.base + ((one - k) << self.low_bits | low)

    def values(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Values first to last (exclusive) together."""
        last = self.n if last is None else min(last, self.n)
        if last <= first:
            return np.zeros(0, np.int64)
        block = first // SAMPLE
        begin = int(self.samples[block])
        stop_block = -(-last // SAMPLE)
        end = int(self.samples[stop_block]) if stop_block < len(self.samples) else len(self.high) * 8
        flags = np.unpackbits(self.high[begin // 8 : end // 8 + 1], bitorder="little")
        ones = np.flatnonzero(flags) + begin // 8 * 8
        ones = ones[ones >= begin][first - block * SAMPLE :][: last - first]
        out = (ones - np.arange(first, last)) << self.low_bits
        if self.low_bits:
            at, until = first * self.low_bits, last * self.low_bits
            bits = np.unpackbits(self.low[at // 8 : (until + 7) // 8], bitorder="little")[at % 8 :][: until - at].reshape(-1, self.low_bits)
            for k in range(self.low_bits):
                out |= bits[:, k].astype(np.int64) << k
        return self.base + out

    def bits(self) -> int:
        return 8 * (len(self.low) + len(self.high) + self.samples.nbytes)
