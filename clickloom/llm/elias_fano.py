"""Elias-Fano lists: ascending integers in near-minimal space, read at any place."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256


def _bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each value, packed without gaps."""
    if not width:
        return b""
    spread = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    """``n`` values: low bits in a packed array, high parts as a bit vector with a one for each value.

    The one of value i stands at place high(i) + i. Every ``SAMPLE``-th one's place is kept as 32-bit integer, so
    a read scans one stretch of the vector.
    """

    HEAD = struct.Struct("<QBQQ")

    def __init__(self, n: int, width: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, "<u4"))
        width = max(0, (int(values[-1]) // n).bit_length() - 1)
        places = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places.astype(np.int64)] = 1
        low = b"".join(_bits(values[i : i + 65536], width) for i in range(0, n, 65536))
        return cls(n, width, low, np.packbits(bits, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = self.HEAD.pack(self.n, self.width, len(self.low), len(self.high))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, width, low, high = cls.HEAD.unpack_from(data)
        at = cls.HEAD.size
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at + low + high)
        return cls(n, width, data[at : at + low], data[at + low : at + low + high], samples)

    def select(self, i: int, count: int = 1) -> np.ndarray:
        """Values ``i`` to ``i + count - 1``."""
        if count <= 0:
            return np.zeros(0, np.uint64)
        first = int(self.samples[i // SAMPLE])
        stop = (i + count - 1) // SAMPLE + 1
        last = int(self.samples[stop]) if stop < len(self.samples) else len(self.high) * 8
        window = np.frombuffer(self.high, np.uint8, -(-last // 8) - first // 8, first // 8)
        ones = np.flatnonzero(np.unpackbits(window, bitorder="little")) + first // 8 * 8
        ones = ones[np.searchsorted(ones, first) + i % SAMPLE :][:count]
        high = ones.astype(np.uint64) - np.arange(i, i + count, dtype=np.uint64)
        if not self.width:
            return high
        a, b = i * self.width, (i + count) * self.width
        raw = np.unpackbits(np.frombuffer(self.low, np.uint8, -(-b // 8) - a // 8, a // 8), bitorder="little")
        raw = raw[a % 8 :][: b - a].reshape(count, self.width).astype(np.uint64)
        low = (raw << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high << np.uint64(self.width)) | low
