"""Elias-Fano sequences in files: monotone integers as low parts packed by bits and unary high parts, read through mmap."""

from __future__ import annotations

import numpy as np

#: Values decoded at a time; what a reader holds in memory is a few blocks, whatever the length of the file.
BLOCK = 1 << 16


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of each value, one after the other; blocks begin at whole bytes, since BLOCK is one."""
    out = []
    for at in range(0, len(values), BLOCK):
        planes = np.unpackbits(values[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little", count=bits)
        out.append(np.packbits(planes.ravel(), bitorder="little"))
    return np.concatenate(out)


def _unpack(packed: np.ndarray, n: int, bits: int) -> np.ndarray:
    planes = np.zeros((n, 64), dtype=np.uint8)
    planes[:, :bits] = np.unpackbits(packed, count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(planes, axis=1, bitorder="little").view("<u8")[:, 0]


class Sequence:
    """A written sequence: log2(largest / n) low bits, rounded down, and 2 to 3 bits of the high part for each value."""

    def __init__(self, at: str, n: int, bits: int):
        self.n, self.bits = n, bits
        self.low = np.memmap(f"{at}.low", dtype=np.uint8, mode="r") if n and bits else None
        self.high = np.memmap(f"{at}.high", dtype=np.uint8, mode="r") if n else None
        self.samples = np.load(f"{at}.samples.npy") if n else np.zeros(1, dtype=np.int64)

    @staticmethod
    def write(at: str, values: np.ndarray) -> Sequence:
        """Values ascending (equal ones as well), not negative."""
        n = len(values)
        if not n:
            return Sequence(at, 0, 0)
        values = values.astype(np.uint64)
        bits = max(0, int(int(values[-1]) // n).bit_length() - 1)
        if bits:
            _pack(values, bits).tofile(f"{at}.low")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        bitmap = np.zeros((int(ones[-1]) >> 3) + 1, dtype=np.uint8)
        np.bitwise_or.at(bitmap, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        bitmap.tofile(f"{at}.high")
        np.save(f"{at}.samples.npy", ones[::BLOCK])  # where each block's first one is: select by block
        return Sequence(at, n, bits)

    def block(self, k: int) -> np.ndarray:
        """The values k * BLOCK up to (k + 1) * BLOCK."""
        start, to = k * BLOCK, min(self.n, (k + 1) * BLOCK)
        first = int(self.samples[k])
        last = int(self.samples[k + 1]) if to < self.n else len(self.high) * 8
        bits = np.unpackbits(self.high[first >> 3 : (last + 7) >> 3], bitorder="little")
        ones = np.flatnonzero(bits[first & 7 :])[: to - start] + first
        values = (ones - np.arange(start, to)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            values |= _unpack(self.low[start * self.bits // 8 : (to * self.bits + 7) // 8], to - start, self.bits)
        return values.astype(np.int64)

    def at(self, places: np.ndarray) -> np.ndarray:
        """Values at ascending places."""
        out = np.empty(len(places), dtype=np.int64)
        cuts = np.searchsorted(places, np.arange(0, self.n + BLOCK, BLOCK))
        for k in np.flatnonzero(np.diff(cuts)):
            out[cuts[k] : cuts[k + 1]] = self.block(k)[places[cuts[k] : cuts[k + 1]] - k * BLOCK]
        return out

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ascending wanted values, the place of the first value that is as large, and whether it is equal.

        Values have to be distinct. Beyond the last value the place is n.
        """
        place, equal = np.full(len(wanted), self.n, dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        if not self.n or not len(wanted):
            return place, equal
        firsts = self.at(np.arange(0, self.n, BLOCK))
        cuts = np.r_[0, np.searchsorted(wanted, firsts[1:]), len(wanted)]
        for k in np.flatnonzero(np.diff(cuts)):
            values, own = self.block(k), wanted[cuts[k] : cuts[k + 1]]
            found = np.searchsorted(values, own)
            place[cuts[k] : cuts[k + 1]] = found + k * BLOCK
            equal[cuts[k] : cuts[k + 1]] = values[np.minimum(found, len(values) - 1)] == own
        return place, equal
