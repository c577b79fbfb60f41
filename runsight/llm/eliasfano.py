"""Elias-Fano sequences over flat arrays, so that they can be read from a memory-mapped file.

A non-decreasing sequence below a universe keeps the low bits of each value packed, and the high parts in unary
in a bit vector with a count of ones before each 64-bit word.  All queries take arrays.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` of ``width`` bits each, packed into 64-bit words."""
    out = np.zeros(len(values) * width // 64 + 2, U64)
    if width:
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(U64)
        v = values.astype(U64)
        np.bitwise_or.at(out, word, v << shift)
        spill = shift.astype(np.int64) + width > 64
        np.bitwise_or.at(out, word[spill] + 1, v[spill] >> (U64(64) - shift[spill]))
    return out


def read_bits(words: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    """Values ``i`` of a packed array."""
    if not width:
        return np.zeros(len(i), U64)
    at = i * width
    word, shift = at >> 6, (at & 63).astype(U64)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
    return (low | high) & U64((1 << width) - 1)


_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Position of the one with rank r in byte b, for all b and r.
_PLACE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.uint8)


def _in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the one with this rank (from 0) in each 64-bit word."""
    octets = words.view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(_ONES[octets], axis=1, dtype=np.uint8)
    octet = (upto <= rank[:, None].astype(np.uint8)).sum(1)
    row = np.arange(len(words))
    before = np.where(octet > 0, upto[row, octet - 1], 0)
    return octet * 8 + _PLACE[octets[row, octet], rank - before]


class EliasFano:
    """``arrays``: low (packed), high (bit vector), ones (ones before each word), meta (n, low width)."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.low, self.high, self.ones, self.meta = (arrays[k] for k in ("low", "high", "ones", "meta"))
        self.n, self.width = int(self.meta[0]), int(self.meta[1])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones  # zeros before each word

    @staticmethod
    def build(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        n = len(values)
        width = max(0, int(universe // max(n, 1)).bit_length() - 1)
        v = values.astype(U64)
        place = (v >> U64(width)).astype(np.int64) + np.arange(n)
        size = (max(int(universe), 1) >> width) + n + 2
        bits = np.zeros((size + 63) // 64 * 64, np.uint8)
        bits[place] = 1
        ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(1))[:-1]]).astype(np.int64)
        return {"low": pack_bits(v & U64((1 << width) - 1), width), "ones": ones,
                "high": np.packbits(bits, bitorder="little").view(U64), "meta": np.array([n, width], np.int64)}

    def _select(self, bit: int, rank: np.ndarray) -> np.ndarray:
        """Place of the one (or zero) with this rank in the bit vector."""
        before = self.ones if bit else self.zeros
        word = np.searchsorted(before, rank, side="right") - 1
        return word * 64 + _in_word(self.high[word] if bit else ~self.high[word], rank - before[word])

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        high = self._select(1, i) - i
        return (high.astype(U64) << U64(self.width)) | read_bits(self.low, self.width, i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value not below ``x`` where it equals ``x``, else -1."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        top = (x >> U64(self.width)).astype(np.int64)
        total = len(self.ones) * 64 - self.n
        good = np.flatnonzero(top < total)
        top, want = top[good], x[good] & U64((1 << self.width) - 1)
        end = self._select(0, top) - top
        begin = np.zeros_like(end)
        later = top > 0
        begin[later] = self._select(0, top[later] - 1) + 1 - top[later]
        lo, hi = begin.copy(), end.copy()
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) >> 1
            less = read_bits(self.low, self.width, mid) < want[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
        here = np.flatnonzero(lo < end)
        same = read_bits(self.low, self.width, lo[here]) == want[here]
        out[good[here[same]]] = lo[here[same]]
        return out


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as one block of bytes: a header line, then each array at a multiple of 64 bytes."""
    import json
    head, at, body = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = [a.dtype.str, len(a), at]
        body.append(raw + b"\0" * (-len(raw) % 64))
        at += len(body[-1])
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 64) + b"\n"
    return line + b"".join(body)


def mapped_arrays(block: bytes) -> dict[str, np.ndarray]:
    """The arrays of ``pack_arrays``, read from a memory-mapped file that is already unlinked."""
    import json
    import tempfile
    with tempfile.TemporaryFile() as f:
        f.write(block)
        f.flush()
        data = np.memmap(f, np.uint8, "r")
    start = block.index(b"\n") + 1
    return {name: data[start + at:start + at + n * np.dtype(kind).itemsize].view(kind)
            for name, (kind, n, at) in json.loads(block[:start]).items()}
