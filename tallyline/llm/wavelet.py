"""Wavelet matrix of a token sequence: one bit-plane per bit of an id, each with rank counts, in one compressed blob.

Plane 0 holds the highest bits in text order; every next plane holds the next bits after a stable split of the
sequence by the bit before, zeros first. Access, rank, counting and occurrence lookup walk down the planes.

Layout, little endian: magic `WM01`, number of planes, tokens and documents; then, each as length and zstd block:
document ids and which of them are missing, document starts, and for each plane the packed bits, the count of ones before every 512th
bit, and the number of zeros.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WM01"
SPAN = 512
HEAD, LENGTH = "<4sIQQ", "<Q"


def _put(out: list[bytes], values: np.ndarray) -> None:
    block = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())
    out += [struct.pack(LENGTH, len(block)), block]


def packed(tokens: np.ndarray, doc_ids: list[int | None], starts: np.ndarray) -> bytes:
    """The blob of a shard: its tokens, and the id and first token of every document (one start more at the end)."""
    planes = max(1, int(tokens.max(initial=0)).bit_length())
    rest = tokens.astype(np.uint16 if planes <= 16 else np.uint32)
    out = [struct.pack(HEAD, MAGIC, planes, len(tokens), len(doc_ids))]
    _put(out, np.array([0 if d is None else d for d in doc_ids], np.int64))
    _put(out, np.packbits(np.array([d is None for d in doc_ids], bool)))
    _put(out, starts.astype(np.int64))
    for plane in range(planes):
        bits = (rest & rest.dtype.type(1 << (planes - 1 - plane))).astype(bool)
        packed_bits = np.packbits(bits)
        spans = np.zeros(-(-len(bits) // SPAN) + 1, np.uint32)
        if len(bits):
            spans[1:] = np.cumsum(np.add.reduceat(np.bitwise_count(packed_bits), np.arange(0, len(packed_bits), SPAN // 8), dtype=np.uint32))
        _put(out, packed_bits)
        _put(out, spans)
        out.append(struct.pack(LENGTH, len(bits) - int(spans[-1])))
        rest = np.concatenate([rest[~bits], rest[bits]])
    return b"".join(out)


class WaveletMatrix:
    """A shard as read from its blob."""

    def __init__(self, blob: bytes):
        magic, self.planes, self.size, docs = struct.unpack_from(HEAD, blob)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        self._blob, self._at = memoryview(blob), struct.calcsize(HEAD)
        ids = self._block(np.int64)
        missing = np.unpackbits(self._block(np.uint8), count=docs).astype(bool)
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, missing, strict=True)]
        self.starts = self._block(np.int64)
        self.bits, self.spans, self.zeros = [], [], []
        for _ in range(self.planes):
            self.bits.append(self._block(np.uint8))
            self.spans.append(self._block(np.uint32))
            self.zeros.append(self._length())

    def _length(self) -> int:
        value, = struct.unpack_from(LENGTH, self._blob, self._at)
        self._at += struct.calcsize(LENGTH)
        return value

    def _block(self, kind) -> np.ndarray:
        length = self._length()
        self._at += length
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self._blob[self._at - length : self._at]), kind)

    def _bit(self, plane: int, at: int) -> int:
        return int(self.bits[plane][at >> 3]) >> (7 - (at & 7)) & 1

    def _ones(self, plane: int, at: int) -> int:
        """Ones before a place."""
        span = at // SPAN
        first = span * SPAN
        return int(self.spans[plane][span]) + int(np.unpackbits(self.bits[plane][first >> 3 : (at + 7) >> 3], count=at - first).sum())

    def _nth(self, plane: int, bit: int, n: int) -> int:
        """Place of the n-th (from 0) one or zero."""
        before = self.spans[plane].astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * SPAN, self.size) - before
        span = int(np.searchsorted(before, n, "right")) - 1
        first = span * SPAN
        here = np.unpackbits(self.bits[plane][first >> 3 : (first + SPAN) >> 3])[: self.size - first]
        return first + int(np.flatnonzero(here == bit)[n - int(before[span])])

    def access(self, at: int) -> int:
        """The token at a place."""
        value = 0
        for plane in range(self.planes):
            bit = self._bit(plane, at)
            value = value << 1 | bit
            ones = self._ones(plane, at)
            at = self.zeros[plane] + ones if bit else at - ones
        return value

    def _range(self, token: int, first: int, last: int) -> tuple[int, int]:
        for plane in range(self.planes):
            low, high = self._ones(plane, first), self._ones(plane, last)
            if token >> (self.planes - 1 - plane) & 1:
                first, last = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                first, last = first - low, last - high
        return first, last

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """How often a token occurs from one place to before another."""
        if token >> self.planes:
            return 0
        a, z = self._range(token, first, self.size if last is None else last)
        return z - a

    def select(self, token: int, n: int) -> int:
        """The place of a token's n-th occurrence, from 0."""
        if not 0 <= n < self.count(token):
            raise IndexError(n)
        at = self._range(token, 0, 0)[0] + n
        for plane in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - plane) & 1
            at = self._nth(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, n) for n in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens, by undoing the splits from the last plane to the first."""
        rest = np.zeros(self.size, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in reversed(range(self.planes)):
            bits = np.unpackbits(self.bits[plane], count=self.size).astype(bool)
            rest[self.zeros[plane] :] |= rest.dtype.type(1 << (self.planes - 1 - plane))
            back = np.empty_like(rest)
            back[~bits], back[bits] = rest[: self.zeros[plane]], rest[self.zeros[plane] :]
            rest = back
        return rest
