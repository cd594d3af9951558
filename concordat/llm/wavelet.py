"""Wavelet matrix over integer ids in one compressed file per shard.

Layout (little-endian)::

    b"WMX1" | u32 length of head | head (zstd JSON) | body

The head names the number of ids, bit planes and documents, the zeros of each
plane, the place of every compressed block in the body, the absolute rank at
the start of each block, and the documents' table. A plane is cut into blocks
of ``BLOCK_BITS`` bits, each compressed on its own, so ``access``, ``rank``,
``count`` and ``select`` read only the blocks that they touch.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections import OrderedDict

import numpy as np
import zstandard

MAGIC = b"WMX1"
BLOCK_BITS = 1 << 19
CACHED_BLOCKS = 64


def planes_of(ids: np.ndarray, bits: int):
    """Yield (plane, zeros) from the highest bit down; each plane is stably
    partitioned by the bits above it."""
    cur = ids
    for k in range(bits - 1, -1, -1):
        plane = (cur >> cur.dtype.type(k)) & cur.dtype.type(1) != 0
        # Taking by index has no branch to mispredict, unlike selection by mask.
        low = np.flatnonzero(~plane)
        yield plane, len(low)
        after = np.empty_like(cur)
        cur.take(low, out=after[: len(low)], mode="clip")
        cur.take(np.flatnonzero(plane), out=after[len(low) :], mode="clip")
        cur = after


def build(ids: np.ndarray, doc_ids: list[int | None], doc_lengths: np.ndarray, bits: int) -> bytes:
    """One shard as bytes. ``doc_lengths`` partition ``ids`` in order."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if int(doc_lengths.sum()) != len(ids) or len(doc_ids) != len(doc_lengths):
        raise ValueError("documents do not cover the ids")
    cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=1)
    zeros, blocks, ranks, body, at = [], [], [], [], 0
    for plane, low in planes_of(cur, bits):
        zeros.append(low)
        own, before, total = [], [], 0
        for i in range(0, len(plane), BLOCK_BITS):
            part = plane[i : i + BLOCK_BITS]
            data = pack.compress(np.packbits(part, bitorder="little").tobytes())
            own.append((at, len(data)))
            before.append(total)
            total += int(np.count_nonzero(part))
            body.append(data)
            at += len(data)
        blocks.append(own)
        ranks.append(before)
    head = {"n": len(ids), "bits": bits, "zeros": zeros, "blocks": blocks, "ranks": ranks, "doc_ids": list(doc_ids), "doc_lengths": doc_lengths.tolist()}
    packed = zstandard.ZstdCompressor(level=3).compress(json.dumps(head, separators=(",", ":")).encode())
    return b"".join((MAGIC, struct.pack("<I", len(packed)), packed, *body))


class WaveletMatrix:
    """Reads a shard from an open random-access file, block by block."""

    def __init__(self, file):
        self.file = file
        file.seek(0)
        if file.read(4) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (size,) = struct.unpack("<I", file.read(4))
        head = json.loads(zstandard.ZstdDecompressor().decompress(file.read(size)))
        self.base = 8 + size
        self.n, self.bits, self.zeros, self.blocks, self.ranks = (head[k] for k in ("n", "bits", "zeros", "blocks", "ranks"))
        self.doc_ids = head["doc_ids"]
        self.doc_ends = np.cumsum(np.array(head["doc_lengths"], dtype=np.int64))
        self._kept: OrderedDict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = OrderedDict()

    def _bits(self, plane: int, block: int) -> np.ndarray:
        at, size = self.blocks[plane][block]
        self.file.seek(self.base + at)
        data = zstandard.ZstdDecompressor().decompress(self.file.read(size))
        n = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
        return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n, bitorder="little")

    def _block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a block, and the ones before each of them and at its end."""
        if (key := (plane, block)) in self._kept:
            self._kept.move_to_end(key)
            return self._kept[key]
        bits = self._bits(plane, block)
        ones = np.zeros(len(bits) + 1, dtype=np.int64)
        np.cumsum(bits, out=ones[1:])
        self._kept[key] = bits, ones + self.ranks[plane][block]
        if len(self._kept) > CACHED_BLOCKS:
            self._kept.popitem(last=False)
        return self._kept[key]

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i <= 0 or not self.n:
            return 0
        block = (i - 1) // BLOCK_BITS
        return int(self._block(plane, block)[1][i - block * BLOCK_BITS])

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.bits):
            block, off = divmod(i, BLOCK_BITS)
            bit = int(self._block(p, block)[0][off])
            ones = self._ones(p, i)
            value = value << 1 | bit
            i = self.zeros[p] + ones if bit else i - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        lo, hi = 0, end
        for p in range(self.bits):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if value >> (self.bits - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, value: int, end: int) -> int:
        """Occurrences of ``value`` among the first ``end`` ids."""
        if value < 0 or value >> self.bits:
            return 0
        lo, hi = self._range(value, min(end, self.n))
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) ``bit`` of a plane."""
        lo, hi = 0, self.n
        while hi - lo > 1:
            mid = (lo + hi) // 2
            before = self._ones(plane, mid) if bit else mid - self._ones(plane, mid)
            lo, hi = (mid, hi) if before <= k else (lo, mid)
        return lo

    def select(self, value: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``value``."""
        if value < 0 or value >> self.bits:
            raise IndexError(k)
        lo, hi = self._range(value, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - p) & 1
            i = self._find(p, bit, i - self.zeros[p] if bit else i)
        return i

    def occurrences(self, value: int) -> list[tuple[int | None, int]]:
        """(document, offset in it) of every occurrence, in order."""
        found = []
        for k in range(self.count(value)):
            i = self.select(value, k)
            d = int(np.searchsorted(self.doc_ends, i, side="right"))
            found.append((self.doc_ids[d], i - (int(self.doc_ends[d - 1]) if d else 0)))
        return found

    def decode(self) -> np.ndarray:
        """All ids at once: the stable partitions are undone from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, dtype=kind)
        for p in range(self.bits - 1, -1, -1):
            bits = np.concatenate([self._bits(p, b) for b in range(len(self.blocks[p]))]).view(bool) if self.n else np.zeros(0, bool)
            cur[self.zeros[p] :] |= kind(1 << (self.bits - 1 - p))
            out = np.empty_like(cur)
            out[np.flatnonzero(~bits)] = cur[: self.zeros[p]]
            out[np.flatnonzero(bits)] = cur[self.zeros[p] :]
            cur = out
        return cur

    def documents(self):
        """Yield (doc_id, ids) in file order."""
        ids, start = self.decode(), 0
        for d, end in zip(self.doc_ids, self.doc_ends, strict=True):
            yield d, ids[start:end]
            start = end


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
