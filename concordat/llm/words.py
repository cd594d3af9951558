"""Words of texts as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

KEPT = 400_000
MUL = np.uint64(0x9E3779B97F4A7C15)
MUL2 = np.uint64(0xD6E8FEB86659FD93)


class Hashes(dict):
    """Hash of a word, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = Hashes()


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """Hashes of the words of a text, cut at ASCII white space (\\x20, \\x09-\\x0D)."""
    if not text:
        return np.zeros(0, np.uint64)
    words = (text.lower() if lower else text).encode().split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def batch_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and where each text's begin (and the last ends).

    Each distinct word of a batch is hashed once.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.utf8_lower(texts)
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    values = [xxhash.xxh3_64_intdigest(w) if w else 0 for w in coded.dictionary.to_pylist()]
    empty = np.array([not w for w in coded.dictionary.to_pylist()], dtype=bool)
    codes = np.asarray(coded.indices)
    offsets = np.asarray(split.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    out = np.array(values, dtype=np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
    if len(values) and empty.any():
        keep = ~empty[codes]
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        out = out[keep]
    return out, offsets


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MUL2
    h = (h ^ (h >> np.uint64(29))) * MUL
    return h ^ (h >> np.uint64(32))


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive words (none if there are fewer).

    Runs double in length, so the cost grows with log(k).
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, block, size = None, 0, h, 1
    rest = k
    while rest:
        if rest & 1:
            part = block[done : done + n]
            out = part if out is None else mix(out * MUL + part)
            done += size
        rest >>= 1
        if rest:
            m = len(block) - size
            block = mix(block[:m] * MUL + block[size : size + m])
            size *= 2
    return mix(out + np.uint64(k))
