"""Hashed word and character n-grams of a text, as bucket numbers.

Characters are code points, words are those of `common.WORD`; case counts, since shouting is a
feature. A word pair whose halves are equal is hashed as "a repeated word", whatever the word.
Texts are read in blocks of `BLOCK` characters, so memory stays bounded; n-grams across the
end of a block are carried over, so the cuts change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np

BLOCK = 1 << 18
CHAR_SIZES = (3, 4)
REPEATED = 0x51ED270B


def _buckets(h: np.ndarray, bits: int) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    h *= np.uint32(0x297A2D39)
    return h >> np.uint32(32 - bits)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    pair = (left * np.uint32(0x1B873593)) ^ (right * np.uint32(0xE6546B64) + right)
    pair[left == right] = REPEATED
    return pair


def grams(text: str, bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers below 2**bits, in arrays; an empty text gives none."""
    held, before = None, np.empty(0, np.uint32)  # hash of a word cut by the block's end, and of the word before
    for at in range(0, len(text), BLOCK):
        part = text[at : at + BLOCK]
        tail = text[max(0, at - max(CHAR_SIZES) + 1) : at]
        chars = np.frombuffer((tail + part).encode("utf-32-le", "surrogatepass"), np.uint32)
        h = chars * np.uint32(0x9E3779B1)
        for n in range(2, max(CHAR_SIZES) + 1):
            if len(chars) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint32(13))) * np.uint32(0x85EBCA6B) + chars[n - 1 :]
            if n in CHAR_SIZES:
                yield _buckets(h[max(0, len(tail) - n + 1) :] + np.uint32(n), bits)
        raw = part.encode("utf-8", "surrogatepass")
        words = raw.split()
        hashes = list(map(crc32, words))
        if held is not None:
            if raw[:1].isspace():
                hashes.insert(0, held)
            else:
                hashes[0] = crc32(words[0], held)
        held = hashes.pop() if at + BLOCK < len(text) and not raw[-1:].isspace() else None
        if hashes:
            w = np.array(hashes, np.uint32)
            yield _buckets(w * np.uint32(0xCC9E2D51) + np.uint32(101), bits)
            run = np.concatenate([before, w])
            yield _buckets(_pair(run[:-1], run[1:]) + np.uint32(202), bits)
            before = w[-1:]


def mean_value(text: str, values: np.ndarray, bits: int) -> float:
    """Mean of `values[bucket]` over all n-grams of the text; 0.0 without any."""
    total, n = 0.0, 0
    for ids in grams(text, bits):
        total += float(values[ids].sum(dtype=np.float64))
        n += len(ids)
    return total / n if n else 0.0


def frequencies(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their shares of the text's n-grams."""
    parts = list(grams(text, bits))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    ids, counts = np.unique(np.concatenate(parts), return_counts=True)
    return ids.astype(np.int64), (counts / counts.sum()).astype(np.float32)


class Sparse:
    """Rows of n-gram shares, one after the other."""

    def __init__(self, texts: list[str], bits: int):
        rows = [frequencies(t, bits) for t in texts]
        self.ids = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.int64)
        self.shares = np.concatenate([r[1] for r in rows]) if rows else np.empty(0, np.float32)
        self.ends = np.cumsum([len(r[0]) for r in rows])
        self.row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        self.rows = len(rows)

    def take(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        end = self.ends[row]
        start = self.ends[row - 1] if row else 0
        return self.ids[start:end], self.shares[start:end]

    def dot(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.shares * values[self.ids], self.rows)

    def gradient(self, by_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.ids, self.shares * by_row[self.row], size)
