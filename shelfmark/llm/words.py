"""Words, word hashes and rolling windows of many texts at once, for use inside tasks.

A word is ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split()`` cuts. Hashes are uint64; windows are
polynomials over word hashes, mixed, so equal windows have equal hashes wherever they start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

SPACES = b" \t\n\r\x0b\x0c"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_KEPT_WORDS = 1 << 18  # memory bound of a worker's word cache; it starts anew beyond


class WordHashes(dict):
    """Word (bytes) to hash, filled as words are met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_chunks(batches: Iterable[pa.RecordBatch], size: int = 1 << 21, text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of batches with about ``size`` bytes of text (one row at least), so that a task's memory is bounded."""
    for batch in batches:
        texts = texts_of(batch.column(text))
        start = held = 0
        for i, x in enumerate(texts):
            held += len(x)
            if held >= size or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0


def hash_words(texts: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one entry more than texts)."""
    parts, starts = [], np.zeros(len(texts) + 1, np.int64)
    for i, x in enumerate(texts):
        words = x.split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        starts[i + 1] = starts[i] + len(words)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), starts


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the window of ``n`` words from each position; the last n-1 positions are left out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    powers = np.full(len(hashes), _BASE)
    powers[0] = 1
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(powers, dtype=np.uint64), dtype=np.uint64, out=total[1:])
    powers = np.full(count, _BASE_INVERSE)
    powers[0] = 1
    return mix((total[n:] - total[:count]) * np.cumprod(powers, dtype=np.uint64))


def inside(starts: np.ndarray, n: int) -> np.ndarray:
    """For each of the positions that ``windows`` returns: does its window stay in one text?"""
    count = int(starts[-1]) - n + 1
    if count <= 0:
        return np.zeros(0, bool)
    ok = np.ones(count + n, bool)
    for back in range(1, n):
        at = starts[1:] - back
        ok[at[(at >= 0) & (at < len(ok)) & (at >= starts[:-1])]] = False
    return ok[:count]


def owners(starts: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def sums(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of a value per word over each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]
