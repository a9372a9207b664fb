"""Words of many texts at once, as arrays: the Arrow-side helper of the operators on words.

A word is ``[^\\x20\\x09-\\x0D]+``. Texts are read from Arrow batches without making Python strings. Word and shingle
hashes are 64 bits wide: equal words always have equal hashes, and where a result depends on equality the callers compare
words or accept the chance of 2^-64 for each compared pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is handled alone. Results don't depend on it.
CHUNK_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD6E8FEB86659FD93
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit hash, so that all its bits depend on all of the input."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        grown = [np.full(max(n, CHUNK_BYTES + 1), x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
        for x in grown:
            x[0] = 1
        _powers = tuple(np.multiply.accumulate(x) for x in grown)
    return _powers


@dataclass
class Words:
    """Words of the texts ``first .. first + texts - 1`` of a batch, in order."""

    first: int
    texts: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)

    def hashes(self) -> np.ndarray:
        """One hash for each word, from its bytes."""
        up, down = _power(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:len(self.data)], out=total[1:])
        own = (total[self.end] - total[self.start]) * down[self.start]
        return mix(own + (self.end - self.start).astype(np.uint64))

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each place on, and the places where so many words are left in the text."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out, factor = np.zeros(n, np.uint64), _STEP
        for j in range(k):
            out += hashes[j:n + j] * np.uint64(factor)
            factor = factor * _BASE % (1 << 64)
        place = np.flatnonzero(self.text[:n] == self.text[k - 1:])
        return mix(out[place]), place


def column(batch: pa.RecordBatch, name: str, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty. ``fold`` turns all letters into lower case."""
    array = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()).fill_null("")
    array = pc.utf8_lower(array) if fold else array
    bounds = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), bounds


def texts(batch: pa.RecordBatch, name: str, lower: bool = False, alnum: bool = False) -> Iterator[Words]:
    """Words of a batch's texts, some megabytes at a time.

    ``lower`` turns A-Z into a-z. ``alnum`` takes runs of letters and digits (any byte above 127 included) as words, in lower
    case of all scripts.
    """
    if not batch.num_rows:
        return
    data, bounds = column(batch, name, fold=alnum)
    first, blank = 0, _NOT_ALNUM if alnum else _BLANK
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, "right")) - 1)
        last = min(last, batch.num_rows)
        own = bounds[first:last + 1] - bounds[first]
        piece = data[bounds[first]:bounds[last]]
        word = ~blank[piece]
        before, after = np.zeros(len(word), bool), np.zeros(len(word), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[own[:-1][own[:-1] < len(word)]] = False
        after[own[1:][own[1:] > 0] - 1] = False
        start = np.flatnonzero(word & ~before)
        yield Words(first, last - first, _LOWER[piece] if lower else piece, start, np.flatnonzero(word & ~after) + 1,
                    np.searchsorted(own, start, "right") - 1, own)
        first = last
