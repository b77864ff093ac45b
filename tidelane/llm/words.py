"""Words of many texts at once: bounds and 64-bit hashes by numpy, for functions that run inside Spark tasks.

A word is known by the hash of its bytes. Two different words share a hash with a probability of 2^-64 a pair.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; numpy needs some 50 bytes for each. A longer text is handled alone.
SLICE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Which bytes belong to words. SPACED: all but white space; LETTERS: a-z, A-Z, 0-9 and all beyond ASCII.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: A random number for each byte; in the second table the same for both cases of A-Z.
_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_FOLDED = _EXACT[_LOWER]

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        made = []
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if n > 2 * SLICE_BYTES:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def give_back() -> None:
    """Return memory that is free in this process to the system; else an idle Python worker keeps what its largest slice took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run``, a function for mapInArrow, that returns free memory after its last batch."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


@dataclass
class Words:
    """Words of a slice of texts, in order."""

    start: np.ndarray  # byte offsets into ``data``
    end: np.ndarray
    first: np.ndarray  # index of each text's first word; one more than texts
    base: np.ndarray  # byte offset of each text; one more than texts
    data: np.ndarray

    def hashes(self, exact: bool = False) -> np.ndarray:
        """A 64-bit hash for each word, in which A-Z count as a-z unless ``exact``."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        power, back = _powers_to(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((_EXACT if exact else _FOLDED)[self.data] * power[:-1], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * back[self.start])

    def of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(texts: pa.Array, inside: np.ndarray) -> Words:
    """Cut texts (binary, no nulls) into words of the bytes that ``inside`` marks."""
    base = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_binary(texts.type) else np.int64)
    base = base[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[base[0] : base[-1]] if raw is not None else np.zeros(0, np.uint8)
    base = base - base[0]
    word = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[base] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | cut[1:-1]
    ends[:-1] &= ~word[1:] | cut[1:-1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, base), base, data)


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as binary without nulls; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.binary() if column.nbytes < 2**31 else pa.large_binary()), b"")


def slices(batch: pa.RecordBatch | pa.Table, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of a batch's rows with at most ``limit`` bytes of text, or one row; each with its texts as binary."""
    texts = plain(batch[text])
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) if len(texts) else np.zeros(0)
    at = 0
    while at < len(texts):
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to
