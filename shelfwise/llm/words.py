"""Words of Arrow text columns as numpy arrays.

Texts are never cut: a batch is worked through in runs of whole texts, so the
arrays stay small next to the batch unless a single text is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything of ASCII but digits and letters separates words.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:0x80] = True
for first, last in (("0", "9"), ("A", "Z"), ("a", "z")):
    NON_ALNUM[ord(first) : ord(last) + 1] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A 64-bit number for each byte; separators are set to 0 where they are used.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
BASE = _U(0xD6E8FEB86659FD93)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    found = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), found


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets from 0)`` of runs of whole texts."""
    if len(column) == 0:
        return
    data, offsets = buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """The words of some texts: byte ranges, 64-bit hashes, and for each text
    (and the end) the number of words before it."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``size`` words from each word on, and which of them end
        in the same text."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(n, np.uint64), np.zeros(n, bool)
        total = np.zeros(n, np.uint64)
        for k, factor in enumerate(powers(_U(0xA24BAED4963EE407), size + 1)[1:]):
            total[: n - size + 1] += self.hashes[k : n - size + 1 + k] * factor
        whole = np.arange(n) + size <= np.repeat(self.first[1:], self.counts)
        return mix(total), whole


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Split texts at bytes that ``separators`` marks; words never span texts.

    ``data`` is taken as it is: lower-case it before if case shall not count.
    """
    inside = ~separators[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < n)]
    before[borders] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[borders - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(starts, ends, np.zeros(0, np.uint64), first)
    code = np.where(separators, _U(0), BYTE_CODE)
    gaps = np.diff(np.append(starts, n))
    within = np.arange(starts[0], n) - np.repeat(starts, gaps)
    terms = code[data[starts[0] :]] * powers(BASE, int(gaps.max()))[within]
    hashes = mix(np.add.reduceat(terms, starts - starts[0]) + (ends - starts).astype(np.uint64))
    return Words(starts, ends, hashes, first)
