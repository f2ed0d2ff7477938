"""Arrow text columns as bytes: slices of bounded size, word and window hashes.

Everything here works inside a task on one Arrow batch; numpy passes run over
slices of about ``SLICE_BYTES``, so memory does not depend on batch size. A
single longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: A random 64-bit value per byte; the seed is part of every stored hash.
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            table = np.full(size, U(base))
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_sums(data: np.ndarray, values: np.ndarray = _BYTE_VALUES) -> np.ndarray:
    """``n + 1`` prefix sums of a polynomial over the bytes, modulo 2**64."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, the same wherever the span stands."""
    _, down = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each position on."""
    _, down = _power_tables(len(sums))
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[width:] - sums[:n]) * down[:n])


@dataclass
class Slice:
    """Some consecutive rows of a batch: rows lo..hi, their bytes, offsets from 0."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column into slices of about ``limit`` bytes; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def byte_table(chars: bytes | list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Bytes that separate the words of ``[^\x20\x09-\x0D]+``.
SPACE = byte_table(b" \t\n\x0b\x0c\r")
#: Bytes that are no part of a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, A-Z aside.
NOT_ALNUM = byte_table([b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of a slice in text order: byte spans, row, and the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray  # rows + 1 entries

    def hashes(self, part: Slice) -> np.ndarray:
        """Of the words with A-Z lower-cased."""
        return span_hashes(prefix_sums(LOWER[part.data]), self.starts, self.ends)


def words(part: Slice, separators: np.ndarray) -> Words:
    inside = ~separators[part.data]
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[part.offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(part.offsets, starts, "right") - 1
    first = np.searchsorted(starts, part.offsets)
    return Words(starts, np.flatnonzero(ends) + 1, rows, first)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values, over row borders too; the caller masks those."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += mix(hashes[i:i + n] + U(((i + 1) * _ODD) & _MASK))
    return mix(total)


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
