"""Words, lines and their hashes for a whole Arrow column at once, in numpy.

Texts are taken as UTF-8 bytes: the separators are ASCII, so cutting bytes cuts
characters rightly.  Hashes are 64-bit; within one text they stand for equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch holding about `limit` bytes of the text column."""
    offsets = utf8(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    return held, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text number of each run of non-space bytes."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    begins, ends = offsets[:-1][full], offsets[1:][full] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, owners(offsets, starts)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text number of each \\n-separated line."""
    breaks = np.flatnonzero(data == 0x0A)
    texts = np.arange(len(offsets) - 1)
    owner = owners(offsets, breaks)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    doc = np.concatenate([texts, owner])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    final = np.ones(len(doc), bool)
    final[:-1] = doc[1:] != doc[:-1]
    ends[final] = offsets[1:]
    return starts, ends, doc


def owners(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which text each byte position lies in."""
    return np.searchsorted(offsets[1:], at, side="right")


def characters(data: np.ndarray) -> np.ndarray:
    """Running count of code points: entry i counts those that begin before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, from one running polynomial sum over all bytes."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(items: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Rolling hash of every run of n items, for each n of `lengths` (ascending).

    Entry i covers items i to i+n-1; the hash for n grows out of the one before.
    """
    up, _ = _power_tables(max(lengths, default=0) + 1)
    value, n = np.zeros(len(items), np.uint64), 0
    for length in lengths:
        while n < length:
            value = value[: max(len(items) - n, 0)] + items[n:] * up[n]
            n += 1
        yield length, value


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def covered(size: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of `size` places lie in a run of `length` places from one of `starts`."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < size:
        size = max(size, 2 * len(_powers[0]), SLICE_BYTES + 64)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers
