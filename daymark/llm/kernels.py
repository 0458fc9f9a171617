"""Array kernels over Arrow text columns: packing, word and shingle hashes.

They run inside tasks, on one slice of a batch at a time. Hashes are 64-bit: a linear form of
the bytes over fixed random values (mod 2**64), then a bijective finaliser. Two different
words of ordinary length collide with a probability of about 2**-58.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_random = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
WORD_VALUES = _random.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)

#: Tab, line feed, vertical tab, form feed, carriage return and space end a word.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text that are hashed at once, unless a row is longer.
PIECE = 1 << 19

_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(kind: str, count: int) -> np.ndarray:
    """BASE**i for "up" and BASE**-i for "down", i below ``count``; kept between calls."""
    have = _powers[kind]
    while len(have) < count:
        step = pow(BASE if kind == "up" else INVERSE, len(have), 2**64)
        have = np.concatenate([have, have * U64(step)])
    _powers[kind] = have
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def packed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and where each row starts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"") if len(texts) else pa.array([], pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]] if len(texts) else whole[:0], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about ``most`` bytes; a longer row is a slice of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_slices(texts: pa.Array, most: int = 1 << 21):
    """(first row, last row, bytes, starts) of each slice of a column."""
    data, offsets = packed(texts)
    for first, last in slices(offsets, most):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def running(data: np.ndarray, table: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Prefix sums H with which ``span`` gives the hash of any stretch."""
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(table[data] * powers("up", len(data)), out=total[1:])
    return total


def span(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from ``start`` to ``end``, the same wherever they stand."""
    down = powers("down", len(total))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of each word of a slice."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = starts[(starts > 0) & (starts < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words with A-Z in lower case."""
    return span(running(LOWER[data]), begin, end)


def _shingles(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    begin, end, row = words(data, starts)
    hashes = word_hashes(data, begin, end)
    rows, hashed = [], []
    if len(hashes) >= size:
        joined = np.zeros(len(hashes) - size + 1, U64)
        for k in range(size):
            joined += hashes[k : len(hashes) - size + 1 + k] * WORD_VALUES[k]
        whole = row[: len(joined)] == row[size - 1 :]
        rows.append(row[: len(joined)][whole])
        hashed.append(mix(joined[whole] + U64(size)))
    counts = np.bincount(row, minlength=len(starts) - 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        joined = np.zeros(len(short), U64)
        for k in range(size - 1):
            has = counts[short] > k
            joined[has] += hashes[first[short[has]] + k] * WORD_VALUES[k]
        rows.append(short)
        hashed.append(mix(joined + counts[short].astype(U64)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    rows, hashed = np.concatenate(rows), np.concatenate(hashed)
    order = np.lexsort((hashed, rows))
    rows, hashed = rows[order], hashed[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashed[1:] != hashed[:-1])
    return rows[new], hashed[new]


def shingles(data: np.ndarray, starts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct word shingles, sorted by both.

    A row with fewer than ``size`` words has its whole sequence as one shingle, a row without
    words has none. Rows are hashed in pieces of ``PIECE`` bytes, since the hashes of a text's
    bytes take many times its memory.
    """
    rows, hashed = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for first, last in slices(starts, PIECE):
        row, some = _shingles(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], size)
        rows.append(row + first)
        hashed.append(some)
    return np.concatenate(rows), np.concatenate(hashed)


def sums(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sum of ``values`` (mod 2**64) for each of ``count`` rows; ``rows`` is sorted."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    bounds = np.searchsorted(rows, np.arange(count + 1))
    return total[bounds[1:]] - total[bounds[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def binary_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose row i has the bytes of ``values[bounds[i]:bounds[i + 1]]``."""
    data = np.ascontiguousarray(values)
    offsets = pa.py_buffer((np.asarray(bounds) * data.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(data.tobytes())])


def long_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column of whole numbers from flat values."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(bounds, np.int32)), pa.array(signed(values) if values.dtype == U64 else values))
