"""Words and hashes of whole Arrow batches of texts, in numpy inside Spark tasks.

A word is a run of ASCII letters, digits and non-ASCII characters; A-Z count as a-z.  As every byte of
a non-ASCII character is 0x80 or more, words can be found in the UTF-8 bytes.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[128:] = True
IS_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))[LOWER]
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; the table is kept and grows."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        _powers[base] = table = np.multiply.accumulate(table)
    return table[:n]


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, each with the power of its place."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return sums


def _between(sums: np.ndarray, start: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    before, back = sums[start], powers(INVERSE, len(sums))[start]
    return [mixed((sums[end] - before) * back ^ (end - start).astype(np.uint64)) for end in ends]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end], equal for equal spans wherever they stand."""
    return _between(_sums(values), start, end)[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row bounds, bytes) of runs of whole texts of about `limit` bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    n = len(column)
    if not n:
        return
    at = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, at[i : j + 1] - at[i], data[at[i] : at[j]]
        i = j


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray  # of the block
    hash: np.ndarray
    bounds: np.ndarray  # words of row r: bounds[r] to bounds[r + 1]
    sums: np.ndarray  # that spans of the block are hashed from


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """The words of each row of a block."""
    inside = IS_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = bounds[1:] > bounds[:-1]
    begins, ends = bounds[:-1][full], bounds[1:][full] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    of_row = np.searchsorted(start, bounds)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(of_row))
    sums = _sums(BYTE_VALUES[data])
    return Words(start, end, row, _between(sums, start, end)[0], of_row, sums)


def beginnings(w: Words, at: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each of `sizes`: the hashes of the first so many bytes of the words `at`, or of all if a word has fewer."""
    start, end = w.start[at], w.end[at]
    return _between(w.sums, start, *(np.minimum(end, start + k) for k in sizes))


def coded(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, a place of each, index of each hash among them), by a hash table."""
    found = pa.array(hashes).dictionary_encode()
    values, code = found.dictionary.to_numpy(), found.indices.to_numpy()
    place = np.empty(len(values), dtype=np.int64)
    place[code] = np.arange(len(code))
    return values, place, code


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `coded`, the distinct hashes ascending."""
    values, place, code = coded(hashes)
    order = np.argsort(values)
    rank = np.empty(len(values), dtype=np.int64)
    rank[order] = np.arange(len(values))
    return values[order], place[order], rank[code]


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of all runs of `size` words of one row."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.row[:n] == w.row[size - 1 :])
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        total += w.hash[at + k] * powers(BASE, size + 1)[k + 1]
    return at, mixed(total ^ np.uint64(size))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long."""
    return x.view(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0]..starts[0]+lengths[0]-1, starts[1].., end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(before - starts, lengths)
