"""Whole texts inside Arrow tasks as flat byte arrays: blocks of rows, words and shingles.

Tasks receive Arrow batches of any size; :func:`blocks` cuts them to a bounded
number of text bytes, so that working arrays stay small (one text longer than
the bound is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
#: For work that needs many bytes for one of text: what a worker has once allocated, it keeps between stages.
SMALL_BLOCK_BYTES = 1 << 19
#: Documents that go to a Python worker at once, where it also needs much memory for its work.
BATCH_ROWS = 1000

#: ``[\x20\x09-\x0D]`` separates words.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text or binary column, and where each row starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, values = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if large else np.int32
    starts = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most ``limit`` bytes, or one row."""
    _, starts = flat(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(starts, starts[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[0][:n], _powers[1][:n]


class RangeHash:
    """Hashes of any byte ranges of one buffer, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        table = _BYTE_VALUE[_LOWER] if lower else _BYTE_VALUE
        up, self.down = _base_powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the number of words before it."""
    inside = ~_SEPARATOR[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:-1]
    closes[:-1] &= ~inside[1:] | first[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return begin, end, np.searchsorted(begin, starts)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, A-Z lower-cased, and for each row the number of words before it."""
    begin, end, rows = word_spans(data, starts)
    return RangeHash(data, lower=True).of(begin, end), rows


def shingles(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each row, and the number of runs before each row.

    A row with fewer words, but at least one, has one run: all its words.
    """
    count = np.diff(rows)
    runs = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=out[1:])
    row = np.repeat(np.arange(len(runs)), runs)
    at = rows[:-1][row] + np.arange(out[-1]) - out[:-1][row]
    left = rows[1:][row] - at
    hashed = np.full(len(at), np.uint64(k), np.uint64)
    for i in range(k):
        word = words[np.minimum(at + i, len(words) - 1)] if len(words) else np.zeros(0, np.uint64)
        hashed = np.where(left > i, mixed(hashed * np.uint64(0x2545F4914F6CDD1D) + word), hashed)
    return hashed, out


def row_sets(hashed: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row in ascending order, and the number of values before each row."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    out = np.zeros(len(rows), np.int64)
    np.cumsum(np.bincount(row[new], minlength=len(rows) - 1), out=out[1:])
    return hashed[new], out


def lists(values: np.ndarray, rows: np.ndarray) -> pa.Array:
    """An Arrow list column with each row's part of ``values``."""
    return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(values))


#: ASCII punctuation, dropped at both ends of a word.
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def trimmed_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`word_hashes`, without punctuation at the ends of words; words of nothing else are left out."""
    begin, end, _ = word_spans(data, starts)
    if len(begin):
        open_ = np.flatnonzero(_PUNCTUATION[data[begin]])
        while len(open_):
            begin[open_] += 1
            open_ = open_[begin[open_] < end[open_]]
            open_ = open_[_PUNCTUATION[data[begin[open_]]]]
        open_ = np.flatnonzero((end > begin) & _PUNCTUATION[data[end - 1]])
        while len(open_):
            end[open_] -= 1
            open_ = open_[begin[open_] < end[open_]]
            open_ = open_[_PUNCTUATION[data[end[open_] - 1]]]
        full = end > begin
        begin, end = begin[full], end[full]
    return RangeHash(data, lower=True).of(begin, end), np.searchsorted(begin, starts)
