"""Bytes and words of Arrow text batches, as numpy arrays."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows that are read, and that travel to Python, together: whole batches of texts are held
#: there, in the heap of the JVM and outside it, and documents may be long.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}
#: Bytes of text that are worked on at once; a longer text is taken alone.
SLICE_BYTES = 1 << 20
#: Bytes that are hashed at once; cut between words.
SEGMENT_BYTES = 1 << 16

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits.
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_KEPT: dict = {}


def kept(key, make):
    """What a Python worker keeps between tasks: the thing of one key, whoever asks.

    Workers are used again by later jobs. Another operator's tables and memory would add
    to those of the one at work, so they go when another key is asked for.
    """
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            gc.collect()
            give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def bound_batches(spark: SparkSession) -> None:
    """Set `BATCHES` for the session: what is planned from now on keeps to them."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def give_back() -> None:
    """Let the allocators of Python, numpy and Arrow return free memory to the system.

    Several workers share an executor's memory, most of them waiting: each would hold on to
    what its largest batch took.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc: it keeps what it has for later use
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return (whole[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(column) else (whole[:0], np.zeros(1, np.int64))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of rows of at most `limit` bytes; a row above it comes alone.

    After the last run, memory that is free by then goes back to the system.
    """
    _, offsets = raw(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield column.slice(at, to - at)
        at = to
    give_back()


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, x, np.uint64)])) for x in (_BASE, inverse))


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word: what stands between `gaps`, in lower case.

    Words never cross a row. Long input is hashed in segments cut at gaps, so beside
    the words only one segment is held as 64-bit numbers.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~gaps[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < n]
    opens[rows] |= inside[rows]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] |= inside[last]
    ends = np.flatnonzero(closes) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + SEGMENT_BYTES, side="right")))
        piece = data[low : ends[to - 1]]
        up, down = _powers(max(SEGMENT_BYTES, 1 << (len(piece)).bit_length()))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((LOWER[piece].astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=total[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return hashes, starts, ends


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row, the index of its first word; one more entry closes the last."""
    return np.searchsorted(starts, offsets, side="left")


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's runs of `size` words.

    A row with fewer words has one shingle, all of them; a row without words none.
    """
    run = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for j in range(size):
        run = mix(run * _BASE + hashes[j : len(run) + j] + np.uint64(j + 1))
    out = []
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= size:
            out.append(np.unique(run[lo : hi - size + 1]))
        elif hi > lo:
            few = np.zeros(1, np.uint64)
            for j in range(hi - lo):
                few = mix(few * _BASE + hashes[lo + j : lo + j + 1] + np.uint64(j + 1))
            out.append(mix(few + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    flat = np.concatenate(values) if values else np.zeros(0)
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
