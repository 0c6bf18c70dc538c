"""Flat word arrays: the words of many texts in one Arrow dictionary plus numpy offsets, without a Python object per word."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Texts are worked on in blocks of about this many UTF-8 bytes; one longer text is a block of its own.
BLOCK_BYTES = 4 << 20

_BYTES = np.arange(256)
#: Lower-cases A-Z and nothing else.
FOLD = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after FOLD: digits, small letters and everything beyond ASCII.
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: Bytes of ``[^\x20\x09-\x0D]``.
SOLID = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Small letters and everything beyond ASCII.
LETTERS = ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def blocks(batch: pa.RecordBatch, column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take about ``max_bytes`` together."""
    texts = batch.column(column)
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    if batch.num_rows:
        sizes[:] = np.asarray(pa.compute.binary_length(texts).fill_null(0))
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_batches(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package on the path of Python workers, where it lies at the same place for them.

    Where it does not, ship it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df.mapInArrow(fn, schema)


@contextmanager
def batches_of(spark, max_bytes: int) -> Iterator[None]:
    """Smaller Arrow batches for what is run inside: where rows are large, a batch of them would fill a task's memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_blocks(df: DataFrame, text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType,
               max_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``map_batches`` over blocks of bounded size; ``fn`` may return None for no rows."""
    def run(batches):
        for batch in batches:
            for block in blocks(batch, text, max_bytes):
                out = fn(block)
                if out is not None and out.num_rows:
                    yield out
    return map_batches(df, run, schema)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the offsets of the texts; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, count=len(texts) + 1, offset=8 * texts.offset)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """``ids[first[i]:first[i + 1]]`` are text i's words as places in ``dictionary``; start and end are byte places."""

    ids: np.ndarray
    dictionary: pa.Array
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of wanted bytes, never across two texts, and the first run of each text."""
    mask = inside[data]
    edge = offsets[:-1][np.diff(offsets) > 0]
    before = np.empty_like(mask)
    before[1:] = mask[:-1]
    before[edge] = False
    start = np.flatnonzero(mask & ~before)
    after = np.empty_like(mask)
    after[:-1] = mask[1:]
    after[np.append(edge[1:], len(data))[:len(edge)] - 1] = False
    end = np.flatnonzero(mask & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def slices(kept: np.ndarray, size: np.ndarray) -> pa.Array:
    """Bytes on end, cut into a binary array of the given sizes."""
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])


def words(texts: pa.Array, inside: np.ndarray = SOLID, fold: bool = False) -> Words:
    data, offsets = raw_bytes(texts)
    if fold:
        data = FOLD[data]
    start, end, first = spans(data, offsets, inside)
    encoded = slices(data[inside[data]], end - start).dictionary_encode()
    return Words(np.asarray(encoded.indices).astype(np.int64), encoded.dictionary, first, start, end, data, offsets)


def hashes(values: pa.Array) -> np.ndarray:
    """64-bit hashes of binary values; the same value has the same hash in every task."""
    import xxhash
    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values.to_pylist()), np.uint64, len(values))


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values; one for each start that has a whole run."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out ^ word_hashes[k:k + n]) + np.uint64(0x9E3779B97F4A7C15)
    return out


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ..., start + size - 1 of each run, on end."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    return base + np.arange(total)


class Runs:
    """Equal runs of two value arrays, found by prefix sums of a polynomial hash instead of value by value."""

    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(len(a), len(b)), self._BASE))))
        self.a, self.b = self._sums(a), self._sums(b)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        spread = mix(values.astype(np.int64).view(np.uint64) + self._BASE)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread * self.power[:len(values)])))

    def equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``a[i:i + size]`` is ``b[j:j + size]``."""
        return (self.a[i + size] - self.a[i]) * self.power[j] == (self.b[j + size] - self.b[j]) * self.power[i]

    def common(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """Values, ``limit`` at most, that ``a`` from ``i`` and ``b`` from ``j`` on have in common; with ``back`` those before them."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            size = (low + high + 1) >> 1
            same = self.equal(i - size, j - size, size) if back else self.equal(i, j, size)
            low, high = np.where(same, size, low), np.where(same, high, size - 1)
        return low
