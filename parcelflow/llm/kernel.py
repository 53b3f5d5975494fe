"""Whole texts as byte arrays inside a task: words, hashes and rolling windows without a loop per word.

All functions work on the flat UTF-8 bytes of many texts and the offsets between them. Words are
``[^\\x20\\x09-\\x0D]+``; those bytes are ASCII, so splitting bytes is splitting characters. Hashes are the
same in every process.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BYTES_LOWER = _BYTES[_LOWER]
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, up to ``n``."""
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(CHUNK + 1, n + 1)
        both = []
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers, _inverse = both
    return _powers, _inverse


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offsets of its texts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``[i, j)`` with their bytes and offsets, about ``limit`` bytes at a time."""
    data, offsets = flat(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of the first word of each text (one more at the end)."""
    inside = ~_SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] |= inside[edges]
    end[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def prefix_sums(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running polynomial sums; ``span_hashes`` turns two of them into the hash of a span."""
    powers, _ = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    values = (_BYTES_LOWER if lower else _BYTES)[data]
    values *= powers[: len(data)]
    np.cumsum(values, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``[start, end)``."""
    _, inverse = _power_tables(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    return span_hashes(prefix_sums(data, lower), starts, ends)


def shingles(hashes: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``width`` words from each word on, and whether they stay inside one text."""
    n = len(hashes)
    out, whole = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    if n >= width:
        value = np.zeros(n - width + 1, dtype=np.uint64)
        for k in range(width):
            value *= _BASE
            value += hashes[k : n - width + 1 + k]
        out[: n - width + 1] = mix(value)
        lasts = np.repeat(firsts[1:], np.diff(firsts))
        whole = np.arange(n) + width <= lasts
    return out, whole


def text_index(firsts: np.ndarray) -> np.ndarray:
    """Number of its text for every word."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def per_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of word values for each text."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[firsts[1:]] - sums[firsts[:-1]]


def slices_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many slices, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def release_memory() -> None:
    """Give back what earlier tasks of this worker process took and no longer use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class WordTable:
    """Token ids of words, remembered across batches up to ``limit`` distinct words.

    ``encode`` takes a list of words as bytes and gives a list of id lists. The table starts over when it is
    full, so its memory doesn't grow with the data.
    """

    def __init__(self, encode, limit: int = 500_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """For each word where its ids begin in ``self.ids`` and how many they are."""
        keys, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            found = self.encode([raw[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ids = np.fromiter((x for ids in found for x in ids), dtype=np.uint32, count=int(size.sum()))
            begin = len(self.ids) + np.cumsum(size) - size
            order = np.argsort(merged := np.concatenate((self.keys, keys[new])), kind="stable")
            self.keys = merged[order]
            self.begin = np.concatenate((self.begin, begin))[order]
            self.size = np.concatenate((self.size, size))[order]
            self.ids = np.concatenate((self.ids, ids))
            at = np.searchsorted(self.keys, keys)
        return self.begin[at][place], self.size[at][place]


def map_texts(docs: DataFrame, build: Callable[[], Callable], fields: str, text: str = "text") -> DataFrame:
    """Replace the text column by ``fields`` computed from whole texts; the other columns go along untouched.

    ``build`` runs once per task and gives a function from bytes and offsets to one array per field, with one
    value per text; or to those arrays and, first, the index of the text of each value (rows may multiply).
    """
    carried = [c for c in docs.columns if c != text]
    added = StructType.fromDDL(fields)
    schema = StructType([docs.schema[c] for c in carried] + added.fields)
    types = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(0)):
                arrays = work(data, offsets)
                rows = None
                if len(arrays) > len(added.fields):
                    rows, arrays = pa.array(arrays[0] + i), arrays[1:]
                own = [batch.column(k + 1) for k in range(len(carried))]
                own = [c.slice(i, j - i) if rows is None else c.take(rows) for c in own]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(a, t) for a, t in zip(arrays, types, strict=True))], names=schema.names)

    return docs.select(F.col(text).cast("string").alias(text), *carried).mapInArrow(run, schema)
