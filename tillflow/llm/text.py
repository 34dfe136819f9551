"""Helpers of the operators: UTF-8 columns as numpy arrays, words, hashes, shared storage.

A text column arrives in Arrow batches; its bytes and offsets are viewed without
copying and worked through in slices of a few megabytes, so a task's memory is
bounded by the slice size or by its longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.runtime import scratch_path, ship_package

#: The arrays over a slice take many times its bytes, in every Python worker.
SLICE_BYTES = 1 << 19
#: Powers that a worker keeps at most.
KEPT_POWERS = 8 << 20
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, *parts: str, **options: str) -> DataFrame:
    """``df`` written once to the shared scratch folder (with the writer's ``options``) and
    read again: cuts lineage and is computed once, however often it is used."""
    path = scratch_path(df.sparkSession, "llm", *parts)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a staged table only if its counted rows fit ``limit``;
    beyond it Spark joins by shuffle, with the same result."""
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df


def text_key(text: Column) -> Column:
    """64-bit identity of a text (null and empty alike), used beside a row's own id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offs


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about ``limit`` bytes, one row at least."""
    data, offs = utf8(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which of the 256 byte values are outside the given (first, last) ranges."""
    inside = np.ones(256, bool)
    for a, b in ranges:
        inside[a : b + 1] = False
    return inside


#: Fixed values. Words ``[^\x20\x09-\x0D]+``.
SPACED = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
LETTERED = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_spans(data: np.ndarray, offs: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data`` (already lower-cased), and for each
    text the index of its first word (one more entry closes the last text)."""
    n = len(data)
    inside = word_bytes[data]
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        cuts = offs[:-1]
        cuts = cuts[cuts < n]
        before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    if n:
        after[:-1] = inside[1:] & before[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, base: int = _BASE, name: str = "up") -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, ``n`` entries at least."""
    have = _POWERS.get(name)
    if have is not None and len(have) >= n:
        return have[:n]
    full = np.full(max(n, SLICE_BYTES + 1024), base, np.uint64)
    full[0] = 1
    full = np.cumprod(full, dtype=np.uint64)
    if n <= KEPT_POWERS:  # those of a longer text are not kept
        _POWERS[name] = full
    return full[:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, pow(_BASE, -1, 1 << 64), "down")


#: One fixed random value for each byte (never 0).
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hashes`` takes the hash of any span."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal spans have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * inverse_powers(len(sums))[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_hashes(data), starts, ends)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive word hashes, one for each start (callers cut at text ends)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = words[:n].copy()
    for j in range(1, k):
        acc *= np.uint64(0x9E6C63D0876A9A99)
        acc += words[j : n + j]
    return mix(acc)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum over each ``w`` consecutive values."""
    if len(x) < w:
        return x[:0]
    cur, size = x, 1
    while size * 2 <= w:
        cur, size = np.minimum(cur[:-size], cur[size:]), size * 2
    if size < w:
        cur = np.minimum(cur[: len(x) - w + 1], cur[w - size : w - size + len(x) - w + 1])
    return cur


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start+1, ... for every (start, length), concatenated."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - first, lengths)


def list_column(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """List column with ``counts[i]`` consecutive values in row i."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), values)


def release_memory() -> None:
    """Gives what a Python worker has freed back to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
