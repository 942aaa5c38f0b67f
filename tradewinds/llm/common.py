"""Helpers shared by the training-data operators: UTF-8 buffers of Arrow batches and word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: The six ASCII characters that separate words: space and tab to carriage return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Slots of the presence filter that tells rows which surely have no partner.
FILTER_SLOTS = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def give_back() -> None:
    """Return free memory of this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """The same work on batches by a worker that starts and ends without what it freed: workers live on from stage to stage."""

    def kept(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return kept


def bounded_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """From now on batches that go to Python hold about ``limit`` bytes, besides their number of rows: texts differ in length.

    What is computed per batch, and the buffers on both sides, stay in proportion.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def codes(seed: int, n: int = 256) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 20) + np.uint64(1))
                   * np.uint64(0x9E3779B97F4A7C15))


_BYTE = codes(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def powers(n: int) -> np.ndarray:
    """The first n powers of the odd hash base, modulo 2^64."""
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def pieces(column: pa.ChunkedArray | pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a text column of about ``limit`` bytes each (a longer text stands alone), with the first row's index.

    Nulls become empty texts. Slices bound the memory of what is computed per byte.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column, "")
    ends = np.cumsum(np.asarray(pc.binary_length(column), dtype=np.int64))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, column.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the offsets where each begins (one more than there are texts)."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of lower-cased texts: (lower-cased bytes, start, end, number of the text)."""
    low = _LOWER[data]
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[offsets[:-1]] |= inside[offsets[:-1]]  # a text's first byte starts a word although the text before ended in one
    start = np.flatnonzero(first[:-1])
    last = inside[:-1].copy()
    last &= ~inside[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    return low, start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    length = end - start
    ends = np.cumsum(length)
    place = np.arange(ends[-1]) - np.repeat(ends - length, length)
    value = _BYTE[low[place + np.repeat(start, length)]] * powers(int(length.max()))[place]
    return mix(np.add.reduceat(value, ends - length) + length.astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, text: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of k words within a text; a text of fewer words (but some) has its whole run as the only one.

    Returns (hash, number of the text), runs in order and with repeats.
    """
    count = np.bincount(text, minlength=n_texts)
    n = len(hashes)
    base = codes(2, k)
    if n >= k:
        run = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            run = mix(run + hashes[i:n - k + 1 + i] * (base[i] | np.uint64(1)))
        whole = text[:n - k + 1] == text[k - 1:]
        run, owner = run[whole], text[:n - k + 1][whole]
    else:
        run, owner = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        begin = np.cumsum(count) - count
        value = np.zeros(len(short), dtype=np.uint64)
        for i in range(k - 1):
            more = count[short] > i
            value[more] = mix(value[more] + hashes[begin[short[more]] + i] * (base[i] | np.uint64(1)))
        value = mix(value + count[short].astype(np.uint64))
        run, owner = np.concatenate([run, value]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        run, owner = run[order], owner[order]
    return run, owner


def crc_mod(column: str, n: int) -> str:
    """SQL: crc32 of a value written as text, modulo n. A null id counts as remainder 0 of the empty text."""
    return f"(crc32(cast(coalesce(cast({column} as string), '') as binary)) % {n})"


def bounded_sample(rows: DataFrame, group: str, n: int, id_col: str) -> DataFrame:
    """Up to n rows of every value of ``group``, those with the least hash of their id.

    Every task passes on n rows of a group at most, so a group that holds a
    third of all rows meets no single task.
    """
    by = Window.partitionBy(group).orderBy(F.xxhash64(id_col), F.col(id_col))
    return rows.withColumn("__nth", F.row_number().over(by)).where(F.col("__nth") <= n).drop("__nth")


def slot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(FILTER_SLOTS)).cast("int")


def presence(ids: DataFrame, column: str = "id") -> np.ndarray:
    """Which slots the ids of a table fall into. At most FILTER_SLOTS numbers come to the driver, however many ids there are."""
    out = np.zeros(FILTER_SLOTS, dtype=bool)
    out[np.asarray(ids.select(slot(column).alias("slot")).distinct().toArrow()["slot"])] = True
    return out
