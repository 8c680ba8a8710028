"""Arrow plumbing and byte-level kernels shared by the text operators.

Texts reach Python as Arrow batches.  A batch is cut into chunks of about ``CHUNK`` bytes of
text (a longer document is a chunk of its own), so that the temporary arrays stay small.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHUNK = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]

#: Byte tables: ASCII lower case, and the two kinds of word the operators use.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True


def release() -> None:
    """Give freed memory back to the system: Python workers are kept for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and validity of a string column; nulls have no bytes."""
    valid = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), valid
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0], valid


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def arrow_map(
    df: DataFrame,
    kernel: Callable[[np.ndarray, np.ndarray, np.ndarray], Sequence[pa.Array]],
    text: str,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    chunk: int = CHUNK,
) -> DataFrame:
    """``keep`` columns of every row plus the columns that ``kernel(bytes, offsets, valid)`` makes."""
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])
    target = to_arrow_schema(schema)
    n_keep = len(keep)

    def run(batches):
        for batch in batches:
            data, offsets, valid = utf8(batch.column(n_keep))
            for lo, hi in chunks(offsets, chunk):
                made = kernel(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], valid[lo:hi])
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(n_keep)]
                made = [a.cast(target.field(n_keep + i).type) for i, a in enumerate(made)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=target.names)
            batch = data = offsets = None
            release()

    # Plain names on the way in: mapInArrow cannot resolve names with dots.
    return df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def list_array(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column from the number of values of each row and all values in order."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def spans_of(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the true runs of ``mask``, which never cross the cuts in ``bounds``."""
    if not len(mask):
        empty = np.zeros(0, np.int64)
        return empty, empty
    before = np.empty(len(mask), bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(len(mask), bool)
    after[-1] = False
    after[:-1] = mask[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(mask))]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, U64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _powers[i] = p
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA0761D6478BD642F)
    x ^= x >> U64(32)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``range_hash`` hashes any byte range."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * p[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start])


def window_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = words[:n].copy()
    for j in range(1, size):
        out *= U64(0x9FB21C651E98DF25)
        out += words[j : j + n]
    return mix(out)
