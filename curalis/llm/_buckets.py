"""Packed records dealt to buckets by key.

Map tasks turn many small records into one blob per bucket, so Spark moves and sorts few rows.  A
bucket is the unit of memory of a reducer; there are ``PER_PARTITION`` of them per shuffle partition, and at
least one for each ``BUCKET_BYTES`` of the input's files.
Fixed fields are stored as byte planes, whose constant high bytes compress well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A
from curalis.llm._store import partitions

PER_PARTITION = 2
BUCKET_BYTES = 16 << 20
#: Text that a map task gathers before it compares what it has and emits: copies within it meet here.
FLUSH = 8 << 20
SCHEMA = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("blob", T.BinaryType())])


def pack(records: np.ndarray) -> bytes:
    """Byte planes after their length; packed records may be joined."""
    planes = records.view(np.uint8).reshape(len(records), -1).T.tobytes()
    return len(planes).to_bytes(4, "little") + planes


def unpack(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    pieces = []
    for b in blobs:
        at = 0
        while at < len(b):
            size = int.from_bytes(b[at : at + 4], "little")
            pieces.append(np.frombuffer(b, np.uint8, size, at + 4))
            at += 4 + size
    out = np.empty(sum(len(x) for x in pieces) // dtype.itemsize, dtype)
    rows, at = out.view(np.uint8).reshape(len(out), dtype.itemsize), 0
    for x in pieces:
        n = len(x) // dtype.itemsize
        rows[at : at + n] = x.reshape(-1, n).T
        at += n
    return out


def deal(records: np.ndarray, keys: np.ndarray, buckets: int, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """One ``(bucket, kind, blob)`` for each bucket that some key falls into."""
    if not len(records):
        return
    bucket = (keys >> A.U64(11)) % A.U64(buckets)
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1], True])
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(bucket[order[lo]]), kind, pack(records[order[lo:hi]])


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, k, x = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(x, pa.binary())], names=SCHEMA.names)


def gather(df: DataFrame, emit: Callable[[pa.Table], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """``emit`` over runs of rows with about ``FLUSH`` bytes (a text column is last)."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            _, offsets, _ = A.utf8(batch.column(batch.num_columns - 1))
            for lo, hi in A.chunks(offsets, FLUSH):
                if size and size + offsets[hi] - offsets[lo] > FLUSH:
                    rows = list(emit(pa.Table.from_batches(held)))
                    held, size = [], 0
                    A.release()
                    if rows:
                        yield batch_of(rows)
                held.append(batch.slice(lo, hi - lo))
                size += int(offsets[hi] - offsets[lo])
        if held:
            rows = list(emit(pa.Table.from_batches(held)))
            held = []
            A.release()
            if rows:
                yield batch_of(rows)

    return df.mapInArrow(run, SCHEMA)


def reduce(df: DataFrame, work: Callable[[int, dict[int, list[bytes]]], Iterator], schema: T.StructType) -> DataFrame:
    """``work(bucket, blobs by kind)`` over one bucket after another.  It yields batches of ``schema`` or, if
    that is SCHEMA, ``(bucket, kind, blob)``; those for one bucket leave the task together."""
    packed = schema == SCHEMA

    def groups(batches):
        now, blobs = None, {}
        for batch in batches:
            for b, k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if b != now and blobs:
                    yield now, blobs
                    blobs = {}
                now = b
                blobs.setdefault(k, []).append(x)
        if blobs:
            yield now, blobs

    def run(batches):
        held: dict[tuple[int, int], list[bytes]] = {}
        size = 0
        for bucket, blobs in groups(batches):
            for made in work(bucket, blobs):
                if not packed:
                    yield made
                    continue
                held.setdefault(made[:2], []).append(made[2])
                size += len(made[2])
            if size > FLUSH:
                yield batch_of([(*at, b"".join(x)) for at, x in held.items()])
                held, size = {}, 0
        if held:
            yield batch_of([(*at, b"".join(x)) for at, x in held.items()])
        A.release()

    n = partitions(df.sparkSession)
    return df.repartitionById(n, F.pmod("bucket", F.lit(n)).cast("int")).sortWithinPartitions("bucket").mapInArrow(run, schema)


def n_buckets(df: DataFrame) -> int:
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = size if size < 1 << 60 else 0  # unknown to Spark
    return max(PER_PARTITION * partitions(df.sparkSession), size // BUCKET_BYTES)


def row_tag(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, list[str]]:
    """What tells rows with one id apart: a 64-bit hash of the text or, where no id is repeated, 0; and the names of
    the columns (``tag`` or none) that rows are joined by besides the id.  Rows that share id and text have the
    same results, so results do not depend on which it is; only size does."""
    repeated = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").limit(1)
    if repeated.isEmpty():
        return F.lit(0).cast("long"), []
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), ["tag"]


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over each run of ``width`` values; the result is shorter."""
    out, have = values, 1
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    if have < width:
        gap = width - have
        out = best(out[: len(out) - gap], out[gap:])
    return out


def window_minima(h: np.ndarray, width: int, last: np.ndarray) -> np.ndarray:
    """Places that hold the least value of some run of ``width`` places ending by ``last`` (exclusive end
    of the own document) of the run's first place."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = sliding(h, width, np.minimum)
    low = np.where(np.arange(width, width + n) <= last[:n], low, 0)
    padded = np.zeros(n + 2 * (width - 1), h.dtype)
    padded[width - 1 : width - 1 + n] = low
    top = sliding(padded, width, np.maximum)
    return np.flatnonzero((top == h) & (h > 0))
