"""Exact substring dedup by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``DEPTH`` = 50 bytes, most significant digit first, and
each pass goes on only with groups that more than one document is in; what is equal after the last
pass is exactly the repeated windows.  The digits of a window are taken from its anchor outwards:

* An anchor of a window is its place with the least hash of 20 bytes.  Equal windows have equal
  anchors, so sorting the suffixes at anchors (one place in 16) sorts all windows.
* Pass 1, digit: the 20 bytes at the anchor.  Groups within one document end here.
* Pass 2, digit: all bytes that windows over the anchor reach (30 before to 50 after).  A member whose
  digit also occurs in a smaller document has all of these bytes removed and goes no further.
* Pass 3, digits: each of the 31 windows over the anchor, for members that are left, also where other
  anchors have removed all of their bytes: they may still be the first to hold a window.

Each map task first sorts its own texts: members that are settled by a smaller document of the same
task send nothing, so an anchor that is everywhere sends one record per task.  An anchor with many
different surroundings in one task (more than ``HEAVY``) is not gathered by anchor at all: in pass 3 its
windows are dealt one by one.  Digits are compared as 96 to 128 bits of hashes.

Neither ``HEAVY`` nor the tag of rows (a hash of the text where some id is repeated, else 0) changes any
result: both ways of a pass are exact.

Texts are UTF-8 bytes of any length; null and empty texts have none.  Matches never cross documents, and a
document with the same id never removes anything from its namesake, whatever its text (equal rows fare alike).
Rows with a null id have no smaller id and are none: they lose nothing and remove nothing.  Of documents that
share a string the one with the least id keeps it.  An empty table gives an empty result.  Added columns
replace their namesakes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A
from curalis.llm import _buckets as B
from curalis.llm._store import materialise

DEPTH, GRAM = 50, 20
WIDTH = DEPTH - GRAM + 1
BEFORE = WIDTH - 1
SPAN = BEFORE + DEPTH
HEAVY = 8
#: Text hashed at a time: smaller pieces leave many small arrays between the temporary ones.
CHUNK = 1 << 20
ALL, SOME, MANY = 1, 2, 3  # answers to an anchor: all its bytes go; compare by anchor; compare by window
WHERE = [("doc", "<i8"), ("tag", "<i8"), ("pos", "<i4")]
ANCHOR = np.dtype([("key", "<u8"), ("ctx", "<u8"), *WHERE])
ANSWER = np.dtype([*WHERE, ("what", "u1")])
PIECE = np.dtype([("key", "<u8"), *WHERE, ("left", "u1"), ("right", "u1"), ("bytes", "u1", (SPAN,))])
WINDOW = np.dtype([("key", "<u8"), ("more", "<u8"), *WHERE])
RUN = np.dtype([*WHERE, ("end", "<i4")])


def _doc_key(records: np.ndarray) -> np.ndarray:
    return A.mix(records["doc"].astype(np.uint64))


def _answers(records: np.ndarray, what: int) -> np.ndarray:
    out = np.zeros(len(records), ANSWER)
    for n in ("doc", "tag", "pos"):
        out[n] = records[n]
    out["what"] = what
    return out


def anchors(data, offsets):
    """Place, document, 20-byte hash and hash of all bytes in reach for each anchor of a chunk."""
    prefix = A.prefix_hash(data)
    n = len(data) - GRAM + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    place = np.arange(n)
    grams = A.range_hash(prefix, place, place + GRAM) | A.U64(1)
    end = np.repeat(offsets[1:], np.diff(offsets))[:n]
    at = B.window_minima(grams, WIDTH, end - GRAM + 1)
    doc = np.searchsorted(offsets, at, "right") - 1
    lo, hi = np.maximum(offsets[doc], at - BEFORE), np.minimum(offsets[doc + 1], at + DEPTH)
    ctx = A.mix(A.range_hash(prefix, lo, hi) + ((at - lo) * 64 + (hi - at)).astype(np.uint64))
    return at, doc, grams[at], ctx


def settle(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of anchors: the rest sorted by key, ctx and doc, the members settled by a smaller document with the
    same key and ctx, and for the rest the number of different ctx of its key."""
    x = x[np.lexsort((x["doc"], x["ctx"], x["key"]))]
    if not len(x):
        return x, x, np.zeros(0, np.int64)
    new_key = np.r_[True, x["key"][1:] != x["key"][:-1]]
    head = np.flatnonzero(new_key | np.r_[True, x["ctx"][1:] != x["ctx"][:-1]])
    lead = np.repeat(head, np.diff(np.r_[head, len(x)]))
    own = x["doc"] == x["doc"][lead]
    keys = np.flatnonzero(new_key[head])
    kinds = np.diff(np.r_[keys, len(head)])
    per_key = np.repeat(kinds, np.diff(np.r_[np.flatnonzero(new_key), len(x)]))
    return x[own], x[~own], per_key[own]


def _pass_1(table: pa.Table, buckets: int):
    ids, tags = (np.asarray(table.column(i).to_numpy(), np.int64) for i in (0, 1))
    parts, at = [], 0
    for piece in table.column(2).chunks:
        data, offsets, _ = A.utf8(piece)
        for lo, hi in A.chunks(offsets, CHUNK):
            off = offsets[lo : hi + 1] - offsets[lo]
            place, doc, key, ctx = anchors(data[offsets[lo] : offsets[hi]], off)
            x = np.zeros(len(place), ANCHOR)
            x["key"], x["ctx"] = key >> A.U64(16), ctx >> A.U64(16)
            x["doc"], x["tag"], x["pos"] = ids[at + lo + doc], tags[at + lo + doc], place - off[doc]
            parts.append(x)
        at += len(piece)
    rest, settled, kinds = settle(np.concatenate(parts) if parts else np.zeros(0, ANCHOR))
    many = kinds > HEAVY
    send = rest[~many]
    send = send[np.lexsort((send["pos"], send["doc"]))]  # neighbours share bytes, which compress
    yield from B.deal(send, _spread(send["key"]), buckets, 0)
    keys = np.unique(rest["key"][many])
    yield from B.deal(keys, _spread(keys), buckets, 1)
    told = np.concatenate([_answers(settled, ALL), _answers(rest[many], MANY)])
    yield from B.deal(told, _doc_key(told), buckets, 2)


def _spread(key: np.ndarray) -> np.ndarray:
    return A.mix(key)


def _pass_2(bucket, blobs, buckets: int):
    rest, settled, kinds = settle(B.unpack(blobs.get(0, []), ANCHOR))
    heavy = np.unique(B.unpack(blobs.get(1, []), np.dtype("<u8")))
    many = np.isin(rest["key"], heavy)
    told = [_answers(settled, ALL), _answers(rest[many], MANY), _answers(rest[~many & (kinds > 1)], SOME)]
    told = np.concatenate(told)
    yield from B.deal(told, _doc_key(told), buckets, 2)
    yield from ((bucket, 2, x) for x in blobs.get(2, []))


#: ``known`` is always true, but a column: of a literal Spark would make a filter and other keys, and deal texts twice.
PER_DOC = T.StructType([T.StructField("known", T.BooleanType()), T.StructField("oid", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("blob", T.BinaryType())])


def _per_doc(dtype: np.dtype, kind: int):
    """Records of a bucket as one row for each document."""

    def work(bucket, blobs):
        x = B.unpack(blobs.get(kind, []), dtype)
        x = x[np.lexsort((x["pos"], x["tag"], x["doc"]))]
        bounds = np.flatnonzero(np.r_[True, (x["doc"][1:] != x["doc"][:-1]) | (x["tag"][1:] != x["tag"][:-1]), True]) if len(x) else np.zeros(1, int)
        if len(bounds) > 1:
            head = x[bounds[:-1]]
            cut = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(head), bool)), pa.array(head["doc"].astype(np.int64)), pa.array(head["tag"].astype(np.int64)), pa.array(cut, pa.binary())], names=PER_DOC.names)

    return work


def _removed(answers: np.ndarray, n: int) -> np.ndarray:
    """Which bytes of a text of n are settled by pass 2."""
    marks = np.zeros(n + 1, np.int32)
    at = answers["pos"][answers["what"] == ALL]
    np.add.at(marks, np.maximum(at - BEFORE, 0), 1)
    np.add.at(marks, np.minimum(at + DEPTH, n), -1)
    return np.cumsum(marks[:-1]) > 0


def _pass_3(table: pa.Table, buckets: int):
    pieces, windows = [], []
    for oid, tag, blob, text in zip(*(table.column(i).to_pylist() for i in range(3)), table.column(table.num_columns - 1), strict=True):
        answers = np.frombuffer(blob, ANSWER)
        open_ = answers[answers["what"] != ALL]
        if not len(open_):
            continue
        raw = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
        n = len(raw)
        pos = open_["pos"].astype(np.int64)
        lo, hi = np.maximum(pos - BEFORE, 0), np.minimum(pos + DEPTH, n)
        # Bytes that pass 2 removed are sent as well: strings are judged on the input, and a window that two
        # smaller documents cover together may be in neither, so that this document is its first holder.
        some = open_["what"] == SOME
        if some.any():
            p = np.zeros(int(some.sum()), PIECE)
            padded = np.r_[np.zeros(BEFORE, np.uint8), raw, np.zeros(DEPTH, np.uint8)]
            p["bytes"] = padded[pos[some][:, None] + np.arange(SPAN)]
            p["doc"], p["tag"], p["pos"] = oid, tag, pos[some]
            p["left"], p["right"] = (pos - lo)[some], (hi - pos)[some]
            pieces.append(p)
        many = open_["what"] == MANY
        if many.any():
            starts = np.zeros(n + 1, np.int32)
            np.add.at(starts, lo[many], 1)
            np.add.at(starts, np.maximum(np.minimum(pos[many], n - DEPTH) + 1, lo[many]), -1)
            s = np.flatnonzero(np.cumsum(starts)[:n] > 0)
            s = s[(s + DEPTH <= n)]
            prefix = A.prefix_hash(raw)
            w = np.zeros(len(s), WINDOW)
            w["key"], w["more"] = A.range_hash(prefix, s, s + DEPTH), A.mix(A.range_hash(prefix, s, s + DEPTH // 2) + A.U64(7))
            w["doc"], w["tag"], w["pos"] = oid, tag, s
            windows.append(w)
    p = np.concatenate(pieces) if pieces else np.zeros(0, PIECE)
    if len(p):
        gram = p["bytes"][:, BEFORE : BEFORE + GRAM]
        flat = np.ascontiguousarray(gram).reshape(-1)
        at = np.arange(len(p)) * GRAM
        p["key"] = A.range_hash(A.prefix_hash(flat), at, at + GRAM)
        yield from B.deal(p, _spread(p["key"]), buckets, 0)
    w = np.concatenate(windows) if windows else np.zeros(0, WINDOW)
    own, gone = first_of(w, ("key", "more"))
    yield from B.deal(own, own["key"], buckets, 1)
    runs = _runs(gone["doc"], gone["tag"], gone["pos"].astype(np.int64))
    yield from B.deal(runs, _doc_key(runs), buckets, 2)


def first_of(x: np.ndarray, names) -> tuple[np.ndarray, np.ndarray]:
    """Records of the smallest document of each group of equal keys, and the others."""
    if not len(x):
        return x, x
    x = x[np.lexsort((x["doc"], *(x[n] for n in reversed(names))))]
    new = np.zeros(len(x), bool)
    new[0] = True
    for n in names:
        new[1:] |= x[n][1:] != x[n][:-1]
    head = np.flatnonzero(new)
    own = x["doc"] == x["doc"][np.repeat(head, np.diff(np.r_[head, len(x)]))]
    return x[own], x[~own]


def _runs(doc, tag, start) -> np.ndarray:
    """Windows that start at consecutive places, as runs of bytes."""
    if not len(doc):
        return np.zeros(0, RUN)
    order = np.lexsort((start, tag, doc))
    doc, tag, start = doc[order], tag[order], start[order]
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + DEPTH)])
    out = np.zeros(len(head), RUN)
    out["doc"], out["tag"], out["pos"] = doc[head], tag[head], start[head]
    out["end"] = start[np.r_[head[1:], len(start)] - 1] + DEPTH
    return out


def _last_pass(bucket, blobs, buckets: int):
    p = B.unpack(blobs.get(0, []), PIECE)
    found = []
    for part in _by_key(p):
        # Hashes of the 31 windows of each member, at one place of its bytes after the other.
        m = len(part)
        flat = part["bytes"].reshape(-1)
        prefix = A.prefix_hash(np.ascontiguousarray(flat))
        at = (np.arange(m) * SPAN)[:, None] + np.arange(WIDTH)
        hashes = A.range_hash(prefix, at.ravel(), at.ravel() + DEPTH)
        j = np.arange(WIDTH)
        fits = (j >= BEFORE - part["left"].astype(int)[:, None]) & (j + DEPTH <= BEFORE + part["right"].astype(int)[:, None])
        row, col = np.nonzero(fits)
        w = np.zeros(len(row), WINDOW)
        w["key"], w["more"] = part["key"][row], hashes.reshape(m, WIDTH)[row, col]
        w["doc"], w["tag"], w["pos"] = part["doc"][row], part["tag"][row], part["pos"][row] - BEFORE + col
        found.append(first_of(w, ("key", "more"))[1])
    found.append(first_of(B.unpack(blobs.get(1, []), WINDOW), ("key", "more"))[1])
    gone = np.concatenate(found)
    runs = _runs(gone["doc"], gone["tag"], gone["pos"].astype(np.int64))
    yield from B.deal(runs, _doc_key(runs), buckets, 2)
    yield from ((bucket, 2, x) for x in blobs.get(2, []))


def _by_key(p: np.ndarray, size: int = 8_000):
    """Parts of about ``size`` records that hold all of their keys."""
    p = p[np.argsort(p["key"], kind="stable")]
    lo = 0
    while lo < len(p):
        hi = min(lo + size, len(p))
        hi = int(np.searchsorted(p["key"], p["key"][hi - 1], "right"))
        yield p[lo:hi]
        lo = hi


def repeated_spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``removed_spans``, the maximal byte ranges covered by
    50-byte strings that also start in a document with a smaller id, and ``n_bytes, n_removed,
    kept_sha256`` of the rest."""
    added = ["removed_spans", "n_bytes", "n_removed", "kept_sha256"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    buckets = B.n_buckets(docs)
    text_of = F.coalesce(F.col(text), F.lit(""))
    tag, by_tag = B.row_tag(docs, id_col, text)
    # Rows with a null id are only carried along, spread by their text.
    own = docs.select(
        *(F.col(f"`{c}`").alias(f"k_{c}") for c in keep),
        F.col(id_col).isNotNull().alias("known"),
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_of)).alias("oid"),
        tag.alias("tag"),
        text_of.alias("text"),
    )
    at = ["known", "oid", *by_tag]
    first = B.gather(own.where("known").select("oid", "tag", "text"), lambda table: _pass_1(table, buckets))
    second = B.reduce(first, lambda b, x: _pass_2(b, x, buckets), B.SCHEMA)
    answers = materialise(B.reduce(second, _per_doc(ANSWER, 2), PER_DOC), "answers")
    answers = answers.select(*at, F.col("blob").alias("answers"))
    # The texts are dealt by id twice, in the same form, so that Spark sends them once.
    open_ = own.join(answers, at).select("oid", "tag", "answers", *(f"k_{c}" for c in keep), "text")
    third = B.gather(open_, lambda table: _pass_3(table, buckets))
    runs = B.reduce(B.reduce(third, lambda b, x: _last_pass(b, x, buckets), B.SCHEMA), _per_doc(RUN, 2), PER_DOC).withColumnRenamed("blob", "runs")
    both = answers.join(runs.select(*at, "runs"), at, "left")
    joined = own.join(both, at, "left").select(*(f"k_{c}" for c in keep), "answers", "runs", "text")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [*(T.StructField(c, docs.schema[c].dataType) for c in keep), T.StructField("removed_spans", T.ArrayType(span)), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )
    k = len(keep)

    def finish(batches):
        for batch in batches:
            rows = []
            for answers_, runs_, text_ in zip(batch.column(k), batch.column(k + 1), batch.column(k + 2), strict=True):
                raw = text_.as_py().encode("utf-8", "surrogatepass")
                if not answers_.is_valid:
                    rows.append(([], len(raw), 0, hashlib.sha256(raw).hexdigest()))
                    continue
                gone = _removed(np.frombuffer(answers_.as_py(), ANSWER), len(raw))
                if runs_.is_valid:
                    for r in np.frombuffer(runs_.as_py(), RUN):
                        gone[r["pos"] : r["end"]] = True
                a, b = A.spans_of(gone, np.zeros(0, np.int64))
                rest = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append(([{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)], len(raw), len(raw) - len(rest), hashlib.sha256(rest).hexdigest()))
            spans, sizes, removed, digests = zip(*rows, strict=True) if rows else ((),) * 4
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            made = [pa.array(spans, kind), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k)), *made], names=schema.names)

    return joined.mapInArrow(finish, schema)


def op4(spark, sf_dir):
    found = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed_spans").cast("long").alias("n_spans"), "kept_sha256")


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100)),
dup AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS m FROM w) WHERE m < doc_id),
marked AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM dup),
grouped AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM marked),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM grouped GROUP BY doc_id, g),
pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM runs),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, CAST(2 * prev + 1 AS BIGINT), CAST(2 * (a - prev) AS BIGINT)), '' ORDER BY a) AS head
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
