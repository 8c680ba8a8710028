"""Toxicity: a character n-gram linear classifier on features scaled by naive Bayes log-count ratios.

Features are the presence of byte n-grams of the lower-cased text (other than letters and digits:
a space) whose shares of documents in the two classes differ significantly (``SIGNIFICANCE`` standard errors, in
``LEAST`` documents or more; there is no limit to their number).  Each is scaled by the log ratio of its smoothed document counts in the two classes, and
a logistic regression is fitted on the scaled features (NB-LR, Wang and Manning 2012).

Training uses at most ``MAX_POSITIVE`` and ``MAX_NEGATIVE`` labelled rows of at most
``MAX_TRAIN_BYTES`` each, chosen by a hash of the id (ties: the least id) and weighted back to the true shares;
scoring reads whole texts, however long.  Null and empty texts get the score of no feature.  Null labels and ids
are not learned from; of rows with one id each text is learned with the id's labels.  Without a row of each
class nothing can be learned: every score is then 1 if all labels are positive, else 0.  Repeated rows score
alike.  An empty table gives an empty result.  Added columns replace their namesakes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A

SIZES = (3, 4, 5, 6)
BITS = 21
MASK = (1 << BITS) - 1
MAX_POSITIVE, MAX_NEGATIVE, MAX_TRAIN_BYTES = 2_500, 2_500, 20_000
#: Least difference of an n-gram's shares of documents in the two classes, in standard errors, and least number
#: of documents with it, to be a feature.
SIGNIFICANCE, LEAST = 5.0, 3
#: The byte classes n-grams are made of.
FOLD = np.where(A.ALNUM, A.LOWER, 32).astype(np.uint8)


def grams(data, offsets):
    """For each n-gram size, the bucket at each byte and whether it lies within a document."""
    low = FOLD[data].astype(np.uint64)
    end = np.repeat(offsets[1:], np.diff(offsets))
    for size in SIZES:
        n = len(low) - size + 1
        if n <= 0:
            continue
        h = low[:n].copy()
        for j in range(1, size):
            h *= A.U64(0x100000001B3)
            h += low[j : j + n]
        h += A.U64(size)
        h *= A.U64(0x9E3779B97F4A7C15)
        yield (h >> A.U64(64 - BITS)).astype(np.int64), np.arange(size, size + n) <= end[:n]


def _presence(data, offsets, wanted=None):
    """Sorted distinct (document, bucket) of a chunk, as document << BITS | bucket."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keys = []
    for bucket, inside in grams(data, offsets):
        at = np.flatnonzero(inside if wanted is None else inside & wanted[bucket])
        keys.append(doc[at] << BITS | bucket[at])
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray, steps: int = 200, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weight of each bucket, and the intercept."""
    table = np.zeros(1 << BITS, np.float32)
    if not len(y) or y.min() == y.max():
        return table, -np.inf if not len(y) or y.max() == 0 else np.inf
    blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(blobs) + 1, np.int64)
    np.cumsum([len(b) for b in blobs], out=offsets[1:])
    data = np.frombuffer(b"".join(blobs), np.uint8)
    parts = [(lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in A.chunks(offsets)]
    p, q = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for lo, piece, off in parts:
        keys = _presence(piece, off)
        positive = y.astype(bool)[lo + (keys >> BITS)]
        for counts_, which in ((p, positive), (q, ~positive)):
            counts_ += np.bincount(keys[which] & MASK, minlength=1 << BITS)
    n_p, n_q = y.sum(), (1 - y).sum()
    share = (p + q) / (n_p + n_q)
    z = np.abs(p / n_p - q / n_q) / np.sqrt(np.maximum(share * (1 - share), 1e-4) * (1 / n_p + 1 / n_q))
    chosen = np.flatnonzero((z >= SIGNIFICANCE) & (p + q >= LEAST))
    ratio = np.log((p[chosen] + 1) / (p[chosen].sum() + len(chosen))) - np.log((q[chosen] + 1) / (q[chosen].sum() + len(chosen)))
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen] = True
    found = [_presence(piece, off, wanted) + (lo << BITS) for lo, piece, off in parts]
    keys = np.concatenate(found)
    row, column = keys >> BITS, np.searchsorted(chosen, keys & MASK)
    value = ratio[column]
    w, b = np.zeros(len(chosen)), float(np.log(max((weight * y).sum(), 1e-9) / max((weight * (1 - y)).sum(), 1e-9)))
    m, v, total = np.zeros(len(w) + 1), np.zeros(len(w) + 1), weight.sum()
    for step in range(1, steps + 1):
        s = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column] * value, minlength=len(y)) + b, -30, 30)))
        error = weight * (s - y) / total
        g = np.append(np.bincount(column, error[row] * value, minlength=len(w)) + decay * w / len(w) ** 0.5, error.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        b -= float(move[-1])
    table[chosen] = (w * ratio).astype(np.float32)
    return table, b


def train(docs: DataFrame, labels: DataFrame, usable=None, text: str = "text", id_col: str = "doc_id", label: str = "toxic") -> tuple[np.ndarray, float]:
    """``usable``: a condition on the id column; only such rows' labels are learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(usable(F.col(id_col))) if usable is not None else known
    known = known.select(F.col(id_col).alias("__id"), (F.col(label).cast("int") > 0).cast("int").alias("__y"))
    counts = dict(known.groupBy("__y").count().collect())
    picked = None
    for y, most in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE)):
        part = known.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    # At most MAX_POSITIVE + MAX_NEGATIVE pairs of numbers are broadcast, and as many bounded texts collected.
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__t")).where(F.octet_length("__t") <= MAX_TRAIN_BYTES)
    rows = texts.join(F.broadcast(picked), "__id").orderBy("__id", "__y").limit(2 * (MAX_POSITIVE + MAX_NEGATIVE)).collect()
    y = np.array([r["__y"] for r in rows], float)
    weight = np.array([counts[int(v)] / max(1, (y == v).sum()) for v in y])
    return fit([r["__t"] for r in rows], y, weight)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``score`` and ``predicted``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(data, offsets, valid):
        table, intercept = shared.value
        keys = _presence(data, offsets, table != 0)
        raw = np.bincount(keys >> BITS, table[keys & MASK], minlength=len(offsets) - 1) + intercept
        s = 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
        return [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]

    return A.arrow_map(docs, kernel, text, keep, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with their own columns, whatever their names.  Null and empty
    texts have the score of a text without features; repeated rows are judged alike."""
    own = docs.select(*(F.col(f"`{c}`").alias(f"k_{c}") for c in docs.columns))
    kept = score(own, model, f"k_{text}").where(F.col("score") < threshold)
    return kept.select(*(F.col(f"`k_{c}`").alias(c) for c in docs.columns))


def held_out(id_col, parts: int = 5):
    return F.crc32(id_col.cast("string")) % parts == 0


def op5(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda c: ~held_out(c))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
