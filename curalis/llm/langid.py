"""Language identification of code-switched text with a linear-chain conditional random field.

Words are runs of ASCII letters and non-ASCII characters, lower-cased.  Their features are prefixes and
suffixes of 1 to 3 bytes and byte trigrams, hashed into a weight table with one column per language, and
the entry of the word in a lexicon: the ``LEXICON`` most frequent words of the training texts, each with a
weight of its own (other words share one entry).  Transitions are learned too.  A chain is a line (longer
lines are cut at ``CHAIN`` words).  Forward-backward gives each word's posterior; a document's
language is the one with the largest sum, its score that sum's share.

Training takes at most ``MAX_PER_LANGUAGE`` rows of each language (the least hashes of id and text, texts
of at most ``MAX_TRAIN_BYTES``), and joins lines of different rows into chains, so that switches occur.
Prediction reads whole texts, however long; a line longer than ``CHAIN`` words is several chains.  Null texts
and texts without a letter are ``und`` with score 0, and so is everything when nothing could be learned.
Rows with a null language or id are predicted but not learned from.  Of languages with equal sums the first
in code-point order is predicted.  Repeated rows are judged alike.  An empty table gives an empty result.
Added columns replace their namesakes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A

BITS = 16
LEXICON = 20_000
CHAIN = 256
MAX_PER_LANGUAGE, MAX_TRAIN_BYTES = 400, 20_000
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h + A.U64(kind)) * A.U64(0xD6E8FEB86659FD93) >> A.U64(64 - BITS)).astype(np.int64)


def entries(lexicon: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Rows of the weight table for word hashes: behind the hashed features, one for each lexicon entry (sorted
    hashes) and one for all other words."""
    at = np.minimum(np.searchsorted(lexicon, words), max(len(lexicon) - 1, 0))
    known = lexicon[at] == words if len(lexicon) else np.zeros(len(words), bool)
    return (1 << BITS) + np.where(known, at, len(lexicon))


def features(data, offsets, lexicon):
    """Word starts and ends, table rows of each word's affixes and lexicon entry (words x 7), and of the
    trigram at each byte, and the place before each word's end up to which trigrams are its own."""
    low = A.LOWER[data]
    starts, ends = A.spans_of(LETTER[low], offsets)
    prefix = A.prefix_hash(low)
    columns = [entries(lexicon, A.range_hash(prefix, starts, ends))]
    for k in (1, 2, 3):
        columns.append(_bucket(A.range_hash(prefix, starts, np.minimum(starts + k, ends)), 1 + k))
        columns.append(_bucket(A.range_hash(prefix, np.maximum(ends - k, starts), ends), 4 + k))
    n = max(len(low) - 2, 0)
    x = low.astype(A.U64)
    tri = _bucket((x[:n] << A.U64(16)) | (x[1 : n + 1] << A.U64(8)) | x[2 : n + 2], 9)
    return low, starts, ends, np.stack(columns, 1) if len(starts) else np.zeros((0, 7), np.int64), tri, np.maximum(starts, np.minimum(ends - 2, n))


def chains(data, starts, offsets, longest: int = CHAIN):
    """First word of each chain and its length: lines of documents, cut at ``longest`` words."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.sort(np.concatenate([offsets[:-1], np.flatnonzero(data == 10)]))
    line = np.searchsorted(breaks, starts, "right")
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    length = np.diff(np.r_[first, len(starts)])
    pieces = -(-length // longest)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + piece * longest
    return first, np.diff(np.r_[first, len(starts)])


def posteriors(emission: np.ndarray, transition: np.ndarray, first: np.ndarray, length: np.ndarray, pairs: bool = False):
    """Marginals of each word by forward-backward over all chains at once; with ``pairs`` also the
    expected number of each transition."""
    n, width = emission.shape
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    e = np.exp(emission - emission.max(1, keepdims=True)) if n else emission
    t = np.exp(transition)
    alpha = np.zeros_like(e)
    live = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
    for step, m in enumerate(live):
        at = first[:m] + step
        a = e[at] if step == 0 else (alpha[at - 1] @ t) * e[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    beta = np.ones_like(e)
    expected = np.zeros_like(t)
    for step in range(len(live) - 1, 0, -1):
        at = first[: live[step]] + step
        be = beta[at] * e[at]
        b = be @ t.T
        if pairs:
            joint = alpha[at - 1][:, :, None] * t[None] * be[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        beta[at - 1] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(1, keepdims=True), 1e-300)
    return (gamma, expected) if pairs else gamma


def _emissions(table, affixes, tri, starts, stops):
    out = np.zeros((len(starts), table.shape[1]))
    for j in range(affixes.shape[1]):
        out += table[affixes[:, j]]
    # Trigrams of a word lie between starts and stops; sums over them are differences of prefix sums.
    # A word in the last two bytes has none: both of its bounds are the end.
    lo, hi = np.minimum(starts, len(tri)), np.minimum(np.maximum(stops, starts), len(tri))
    for k in range(table.shape[1]):
        sums = np.zeros(len(tri) + 1)
        np.cumsum(table[:, k][tri], out=sums[1:])
        out[:, k] += sums[hi] - sums[lo]
    return out


def fit(texts: list[str], labels: np.ndarray, width: int, epochs: int = 6, seed: int = 5):
    """Lexicon, weight table and transitions, by AdaGrad on the conditional log-likelihood."""
    rng = np.random.default_rng(seed)
    lines = [(line, y) for t, y in zip(texts, labels, strict=True) for line in t.split("\n") if line.strip()]
    order = rng.permutation(len(lines))
    # Chains of up to three lines, mostly of different rows: that is where languages switch.
    blobs = [lines[i][0].replace("\n", " ").encode("utf-8", "surrogatepass") + b" " for i in order]
    y_line = np.array([lines[i][1] for i in order], np.int64)
    lexicon = learn_lexicon(blobs)
    table, trans = np.zeros(((1 << BITS) + len(lexicon) + 1, width)), np.zeros((width, width))
    sq, sq_t = np.full_like(table, 1e-2), np.full_like(trans, 1.0)
    batch = 150
    for epoch in range(epochs):
        for lo in range(0, len(blobs), batch):
            part = blobs[lo : lo + batch]
            offsets = np.r_[0, np.cumsum([len(b) for b in part])].astype(np.int64)
            data = np.frombuffer(b"".join(part), np.uint8)
            _, starts, _, affixes, tri, stops = features(data, offsets, lexicon)
            if not len(starts):
                continue
            y = y_line[lo : lo + batch][np.searchsorted(offsets, starts, "right") - 1]
            group = (np.arange(len(part)) + epoch) // 3
            word_group = group[np.searchsorted(offsets, starts, "right") - 1]
            first = np.flatnonzero(np.r_[True, word_group[1:] != word_group[:-1]])
            length = np.diff(np.r_[first, len(starts)])
            gamma, expected = posteriors(_emissions(table, affixes, tri, starts, stops), trans, first, length, pairs=True)
            error = -gamma
            error[np.arange(len(y)), y] += 1
            seen = np.zeros_like(trans)
            inner = np.ones(len(y), bool)
            inner[first] = False
            at = np.flatnonzero(inner)
            np.add.at(seen, (y[at - 1], y[at]), 1)
            word = np.repeat(np.arange(len(starts)), np.maximum(stops - starts, 0))
            where = np.repeat(starts, np.maximum(stops - starts, 0)) + (np.arange(len(word)) - np.repeat(np.cumsum(np.maximum(stops - starts, 0)) - np.maximum(stops - starts, 0), np.maximum(stops - starts, 0)))
            bucket = np.concatenate([affixes.ravel(), tri[where]])
            owner = np.concatenate([np.repeat(np.arange(len(starts)), affixes.shape[1]), word])
            touched, place = np.unique(bucket, return_inverse=True)
            for k in range(width):
                g = np.bincount(place, error[owner, k]) - 1e-2 * table[touched, k]
                sq[touched, k] += g * g
                table[touched, k] += 0.3 * g / np.sqrt(sq[touched, k])
            g = seen - expected
            sq_t += g * g
            trans += 0.3 * g / np.sqrt(sq_t)
    return lexicon, table.astype(np.float32), trans


def learn_lexicon(blobs: list[bytes], size: int = LEXICON) -> np.ndarray:
    """Sorted hashes of the most frequent words of some lines (of equally frequent ones, the least hashes)."""
    offsets = np.r_[0, np.cumsum([len(b) for b in blobs])].astype(np.int64)
    data = np.frombuffer(b"".join(blobs), np.uint8)
    found = []
    for lo, hi in A.chunks(offsets):
        low = A.LOWER[data[offsets[lo] : offsets[hi]]]
        starts, ends = A.spans_of(LETTER[low], offsets[lo : hi + 1] - offsets[lo])
        found.append(A.range_hash(A.prefix_hash(low), starts, ends))
    words, count = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, int))
    return np.sort(words[np.lexsort((words, -count))[:size]])


def train(docs: DataFrame, usable=None, text: str = "text", lang: str = "lang", id_col: str = "doc_id"):
    """Languages (sorted), lexicon, weight table and transitions.  ``usable``: a condition on the id column."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(usable(F.col(id_col))) if usable is not None else known
    known = known.select(F.col(lang).cast("string").alias("y"), F.col(text).alias("t"), F.col(id_col).cast("string").alias("i"))
    known = known.where(F.octet_length("t") <= MAX_TRAIN_BYTES).withColumn("h", F.shiftrightunsigned(F.xxhash64("i", "t"), 1) / float(1 << 63))
    counts = dict(known.groupBy("y").count().collect())
    langs = sorted(counts)
    if not langs:
        return [], None, None, None
    # Hashes are even: a quarter more than wanted lies below the share, and only that is collected (of one
    # row repeated without end, a part of the equal copies).
    below = F.lit(0.0)
    for y in langs:
        below = F.when(F.col("y") == y, 1.25 * MAX_PER_LANGUAGE / counts[y]).otherwise(below)
    near = known.where(F.col("h") < below).limit(2 * MAX_PER_LANGUAGE * len(langs)).collect()
    near.sort(key=lambda r: (r["h"], r["i"], r["t"]))
    rows = [r for y in langs for r in [r for r in near if r["y"] == y][:MAX_PER_LANGUAGE]]
    rows.sort(key=lambda r: (r["i"], r["t"]))
    place = {y: i for i, y in enumerate(langs)}
    return [langs, *fit([r["t"] for r in rows], np.array([place[r["y"]] for r in rows], np.int64), len(langs))]


def predict(docs: DataFrame, model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``lang_pred``, ``score`` and ``word_langs``, the number of
    words labelled with each language in the order of the learned languages."""
    added = ["lang_pred", "score", "word_langs"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(data, offsets, valid):
        langs, lexicon, table, trans = shared.value
        n = len(offsets) - 1
        if not langs:
            return [pa.array(["und"] * n), pa.array(np.zeros(n)), pa.array([[]] * n, pa.list_(pa.int64()))]
        low, starts, _, affixes, tri, stops = features(data, offsets, lexicon)
        first, length = chains(data, starts, offsets)
        gamma = posteriors(_emissions(table, affixes, tri, starts, stops), trans, first, length)
        bounds = np.searchsorted(starts, offsets)
        sums = np.zeros((len(starts) + 1, len(langs)))
        np.cumsum(gamma, axis=0, out=sums[1:])
        total = sums[bounds[1:]] - sums[bounds[:-1]]
        words = np.zeros((n, len(langs)), np.int64)
        np.add.at(words, (np.searchsorted(bounds, np.arange(len(starts)), "right") - 1, gamma.argmax(1)), 1)
        best = total.argmax(1)
        with np.errstate(invalid="ignore"):
            share = np.clip(np.nan_to_num(total[np.arange(n), best] / total.sum(1)), 0, 1)
        letters = np.r_[0, np.cumsum((low >= 97) & (low <= 122))]
        pred = np.array(langs, object)[best]
        for i in np.flatnonzero(letters[offsets[1:]] == letters[offsets[:-1]]):
            if not any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")):
                pred[i], share[i] = "und", 0.0
        return [pa.array(pred, pa.string()), pa.array(share), A.list_array(np.full(n, len(langs)), pa.array(words.ravel()))]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("word_langs", T.ArrayType(T.LongType()))]
    return A.arrow_map(docs, kernel, text, keep, fields)


def held_out(id_col):
    return F.crc32(id_col.cast("string")) % 4 == 2


def op1(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, lambda c: ~held_out(c))
    return predict(docs, model, keep=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
