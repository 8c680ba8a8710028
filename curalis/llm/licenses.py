"""License scans: MinHash bands over overlapping text windows, verified by exact shingle containment.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; shingles are 5 words.  A
template's window is two blocks of P shingles, P the least power of two that holds the template, and windows
overlap by one block, so that every occurrence lies within one.  Each window has ``BANDS`` bands of one MinHash
each; a template is retrieved if a band agrees.  Minima of blocks are made of those of the halves, so all
lengths of template share one pass over the text.

Guarantee: if a window holds the share c of a template's T > P / 2 shingles, the Jaccard similarity of template
and window is at least j = c T / (T + 2 P - c T) > c / (5 - c); all bands miss with probability
(1 - j) ** BANDS.  At c = 0.8 and 64 bands, that is below 1.4e-6.

A retrieved template is verified at every offset: the shingles of the template's length must contain at
least ``CONTAINMENT`` = 0.8 of the template's.  Of matches of which one covers half of the other, the one that has
more shingles in common stays (then the one with the larger containment, then the first name): so sibling
licenses that share most of their text are told apart by the rest.

Null texts and texts without words match nothing.  Templates of fewer than 5 words are one shingle of all
their words.  Texts of any length are scanned whole.  Repeated rows match alike.  An empty table or library
gives no match.  Added columns replace their namesakes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A
from curalis.llm.license_texts import TEMPLATES

SHINGLE, BANDS, CONTAINMENT = 5, 64, 0.8

_rng = np.random.default_rng(11)
SEEDS = _rng.integers(1, 1 << 63, BANDS).astype(np.uint64) | np.uint64(1)
FIELD = T.StructField(
    "licenses",
    T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType())])),
)


def read_templates(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Templates from a folder of text files named after their licenses (``<license>.txt`` or ``<license>``)."""
    rows = spark.read.text(folder, wholetext=True).select(F.input_file_name().alias("f"), "value").collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows):
        out.setdefault(r["f"].rpartition("/")[2].removesuffix(".txt"), []).append(r["value"])
    return out


def _words(data, offsets):
    low = A.LOWER[data]
    starts, ends = A.spans_of(A.ALNUM[low], offsets)
    return A.range_hash(A.prefix_hash(low), starts, ends), np.searchsorted(starts, offsets)


class Library:
    """Templates as sorted distinct shingle hashes, grouped by the words of a shingle and the blocks of a window."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names, self.sizes, self.sets = [], [], []
        members: dict[tuple[int, int], list[int]] = {}
        for name, texts in sorted(templates.items()):
            for text in texts:
                raw = text.encode("utf-8")
                words, _ = _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                if not len(words):
                    continue
                k = min(SHINGLE, len(words))
                tokens = A.window_hash(words, k)
                self.names.append(name)
                self.sizes.append(len(tokens))
                self.sets.append(np.unique(tokens))
                members.setdefault((k, (len(tokens) - 1).bit_length()), []).append(len(self.names) - 1)
        #: By shingle words: level (blocks of 2**level shingles), templates and their minima per band.
        self.groups: dict[int, dict[int, tuple[list[int], np.ndarray]]] = {}
        for (k, level), own in sorted(members.items()):
            keys = np.array([[(self.sets[m] * s >> A.U64(1)).min() for s in SEEDS] for m in own], np.uint64)
            self.groups.setdefault(k, {})[level] = (own, keys)


def _retrieve(groups: dict, tokens: np.ndarray, counts: np.ndarray) -> set[tuple[int, int, int]]:
    """``(level, window, template)`` where some band agrees; windows are numbered by their first block."""
    steps, last = [], []
    blocks = counts
    for level in range(max(groups) + 1):
        if level:
            halves, blocks = blocks, (blocks + 1) // 2
            first = np.repeat(np.cumsum(halves) - halves, blocks)
            steps.append(first + 2 * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)))
        ends = np.zeros(blocks.sum(), bool)
        ends[np.cumsum(blocks)[blocks > 0] - 1] = True
        last.append(ends)
    found = set()
    for b, seed in enumerate(SEEDS):
        low = tokens * seed >> A.U64(1)
        for level in range(max(groups) + 1):
            if level:
                low = np.minimum.reduceat(low, steps[level - 1])
            if level in groups:
                both = low.copy()
                both[:-1] = np.where(last[level][:-1], low[:-1], np.minimum(low[:-1], low[1:]))
                own, keys = groups[level]
                order = np.argsort(keys[:, b])
                known = keys[order, b]
                at = np.flatnonzero(known[np.minimum(np.searchsorted(known, both), len(known) - 1)] == both)
                for w in at.tolist():
                    found.update((level, w, own[order[i]]) for i in range(np.searchsorted(known, both[w]), np.searchsorted(known, both[w], "right")))
    return found


def contained(own: np.ndarray, part: np.ndarray, size: int) -> tuple[int, int]:
    """The most distinct shingles of ``own`` in ``size`` consecutive ones of ``part``, and the first place of these."""
    place = np.minimum(np.searchsorted(own, part), len(own) - 1)
    at = np.flatnonzero(own[place] == part)
    if not len(at):
        return 0, 0
    kind = place[at]
    order = np.lexsort((at, kind))
    before = np.full(len(at), -1)
    same = np.r_[False, kind[order][1:] == kind[order][:-1]]
    before[order[same]] = at[order[np.flatnonzero(same) - 1]]
    # A shingle counts for the runs that hold it but not its previous occurrence.
    n = max(1, len(part) - size + 1)
    change = np.zeros(n + 1, np.int64)
    lo, hi = np.maximum(before + 1, at - size + 1), np.minimum(at + 1, n)
    lo = np.maximum(lo, 0)
    real = lo < hi
    np.add.at(change, lo[real], 1)
    np.add.at(change, hi[real], -1)
    count = np.cumsum(change[:-1])
    s = int(np.argmax(count))
    return int(count[s]), s


def _best(matches: list[tuple]) -> list[tuple]:
    """``(name, start, end, containment, shared)`` without those that a better one covers by half."""
    kept: list[tuple] = []
    for m in sorted(set(matches), key=lambda v: (-v[4], -v[3], v[0], v[1])):
        if all(2 * (min(m[2], x[2]) - max(m[1], x[1])) < min(m[2] - m[1], x[2] - x[1]) for x in kept):
            kept.append(m)
    return sorted((m[:4] for m in kept), key=lambda v: (v[1], v[0]))


def scan(library: Library, data, offsets) -> list[list[tuple]]:
    words, first = _words(data, offsets)
    n_docs = len(offsets) - 1
    out: list[list] = [[] for _ in range(n_docs)]
    for k, groups in library.groups.items():
        tokens = A.window_hash(words, k)
        end = np.repeat(first[1:], np.diff(first))[: len(tokens)]
        tokens = tokens[np.arange(k, k + len(tokens)) <= end]
        counts = np.maximum(np.diff(first) - k + 1, 0)
        if not len(tokens):
            continue
        bounds = np.r_[0, np.cumsum(counts)]
        for level, w, m in sorted(_retrieve(groups, tokens, counts)):
            blocks = -(-counts // (1 << level))
            ahead = np.cumsum(blocks)
            doc = int(np.searchsorted(ahead, w, "right"))
            lo = int(bounds[doc] + ((w - (ahead[doc] - blocks[doc])) << level))
            hi = int(min(lo + (2 << level), bounds[doc + 1]))
            own, size = library.sets[m], library.sizes[m]
            shared, s = contained(own, tokens[lo:hi], size)
            if shared >= CONTAINMENT * len(own) - 1e-9:
                s += lo - int(bounds[doc])
                out[doc].append((library.names[m], s, min(s + size, int(counts[doc])) + k - 1, shared / len(own), shared))
    return [_best(x) if x else x for x in out]


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``licenses``: name, word range and containment of each match."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "licenses"]
    library = docs.sparkSession.sparkContext.broadcast(Library(TEMPLATES if templates is None else templates))
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

    def kernel(data, offsets, valid):
        found = scan(library.value, data, offsets)
        return [pa.array([[dict(zip(("license", "start", "end", "containment"), x, strict=True)) for x in doc] for doc in found], kind)]

    return A.arrow_map(docs, kernel, text, keep, [FIELD])


def op6(spark, sf_dir):
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"]))), ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_matches"),
    )
