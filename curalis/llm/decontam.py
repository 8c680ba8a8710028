"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.  The windows
of an item are its runs of ``n`` words (an item of fewer, but not none, is one window).  Hashes
of the documents' windows are looked up in the broadcast set; each hit is verified word by word.

A benchmark of up to ``MAX_SET_BYTES`` of text is one set, a larger one several, scanned one after the other;
results are the same, as spans and items of all sets are merged.

Nulls and texts without words have no windows and no hits.  Items without words match nothing;
an item whose id is null still marks words but is not listed.  Texts of any length are scanned whole; a word
in windows of several items counts once, and all of these are listed, in the order of their ids as strings.
Repeated rows are judged alike, each on its own; repeated items are listed once.  An empty table of documents
gives an empty result, an empty benchmark no hits.  Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A
from curalis.llm._store import materialise

N = 10
#: Most bytes of benchmark text in one broadcast set; a larger benchmark is scanned in shards.
MAX_SET_BYTES = 16 << 20
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", _SPANS),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def _words(data, offsets):
    """Lower-cased bytes, word starts and ends, and the number of words before each document."""
    low = A.LOWER[data]
    starts, ends = A.spans_of(A.ALNUM[low], offsets)
    return low, starts, ends, np.searchsorted(starts, offsets)


class Grams:
    """The windows of some benchmark items by length: sorted hashes, each with its item and its first word; and
    the items' words, against which hits are verified.  About 40 bytes for each word, five times that in the making."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        self.names = [name for name, _ in items]
        blobs = [(t or "").encode("utf-8", "surrogatepass") for _, t in items]
        offsets = np.zeros(len(blobs) + 1, np.int64)
        np.cumsum([len(b) for b in blobs], out=offsets[1:])
        low, self.starts, self.ends, first = _words(np.frombuffer(b"".join(blobs), np.uint8), offsets)
        self.raw = low.tobytes()
        counts = np.diff(first)
        self.sets: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.bits = {}
        words = A.range_hash(A.prefix_hash(low), self.starts, self.ends)
        item = np.repeat(np.arange(len(items), dtype=np.int32), counts)
        for size in np.unique(np.minimum(counts[counts > 0], n)).tolist():
            hashes = A.window_hash(words, size)
            at = np.flatnonzero((np.minimum(counts, n)[item] == size) & (np.arange(len(words)) + size <= np.repeat(first[1:], counts)))
            order = at[np.argsort(hashes[at], kind="stable")]
            self.sets[size] = (hashes[order], item[order], order.astype(np.int32))
            bits = np.zeros(1 << 20, bool)
            bits[hashes[order] >> A.U64(44)] = True
            self.bits[size] = bits

    def holders(self, size: int, h, words: list[bytes]) -> set[str] | None:
        """Names of the items with this window, none of which may be named; null if no item has it."""
        hashes, item, at = self.sets[size]
        found = None
        for i in range(int(np.searchsorted(hashes, h)), int(np.searchsorted(hashes, h, "right"))):
            w = int(at[i])
            if all(self.raw[a:b] == x for a, b, x in zip(self.starts[w : w + size], self.ends[w : w + size], words, strict=True)):
                found = (found or set()) | {self.names[item[i]]}
        return None if found is None else found - {None}


def scan(grams: Grams, data, offsets):
    """Words per document, spans of hit words and the items found, for a chunk of documents."""
    low, starts, ends, first = _words(data, offsets)
    n_docs, counts = len(offsets) - 1, np.diff(first)
    hashes = A.range_hash(A.prefix_hash(low), starts, ends)
    doc_end = np.repeat(first[1:], counts)
    marks = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for size, (known, _, _) in grams.sets.items():
        windows = A.window_hash(hashes, size)
        at = np.flatnonzero(grams.bits[size][windows >> A.U64(44)])
        at = at[at + size <= doc_end[at]]
        near = np.minimum(np.searchsorted(known, windows[at]), len(known) - 1)
        seen: dict[tuple, set[str] | None] = {}  # a chunk may hold one window many times
        for i in at[known[near] == windows[at]]:
            words = tuple(low[s:e].tobytes() for s, e in zip(starts[i : i + size], ends[i : i + size], strict=True))
            if words not in seen:
                seen[words] = grams.holders(size, windows[i], words)
            holders = seen[words]
            if holders is not None:
                marks[i] += 1
                marks[i + size] -= 1
                items[int(np.searchsorted(first, i, "right")) - 1] |= holders
    hit = np.cumsum(marks[:-1]) > 0
    a, b = A.spans_of(hit, first)
    doc = np.searchsorted(first, a, "right") - 1
    return counts, np.bincount(doc, minlength=n_docs), a - first[doc], b - first[doc], [sorted(items.get(i, ())) for i in range(n_docs)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, id_col: str = "item_id", text_col: str = "text", keep: list[str] | None = None, max_set_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """``keep`` columns of every document (default: all) with ``n_words``, ``hit_spans`` (word
    ranges covered by benchmark windows) and ``hit_items`` (ids as strings, sorted).

    The benchmark's size is checked: up to ``max_set_bytes`` of text are one broadcast set; more
    are cut into shards of that size, scanned one after the other, and the spans merged."""
    added = [f.name for f in FIELDS]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("words")).where("words is not null")
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-size // (max_set_bytes // 2))) if size > max_set_bytes else 1
    df = docs
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("words"), F.lit(shards)) == shard) if shards > 1 else items
        rows = [(r[0], r[1]) for r in part.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(Grams(rows, n))

        def kernel(data, offsets, valid, shared=shared):
            counts, n_spans, a, b, found = scan(shared.value, data, offsets)
            spans = pa.StructArray.from_arrays([pa.array(a), pa.array(b)], ["start", "end"])
            return [pa.array(counts), A.list_array(n_spans, spans), pa.array(found, pa.list_(pa.string()))]

        passed = [text_col, *added] if shard else []
        kept = [*keep, *(c for c in [text_col, *added] if shards > 1 and c not in keep and c in df.columns)]
        out = A.arrow_map(df.withColumnsRenamed({c: f"__{c}" for c in added}) if passed else df.drop(*added), kernel, text_col, [f"__{c}" if c in added else c for c in kept] if passed else kept, FIELDS)
        if passed:
            out = out.withColumns({"hit_spans": F.concat("__hit_spans", "hit_spans"), "hit_items": F.array_sort(F.array_union("__hit_items", "hit_items"))}).drop(*(f"__{c}" for c in added))
        df = materialise(out, "decontam") if shard < shards - 1 else out
    return df.select(*(F.col(f"`{c}`") for c in (*keep, *added)))


def n_hit_words(spans: str = "hit_spans"):
    """Number of words in the union of the spans."""
    merged = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["to"], s["start"]))).alias("n"),
            F.greatest(acc["to"], s["end"]).alias("to"),
        ),
    )
    return merged["n"]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns, whatever their names.  ``text_col`` names
    the text of both tables; the other options are those of ``find_contamination``."""
    text = options.pop("text_col", "text")
    own = docs.select(*(F.col(f"`{c}`").alias(f"k_{c}") for c in docs.columns), F.col(f"`{text}`").alias(text))
    kept = find_contamination(own, benchmark, text_col=text, **options).where(F.size("hit_spans") == 0)
    return kept.select(*(F.col(f"`k_{c}`").alias(c) for c in docs.columns))


def op9(spark, sf_dir):
    found = find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
item_windows AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM split WHERE kind = 'b' AND len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT id AS doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM split, sizes WHERE kind = 'd' AND len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT s.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN covered c ON c.doc_id = s.id LEFT JOIN found f ON f.doc_id = s.id WHERE kind = 'd'
"""
