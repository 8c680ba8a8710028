"""Ranked lexical search over an index of two levels.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.  With N documents that have a term, L
terms in all and n in a document, a term found tf times adds ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` to its score, where
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 10 + (90 n N) div L``; all but the logarithm is integer arithmetic.

The index has a row for each document with a term of the queries (the vocabulary is known, so other postings are never
made): level one holds term numbers and impacts, which are the fraction above in steps of ``STEP``, rounded up to a byte;
level two holds tf and n.  A search reads level one for a lower and an upper bound of every pair of query and document that share
a term: the k-th greatest lower bound of a query is its threshold.  Then every document whose upper bound reaches the
threshold, and no other, is scored exactly from level two, and the k best are ranked.  No such document is missed, so the
result is that of scoring everything.

Texts are read once; the postings, and then the index, are written to the shared folder.  A task sends k lower bounds for each
query, and a window with a limit in each task ranks the exact scores.  The queries are broadcast: up to ``MAX_QUERY_BYTES`` of text
at a time, more are answered in shards, each with an index of its own.  Statistics of the vocabulary are collected (its size is
that of the queries).

A null or wordless text has no terms, is not counted and never found; a null or wordless query finds nothing.  Documents with a null
id are found as any other and come last among equal scores.  Repeated rows are documents of their own, repeated queries queries of
their own.  Texts of any length are read whole, long ones in parts cut where no term is.  Equal scores are in the
order of ids; of rows that share id and score any order is the same.  Scores of zero are not listed.  An empty
table on either side gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A
from curalis.llm._store import materialise

K = 10
MAX_QUERY_BYTES = 16 << 20
#: One step of an impact byte: the fraction is below a million, so 250 steps cover it.
STEP = 4000
#: Pairs of document and query that are bounded at a time, and the part of a text that is read at a time.
CELLS = 1 << 20
PART = 1 << 22


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms, and the number of terms before each document."""
    low = A.LOWER[data]
    starts, ends = A.spans_of(A.ALNUM[low], offsets)
    return A.range_hash(A.prefix_hash(low), starts, ends), np.searchsorted(starts, offsets)


class Queries:
    """Distinct terms of some texts as sorted hashes, and which texts hold each."""

    def __init__(self, texts: list[str | None]):
        blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        offsets = np.cumsum([0, *map(len, blobs)])
        hashes, first = _terms(np.frombuffer(b"".join(blobs), np.uint8), offsets)
        self.vocabulary, term = np.unique(hashes, return_inverse=True)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        pairs = np.unique(term.astype(np.int64) * max(1, len(texts)) + owner)
        self.size = len(texts)
        self.holders = (pairs % max(1, len(texts))).astype(np.int64)
        self.counts = np.bincount(pairs // max(1, len(texts)), minlength=len(self.vocabulary))
        self.first = np.cumsum(self.counts) - self.counts
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.vocabulary >> A.U64(44)] = True

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are in the vocabulary, and their numbers."""
        at = np.flatnonzero(self.bits[hashes >> A.U64(44)])
        near = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        found = self.vocabulary[near] == hashes[at] if len(self.vocabulary) else np.zeros(0, bool)
        return at[found], near[found]

    def pairs(self, doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each posting and each query that holds its term: the cell ``doc * size + query``, and the posting."""
        n = self.counts[term]
        posting = np.repeat(np.arange(len(term)), n)
        at = np.arange(len(posting)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term], n)
        return doc[posting] * self.size + self.holders[at], posting


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first document, bytes, offsets)`` in parts of about ``PART`` bytes; a long text is cut at bytes of no term."""
    for lo, hi in A.chunks(offsets, PART):
        a, b = int(offsets[lo]), int(offsets[hi])
        while b - a > PART:
            free = np.flatnonzero(~A.ALNUM[data[a + PART : b]])
            if not len(free):
                break
            cut = a + PART + int(free[0])
            yield lo, data[a:cut], np.array([0, cut - a])
            a = cut
        yield lo, data[a:b], np.concatenate([[0], offsets[lo + 1 : hi + 1] - a])


def postings(docs: DataFrame, queries: Queries, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: its number of terms, the numbers of those in the
    vocabulary, in order, and how often each occurs."""
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("tfs", ints)]
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def kernel(data, offsets, valid):
        q, many = shared.value, len(offsets) - 1
        width = max(1, len(q.vocabulary))
        n, keys, tfs = np.zeros(many, np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, part, bounds in _parts(data, offsets):
            hashes, before = _terms(part, bounds)
            counts = np.diff(before)
            n[first : first + len(counts)] += counts
            at, term = q.numbers(hashes)
            doc = first + np.searchsorted(before, at, "right") - 1
            some, tf = np.unique(doc * width + term, return_counts=True)
            keys.append(some)
            tfs.append(tf)
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.bincount(back, np.concatenate(tfs), len(key)).astype(np.int64)
        each = np.bincount(key // width, minlength=many)
        return [pa.array(n), A.list_array(each, pa.array(key % width, pa.int32())), A.list_array(each, pa.array(tf, pa.int32()))]

    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return A.arrow_map(plain, kernel, "text", ["id"], fields).where("n > 0")


class Weights:
    """Corpus statistics and the weight of each term of the vocabulary."""

    def __init__(self, table: DataFrame, size: int):
        self.documents, total = table.agg(F.count("*"), F.sum("n")).first()
        self.total = total or 0
        df = np.zeros(size, np.int64)
        for term, n in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = n
        self.w = np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)

    def fractions(self) -> Column:
        """``(10**9 * tf) div (1000 * tf + 8 * m)`` of each posting of a row."""
        m = F.lit(10) + F.expr(f"(90 * n * {self.documents}L) div {max(1, self.total)}L")
        return F.transform("tfs", lambda tf: F.call_function("div", F.lit(10**9).cast("long") * tf, F.lit(1000).cast("long") * tf + F.lit(8) * m))


def build_index(table: DataFrame, weights: Weights) -> DataFrame:
    """Level one (``terms, impacts``) and level two (``n, tfs``) of each document with a posting."""
    impacts = F.transform(weights.fractions(), lambda x: F.call_function("div", x + (STEP - 1), F.lit(STEP)).cast("smallint"))
    return table.where(F.size("terms") > 0).select("id", "n", "terms", "tfs", impacts.alias("impacts"))


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    return np.asarray(column.flatten()).astype(np.int64), np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)


def _bounds(batch: pa.RecordBatch, queries: Queries, w: np.ndarray):
    """``(first row, rows, cells of postings, postings, upper, lower)`` for runs of rows: bounds of every pair of row and query, as
    one array; sums are below 2**53 and so exact as floats."""
    terms, each = _lists(batch, "terms")
    impacts, _ = _lists(batch, "impacts")
    ends = np.cumsum(each)
    step = max(1, CELLS // max(1, queries.size))
    for lo in range(0, batch.num_rows, step):
        hi = min(lo + step, batch.num_rows)
        a, b = int(ends[lo] - each[lo]), int(ends[hi - 1])
        cell, posting = queries.pairs(np.repeat(np.arange(hi - lo), each[lo:hi]), terms[a:b])
        weight, impact = w[terms[a:b]], impacts[a:b]
        size = (hi - lo) * queries.size
        upper = np.bincount(cell, (weight * impact * STEP)[posting], size)
        lower = upper - np.bincount(cell, (weight * np.where(impact > 0, STEP - 1, 0))[posting], size)
        yield lo, hi - lo, cell, posting + a, upper, lower


def thresholds(index: DataFrame, queries: Queries, weights: Weights, k: int) -> np.ndarray:
    """The k-th greatest lower bound of each query, or 0 if fewer documents have one."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights.w))

    def run(batches):
        q, w = shared.value
        best = np.zeros((k, q.size))
        for batch in batches:
            for _, rows, _, _, _, lower in _bounds(batch, q, w):
                both = np.concatenate([best, lower.reshape(rows, q.size)])
                best = np.partition(both, len(both) - k, axis=0)[-k:]
        at, query = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(best[at, query].astype(np.int64))], ["query", "bound"])

    rows = index.select("terms", "impacts").mapInArrow(run, "query int, bound long")
    order = Window.partitionBy("query").orderBy(F.desc("bound"))
    out = np.zeros(queries.size, np.int64)
    for query, bound in rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).where(F.col("rank") == k).select("query", "bound").collect():
        out[query] = bound
    return out


def rescored(index: DataFrame, queries: Queries, weights: Weights, least: np.ndarray) -> DataFrame:
    """``query, id, score``: exact scores of all documents whose upper bound reaches the query's threshold."""
    schema = T.StructType([T.StructField("query", T.IntegerType()), index.schema["id"], T.StructField("score", T.LongType())])
    target = A.to_arrow_schema(schema)
    documents, total = weights.documents, max(1, weights.total)
    shared = index.sparkSession.sparkContext.broadcast((queries, weights.w, least))

    def run(batches):
        q, w, theta = shared.value
        for batch in batches:
            terms, each = _lists(batch, "terms")
            tfs, _ = _lists(batch, "tfs")
            n = np.asarray(batch.column(batch.schema.get_field_index("n"))).tolist()
            m = np.repeat(np.array([10 + 90 * x * documents // total for x in n], np.int64), each)
            exact = w[terms] * (10**9 * tfs // (1000 * tfs + 8 * m))
            ids = batch.column(batch.schema.get_field_index("id"))
            for lo, rows, cell, posting, upper, _ in _bounds(batch, q, w):
                reached = (upper.reshape(rows, q.size) >= np.maximum(theta, 1)).ravel()
                wanted = reached[cell]
                score = np.zeros(len(reached), np.int64)
                np.add.at(score, cell[wanted], exact[posting[wanted]])
                at = np.flatnonzero(score > 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(at % q.size, pa.int32()), ids.take(pa.array(lo + at // q.size)), pa.array(score[at])], schema=target)

    return index.mapInArrow(run, schema)


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text", max_query_bytes: int = MAX_QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of each query: its id, ``rank`` from 1, the document's id, ``score``."""
    asked = queries.select(F.col(f"`{query_id}`").alias("item"), F.col(f"`{query_text}`").alias("words")).where("words is not null")
    size = asked.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-size // (max_query_bytes // 2))) if size > max_query_bytes else 1
    out = []
    for shard in range(shards):
        rows = (asked.where(F.pmod(F.xxhash64("words"), F.lit(shards)) == shard) if shards > 1 else asked).collect()
        known = Queries([r["words"] for r in rows])
        table = materialise(postings(docs, known, id_col, text_col), "postings")
        weights = Weights(table, len(known.vocabulary))
        index = materialise(build_index(table, weights), "index")
        found = rescored(index, known, weights, thresholds(index, known, weights, k) if rows else np.zeros(0, np.int64))
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = docs.sparkSession.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], T.StructType([T.StructField("query", T.IntegerType()), asked.schema["item"]]))
        out.append(found.join(F.broadcast(names), "query").select(F.col("item").alias(query_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
    return reduce(DataFrame.unionAll, out)


def op13(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
totals AS (SELECT count(*) AS many, sum(len(w))::BIGINT AS total FROM split WHERE kind = 'd' AND len(w) > 0),
asked AS (SELECT DISTINCT id AS item_id, unnest(w) AS term FROM split WHERE kind = 'b'),
found AS (
  SELECT id AS doc_id, n, term, count(*) AS tf
  FROM (SELECT id, len(w) AS n, unnest(w) AS term FROM split WHERE kind = 'd') WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * many + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM found, totals GROUP BY term, many),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * many) // total)))))::BIGINT AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
