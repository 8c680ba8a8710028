"""Ranked search against scoring everything."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from curalis.llm import search
from tests.conftest import DATA
from tests.llm.test_operators import LOWER, ODD, VOCAB, docs, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def everything(texts, ids, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in zip(ids, texts)]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    many, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c, n in bags:
            m = 100 - 90 + 90 * n * many // total
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        out[item] = [(n, None if i == math.inf else i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def corpus(rng):
    few = VOCAB[:60]
    texts = [*ODD, *(prose(rng, rng.randint(1, 120), few if i % 3 else None) for i in range(250))]
    texts += [texts[20]] * 30 + [texts[20].upper(), "Ünïté 漢字 " + texts[30], " ".join(few), few[0] * 3]
    ids = [None if i in (12, 15) else i for i in range(len(texts))]
    ids[40] = 41
    return texts, ids


def asked(rng, texts):
    items = [(0, texts[20]), (1, "Ünïté, 漢字!"), (2, None), (3, " ."), (4, "nowhere"), (5, VOCAB[0]), (6, " ".join(VOCAB[:60]) * 3), (None, texts[33])]
    return items + [(10 + i, prose(rng, rng.randint(1, 30), VOCAB[:200])) for i in range(25)]


@pytest.mark.parametrize("cells, part, shards, k", [(1 << 20, 1 << 22, 1 << 24, 10), (50, 64, 900, 3), (1, 1, 1 << 24, 1)])
def test_search(spark, monkeypatch, cells, part, shards, k):
    rng = random.Random(1)
    texts, ids = corpus(rng)
    items = asked(rng, texts)
    monkeypatch.setattr(search, "CELLS", cells)
    monkeypatch.setattr(search, "PART", part)
    table = docs(spark, texts, ids=ids).withColumns({"id": F.lit("x"), "a.b": F.lit(1), "rank": F.lit(2)}).repartition(4)
    got = search.search(table, spark.createDataFrame(items, "item_id long, text string"), k, max_query_bytes=shards)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert {i: sorted(x) for i, x in rows.items()} == {i: x for i, x in everything(texts, ids, items, k).items() if x}


def test_bounds_hold_and_prune(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(20, 200)) for _ in range(400)]
    known = search.Queries([prose(rng, 12) for _ in range(20)])
    table = search.postings(docs(spark, texts), known)
    weights = search.Weights(table, len(known.vocabulary))
    index = search.build_index(table, weights)
    least = search.thresholds(index, known, weights, 10)
    every = search.rescored(index, known, weights, least * 0)
    some = search.rescored(index, known, weights, least)
    tenth = {}
    for r in every.collect():
        tenth.setdefault(r.query, []).append(r.score)
    tenth = {q: sorted(s)[-10] for q, s in tenth.items() if len(s) >= 10}
    kept = some.collect()
    assert all(least[q] <= s for q, s in tenth.items())
    assert Counter(r.query for r in kept if r.score >= tenth.get(r.query, 0)) == Counter(r.query for r in every.collect() if r.score >= tenth.get(r.query, 0))
    assert len(kept) < every.count() / 3


def test_nothing_to_find_or_to_ask(spark):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    table = docs(spark, [None, "", "word word"])
    assert search.search(table.limit(0), items).count() == 0
    assert search.search(table, items.limit(0)).count() == 0
    assert search.search(docs(spark, [None, " ."]), items).count() == 0
    assert [tuple(r) for r in search.search(table, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 2)]


def test_long_text(spark):
    rng = random.Random(3)
    texts = [prose(rng, 1_500_000, VOCAB[:50]), "x" * 9_000_000 + " " + VOCAB[0], prose(rng, 50)]
    items = [(1, VOCAB[0]), (2, prose(rng, 5, VOCAB[:80]))]
    got = search.search(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    rows = {}
    for r in got.collect():
        rows.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert {i: sorted(x) for i, x in rows.items()} == everything(texts, [0, 1, 2], items)


def test_sql(spark):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = db.sql(f"SELECT item_id, rank, doc_id, score FROM ({search.ORACLE})").fetchall()
    assert Counter(want) == Counter(tuple(r) for r in search.op13(spark, DATA).collect()) and want
