"""Token counts against the library that the vocabulary file is for."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curalis.llm import tokens
from tests.conftest import DATA
from tests.llm.test_operators import ODD, docs

LIBRARY = Tokenizer.from_file(public_tokenizers.path(tokens.FILE))
PIECES = ["<|endoftext|>", "<|endof", "|>", "'re", "'ll", "'s", "'", "''", " ", "  ", "\n", "\t's", " the", "ing", "aaaa", "!!!", "ñ", "漢字", "😀", "　", " ", "１２", "½", "é", "\U000323b0", "͸", "\x00", "A", "7"]


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def odd_texts(n, seed=8):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(*tokens.specification(public_tokenizers.path(tokens.FILE)))


def test_every_prefix(counter):
    for text in odd_texts(400):
        assert counter.all_prefixes(text).tolist() == [library(text[:n]) for n in range(len(text) + 1)], repr(text)


def test_classes_of_all_characters(counter):
    """A letter, a digit and a sign before each character: what joins them is what the library joins."""
    rng = random.Random(2)
    points = [*range(0x3000), *rng.sample(range(0x3000, 0xD800), 6000), *rng.sample(range(0xE000, 0x110000), 6000)]
    for lo in range(0, len(points), 500):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}\n" for c in points[lo : lo + 500])
        assert int(counter.totals([text])[0]) == library(text)


def test_memory_is_bounded_and_harmless(monkeypatch, counter):
    monkeypatch.setattr(tokens, "REMEMBERED", 7)
    counter.memory.clear()
    texts = odd_texts(60, 9)
    plain = [t.replace("<|endoftext|>", "") for t in texts]
    assert counter.totals(plain).tolist() == [library(t) for t in plain]
    assert len(counter.memory) <= 7


def test_count_tokens(spark, monkeypatch):
    rng = random.Random(3)
    long = " ".join(rng.choice(["word", "ñandú", "it's", "12,5", "<|endoftext|>", "\n\n"]) for _ in range(400_000))
    texts = [*ODD, *odd_texts(200), long, "x" * 300_000, "same", "same"]
    table = docs(spark, texts).withColumn("n_tokens", F.lit("old")).withColumn("a.b", F.lit(1))
    got = tokens.count_tokens(table.repartition(3))
    assert set(got.columns) == {*table.columns, "n_bytes"}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got.collect()} == {i: (len((t or "").encode()), library(t)) for i, t in enumerate(texts)}
    assert tokens.count_tokens(table.limit(0)).count() == 0


def test_budgets_from_stored_prefixes(spark):
    texts = [*ODD[:-2], *odd_texts(80, 5), "internationalisation of the international internationals " * 20]
    stored = tokens.count_tokens(docs(spark, texts), keep=["doc_id"], prefixes=True)
    asked = stored.select("doc_id", *(tokens.longest_prefix(F.col("prefix_tokens"), k).alias(f"b{k}") for k in (-1, 0, 3, 9)), tokens.tokens_of_prefix(F.col("prefix_tokens"), F.lit(4)).alias("four"))
    for r in asked.collect():
        text = texts[r.doc_id] or ""
        counts = [library(text[:n]) for n in range(len(text) + 1)]
        assert r["b-1"] is None
        for k in (0, 3, 9):
            assert r[f"b{k}"] == max(n for n, c in enumerate(counts) if c <= k)
        assert r.four == (counts[4] if len(text) >= 4 else None)
    for r in tokens.truncate(docs(spark, texts).withColumn("a.b", F.lit(2)), 5).collect():
        text = texts[r.doc_id]
        assert r["a.b"] == 2 and (r.text is None) == (text is None)
        if text is not None:
            counts = [library(text[:n]) for n in range(len(text) + 1)]
            assert r.text == text[: max(n for n, c in enumerate(counts) if c <= 5)]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.specification(public_tokenizers.path("word_bpe_49k.json"))


def test_query(spark):
    want = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = tokens.op11(spark, DATA).collect()
    assert len(rows) == len(want)
    for r in rows:
        n = library(want[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((want[r.doc_id] or "").encode()), n, n > 1024)
