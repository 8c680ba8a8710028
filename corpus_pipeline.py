"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``.
"""

from __future__ import annotations

from curalis.llm import decontam, mixing, simhash, substring, toxicity
from curalis.llm._store import materialise


def drop_toxic(spark, docs, sf_dir):
    """Documents whose toxicity score is below one half; the model is fitted on this stage's input."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8)."""
    return simhash.drop_near_duplicates(docs)


def cut_passages(spark, docs, sf_dir):
    """Documents without the passages that repeat one of a document with a smaller id."""
    return substring.remove_passages(docs)


def drop_leaks(spark, docs, sf_dir):
    """Documents in which no window of a benchmark item occurs."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark, docs, sf_dir):
    """The training mix: one row for each time a document is taken, in the order of training."""
    return mixing.training_order(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("substring", cut_passages),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

#: Classifier, fingerprint components and curriculum have no SQL; tests/llm compares stages by brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
