"""The stateless phases over a stream of notes.  Dedup marks need all rows and are left to batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from curalis.operators import enrich, quality, redact


def curate(notes: DataFrame, lists=None, abbreviations=None) -> DataFrame:
    """Normalised, redacted, expanded and classified notes; batch or ``readStream`` alike."""
    df = redact.redact_fields(quality.normalise(notes), quality.KEYS, lists)
    return enrich.classify(enrich.expand_fields(df, list(quality.KEYS), abbreviations))
