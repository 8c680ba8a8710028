"""Normalised columns, quality flags, keep-first dedup marks and the quality summary."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curalis.functions import batches
from curalis.functions import values as V
from curalis.sources import store

KEYS = {"reason": V.REASON, "exam": V.EXAM, "stay": V.STAY}
#: Columns of texts that nothing after the flags reads, and all columns of texts.
UNREAD = (*KEYS, "text_concat", "text_norm")
TEXTS = (*UNREAD, *(f"{k}_clean" for k in KEYS))


def names_where(tests: dict[str, Column]) -> Column:
    """The names whose test holds, in order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))


@cache
def _in_batches(exported: bool):
    """Column functions of texts, computed on batches: clean fields, a matching key, whether clean fields end in a function word."""

    @F.arrow_udf(", ".join(f"{k} string" for k in KEYS))
    def clean_texts(*texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([batches.cleaned(t, exported).cast(pa.string()) for t in texts], list(KEYS))

    @F.arrow_udf("string")
    def match_key(text: pa.Array) -> pa.Array:
        return batches.match_keys(text)

    @F.arrow_udf("boolean")
    def ends_open(text: pa.Array) -> pa.Array:
        return batches.ends_open(text)

    return clean_texts, match_key, ends_open


def normalise(notes: DataFrame, exported: bool = True) -> DataFrame:
    """Cleaned fields (of an export or not: ``text.clean``), their concatenation, its matching key, and the age unit."""
    clean_texts, match_key, _ = _in_batches(exported)
    df = notes.withColumn("__clean", clean_texts(*(F.col(k).cast("string") for k in KEYS)))
    df = df.withColumns({f"{k}_clean": F.col(f"__clean.{k}") for k in KEYS}).drop("__clean")
    df = df.withColumn("text_concat", F.concat_ws(" \n", *(F.nullif(f"{k}_clean", F.lit("")) for k in KEYS)))
    unit = match_key(F.coalesce("unit", F.lit("")))
    return df.withColumns({"text_norm": match_key(F.col("text_concat")), "es_pediatrico": unit == "meses", "unidad_edad": F.nullif(unit, F.lit(""))})


def truncated(key: str) -> Column:
    cut = _in_batches(True)[2](F.col(f"{key}_clean"))
    if KEYS[key] in V.CAPPED:
        cut = (F.length(F.coalesce(key, F.lit(""))) >= V.CAP) | cut
    return (F.col(f"{key}_clean") != "") & cut


def row_flags(df: DataFrame, min_chars: int = V.MIN_CHARS) -> DataFrame:
    """Flags that depend on a row alone, and the hash by which texts are compared."""
    df = df.withColumns({f"cut_{k}": truncated(k) for k in KEYS} | {"n_chars": F.length("text_concat"), "hash_texto": F.left(F.sha2("text_norm", 256), F.lit(16))})
    empty = F.col("n_chars") == 0
    missing = {name: F.col(f"{k}_clean") == "" for k, name in KEYS.items()}
    df = df.withColumns(
        {
            "empty": empty,
            "too_short": ~empty & (F.col("n_chars") < min_chars),
            "campos_truncados": names_where({name: F.col(f"cut_{k}") for k, name in KEYS.items()}),
            "campos_vacios": names_where(missing),
        }
    )
    df = df.withColumns({"truncated": F.size("campos_truncados") > 0, "incompleto": ~F.col("empty") & (F.size("campos_vacios") > 0)})
    return df.drop(*(f"cut_{k}" for k in KEYS))


def _order(file, row) -> Column:
    """The order of rows of one text: by integer id, rows without one last, then by place."""
    number = F.col("record_id").cast("bigint")
    return F.struct(number.isNull().alias("unnumbered"), number.alias("id"), file.alias("file"), row.alias("row"))


def _first(rows: DataFrame) -> DataFrame:
    """The first row of each text, from narrow rows; a text that is everywhere sends one row from each task."""
    return rows.where(~F.col("empty")).groupBy("hash_texto").agg(F.min("__order").alias("first"), F.count("*").alias("n"))


def flags(df: DataFrame, min_chars: int = V.MIN_CHARS, earlier: DataFrame | None = None, drop: Iterable[str] = ()) -> DataFrame:
    """Flags of normalised notes.  Nothing is dropped; of the rows with one text, the one with the least integer id stays
    and the others are marked as duplicates.  Rows that share an id are told apart by their place, and rows without an id come
    after all others.  Empty notes are no duplicates.

    The rows are written once (``store.written``): texts are cleaned once and places are fixed.  The first of each text is found
    on narrow rows, and only texts that repeat are looked up.  ``earlier`` (``hash_texto, id``; see ``first_ids``) are
    the first ids of notes seen before, which are not read again: a text of theirs with a lesser or equal id is a duplicate.  Columns
    to ``drop`` are not written: flags alone need no text (``TEXTS``)."""
    stored = store.written(row_flags(df, min_chars).drop(*drop))
    rows = stored.select("*", _order(F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("__order"))
    first = _first(rows)
    if earlier is not None:
        before = earlier.select("hash_texto", F.struct(F.col("id").isNull().alias("unnumbered"), F.col("id").alias("id"), F.lit("").alias("file"), F.lit(-1).cast("bigint").alias("row")).alias("first"), F.lit(1).cast("bigint").alias("n"))
        first = first.unionAll(before.join(first, "hash_texto", "left_semi")).groupBy("hash_texto").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    first = first.where("n > 1").select(F.col("hash_texto").alias("__hash"), F.col("first").alias("__first"))
    rows = rows.join(first, F.col("hash_texto") == F.col("__hash"), "left")
    rows = rows.withColumn("duplicate", ~F.col("empty") & F.coalesce(F.col("__order") != F.col("__first"), F.lit(False))).drop("__hash", "__first", "__order")
    rows = rows.withColumn("indexable", ~(F.col("empty") | F.col("too_short") | F.col("duplicate")))
    return rows.withColumns({"apto_rag": F.col("indexable") & ~F.col("truncated") & ~F.col("incompleto"), "quality_flags": names_where({f: F.col(f) for f in V.FLAGS})})


def first_ids(flagged: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """``hash_texto, id`` of the first note of each text, together with those found before; to be kept for the next file.
    Written with ``bucketBy(n, "hash_texto")``, the next grouping and lookup need no shuffle of it."""
    now = flagged.where(~F.col("empty") & ~F.col("duplicate")).select("hash_texto", F.col("record_id").cast("bigint").alias("id"))
    both = now if earlier is None else now.unionAll(earlier.select("hash_texto", "id"))
    return both.groupBy("hash_texto").agg(F.min("id").alias("id"))


def displaced(flagged: DataFrame, earlier: DataFrame) -> DataFrame:
    """``hash_texto, id`` of notes seen before that are duplicates now, as a new note with their text has a lesser id."""
    now = flagged.where(~F.col("empty") & ~F.col("duplicate")).select("hash_texto", F.col("record_id").cast("bigint").alias("__id"))
    return earlier.join(now, "hash_texto").where(F.col("__id").isNotNull() & (F.col("id").isNull() | (F.col("__id") < F.col("id")))).select("hash_texto", "id")


def counted() -> dict[str, Column]:
    """The tests whose counts make up the summary, in order."""
    i, t, c = F.col("indexable"), F.col("truncated"), F.col("incompleto")
    return {
        "total": F.lit(True),
        "empty": F.col("empty"),
        "too_short": F.col("too_short"),
        "duplicate": F.col("duplicate"),
        "truncated": t,
        "incompleto": c,
        "indexable": i,
        "excluido_truncado": i & t,
        "excluido_incompleto": i & ~t & c,
        "apto_rag": F.col("apto_rag"),
    }


def summary(df: DataFrame) -> DataFrame:
    """``metrica, n, pct``: ten rows from one aggregation."""
    tests = counted()
    one = df.agg(*(F.count_if(x).alias(n) for n, x in tests.items()))
    rows = one.select(F.col("total").alias("all"), F.explode(F.array(*(F.struct(F.lit(n).alias("metrica"), F.col(n).alias("n")) for n in tests))).alias("r"))
    return rows.select("r.metrica", "r.n", F.bround(F.col("r.n") / F.nullif("all", F.lit(0)) * 100, 2).alias("pct"))
