"""Abbreviation expansion and rule-based classification."""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curalis.functions import batches, fold
from curalis.functions import text as X
from curalis.functions import values as V


def expand(text: Column, abbreviations: dict[str, str]) -> Column:
    """``struct<text, keys>``: the first occurrence of each key gets its expansion in brackets."""
    none = F.struct(fold.without_marks(text).alias("text"), F.array().cast("array<string>").alias("keys"))
    if not abbreviations:
        return none
    pattern = rf"(?iU)\b{X.one_of(list(abbreviations), re.escape, re.escape)}\b"
    table = F.create_map(*(F.lit(x) for k, v in abbreviations.items() for x in (k.lower(), v)))

    def step(acc: Column, part: Column) -> Column:
        def named(key: Column) -> Column:
            new = ~F.array_contains(acc["keys"], key)
            return F.struct(
                (acc["i"] + 1).alias("i"),
                F.concat(acc["out"], part, F.when(new, F.coalesce(F.concat(F.lit(" ("), F.try_element_at(table, key), F.lit(")")), F.lit(""))).otherwise("")).alias("out"),
                F.when(new, F.array_append(acc["keys"], key)).otherwise(acc["keys"]).alias("keys"),
            )

        kept = F.struct((acc["i"] + 1).alias("i"), F.concat(acc["out"], part).alias("out"), acc["keys"].alias("keys"))
        return F.when(acc["i"] % 2 == 1, fold.let(F.lower(part), named)).otherwise(kept)

    def folded(marked: Column) -> Column:
        zero = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"), F.array().cast("array<string>").alias("keys"))
        return F.aggregate(F.split(marked, fold.MARK, -1), zero, step, lambda a: F.struct(a["out"].alias("text"), a["keys"].alias("keys")))

    return fold.let(fold.marked(fold.without_marks(text), pattern), lambda m: F.when(m.contains(fold.MARK), folded(m)).otherwise(none))


def expand_fields(df: DataFrame, keys: list[str], abbreviations: dict[str, str] | None = None) -> DataFrame:
    """Each ``<key>_anon`` expanded in place, and ``abreviaturas``, the sorted keys found in any."""
    table = V.ABBREVIATIONS if abbreviations is None else abbreviations
    packed, names = json.dumps(table), [*(f"{key}_anon" for key in keys), "abreviaturas"]

    @F.arrow_udf(", ".join(f"{n} string" for n in names[:-1]) + ", abreviaturas array<string>")
    def expanded_texts(*texts: pa.Array) -> pa.Array:
        done, found = batches.expanded(list(texts), packed)
        return pa.StructArray.from_arrays([*done, found], names)

    df = df.withColumn("__x", expanded_texts(*(F.col(n) for n in names[:-1])))
    return df.withColumns({n: F.col(f"__x.{n}") for n in names}).drop("__x")


def _any(text: Column, patterns: list[str]) -> Column:
    """Whether any pattern is found in a key of ``label_key``.  Each is tried only where the letters that it cannot do without stand in the text: to look for these
    takes a fraction of the time of a pattern, and most are not there."""

    def one(pattern: str) -> Column:
        # Keys have no accents, and single spaces for white space.
        pattern = re.sub(r"\[([a-z])[áéíóúñü]\]", r"\1", pattern).replace(r"\s+", " ")
        needed = X.literal(pattern)
        found = text.rlike(f"(?U){pattern}")
        return text.contains(needed) if needed == pattern else text.contains(needed) & found if needed else found

    return reduce(or_, map(one, patterns))


def _first(text: Column, labels: dict[str, list[str]]) -> Column:
    return F.coalesce(*(F.when(_any(text, p), F.lit(label)) for label, p in labels.items()))


def mechanism(reason: Column, body: Column) -> Column:
    """The first label found in the reason, else the first in reason and body."""
    return _mechanism(X.label_key(reason), X.label_key(body))


def _mechanism(reason: Column, body: Column) -> Column:
    both = lambda m: F.concat(m, F.lit(" "), body)
    return fold.let(reason, lambda m: F.coalesce(_first(m, V.MECHANISMS), fold.let(both(m), lambda t: _first(t, V.MECHANISMS)), F.lit(V.UNKNOWN)))


def regions(text: Column) -> Column:
    return _regions(X.label_key(text))


def _regions(key: Column) -> Column:
    return fold.let(key, lambda t: F.array_compact(F.array(*(F.when(_any(t, p), F.lit(label)) for label, p in V.REGIONS.items()))))


def outcome(body: Column) -> Column:
    return _outcome(X.label_key(body))


def _outcome(key: Column) -> Column:
    return fold.let(key, lambda t: F.coalesce(_first(t, V.OUTCOMES), F.lit(V.UNKNOWN)))


LABELS = ("mecanismo_lesion", "region_anatomica", "desenlace")


def classify(df: DataFrame) -> DataFrame:
    """``mechanism``, ``regions`` and ``outcome`` of the fields, on batches of texts."""

    @F.arrow_udf("mecanismo_lesion string, region_anatomica array<string>, desenlace string")
    def labels_of(reason: pa.Array, exam: pa.Array, stay: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(batches.labelled(reason, exam, stay), list(LABELS))

    df = df.withColumn("__labels", labels_of(*(F.col(f"{k}_anon") for k in ("reason", "exam", "stay"))))
    return df.withColumns({n: F.col(f"__labels.{n}") for n in LABELS}).drop("__labels")


def label_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
