"""Draft word lists mined from a corpus."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curalis.functions import gazetteer
from curalis.functions import text as X
from curalis.functions import values as V
from curalis.sources.notes import write_text

FIRST_ROWS = 30_000


def blobs(notes: DataFrame) -> DataFrame:
    """One text for each note, its fields joined by a double pipe."""
    fields = (F.coalesce(c, F.lit("")) for c in ("reason", "exam", "stay"))
    return notes.select("record_id", F.concat_ws(" || ", *fields).alias("blob"))


def institutions(texts: DataFrame, at_least: int = 3) -> DataFrame:
    """Names after a type word, cut at the first stop word, that occur often enough."""
    pattern = rf"(?iU)\b{V.TYPE_WORDS}\s+((?:[{V.LETTERS}]+\s*){{1,4}})"
    found = texts.select(F.explode(F.regexp_extract_all("blob", F.lit(pattern), F.lit(1))).alias("m"))
    tokens = F.split(X.label_key(F.col("m")), " ")
    stop = F.array(*(F.lit(w) for w in V.STOP_AFTER_TYPE))
    kept = found.select(tokens.alias("w")).withColumn("first", F.array_min(F.transform("w", lambda x, i: F.when(F.array_contains(stop, x), i))))
    name = F.array_join(F.slice("w", F.lit(1), F.coalesce("first", F.size("w"))), " ")
    rows = kept.select(name.alias("nombre")).where(F.length("nombre") >= 4)
    return rows.groupBy("nombre").agg(F.count("*").alias("n")).where(F.col("n") >= at_least).orderBy("nombre")


def doctors(texts: DataFrame) -> DataFrame:
    pattern = rf"(?iU)\b(?:dr|dra|doctor|doctora)\.?\s+([{V.LETTERS}]{{3,}})"
    found = texts.select(F.explode(F.regexp_extract_all("blob", F.lit(pattern), F.lit(1))).alias("m")).select(X.label_key(F.col("m")).alias("apellido"))
    return found.where(~F.col("apellido").isin(V.NOT_DOCTORS)).distinct().orderBy("apellido")


def places(texts: DataFrame, first_rows: int = FIRST_ROWS) -> DataFrame:
    """Seeds that occur in the first rows by id (a limit that is part of the operator)."""
    head = texts.orderBy(F.col("record_id").cast("bigint")).limit(first_rows).select(X.label_key(F.col("blob")).alias("t"))
    seen = F.array_compact(F.array(*(F.when(F.col("t").rlike(rf"(?U)\b{p}\b"), F.lit(p)) for p in V.PLACE_SEEDS)))
    return head.select(F.explode(seen).alias("municipio")).distinct().orderBy("municipio")


NOTE = "Borrador minado del corpus: revisar a mano, añadir lo que falte y quitar falsos positivos. Claves en minúsculas y sin tildes."


def draft_lists(texts: DataFrame, path: str) -> dict[str, list[str]]:
    """The three lists as YAML in any store, to be curated by hand, under the keys the rules read.  Each list is also written by
    Spark, one name a line, to ``<path>.d``; it is read from there, if its size is one that the rules take
    (``gazetteer.MAX_BYTES``)."""
    spark = texts.sparkSession
    tables = {"instituciones": institutions(texts).select("nombre"), "medicos": doctors(texts), "municipios": places(texts)}
    lists = {}
    for name, table in tables.items():
        table.toDF("value").write.mode("overwrite").text(f"{path}.d/{name}")
        lists[name] = gazetteer.names_of(spark.read.text(f"{path}.d/{name}"), "value")
    write_text(spark, path, yaml.safe_dump({"_nota": NOTE, **lists}, allow_unicode=True, sort_keys=False))
    return lists
