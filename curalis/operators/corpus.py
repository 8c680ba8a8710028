"""Documents of the corpus and its files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curalis.functions import text as X
from curalis.functions import values as V
from curalis.operators.quality import KEYS

METADATA = ("mecanismo_lesion", "region_anatomica", "desenlace", "es_pediatrico", "truncado", "doc_largo", "n_chars", "abreviaturas")


def document() -> Column:
    parts = [F.when(X.strip(F.coalesce(f"{k}_anon", F.lit(""))) != "", F.concat(F.lit(f"{V.TITLES[name]}: "), X.strip(F.col(f"{k}_anon")))) for k, name in KEYS.items()]
    return F.array_join(F.array_compact(F.array(*parts)), "\n\n")


def notice() -> Column:
    titles = F.create_map(*(F.lit(x) for k, v in V.TITLES.items() for x in (k, v.lower())))
    named = F.array_join(F.transform("campos_truncados", lambda c: F.coalesce(F.element_at(titles, c), F.lower(c))), ", ")
    named = F.when(F.size("campos_truncados") > 0, named).otherwise("algún campo")
    return F.when(F.col("truncated"), F.concat(F.lit("[Registro truncado en "), named, F.lit(": el desenlace puede no estar documentado.]"))).otherwise("")


def assemble(df: DataFrame, notice_in_text: bool = False) -> DataFrame:
    """The 19 columns of the corpus.  With the notice, lengths are taken before the last strip."""
    text = F.concat(document(), F.lit("\n\n"), notice()) if notice_in_text else document()
    df = df.withColumn("__doc", text)
    length = F.length("__doc")
    return df.select(
        "record_id",
        (X.strip(F.col("__doc")) if notice_in_text else F.col("__doc")).alias("texto"),
        length.alias("n_chars_doc"),
        "campos_truncados",
        "campos_vacios",
        "mecanismo_lesion",
        "region_anatomica",
        "desenlace",
        "es_pediatrico",
        "unidad_edad",
        "abreviaturas",
        "quality_flags",
        F.col("truncated").alias("truncado"),
        "indexable",
        "apto_rag",
        "n_reemplazos_phi",
        "tipos_phi",
        "hash_texto",
        (length > V.LONG_DOCUMENT).alias("doc_largo"),
    )


def exclusion_reason() -> Column:
    return F.coalesce(*(F.when(F.array_contains("quality_flags", f), F.lit(f)) for f in V.REASONS), F.lit(""))


def exclusions(corpus: DataFrame, column: str = "apto_rag") -> DataFrame:
    """What the index does not get, and the first reason."""
    return corpus.where(~F.col(column)).select(
        "record_id", exclusion_reason().alias("motivo"), F.array_join("campos_truncados", "|").alias("campos_truncados"), F.array_join("campos_vacios", "|").alias("campos_vacios"), "n_chars_doc"
    )


def index_lines(corpus: DataFrame, column: str = "apto_rag") -> DataFrame:
    """One JSON object per indexed document, as ``value``."""
    meta = F.struct(*(F.col("n_chars_doc").alias("n_chars") if m == "n_chars" else F.col(m) for m in METADATA))
    line = F.to_json(F.struct(F.col("record_id").alias("id"), F.col("texto").alias("text"), meta.alias("metadata")), {"ignoreNullFields": "false"})
    return corpus.where(column).orderBy(F.col("record_id").cast("bigint")).select(line.alias("value"))


def write(corpus: DataFrame, folder: str, column: str = "apto_rag") -> None:
    """The three files.  The corpus is written once and the other two are made of its file: a sort reads its input twice, and
    notes are not to be redacted and labelled again for each."""
    corpus.write.mode("overwrite").parquet(f"{folder}/corpus.parquet")
    corpus = corpus.sparkSession.read.schema(corpus.schema).parquet(f"{folder}/corpus.parquet")
    index_lines(corpus, column).write.mode("overwrite").text(f"{folder}/corpus_indexable.jsonl")
    exclusions(corpus, column).write.mode("overwrite").option("header", True).csv(f"{folder}/excluidos_rag.csv")
