"""Named-entity candidates for manual review."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curalis.functions import bloom, fold
from curalis.functions import text as X
from curalis.functions import values as V
from curalis.sources import store

MODEL = "es_core_news_lg"
WORD = f"[{V.LETTERS}]{{3,}}"
RUN = rf"(?U)\b[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?:\s+(?:de\s+|del\s+|la\s+)?[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)*"


def words(text):
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?U){WORD}"), F.lit(0)))


def document_frequency(texts: DataFrame, text: str = "texto", among: DataFrame | None = None) -> DataFrame:
    """In how many documents each word of 3 letters occurs.  With ``among`` (a column ``token``), of these words at least, and of few
    others: a Bloom filter drops words before they are counted, so that the shuffle grows with what is asked."""
    found = words(F.col(text))
    if among is not None:
        wanted = bloom.build(among, "token")
        found = F.filter(found, wanted.may_hold)
    return texts.select(F.explode(found).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def not_shouting(texts: DataFrame, text: str = "texto") -> DataFrame:
    return texts.where(~X.mostly_upper(F.col(text)))


def longest(texts: DataFrame, n: int, length: str = "n_chars_doc", key: str = "record_id") -> DataFrame:
    return texts.orderBy(F.desc(length), F.col(key).cast("bigint")).limit(n)


def label_of(name: Column) -> Column:
    """ORG: a name with an institution's type word; LOC: a place of the seed list; else PER."""
    label = lambda key: F.when(key.rlike(rf"(?U)\b{V.TYPE_WORDS}\b"), "ORG").when(key.isin(V.PLACE_SEEDS), "LOC").otherwise("PER")
    return fold.let(X.label_key(name), label)


def capitalised_runs(texts: DataFrame) -> DataFrame:
    """The default tagger: runs of capitalised words, as ``record_id, label, entidad, inicio, t``."""
    found = texts.select("record_id", "t", F.explode(fold.spans(F.col("t"), RUN)).alias("m"))
    return found.select("record_id", label_of(F.col("m.match")).alias("label"), F.col("m.match").alias("entidad"), F.col("m.a").alias("inicio"), "t")


def model_tagger(name: str = MODEL, batch_size: int = 64):
    """A tagger by a spaCy model without the parts that are not needed, loaded once in each Python worker; ends
    with a message where package or model is missing."""
    skip = ["lemmatizer", "tagger", "attribute_ruler", "parser"]

    def load():
        import spacy

        return spacy.load(name, exclude=skip)

    try:
        load()
    except ImportError:
        raise SystemExit(f"spaCy is not installed: pip install spacy, then python -m spacy download {name}") from None
    except OSError:
        raise SystemExit(f"the model is missing: python -m spacy download {name}") from None

    def tag(frames):
        model = load()
        for frame in frames:
            found = [(r, e.label_, e.text, e.start_char, t) for r, t, d in zip(frame["record_id"], frame["t"], model.pipe(frame["t"], batch_size=batch_size), strict=True) for e in d.ents]
            yield pd.DataFrame(found, columns=["record_id", "label", "entidad", "inicio", "t"])

    return tagged_by(tag)


def tagged_by(tagger: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]):
    """A tagger over Arrow batches of ``record_id, t``; a model is loaded once per Python worker."""
    return lambda texts: texts.select("record_id", "t").mapInPandas(tagger, "record_id string, label string, entidad string, inicio int, t string")


def candidates(texts: DataFrame, frequency: DataFrame | None = None, max_df: int = 20, text: str = "texto", tagger=capitalised_runs, labels=("PER", "LOC", "ORG"), corpus: DataFrame | None = None) -> DataFrame:
    """Entities of some texts all of whose words are rare: by a table of frequencies or else in the documents of ``corpus``.  Then
    the entities found are written once (``store.written``), as their words decide which ones are counted in the corpus."""
    masked = texts.select("record_id", X.mask_placeholders(F.col(text)).alias("t"))
    found = tagger(masked).where(F.col("label").isin(*labels))
    name = X.sub(F.col("entidad"), r"^[ .,:;()\[\]\n]+|[ .,:;()\[\]\n]+$", "")
    found = found.withColumn("entidad", name).where((F.length("entidad") >= 3) & ~F.col("entidad").rlike(r"^\d+$") & (F.upper("entidad") != "XX"))
    found = found.withColumn("tokens", words(F.col("entidad"))).where((F.size("tokens") > 0) & ~F.arrays_overlap("tokens", F.array(*(F.lit(e) for e in V.EPONYMS))))
    begin = F.greatest(F.lit(0), F.col("inicio") - 70)
    context = F.replace(F.substring("t", begin + 1, F.col("inicio") + F.length("entidad") + 70 - begin), F.lit("\n"), F.lit(" "))
    found = found.select("record_id", "label", "entidad", "tokens", "inicio", context.alias("contexto"))
    found = store.written(found) if frequency is None else found
    # Frequencies of the distinct entities only, then back to their occurrences.
    names = found.select("entidad", F.explode("tokens").alias("token")).distinct()
    frequency = document_frequency(texts if corpus is None else corpus, text, names) if frequency is None else frequency
    rare = names.join(frequency, "token", "left").groupBy("entidad").agg(F.max(F.coalesce("df", F.lit(0))).alias("df_corpus")).where(F.col("df_corpus") <= max_df)
    return found.join(rare, "entidad").select("record_id", "label", "entidad", F.col("df_corpus").cast("bigint").alias("df_corpus"), "contexto", "inicio").orderBy("df_corpus", "record_id", "inicio")


def candidate_summary(found: DataFrame) -> DataFrame:
    order = F.struct(F.col("record_id").cast("bigint"), F.col("inicio"))
    rows = found.groupBy("entidad", "label").agg(F.count("*").alias("n"), F.min("df_corpus").alias("df_corpus"), F.min_by("contexto", order).alias("ejemplo"))
    return rows.orderBy(F.desc("n"), "entidad")


def run(corpus: DataFrame, out: str, top: int = 0, max_df: int = 20, include_upper: bool = False, tagger=capitalised_runs) -> tuple[DataFrame, DataFrame]:
    """The review of a corpus: candidates as ``<out>`` and their summary as ``<out without .csv>_resumen.csv``.  Of the
    indexable documents all count for the frequencies; then those in capitals go, unless ``include_upper``, and
    of the rest the ``top`` longest are reviewed (0: all)."""
    kept = corpus.where("indexable")
    reviewed = kept if include_upper else not_shouting(kept)
    reviewed = longest(reviewed, top) if top else reviewed
    work = out.removesuffix(".csv")
    candidates(reviewed, None, max_df, tagger=tagger, corpus=kept).write.mode("overwrite").parquet(f"{work}.parquet")
    found = corpus.sparkSession.read.parquet(f"{work}.parquet")
    rows, summary = found.drop("inicio"), candidate_summary(found)
    rows.write.mode("overwrite").option("header", True).csv(out)
    summary.write.mode("overwrite").option("header", True).csv(f"{work}_resumen.csv")
    return rows, summary
