"""The whole curation run: normalise, flag, redact, enrich, assemble, verify, and write."""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curalis.functions import values as V
from curalis.operators import corpus, enrich, quality, redact, verify
from curalis.sources import notes as source


REPORT_ROWS = 40


@dataclass
class Options:
    min_chars: int = V.MIN_CHARS
    sample: int = 250
    seed: int = 42
    notice_in_text: bool = False
    include_incomplete: bool = False
    lists: str | None = None
    abbreviations: str | None = None

    @property
    def column(self) -> str:
        return "indexable" if self.include_incomplete else "apto_rag"


def flagged(notes: DataFrame, options: Options | None = None, exported: bool = True, drop: tuple[str, ...] = ()) -> DataFrame:
    return quality.flags(quality.normalise(notes, exported), (options or Options()).min_chars, drop=drop)


def redacted(notes: DataFrame, options: Options | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    options = options or Options()
    return redact.redact_fields(flagged(notes, options, drop=drop), quality.KEYS, source.read_lists(options.lists))


def enriched(notes: DataFrame, options: Options | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Expansion follows redaction, and classification follows expansion."""
    options = options or Options()
    df = enrich.expand_fields(redacted(notes, options, drop), list(quality.KEYS), source.read_abbreviations(options.abbreviations))
    return enrich.classify(df)


def rewritten(notes: DataFrame, options: Options | None = None) -> DataFrame:
    """``redacted`` without flags: these drop no row, and what reads none of them need not compute and write them."""
    options = options or Options()
    return redact.redact_fields(quality.normalise(notes), quality.KEYS, source.read_lists(options.lists))


def labelled(notes: DataFrame, options: Options | None = None) -> DataFrame:
    """``enriched`` without flags, likewise."""
    options = options or Options()
    df = enrich.expand_fields(rewritten(notes, options), list(quality.KEYS), source.read_abbreviations(options.abbreviations))
    return enrich.classify(df)


def documents(notes: DataFrame, options: Options | None = None) -> DataFrame:
    options = options or Options()
    return corpus.assemble(enriched(notes, options, quality.UNREAD), options.notice_in_text)


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _csv_if_any(df: DataFrame, path: str) -> bool:
    """Written only where there is a row."""
    if df.isEmpty():
        return False
    _csv(df, path)
    return True


#: What a run may write, besides its manifest.
FILES = {
    "out": ("enriched.parquet", "corpus.parquet", "corpus_indexable.jsonl", "excluidos_rag.csv", "log_reemplazos.csv", "residuo.parquet"),
    "reports": ("residuo_phi.csv", "muestra_revision_manual.csv", "medicos_no_whitelist.csv", "hospital_tokens_anonimizados.csv", "reporte_anonimizacion.html"),
}


class Attempt:
    """A run that has not ended.  Its files are written beside their places, in a folder named after input and options; a
    phase that is complete leaves a mark with its figures, and a run that is started again goes on after the last mark.
    When all phases are complete the old manifest goes, files are moved to their places, and the new manifest is written last: as
    long as there is a manifest, the files are those of one run."""

    def __init__(self, spark: SparkSession, out: str, reports: str, key: str):
        self.spark, self.out, self.reports = spark, out, reports
        self.folders = {"out": f"{out}/_attempt-{key}", "reports": f"{reports}/_attempt-{key}"}
        self.files: dict[str, tuple[str, str]] = {}

    def add(self, kind: str, name: str) -> None:
        """A file of ``out`` or ``reports``: where it is written, and its place."""
        self.files[name] = (f"{self.folders[kind]}/{name}", f"{getattr(self, kind)}/{name}")

    def _store(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def phase(self, name: str, work) -> dict:
        """The figures of a phase, from its mark if it was completed before."""
        mark = f"{self.folders['out']}/{name}.done"
        if source.exists(self.spark, mark):
            return json.loads(source.read_text(self.spark, mark))
        figures = work()
        source.write_text(self.spark, mark, json.dumps(figures, ensure_ascii=False))
        return figures

    def commit(self, manifest: dict) -> None:
        """Files to their places, each replacing what was there, then the manifest.  After a failure it can be repeated."""
        store, target = self._store(f"{self.out}/manifest.json")
        moving = f"{self.folders['out']}/moving"
        if not source.exists(self.spark, moving):
            store.delete(target, True)
            for _, to in self.files.values():
                there, where = self._store(to)
                there.delete(where, True)
            source.write_text(self.spark, moving, "")
        for made, to in self.files.values():
            there, where = self._store(made)
            if there.exists(where):
                there.delete(self._store(to)[1], True)
                there.rename(where, self._store(to)[1])
        source.write_text(self.spark, f"{self.out}/manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2))
        for folder in self.folders.values():
            there, where = self._store(folder)
            there.delete(where, True)


def run(spark: SparkSession, path: str | None, out: str, reports: str, options: Options | None = None, say=lambda line: None) -> dict:
    """All files of a run; returns the manifest.  ``say`` gets the lines of a summary.  What several files are made
    from is computed once: the enriched notes and the residue are written, and the counts of the quality report are observed while the
    notes are written, not by scans of their own.  A run that was cut off goes on where it was (``Attempt``)."""
    options, began = options or Options(), time.time()
    path = path or source.discover(spark)
    digest = source.sha256(spark, path)
    say(f"[0] {path} sha256={digest[:16]}")
    chosen = [source.read_lists(options.lists), source.read_abbreviations(options.abbreviations)]
    key = hashlib.sha256(json.dumps([digest, asdict(options), chosen], sort_keys=True).encode()).hexdigest()[:16]
    attempt = Attempt(spark, out, reports, key)
    for kind, names in FILES.items():
        for name in names:
            attempt.add(kind, name)
    at = report_at = lambda name: attempt.files[name][0]

    def enrich_notes() -> dict:
        seen = Observation()
        rows = enriched(source.to_notes(source.read_csv(spark, path)), options)
        rows.observe(seen, *(F.count_if(x).alias(n) for n, x in quality.counted().items())).write.mode("overwrite").parquet(at("enriched.parquet"))
        return seen.get

    # Files are read in phases only: those of a run that was cut off while they were moved may be in their places.
    rows, docs = (lambda n=n: spark.read.parquet(at(n)) for n in ("enriched.parquet", "corpus.parquet"))
    found_counts = attempt.phase("enriched", enrich_notes)

    def write_corpus() -> dict:
        corpus.write(corpus.assemble(rows(), options.notice_in_text), attempt.folders["out"], options.column)
        return {}

    attempt.phase("corpus", write_corpus)
    n_kept = found_counts[options.column]
    attempt.phase("log", lambda: {"rows": _csv_if_any(redact.replacement_log(rows()), at("log_reemplazos.csv"))})

    def small(df: DataFrame, limit: int | None = None) -> list[list]:
        return [df.columns, [list(r) for r in (df if limit is None else df.limit(limit)).collect()]]

    def write_residue() -> dict:
        verify.residue(docs().where(options.column), lists=chosen[0]).write.mode("overwrite").parquet(at("residuo.parquet"))
        found = spark.read.parquet(at("residuo.parquet"))
        _csv_if_any(found, report_at("residuo_phi.csv"))
        return {"summary": small(verify.residue_summary(found, n_kept)), "examples": small(found.where("veredicto = 'revisar'"), REPORT_ROWS)}

    residue = attempt.phase("residue", write_residue)

    def write_sample() -> dict:
        sample = verify.review_sample(docs(), options.sample, options.seed, options.column)
        _csv(sample.select("record_id", "n_chars_doc", "mecanismo_lesion", "desenlace", "truncado", "texto"), report_at("muestra_revision_manual.csv"))
        return {}

    attempt.phase("sample", write_sample)

    def write_tokens() -> dict:
        doctors, hospitals = redact.kept_doctors(rows()), redact.hospital_tokens(rows())
        _csv_if_any(doctors.withColumnRenamed("token", "token_tras_dr"), report_at("medicos_no_whitelist.csv"))
        _csv_if_any(hospitals.withColumnRenamed("token", "token_tras_hospital"), report_at("hospital_tokens_anonimizados.csv"))
        labels = {k: small(enrich.label_counts(docs().where(options.column), k)) for k in ("mecanismo_lesion", "desenlace")}
        return {"doctors": small(doctors, REPORT_ROWS), "rules": small(redact.rule_counts(redact.replacement_log(rows()))), "labels": labels}

    tokens = attempt.phase("tokens", write_tokens)
    total = max(found_counts["total"], 1)
    quality_rows = [["metrica", "n", "pct"], [[n, k, round(k / total * 100, 2)] for n, k in found_counts.items()]]
    excluded = {"truncados": found_counts["excluido_truncado"], "incompletos": found_counts["excluido_incompleto"]} if options.column == "apto_rag" else {}
    report = verify.html_report(
        n_kept,
        {
            "1. Calidad del corpus": quality_rows,
            "2. Reemplazos aplicados": tokens["rules"],
            "3. Residuo tras la anonimización": residue["summary"],
            "4. Ejemplos de residuo": residue["examples"],
            "5. Tokens tras Dr/Dra fuera de la lista": tokens["doctors"],
        },
        REPORT_ROWS,
    )
    source.write_text(spark, report_at("reporte_anonimizacion.html"), report)
    named = [dict(zip(residue["summary"][0], r, strict=True)) for r in residue["summary"][1]]
    manifest = {
        "generado": time.strftime("%Y-%m-%dT%H:%M:%S"),
        "entrada": path,
        "sha256_entrada": digest,
        "n_registros": found_counts["total"],
        "n_indexables": n_kept,
        "criterio_indice": options.column,
        "n_excluidos_indexables": excluded,
        "parametros": asdict(options),
        "calidad": found_counts,
        "reemplazos_por_regla": {r[0]: r[1] for r in tokens["rules"][1]},
        "residuo_por_detector": {r["detector"]: {"matches": r["n_matches"], "a_revisar": r["a_revisar"]} for r in named},
        "duracion_s": round(time.time() - began, 1),
    }
    attempt.commit(manifest)
    say(f"[2] {manifest['calidad']}")
    say(f"[3] {manifest['reemplazos_por_regla']}")
    for name, (_, counts) in tokens["labels"].items():
        say(f"[4] {name}: " + ", ".join(f"{r[0]} {r[1]:,}" for r in counts))
    say(f"[5] {n_kept:,} documentos al índice (criterio {options.column}); fuera: {excluded}")
    for r in named:
        say(f"[6] {r['detector']}: {r['n_matches']:,} matches, a revisar {r['a_revisar']:,} en {r['n_docs']:,} docs ({r['pct_docs_revisar']} %)")
    say(f"Listo en {manifest['duracion_s']} s: {out}/manifest.json")
    return manifest


def excluded_counts(df: DataFrame) -> DataFrame:
    i, t = F.col("indexable"), F.col("truncated")
    return df.agg(F.count_if(i & t).alias("truncados"), F.count_if(i & ~t & F.col("incompleto")).alias("incompletos"))
