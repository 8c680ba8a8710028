"""Command line: ``python -m curalis run | review | mine``."""

from __future__ import annotations

import argparse
from pathlib import Path

from curalis.functions import values as V
from curalis.operators import mining, review
from curalis.plans import pipeline
from curalis.sources import notes as source

TOP_ROWS = 30


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="curalis", description=__doc__)
    kinds = parser.add_subparsers(dest="command", required=True)
    run = kinds.add_parser("run", help="curate a file of notes")
    run.add_argument("--entrada", help=f"the file; else the first of {', '.join(V.DEFAULT_PATHS)}")
    run.add_argument("--salida", default="outputs")
    run.add_argument("--reportes", default="reports")
    run.add_argument("--config", help="folder with gazetteers.yaml and abreviaturas.yaml; else the built-in lists")
    run.add_argument("--min-chars", type=int, default=V.MIN_CHARS)
    run.add_argument("--muestra", type=int, default=250)
    run.add_argument("--seed", type=int, default=42)
    run.add_argument("--aviso-en-texto", action="store_true", help="the notice of truncation within the text")
    run.add_argument("--incluir-incompletos", action="store_true", help="index all that is indexable")
    ner = kinds.add_parser("review", help="entity candidates of a corpus")
    ner.add_argument("--corpus", default="outputs/corpus.parquet")
    ner.add_argument("--salida", default="reports/ner_revision.csv")
    ner.add_argument("--top", type=int, default=0, help="only the longest documents (0: all)")
    ner.add_argument("--max-df", type=int, default=20)
    ner.add_argument("--incluir-mayus", action="store_true")
    ner.add_argument("--modelo", nargs="?", const=review.MODEL, help="a spaCy model; else runs of capitalised words")
    mine = kinds.add_parser("mine", help="draft word lists from a file of notes")
    mine.add_argument("--entrada", help="as for run")
    mine.add_argument("--salida", default="config/gazetteers.yaml")
    return parser


def main(arguments: list[str] | None = None, spark=None) -> None:
    args = _parser().parse_args(arguments)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("curalis").getOrCreate()
    try:
        path = (args.entrada or source.discover(spark)) if args.command != "review" else args.corpus
        if not source.exists(spark, path):
            raise FileNotFoundError(path)
    except FileNotFoundError as missing:
        raise SystemExit(f"not found: {missing}") from None
    if args.command == "run":
        lists, table = (str(p) if args.config and (p := Path(args.config) / n).exists() else None for n in ("gazetteers.yaml", "abreviaturas.yaml"))
        options = pipeline.Options(args.min_chars, args.muestra, args.seed, args.aviso_en_texto, args.incluir_incompletos, lists, table)
        pipeline.run(spark, path, args.salida, args.reportes, options, print)
    elif args.command == "review":
        tagger = review.model_tagger(args.modelo) if args.modelo else review.capitalised_runs
        found, summary = review.run(spark.read.parquet(path), args.salida, args.top, args.max_df, args.incluir_mayus, tagger)
        print(f"candidates: {found.count():,}, distinct: {summary.count():,}, in {args.salida}")
        for r in summary.orderBy(summary.n.desc(), "entidad").limit(TOP_ROWS).collect():
            print(f"  {r['entidad']} ({r['label']}): {r['n']}, df {r['df_corpus']}")
    else:
        lists = mining.draft_lists(mining.blobs(source.to_notes(source.read_loose_csv(spark, path))), args.salida)
        print(", ".join(f"{k}: {len(v)}" for k, v in lists.items()), "->", args.salida)


if __name__ == "__main__":
    main()
