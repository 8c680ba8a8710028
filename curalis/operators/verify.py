"""Independent residue detection, verdicts, the stratified review sample and the HTML report."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curalis.functions import fold, gazetteer
from curalis.functions import text as X
from curalis.functions import values as V
from curalis.operators.redact import known


def _verdict(detector: str, match: Column, context: Column, lists, found: Column | None = None) -> Column:
    token = lambda pattern: F.lower(X.unaccent(F.regexp_extract(match, "(?iU)" + pattern, 1)))
    expected = F.lit(False)
    if detector == "anio":
        expected = _after(context, match).rlike("(?iU)" + V.UNIT_AFTER)
    elif detector == "trigger_institucion":
        expected = known(token(V.INSTITUTION_TOKEN), lists, "tipos_genericos", found) | known(token(V.INSTITUTION_TOKEN), lists, "hospital_genericos", found)
    elif detector == "trigger_medico":
        expected = (token(V.DOCTOR_TOKEN) != "") & ~known(token(V.DOCTOR_TOKEN), lists, "medicos", found)
    return F.when(expected, "esperado").otherwise("revisar")


def _after(context: Column, match: Column) -> Column:
    """What follows the first occurrence of the match in its context."""
    return F.substring(context, F.position(match, context) + F.length(match), F.length(context))


def _labelled(rows: Column, name: str) -> Column:
    return F.transform(rows, lambda x: F.struct(F.lit(name).alias("detector"), x["a"].alias("a"), x["b"].alias("b"), x["match"].alias("match")))


def residue(texts: DataFrame, text: str = "texto", lists=None) -> DataFrame:
    """One row for each match of each detector."""
    lists = V.LISTS if lists is None else lists
    kept = texts.where(F.col(text).isNotNull() & (F.col(text) != "")).select("record_id", fold.without_marks(F.col(text)).alias("t"))
    found = []
    for name, (pattern, ignore_case) in V.DETECTORS.items():
        rows = fold.spans(F.col("t"), ("(?iU)" if ignore_case else "(?U)") + pattern)
        found.append(_labelled(rows, name))
    names = gazetteer.large({k: lists[k] for k in ("tipos_genericos", "hospital_genericos", "medicos")})
    looked_up = gazetteer.finder(texts.sparkSession, names, set())(F.col("t")) if names else F.lit(None)
    rows = kept.select("record_id", "t", looked_up.alias("found"), F.explode(F.concat(*found)).alias("m"))
    begin = F.greatest(F.lit(0), F.col("m.a") - 60)
    context = F.replace(F.substring("t", begin + 1, F.col("m.b") + 60 - begin), F.lit("\n"), F.lit(" "))
    rows = rows.select("record_id", F.col("m.detector").alias("detector"), F.col("m.match").alias("match"), context.alias("contexto"), "found")
    verdict = F.coalesce(*(F.when(F.col("detector") == n, _verdict(n, F.col("match"), F.col("contexto"), lists, F.col("found") if names else None)) for n in ("anio", "trigger_institucion", "trigger_medico")), F.lit("revisar"))
    return rows.select("record_id", "detector", "match", verdict.alias("veredicto"), "contexto")


def residue_summary(found: DataFrame, n_texts: int) -> DataFrame:
    review = F.col("veredicto") == "revisar"
    rows = found.groupBy("detector").agg(F.count("*").alias("n_matches"), F.count_if(review).alias("a_revisar"), F.countDistinct(F.when(review, F.col("record_id"))).alias("n_docs"))
    return rows.withColumn("pct_docs_revisar", F.bround(F.col("n_docs") / F.lit(max(n_texts, 1)) * 100, 3)).orderBy(F.desc("a_revisar"), F.desc("n_matches"), "detector")


#: Bins of a histogram.
BINS = 1000
LEAST_ID = -(1 << 63)


def ranked_keys(rows: DataFrame, ranks: list[int]) -> list[tuple[int, int]]:
    """The keys ``(a, b)`` of the rows with some ranks (from 1), by refining a histogram: counts of a few bins, then of the
    bins of the one that holds the rank, first by ``a``, then by ``b``.  Tasks send counts only, and each round is one pass over
    two narrow columns for all ranks."""
    whole = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    low, high = rows.agg(F.min("a"), F.max("a")).first()
    found: dict[int, tuple[int, int]] = {}
    # For each rank: the value of ``a`` once known, the range still open, and the rank within it.
    open_ = {r: (None, low, high, r) for r in ranks} if low is not None else {}
    while open_:
        wanted = sorted({(a is None, a, lo, hi) for a, lo, hi, _ in open_.values()}, key=str)
        parts = []
        for i, (by_a, a, lo, hi) in enumerate(wanted):
            value = F.col("a" if by_a else "b")
            width = max(1, -(-(hi - lo + 1) // BINS))
            inside = (value >= F.lit(lo)) & (value <= F.lit(hi)) & (F.lit(True) if by_a else F.col("a") == F.lit(a))
            # Differences may exceed 64 bits.
            bin_ = F.call_function("div", value.cast("decimal(38,0)") - whole(lo), whole(width)).cast("int")
            parts.append(F.when(inside, F.struct(F.lit(i).alias("i"), bin_.alias("bin"))))
        counts: dict[tuple[int, int], int] = {}
        for r in rows.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect():
            counts[r["p"]["i"], r["p"]["bin"]] = r["n"]
        still = {}
        bounds = {}
        for rank, (a, lo, hi, left) in open_.items():
            i = wanted.index((a is None, a, lo, hi))
            width = max(1, -(-(hi - lo + 1) // BINS))
            for b in sorted(x for j, x in counts if j == i):
                if left <= counts[i, b]:
                    break
                left -= counts[i, b]
            lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
            if lo < hi:
                still[rank] = (a, lo, hi, left)
            elif a is None:
                bounds.setdefault(lo, []).append((rank, left))
            else:
                found[rank] = (a, lo)
        if bounds:
            for r in rows.where(F.col("a").isin(list(bounds))).groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).collect():
                for rank, left in bounds[r["a"]]:
                    if r["lo"] == r["hi"]:
                        found[rank] = (r["a"], r["lo"])
                    else:
                        still[rank] = (r["a"], r["lo"], r["hi"], left)
        open_ = still
    return [found[r] for r in ranks if r in found]


def review_sample(corpus: DataFrame, n: int = 250, seed: int = 42, column: str = "apto_rag") -> DataFrame:
    """A stratified sample by document length, biased to long documents; the order within a stratum is
    a hash of seed and id.  Strata are quarters of the ranks by length and id (a null id is the least): the three rows that end
    them are selected by histograms, and every document is compared with these.  No task sorts documents or holds those of
    one length.  Documents that share length and id are in one stratum."""
    key = F.coalesce(F.col("record_id").cast("bigint"), F.lit(LEAST_ID))
    kept = corpus.where(column).select("record_id", F.col("n_chars_doc").cast("bigint").alias("a"), key.alias("b"))
    total = kept.count()
    quarters = [1 + s * max(total - 1, 0) // 4 for s in (1, 2, 3)]
    # A stratum ends with the row of rank 1 + floor(s * (total - 1) / 4).
    cuts = ranked_keys(kept, quarters)
    above = [(F.col("a") > a) | ((F.col("a") == a) & (F.col("b") > F.lit(b))) for a, b in cuts]
    stratum = sum((x.cast("int") for x in above), F.lit(1))
    quotas = [max(1, round(n * w)) for _, w in V.STRATA]
    names, quota = (F.array(*map(F.lit, x)) for x in ([s for s, _ in V.STRATA], quotas))
    drawn = Window.partitionBy("__s").orderBy(F.md5(F.concat(F.lit(str(seed)), F.col("record_id"))), "record_id")
    # The literal bound lets each task keep so many rows of a stratum before anything is sent.
    picked = kept.select("record_id", stratum.alias("__s")).withColumn("__k", F.row_number().over(drawn)).where(F.col("__k") <= max(quotas))
    picked = picked.where(F.col("__k") <= F.get(quota, F.col("__s") - 1)).select("record_id", F.get(names, F.col("__s") - 1).alias("estrato"))
    # A sample of fixed size: the texts are fetched for it alone.
    return corpus.where(column).join(F.broadcast(picked), "record_id")


def html_report(n_docs: int, tables: dict[str, tuple[list[str], list]], limit: int = 40) -> str:
    """A page with the number of documents, key figures and the first rows of small tables, given as columns and rows."""
    text = lambda v: html.escape("" if v is None else str(v))

    def table(columns, rows) -> str:
        if not rows:
            return "<p>sin datos</p>"
        head = "".join(f"<th>{text(c)}</th>" for c in columns)
        return f"<table><tr>{head}</tr>" + "".join("<tr>" + "".join(f"<td>{text(v)}</td>" for v in r) + "</tr>" for r in rows[:limit]) + "</table>"

    kpis = {"documentos indexables": n_docs} | {f"{title}: filas": len(rows) for title, (_, rows) in tables.items()}
    out = ["<!DOCTYPE html><html lang='es'><meta charset='utf-8'><title>Reporte de anonimización</title><body><h1>Reporte de anonimización</h1>"]
    out += ["<ul>", *(f"<li>{text(k)}: <b>{v:,}</b></li>" for k, v in kpis.items()), "</ul>"]
    out += [f"<h2>{text(title)}</h2>{table(*rows)}" for title, rows in tables.items()]
    return "\n".join([*out, "</body></html>"])
