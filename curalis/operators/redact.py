"""Ordered rewrite rules with an audit log, and the counts drawn from it."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curalis.functions import batches, fold, gazetteer
from curalis.functions import text as X
from curalis.functions import values as V

I, U = "(?iU)", "(?U)"


def _key(token: Column) -> Column:
    return F.lower(X.unaccent(token))


def _always(placeholder: str):
    return lambda found, pos: F.lit(placeholder)


def _age(found: list[Column], value: int, unit: int) -> Column:
    return X.age_band(found[value].cast("int"), found[unit])


def _person_age(found: list[Column], pos: Column) -> Column:
    # The text before the number stays: what is left of the match without number, blanks and unit.
    before = F.regexp_extract(found[0], r"(?s)^(.*?)\d{1,3}\s*\p{L}+$", 1)
    return F.concat(before, _age(found, 1, 2))


#: Lists that stand in patterns; the others are looked up by word.
IN_PATTERNS = {"instituciones", "instituciones_sin_trigger", "municipios", "tipos_genericos"}
#: Lists that may have any number of names.
LOOKED_UP = IN_PATTERNS | {"medicos", "hospital_genericos"}


def large(lists: dict[str, list[str]]) -> dict[str, list[str]]:
    return gazetteer.large({k: v for k, v in lists.items() if k in LOOKED_UP})


def any_name(lists: dict[str, list[str]], name: str, before: str, after: str, found: Column | None) -> str | Column:
    """The pattern with any name of a list; of a large one, with those found in the text."""
    if found is not None and name in large(lists):
        return gazetteer.alternation(found[name], before, after)
    return f"{before}{X.one_of(lists[name])}{after}"


def known(token: Column, lists: dict[str, list[str]], name: str, found: Column | None) -> Column:
    """Whether a list has the word; of a large one, whether it is among those found in the text."""
    if found is not None and name in large(lists):
        return F.array_contains(found[name], token)
    words = [x.lower() for x in lists[name]]
    return token.isin(words) if words else F.lit(False)


def rules(lists: dict[str, list[str]]) -> list[tuple[str, object]]:
    """Rules in the order in which they apply, each with its name; an empty list has no rule.  A rule is a function of the
    names of large lists found in the text (or none) that gives ``(pattern, decision, groups)`` and, where there is one, what every match holds (a pattern of figures and signs, then one of names)."""
    unit = rf"(?!\s*{V.UNITS})"

    def fixed(name: str, pattern: str, decide, groups: int = 0, needs: str | None = None):
        return name, lambda found: (pattern, decide, groups, needs)

    def named(list_name: str, before: str, after: str):
        return lambda found: any_name(lists, list_name, before, after, found)

    out = [
        fixed("email", U + V.EMAIL, _always("[EMAIL]"), needs="@"),
        fixed("documento", I + V.DOCUMENT, _always("[DOCUMENTO]"), needs=U + r"\d[\d\.\s]{3,15}\d"),
        fixed("telefono", U + V.PHONE, _always("[TELEFONO]"), needs=U + r"3\d{2}[\s-]?\d{3}"),
        fixed("numero_id", I + V.LONG_NUMBER + unit, _always("[NUMERO_ID]"), needs=U + r"\d{7}"),
    ]
    if lists["instituciones_sin_trigger"]:
        plain = named("instituciones_sin_trigger", rf"{I}\b", r"\b")
        out.append(("institucion", lambda found: (plain(found), _always("[INSTITUCION]"), 0)))
    if lists["instituciones"]:
        after_type = named("instituciones", rf"{I}{V.INSTITUTION}{V.FILLER}\s+", r"\b")
        generic = named("tipos_genericos", rf"{I}^{V.INSTITUTION}\s+", r"\s*$")
        veto = lambda found: lambda bits, pos: F.when(~fold.holds(bits[0], generic(found)), F.lit("[INSTITUCION]"))
        # A name follows white space; to look for names first takes less than to look for types of institutions.
        listed = None if "instituciones" in large(lists) else rf"{I}\s{X.one_of(lists['instituciones'])}"
        out.append(("institucion", lambda found: (after_type(found), veto(found) if lists["tipos_genericos"] else _always("[INSTITUCION]"), 0, None, listed)))
    hospital = lambda found: lambda bits, pos: F.when(~known(_key(bits[1]), lists, "hospital_genericos", found), F.lit("[INSTITUCION]"))
    doctor = lambda found: lambda bits, pos: F.when(known(_key(bits[1]), lists, "medicos", found), F.lit("[MEDICO]"))
    out += [
        ("institucion_santoral", lambda found: (I + V.SAINT, _always("[INSTITUCION]"), 0, None, I + r"\ss[aá]n")),
        ("institucion_hospital", lambda found: (I + V.HOSPITAL, hospital(found), 1)),
    ]
    if lists["instituciones_siglas"]:
        out.append(fixed("institucion_sigla", rf"{U}\b{'(?:' + '|'.join(map(_quote, lists['instituciones_siglas'])) + ')'}\b", _always("[INSTITUCION]")))
    return out + [
        ("medico", lambda found: (I + V.DOCTOR, doctor(found), 1)),
        fixed("fecha", U + V.DATE, _always("[FECHA]"), needs=U + r"\d\s*[/\-.]\s*\d"),
        fixed("fecha", I + V.TEXT_DATE, _always("[FECHA]"), needs=U + r"\d\s*[-/. dD]"),
        fixed("fecha", I + V.MONTH_YEAR, _always("[FECHA]"), needs=U + r"(?:19|20)\d{2}"),
        fixed("hora", I + V.TIME, _always("[HORA]"), needs=U + r"\d\s*:"),
        fixed("anio", I + V.YEAR + unit, _always("[ANIO]"), needs=U + r"(?:19[5-9]|20[0-3])\d"),
        fixed("edad", I + V.AGE_SUFFIX, lambda bits, pos: _age(bits, 1, 2), 2, I + r"\d\s*(?:a[nñ]o|mes)"),
        fixed("edad", I + V.AGE_PERSON, _person_age, 2, I + r"\d\s*(?:a[nñ]o|mes|d[ií]a)"),
    ]


def _quote(s: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in s)


def _places(s: Column, lists: dict[str, list[str]], found: Column | None) -> Column:
    pattern = any_name(lists, "municipios", rf"{I}\b", r"\b", found)
    spans = [fold.spans(s["text"], I + p) for p in lists["municipios_excepciones"]]
    out = F.flatten(F.array(*spans)) if spans else F.array().cast("array<struct<a:int,b:int,match:string>>")
    outside = lambda out: lambda m, pos: F.when(~F.exists(out, lambda x: (x["a"] <= pos) & (pos < x["b"])), F.lit("[MUNICIPIO]"))
    return F.when(fold.holds(s["text"], pattern), fold.let(out, lambda out: fold.rewritten(s, "municipio", pattern, outside(out)))).otherwise(s)


def rewritten(now: Column, lists: dict[str, list[str]], only: set[str] | None = None, found: bool = False) -> Column:
    """The states that an array of states ends in, all rules applied in order; ``only`` names the rules to apply.
    One expression, in which each state occurs once: it is analysed and computed once.  With ``found``, the
    array holds pairs of a state and the names found in its text."""

    def applied(name: str, rule):
        if found:
            return lambda x: F.struct(fold.rewritten(x["state"], name, *rule(x["found"])).alias("state"), x["found"].alias("found"))
        return lambda s: fold.rewritten(s, name, *rule(None))

    for name, rule in rules(lists):
        if only is None or name in only:
            now = F.transform(now, applied(name, rule))
    if lists["municipios"] and (only is None or "municipio" in only):
        now = F.transform(now, lambda x: F.struct(_places(x["state"], lists, x["found"]).alias("state"), x["found"].alias("found")) if found else _places(x, lists, None))
    return F.transform(now, lambda x: x["state"]) if found else now


def rewrite_texts(df: DataFrame, texts: list[Column], name: str, lists: dict[str, list[str]], only: set[str] | None = None) -> DataFrame:
    """``name``: the final states of some texts, as an array."""
    names = large(lists)
    if not names:
        return df.withColumn(name, rewritten(F.array(*map(fold.state, texts)), lists, only))
    finder = gazetteer.finder(df.sparkSession, names, IN_PATTERNS)
    df = df.withColumns({f"__found{i}": finder(fold.without_marks(t)) for i, t in enumerate(texts)})
    pairs = F.array(*(F.struct(fold.state(t).alias("state"), F.col(f"__found{i}").alias("found")) for i, t in enumerate(texts)))
    return df.withColumn(name, rewritten(pairs, lists, only, True)).drop(*(f"__found{i}" for i in range(len(texts))))


def redact(df: DataFrame, column: str, lists: dict[str, list[str]] | None = None, only: set[str] | None = None) -> DataFrame:
    """``<column>_anon`` and ``<column>_log`` for a text column."""
    df = rewrite_texts(df, [F.coalesce(column, F.lit(""))], "__s", V.LISTS if lists is None else lists, only).withColumn("__s", F.get("__s", F.lit(0)))
    return df.withColumns({f"{column}_anon": F.col("__s.text"), f"{column}_log": F.col("__s.log")}).drop("__s")


def _named(log: Column, field: str) -> Column:
    names = {"rule": "regla", "original": "original", "placeholder": "placeholder", "start": "inicio", "token": "token"}
    return F.transform(log, lambda x: F.struct(F.lit(field).alias("campo"), *(x[k].alias(v) for k, v in names.items())))


def _in_batches(fields: dict[str, str], lists: dict[str, list[str]]):
    """A column function of texts: a struct of their rewritten texts and the log of all."""
    names, packed = list(fields.values()), json.dumps(lists)
    keys = [f"{key}_anon" for key in fields]

    @F.arrow_udf(", ".join(f"{k} string" for k in keys) + ", events array<struct<campo:string,regla:string,original:string,placeholder:string,inicio:int,token:string>>")
    def rewritten_texts(*texts: pa.Array) -> pa.Array:
        done, log = batches.redacted(list(texts), names, packed)
        return pa.StructArray.from_arrays([*done, log], [*keys, "events"])

    return rewritten_texts


def redact_fields(df: DataFrame, fields: dict[str, str], lists=None) -> DataFrame:
    """Each ``<key>_clean`` redacted to ``<key>_anon``, all in one pass; all logs in one array with the field's name.  With lists
    that stand in patterns as a whole, on batches of texts (``batches.redacted``)."""
    lists = V.LISTS if lists is None else lists
    if large(lists):
        df = rewrite_texts(df, [F.coalesce(f"{key}_clean", F.lit("")) for key in fields], "__s", lists)
        at = lambda i: F.get("__s", F.lit(i))
        logs = [_named(at(i)["log"], name) for i, name in enumerate(fields.values())]
        df = df.withColumns({f"{key}_anon": at(i)["text"] for i, key in enumerate(fields)} | {"events": F.concat(*logs)}).drop("__s")
    else:
        df = df.withColumn("__s", _in_batches(fields, lists)(*(F.col(f"{key}_clean") for key in fields)))
        df = df.withColumns({name: F.col(f"__s.{name}") for name in (*(f"{key}_anon" for key in fields), "events")}).drop("__s")
    made = F.filter("events", lambda x: x["placeholder"].isNotNull())
    return df.withColumns({"n_reemplazos_phi": F.size(made), "tipos_phi": F.array_sort(F.array_distinct(F.transform(made, lambda x: x["regla"])))})


def replacement_log(df: DataFrame) -> DataFrame:
    rows = df.select("record_id", F.explode_outer("events").alias("e")).where("e.placeholder is not null")
    return rows.select("record_id", "e.campo", "e.regla", "e.original", "e.placeholder", "e.inicio")


def rule_counts(log: DataFrame) -> DataFrame:
    """Replacements and records per rule, most frequent first."""
    return log.groupBy("regla").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("n_registros")).orderBy(F.desc("n"), "regla")


def kept_doctors(df: DataFrame) -> DataFrame:
    """Tokens after a doctor's title that no list has, with counts."""
    rows = df.select(F.explode_outer("events").alias("e")).where("e.regla = 'medico' and e.placeholder is null")
    return rows.groupBy(_key(F.col("e.token")).alias("token")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token")


def hospital_tokens(df: DataFrame) -> DataFrame:
    """Tokens after "hospital" that were taken for names, with counts."""
    rows = df.select(F.explode_outer("events").alias("e")).where("e.regla = 'institucion_hospital' and e.placeholder is not null")
    return rows.groupBy(_key(F.col("e.token")).alias("token")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token")
