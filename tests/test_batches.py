"""Kernels on batches give what the column expressions give, and sieves let pass all that patterns find."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curalis.functions import batches
from curalis.functions import values as V
from curalis.operators import quality, redact
from curalis.plans import catalog
from tests.conftest import DATA

PIECES = (
    "a@b.co|c.c. 12 345|cédula 1234567|310 555 1234|+57 3105551234|1234567|1234567 cc|3 /4-2019|5 De Marzo|12 ago 19|11-jun2014|Agosto de 2018|2019|7 : 30 pm|15 años de edad|"
    "hace 15 años de edad|niña 3 DÍAS|bebé de 2 MES|paciente\n45 años|anciano 93 anos|neonato 0 años|Hospital San Rafael|CLÍNICA la aurora|ips  santa ana|hospital local|hospital tulipanes|"
    "clinica satisfactoria|fundacion san martin de porres|E.S.E. norte|HUC|huc|dr. Moncada|Dra perez|Jamundí|bolivar|signo de  bolivar|ernesto gil trujillo|CALI|localiza|rayito de sol|"
    "eſe ſan joſe|Kelvin İstmina|istmına|fx de codo|TAC, tac|ce en ojo|HPAF|me pegaron|me pegaron un tiro|dedo|dedo del pie|mano|tórax|uci|se da salida|laparotomía|caída de moto|cayó de|"
    "riña|palo|ộ|ﬁ|﷐x|\xa0|\t\t|\n\n\n|....|\"\"|\"|'|\" a\"|,a|;b|:c|,1| ,|\x01|\x85|123\"ABC|12 ABC|😀|de|del|con|,;:-|ª|º|Más|ÿ|ß|ΟΔΟΣ"
).split("|")


def _texts(n: int, seed: int) -> list[str | None]:
    rng = random.Random(seed)
    return [None, "", *(rng.choice([" ", " ", "  ", "", ",", "."]).join(rng.choice(PIECES) for _ in range(rng.randint(0, 7))) for _ in range(n))]


def test_redaction_in_batches(spark):
    """All fields of a note at once: texts and logs of ``redact`` on each field."""
    texts = [None, "", *(batches._clean(t, True) for t in _texts(900, 1)[2:])]
    rows = [(str(i), *texts[i : i + 3]) for i in range(0, len(texts) - 2, 3)]
    df = spark.createDataFrame(rows, "record_id string, reason_clean string, exam_clean string, stay_clean string")
    got = redact.redact_fields(df, quality.KEYS).collect()
    apart = spark.createDataFrame([(f"{r[0]} {n}", t) for r in rows for n, t in zip(quality.KEYS.values(), r[1:], strict=True)], "place string, t string")
    want = {r.place: r for r in redact.redact(apart, "t").collect()}
    assert len(got) == len(rows)
    for row in got:
        log = []
        for key, name in quality.KEYS.items():
            field = want[f"{row.record_id} {name}"]
            assert row[f"{key}_anon"] == field.t_anon
            log += [(name, *e) for e in field.t_log]
        assert [(e.campo, e.regla, e.original, e.placeholder, e.inicio, e.token) for e in row.events] == log


def test_sieves_let_pass_what_patterns_find():
    texts = [t for t in _texts(3000, 2) if t and max(t) <= "\xff"]
    column = pa.array(texts, batches.TEXT)
    lists = V.LISTS | {"municipios": [*V.LISTS["municipios"], ".x", "ñandú (alto)"], "instituciones_siglas": ["HUC", "C.C."]}
    for rule in batches.rules(json.dumps(lists)):
        passed = batches._found(column, rule.sieve)
        hits = [any(True for _ in rule.search(t)) for t in texts]
        assert any(hits) and all(p for p, h in zip(passed, hits, strict=True) if h), rule.name
        assert all([m.span() for m in rule.search(t)] == [m.span() for m in rule.search(t, False)] for t in texts), rule.name
    assert batches.sieve(r"\ba(?!\s*(?:b|c\)))d\b") and batches.sieve("ſ") is None


@pytest.mark.parametrize("name", ["redact_counts", "kept_doctors", "redact_texts", "municipality_exceptions"])
def test_redaction_needs_no_flags(spark, monkeypatch, name):
    """What reads no flag writes no notes, and texts are rewritten on batches, in one step."""
    monkeypatch.setattr(quality, "flags", None)
    plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rewritten_texts(") == plan.count("ArrowEvalPython [rewritten_texts(") == 1


def test_cleaning_and_keys_in_batches(spark):
    from curalis.functions import text as X

    texts = _texts(1500, 3)
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for exported in (True, False):
        got = batches.cleaned(pa.array(texts, pa.string()), exported).to_pylist()
        assert got == [r[0] for r in df.select(X.clean(F.col("t"), exported)).collect()]
    want = df.select(X.match_key(F.col("t")), X.label_key(F.coalesce("t", F.lit("")))).collect()
    assert batches.match_keys(pa.array(texts, pa.string())).to_pylist() == [r[0] for r in want]
    assert [batches.label_key(t or "") for t in texts] == [r[1] for r in want]
    ends = ["de", "sala de", "según", "x MÁS", "con,", ",;-el-", "adel", "", "a\nlos", "dè", "ộ de", "desde.", "x del :"]
    assert batches.ends_open(pa.array(ends)).to_pylist() == [True, True, False, True, True, True, False, False, True, True, True, False, False]


def test_expansion_and_labels_in_batches(spark):
    """As the expressions; what flags, labels and expansions are made of is computed on batches."""
    from curalis.operators import enrich
    from curalis.plans import pipeline as P

    texts = [None, "", *(batches._clean(t, True) for t in _texts(600, 4)[2:])]
    df = spark.createDataFrame([("", t, texts[i - 1]) for i, t in enumerate(texts)], "reason_anon string, exam_anon string, stay_anon string").coalesce(1)
    for table in (V.ABBREVIATIONS, {"c.e": "x", "tac": "y"}, {}):
        want = [r[0] for r in df.select(enrich.expand(F.col("exam_anon"), table)).collect()]
        got = enrich.expand_fields(df.select("exam_anon"), ["exam"], table).collect()
        assert [(r.exam_anon, r.abreviaturas) for r in got] == [(w.text, sorted(w["keys"])) for w in want]
    e, s = (F.coalesce(c, F.lit("")) for c in ("exam_anon", "stay_anon"))
    body = F.concat(e, F.lit(" "), s)
    want = df.select(enrich.mechanism(F.lit(""), body), enrich.regions(body), enrich.outcome(body)).collect()
    assert [tuple(r[3:]) for r in enrich.classify(df).collect()] == [tuple(r) for r in want]
    plan = P.labelled(catalog.a(spark, DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert {step: plan.count(f"{step}(") for step in ("clean_texts", "rewritten_texts", "expanded_texts", "labels_of")} == dict(clean_texts=1, rewritten_texts=1, expanded_texts=1, labels_of=1)
