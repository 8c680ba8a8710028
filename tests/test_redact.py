"""Rewrite rules, their log and their order; expansion and labels."""

import pytest
from pyspark.sql import functions as F

from curalis.functions import values as V
from curalis.operators import enrich, redact
from curalis.plans import pipeline as P

REPLACED = [
    ("cc 1.234.567 vive sola", "[DOCUMENTO]"),
    ("historia clínica n° 998877 abierta", "[DOCUMENTO]"),
    ("radicado 12345678 anexo", "[NUMERO_ID]"),
    ("escribir a ana.gil@correo.co", "[EMAIL]"),
    ("celular 310 555 1234", "[TELEFONO]"),
    ("ingresa 15/058/2019", "[FECHA]"),
    ("el 3 de marzo de 2018 consulta", "[FECHA]"),
    ("el 11-jun2014 consulta", "[FECHA]"),
    ("desde enero de 2017", "[FECHA]"),
    ("a las 14:35 hrs", "[HORA]"),
    ("cirugia en 2012 previa", "[ANIO]"),
    ("mujer de 34 años", "[EDAD:30-39]"),
    ("niño 7 años", "[EDAD:5-9]"),
    ("lactante de 8 meses", "[EDAD:<1 año]"),
    ("neonato de 9 días", "[EDAD:<1 mes]"),
    ("anciano de 93 años", "[EDAD:90+]"),
    ("44 años de edad", "[EDAD:40-49]"),
    ("remitida de Hospital San Rafael", "[INSTITUCION]"),
    ("llega de CLÍNICA la aurora", "[INSTITUCION]"),
    ("atendido en rayito de sol", "[INSTITUCION]"),
    ("hospital sann matias", "[INSTITUCION]"),
    ("hospital tulipanes", "[INSTITUCION]"),
    ("remite HUC hoy", "[INSTITUCION]"),
    ("valora Dr. Moncada", "[MEDICO]"),
    ("procedente de Jamundí", "[MUNICIPIO]"),
]
KEPT = ["glasgow 13/15", "ta 120/80", "adrenalina 1:1000", "drena 2000 cc", "hace 3 días", "hace 4 años de edad", "evolución clínica satisfactoria", "ojo dr. sangrado", "hospital local", "remitido al hospital más cercano", "signo de bolivar presente", "huc minuscula", "3 cm de largo", "drenado 1234567 cc"]


def run(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [(r.t_anon, r.t_log) for r in redact.redact(df, "t", **options).orderBy("i").collect()]


def test_replaced(spark):
    for (text, want), (got, log) in zip(REPLACED, run(spark, [t for t, _ in REPLACED]), strict=True):
        assert want in got, (text, got)
        for e in log:
            if e.placeholder and len([x for x in log if x.placeholder]) == 1:
                assert text[e.start :].startswith(e.original), (text, e)


def test_kept(spark):
    assert [g for g, _ in run(spark, KEPT)] == KEPT


def test_order_log_and_marks(spark):
    got, log = run(spark, ["😀 dr. doctor moncada, hospital de buga en buga ﷐x"])[0]
    assert got == "😀 dr. doctor moncada, [INSTITUCION] en [MUNICIPIO] x"
    kept = [e for e in log if e.placeholder is None]
    assert [e.token for e in kept] == ["doctor"] and kept[0].start == 2
    again = run(spark, [got])[0][0]
    assert again == got
    assert run(spark, [None, ""]) == [("", []), ("", [])]


def test_empty_lists(spark):
    lists = {k: [] for k in V.LISTS}
    assert run(spark, ["dr. moncada de cali en hospital local"], lists=lists)[0][0] == "dr. moncada de cali en [INSTITUCION]"


def test_expand_and_classify(spark):
    df = spark.createDataFrame([("FX de codo y fx de mano por HPAF",)], "t string")
    x = df.select(enrich.expand(F.col("t"), V.ABBREVIATIONS).alias("x")).first().x
    assert x.text == "FX (fractura) de codo y fx de mano por HPAF (herida por arma de fuego)" and x.keys == ["fx", "hpaf"]
    assert df.select(enrich.expand(F.col("t"), {}).alias("x")).first().x.text == "FX de codo y fx de mano por HPAF"
    label = lambda r, b: df.select(enrich.mechanism(F.lit(r), F.lit(b))).first()[0]
    assert label("me pegaron un tiro", "") == "arma_de_fuego" and label("me pegaron", "") == "contundente"
    assert label("dolor", "caída de moto") == "caida" and label("", "") == "no_determinado"
    assert label("", "CE (cuerpo extrano) en ojo") == "cuerpo_extrano"
    r = df.select(enrich.regions(F.lit("Trauma en ojo y dedo del pie, FAST abdominal")), enrich.outcome(F.lit("Cirugía: laparotomía, luego alta médica"))).first()
    assert r[0] == ["ojo", "abdomen", "miembro_inferior"] or "abdomen" in r[0]
    assert r[1] == "cirugia"


def test_whole_run_counts(spark):
    rows = [("1", "Años", "Caida", "hombre de 40 años, dr. perez", "hospital tulipanes el 01/02/2020")]
    df = P.enriched(spark.createDataFrame(rows, "record_id string, unit string, reason string, exam string, stay string"))
    r = df.first()
    assert r.n_reemplazos_phi == 3 and r.tipos_phi == ["edad", "fecha", "institucion_hospital"]
    assert redact.kept_doctors(df).collect()[0].token == "perez"
    assert redact.hospital_tokens(df).collect()[0].token == "tulipanes"
    log = redact.replacement_log(df)
    assert {(x.campo, x.regla) for x in log.collect()} == {(V.EXAM, "edad"), (V.STAY, "institucion_hospital"), (V.STAY, "fecha")}
    assert redact.rule_counts(log).count() == 3


def test_prefix_of_an_age_keeps_its_line_end(spark):
    df = spark.createDataFrame([("paciente\n45 años consulta",), ("Niña de\n3 meses",)], "t string")
    assert [r.t_anon for r in redact.redact(df, "t").collect()] == ["paciente\n[EDAD:40-49] consulta", "Niña de\n[EDAD:<1 año]"]


def test_private_use_characters_stay(spark):
    df = spark.createDataFrame([("\ue000 logo \ue001 el 12/03/2019",)], "t string")
    assert redact.redact(df, "t").first().t_anon == "\ue000 logo \ue001 el [FECHA]"


def test_keys_with_punctuation_are_literal(spark):
    from curalis.operators import enrich

    df = spark.createDataFrame([("cxe y ce, c.e y C.E",), ("a+b",)], "t string")
    got = [r.x for r in df.select(enrich.expand(F.col("t"), {"C.e": "cuerpo extrano", "ce": "x"}).alias("x")).collect()]
    assert [g.text for g in got] == ["cxe y ce (x), c.e (cuerpo extrano) y C.E", "a+b"] and got[0].keys == ["ce", "c.e"]


def test_plan_grows_with_the_rules_only(spark):
    """Each state occurs once: a rule adds its own expression and does not double what is there."""
    from curalis.functions import values as V

    df = spark.createDataFrame([("x",)], "t string")
    names = [n for n, _ in redact.rules(V.LISTS)]
    size = lambda only: len(redact.redact(df, "t", only=only)._jdf.queryExecution().analyzed().toString())
    empty, every = size(set()), size(None)
    assert every - empty <= sum(size({n}) - empty for n in {*names, "municipio"}) * 1.1


def test_lists_as_trees_and_needed_parts(spark):
    """A tree of names matches as the alternation of all does, longest name first; a pattern's needed letters are in what it finds;
    and a rule finds nothing in texts without its needed part."""
    import random
    import re

    from curalis.functions import text as X

    rng = random.Random(1)
    for names in (V.LISTS["municipios"], V.LISTS["tipos_genericos"], ["a", "ab", "a b", "ab c", "b", "a b c"], ["so-so", "so"]):
        flat, tree = (re.compile(rf"(?i)\b{make(names)}\b") for make in (X.any_of, X.one_of))
        words = [*(w for n in names for w in n.split()), "x", "aá", "Calí", "ni", "de"]
        for _ in range(2000):
            t = rng.choice([" ", "  ", "", "-"]).join(rng.choice(words) for _ in range(rng.randint(1, 8)))
            assert [m.span() for m in flat.finditer(t)] == [m.span() for m in tree.finditer(t)]
    assert X.one_of(V.LISTS["municipios"]).count("b[uúü]") < X.any_of(V.LISTS["municipios"]).count("b[uúü]")
    found = {r"\bmss?[di]\b": "ms", r"radi[oa]l": "radi", r"a(?:bcd)?ef|gh": "", r"zona\s+i{1,3}\s+de\s+cuello": "cuello", r"dedo(?!\s+del\s+pie)": "dedo", r"abc?d*": "ab", r"(?:ab)cd": "cd"}
    assert {p: X.literal(p) for p in found} == found
    pieces = "a@b.co|c.c. 12 345|cédula 1234567|310 555 1234|1234567|3 /4-2019|5 De Marzo|12 ago 19|Agosto de 2018|2019|7 : 30 pm|15 años de edad|niña 3 DÍAS|bebé de 2 MES".split("|")
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 3))) for _ in range(300)] + [p.replace(p[i], "", 1) for p in pieces for i in range(len(p))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").cache()
    for name, rule in redact.rules(V.LISTS):
        pattern, _, _, *needs = rule(None)
        if needs and needs[0]:
            assert df.where(F.col("t").rlike(pattern) & ~F.col("t").rlike(needs[0])).isEmpty(), name
            assert not df.where(F.col("t").rlike(pattern)).isEmpty(), name


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_matches_are_decided_once_and_names_looked_for_first(spark):
    """A match's placeholder is one expression of the plan; what is looked for before a rule of names is in all of its matches."""
    df = spark.createDataFrame([("paciente de 34 años",)], "t string")
    assert _plan(redact.redact(df, "t", only={"edad"})).count("[EDAD:90+]") == 2
    texts = ["Hospital  de la SAN\u00a0rafael", "CLÍNICA aurora", "clinica\nrayito de sol", "ips santa ana", "eſe ſan joſe", "meses San Juan de Dios", "aurora", "hospital"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").cache()
    tried = 0
    for name, rule in redact.rules(redact.V.LISTS):
        pattern, _, _, *needs = rule(None)
        if needs[1:]:
            found = df.where(F.col("t").rlike(pattern))
            assert found.count() and found.where(~F.col("t").rlike(needs[1])).isEmpty(), name
            tried += 1
    assert tried == 2


def test_cleaning_writes_only_texts_that_change(spark):
    """Each step of cleaning is guarded, the text before it is one expression, and white space is that of the regex engine."""
    from curalis.functions import text as X

    df = spark.createDataFrame([("a",)], "t string")
    assert "+|\\s+$" not in _plan(df.select(X.clean(F.col("t")))) and "contains(" in _plan(df.select(X.clean(F.col("t")))).lower()
    assert _plan(df.select(X.match_key(F.col("t")))).count("regexp_replace") <= 6
    every = spark.range(1, 0xD800).select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    assert every.where(F.col("c").rlike(r"(?U)\s") != (X.strip(F.col("c")) == "")).isEmpty()


def test_labels_need_no_regex_for_accents_and_blanks(spark):
    from curalis.functions import values as V
    from curalis.operators import enrich

    df = spark.createDataFrame([("apuñalado con\u00a0arma   de  fuego, RIÑA; trauma en tórax",)], "t string")
    assert _plan(df.select(enrich.mechanism(F.lit(""), F.col("t")))).count("RLIKE") < sum(map(len, V.MECHANISMS.values()))
    got = df.select(enrich.mechanism(F.col("t"), F.lit("")).alias("m"), enrich.regions(F.col("t")).alias("r")).first()
    assert got.m == "arma_de_fuego" and got.r == ["torax"]


def test_capitals_are_counted_by_runs(spark):
    """As by single characters; null where the text is null stays false or null as a filter."""
    from curalis.functions import text as X

    texts = ["", "...", "ABCDe", "ABCd", "ÁÉ íó", "AB 12 CD\n-- ÑÑ", "a", None, "ＡＢ x", "\U0001d400 b", "ab" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.mostly_upper(F.col("t")).alias("u"))
    for row in df.collect():
        letters = [c for c in row.t or "" if c.isalpha()]
        assert bool(row.u) == (bool(letters) and sum(c.isupper() for c in letters) / len(letters) > 0.8), row
    assert "[^\\p{L}]," not in _plan(df) and "[^\\p{L}]+" in _plan(df)


def test_keys_of_labels_are_computed_once(spark):
    """``classify`` gives what each label gives by itself, and looks at each text once."""
    texts = [None, "", " ", "Me CAÍ ", " de la moto", "ΟΔΟΣ", "me", "cortó  İ é", "CE", "en ojo; riñón", "́x", "UCI"]
    rows = [(r, e, s) for r in texts for e in texts[::2] for s in texts[1::3]]
    df = spark.createDataFrame(rows, "reason_anon string, exam_anon string, stay_anon string")
    r, e, s = (F.coalesce(c, F.lit("")) for c in df.columns)
    body = F.concat(e, F.lit(" "), s)
    got = enrich.classify(df)
    want = df.select("*", enrich.mechanism(r, body).alias("m"), enrich.regions(F.concat(r, F.lit(" "), body)).alias("r"), enrich.outcome(body).alias("o"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert _plan(got).count("regexp_replace") < _plan(want).count("regexp_replace")


def test_flags_alone_write_no_texts(spark):
    from curalis.operators import quality
    from curalis.plans import catalog

    flagged = catalog.P.flagged(catalog.b(spark, "/root/testdata/sf0.001"), exported=False, drop=quality.TEXTS)
    assert not {*quality.TEXTS} & {*spark.read.parquet(*flagged.inputFiles()).columns}
    every = catalog.P.flagged(catalog.b(spark, "/root/testdata/sf0.001"), exported=False)
    assert flagged.exceptAll(every.select(flagged.columns)).isEmpty() and flagged.count() == every.count()
