"""Lists of many names against the alternation of all of them, and against a plain search."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curalis.functions import gazetteer, values as V
from curalis.operators import quality, redact, verify
from curalis.plans import pipeline as P
from curalis.sources import notes as S
from tests.conftest import DATA

LISTS = {k: [*v] for k, v in V.LISTS.items()}


def odd_texts(rng, n=300):
    names = [*LISTS["municipios"], *LISTS["instituciones"], *LISTS["medicos"], *LISTS["hospital_genericos"], *LISTS["tipos_genericos"], *LISTS["instituciones_sin_trigger"]]
    words = ["hospital", "clínica", "dr.", "Dra", "de", "signo de", "ips", "e.s.e", "fundación", "universitario", "fecha", "12/03/2019", "x", "[FECHA]", "tel", "35 años de edad", "mes"]
    change = [lambda s: s, str.upper, str.title, lambda s: s.replace("a", "á"), lambda s: s.replace(" ", "  \n"), lambda s: s + "s", lambda s: s.replace("i", "İ"), lambda s: s.replace("s", "ſ"), lambda s: s.replace("n", "ñ")]
    return [" ".join(rng.choice(change)(rng.choice(names)) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(n)] + [f"visto por dr. {m} y dra {m.title()}" for m in LISTS["medicos"]] + [None, "", "﷐cali﷑ pal﷐mira"]


def test_as_the_whole_alternation(spark, monkeypatch):
    """All rules with all lists looked up by automaton give what they give by regex alone."""
    lists = LISTS | {"municipios": [*LISTS["municipios"], "fecha", "mes", "a [b] c", "san  luis", "cali vieja", "Bogotá", "x-y", "  "]}
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(odd_texts(random.Random(1)))], "record_id string, t string")
    want = {r.record_id: (r.t_anon, r.t_log) for r in redact.redact(df, "t", lists).collect()}
    monkeypatch.setattr(gazetteer, "LARGE", 0)
    assert set(redact.large(lists)) == redact.LOOKED_UP
    got = {r.record_id: (r.t_anon, r.t_log) for r in redact.redact(df, "t", lists).collect()}
    assert got == want
    assert any("[MUNICIPIO]" in t for t, _ in want.values()) and any("[INSTITUCION]" in t for t, _ in want.values()) and any("[MEDICO]" in t for t, _ in want.values())


def test_whole_notes_and_residue(spark, monkeypatch):
    notes = S.from_orders(spark, DATA).limit(400)
    columns = ["record_id", "reason_anon", "exam_anon", "stay_anon", "n_reemplazos_phi"]
    texts = notes.select("record_id", F.concat_ws(" ", "exam", "stay", F.lit("en el hospital local, dr. moncada, dr. otro")).alias("texto"))
    want = sorted(map(str, P.redacted(notes).select(columns).collect())), sorted(map(str, verify.residue(texts).collect()))
    monkeypatch.setattr(gazetteer, "LARGE", 0)
    got = sorted(map(str, redact.redact_fields(P.flagged(notes), quality.KEYS, LISTS).select(columns).collect())), sorted(map(str, verify.residue(texts).collect()))
    assert got == want


def test_a_hundred_thousand_names(spark):
    rng = random.Random(2)
    syllables = ["ca", "lo", "mer", "tá", "nu", "bri", "gón", "se", "pal", "ñi", "xa", "del"]
    names = sorted({" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 3))) for _ in range(150_000)})
    names = sorted(rng.sample(names, 100_000))
    assert len(names) == 100_000
    plain = {n.lower() for n in names}
    rows = []
    for i in range(400):
        words = [rng.choice(["".join(rng.choice(syllables) for _ in range(rng.randint(1, 5))), rng.choice(names)]) for _ in range(rng.randint(1, 15))]
        rows.append((str(i), " ".join(words)))
    lists = LISTS | {"municipios": names, "municipios_excepciones": []}
    df = spark.createDataFrame(rows, "record_id string, t string")
    got = {r.record_id: r.t_anon for r in redact.redact(df, "t", lists, {"municipio"}).collect()}
    # Letters of a class match with and without accent if the name's letter is plain; other letters match as they are.
    tolerance = str.maketrans("áéíóúüñç", "aeiouunc")

    def matches(name, part):
        return len(name) == len(part) and all(a == b or (a in "aeiounc" and a == b.translate(tolerance)) for a, b in zip(name, part))

    by_key = {}
    for n in plain:
        by_key.setdefault(n.translate(tolerance), []).append(n)
    for i, text in rows:
        words, out, at = text.split(" "), [], 0
        while at < len(words):
            found = None
            for k in range(min(3, len(words) - at), 0, -1):
                part = " ".join(words[at : at + k])
                hits = [n for n in by_key.get(part.translate(tolerance), []) if matches(n, part)]
                if hits and (found is None or len(part) > found[1]):
                    found = (k, len(part))
            out.append("[MUNICIPIO]" if found else words[at])
            at += found[0] if found else 1
        assert got[i] == " ".join(out)
    assert sum("[MUNICIPIO]" in t for t in got.values()) > 100


def test_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(gazetteer, "MAX_BYTES", 100)
    with pytest.raises(ValueError, match="bytes of names"):
        gazetteer.finder(spark, {"municipios": ["x" * 101]}, set())
    with pytest.raises(ValueError, match="bytes of names"):
        gazetteer.names_of(spark.createDataFrame([("x" * 101,)], "n string"), "n")
    assert gazetteer.names_of(spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "n string"), "n") == ["a", "b"]


def test_folding():
    assert gazetteer.fold("ÁRBOL\n\t ſİKß") == "arbol sikß"
    assert re.search(r"\s", gazetteer.fold("a b")) is not None


def test_names_take_little_memory():
    """An automaton holds a few numbers for each name, not objects; names that fold alike are all found."""
    import tracemalloc

    from curalis.functions.gazetteer import Names

    names = [f"name{i:06d}" for i in range(20_000)]
    tracemalloc.start()
    Names({"a": names})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(names)
    assert Names({"a": ["Calí", "x", "CALI"], "b": ["cali"]}).found("de cali") == {"a": ["Calí", "CALI"], "b": ["cali"]}
