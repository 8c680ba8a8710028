"""Quality flags, cleaning, sources and files of the notes."""

import hashlib
import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from curalis.functions import bloom
from curalis.functions import text as X
from curalis.functions import values as V
from curalis.operators import corpus, mining, quality, review, verify
from curalis.plans import pipeline as P
from curalis.sources import notes as S
from tests.conftest import DATA

NOTE = "record_id string, unit string, reason string, exam string, stay string"
FULL = ("Caida de su propia altura en casa", "Dolor en hombro derecho sin deformidad", "Se da salida con analgesia oral")


def notes(spark, rows):
    return spark.createDataFrame([(str(i), "Años", *r) for i, r in rows], NOTE)


def flagged(spark, rows):
    return {r.record_id: r for r in P.flagged(notes(spark, rows)).collect()}


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""),
        ('"""SE CAYO"""', "SE CAYO"),
        ('2HERIDA POR ARMA""', "HERIDA POR ARMA"),
        ("a  b\x07c", "a b c"),
        ("uno \n\n\n\n dos", "uno\n\ndos"),
        ("fin.....", "fin..."),
        ("a , b:c", "a, b: c"),
        ("árbol", "árbol"),
        ("hora 14:35", "hora 14:35"),
    ],
)
def test_clean(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(X.clean(F.col("t"))).first()[0] == want


def test_canonical_composition(spark):
    """All characters that are taken apart or join others, and random strings of them, as Python composes them."""
    rng = random.Random(1)
    pool = [chr(p) for p in X._POINTS if unicodedata.combining(chr(p)) or unicodedata.decomposition(chr(p))]
    common = [*"aeiounc AEN가각ᄀÅकか", "\u0300", "\u0301", "\u0308", "\u0303", "\u0327", "\u0323", "\u1161", "\u11a8", "\u0344", "\u0f73", "\u093c", "\u09be", "\u09c7", "\u0958", "\u3099"]
    texts = [*pool, *("".join(rng.choice(common if rng.random() < 0.8 else pool) for _ in range(rng.randint(0, 12))) for _ in range(4000))]
    texts += [f(chr(0xAC00 + i) + "a") for i in range(0, 11172, 17) for f in (str, lambda c: unicodedata.normalize("NFD", c))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    bare = lambda t: unicodedata.normalize("NFC", re.sub("[\u0300-\u036f]", "", unicodedata.normalize("NFD", t)))
    for r in df.select("i", X.compose(F.col("t")).alias("nfc"), X.compose(X.unaccent(F.col("t"))).alias("bare")).collect():
        assert (r.nfc, r.bare) == (unicodedata.normalize("NFC", texts[r.i]), bare(texts[r.i])), ascii(texts[r.i])
    odd = spark.createDataFrame([("\x01A\u030a\x01 \x02e\u0301",), ("q\u0307\u0323",)], "t string")
    assert [r[0] for r in odd.select(X.clean(F.col("t"))).collect()] == ["\u00c5 é", "q\u0323\u0307"]


def test_flags(spark):
    long = "x" * 479
    rows = [
        (2, FULL),
        (10, FULL),
        (3, (None, *FULL[1:])),
        (4, (None, None, None)),
        (5, ("corto", None, None)),
        (6, (FULL[0], long, FULL[2])),
        (7, (FULL[0] + " siete", long + "y", FULL[2])),
        (8, ("y" * 600, *FULL[1:])),
        (9, (FULL[0] + " ocho", FULL[1], "Paciente queda con")),
        (11, (FULL[0] + " once", FULL[1], "Paciente queda con.")),
    ]
    f = flagged(spark, rows)
    assert f["2"].apto_rag and not f["2"].quality_flags
    assert f["10"].quality_flags == ["duplicate"] and not f["2"].duplicate
    assert f["3"].indexable and f["3"].quality_flags == ["incompleto"] and f["3"].campos_vacios == [V.REASON]
    assert f["4"].empty and not f["4"].incompleto and len(f["4"].campos_vacios) == 3
    assert f["5"].too_short
    assert [f[i].truncated for i in ("6", "7", "8", "9", "11")] == [False, True, False, True, False]
    assert f["9"].campos_truncados == [V.STAY]


def test_summary_and_empty(spark):
    df = P.flagged(notes(spark, [(2, FULL), (10, FULL)]))
    assert {r.metrica: (r.n, r.pct) for r in quality.summary(df).collect()}["apto_rag"] == (1, 50.0)
    assert {r.n for r in quality.summary(P.flagged(notes(spark, [(1, FULL)]).limit(0))).collect()} == {0}


def test_csv_and_run(spark, tmp_path):
    path = tmp_path / "in.csv"
    head = ";".join([V.ID, V.UNIT, *V.FIELDS])
    rows = ["1;Meses;Caida de la cama;Paciente de 8 meses sin lesion;Se da salida, valorado por dr. moncada el 12/03/2019", f'2;;NA;"dos\nlineas";{FULL[2]}', "3;Años;;;"]
    path.write_text("\n".join([head, *rows]), encoding="utf-8")
    df = S.to_notes(S.read_csv(spark, str(path)))
    found = {r.record_id: r for r in df.collect()}
    assert found["2"].reason == "NA" and found["2"].exam == "dos\nlineas" and found["3"].reason is None
    with pytest.raises(ValueError, match="missing"):
        (tmp_path / "bad.csv").write_text("a;b\n1;2")
        S.read_csv(spark, str(tmp_path / "bad.csv"))
    manifest = P.run(spark, str(path), str(tmp_path / "out"), str(tmp_path / "rep"))
    assert manifest["sha256_entrada"] == hashlib.sha256(path.read_bytes()).hexdigest()
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/corpus_indexable.jsonl").collect()]
    assert [x["id"] for x in lines] == ["1", "2"][: len(lines)] and lines[0]["metadata"]["es_pediatrico"] is True
    assert "[FECHA]" in lines[0]["text"] and "[MEDICO]" in lines[0]["text"] and "unidad" not in lines[0]["metadata"]
    assert (tmp_path / "rep" / "reporte_anonimizacion.html").exists()
    out = {r.record_id: r.motivo for r in spark.read.option("header", True).csv(f"{tmp_path}/out/excluidos_rag.csv").collect()}
    assert out["3"] == "empty"


def test_notice_counts_before_strip(spark):
    rows = [(1, FULL), (2, (FULL[0] + " dos", FULL[1], "Paciente queda con"))]
    got = {r.record_id: r for r in P.documents(notes(spark, rows), P.Options(notice_in_text=True)).collect()}
    assert got["1"].n_chars_doc == len(got["1"].texto) + 2
    assert got["2"].texto.endswith("[Registro truncado en evolución y hospitalización: el desenlace puede no estar documentado.]")


def test_exclusion_order(spark):
    df = spark.createDataFrame([(["truncated", "incompleto", "duplicate"],)], "quality_flags array<string>")
    assert df.select(corpus.exclusion_reason()).first()[0] == "duplicate"


def test_residue(spark):
    t = spark.createDataFrame([("1", "visto 12/03/2019, drenaje de 2000 cc en 2015 y hospital local y dr. Moncada"), ("2", None), ("3", "")], "record_id string, texto string")
    got = {(r.detector, r.match): r.veredicto for r in verify.residue(t).collect()}
    assert got[("fecha_numerica", "12/03/2019")] == "revisar"
    assert got[("anio", "2000")] == "esperado" and got[("anio", "2015")] == "revisar"
    assert got[("trigger_institucion", "hospital local")] == "esperado"
    assert got[("trigger_medico", "dr. Moncada")] == "revisar"
    assert verify.residue_summary(verify.residue(t), 1).count() == 4


@pytest.mark.parametrize("n", [1, 2, 6, 41])
def test_strata(spark, n):
    import pandas as pd

    df = spark.createDataFrame([(str(i), i % 5, True) for i in range(n)], "record_id string, n_chars_doc int, apto_rag boolean")
    got = {r.record_id: r.estrato for r in verify.review_sample(df, 10_000).collect()}
    assert len(got) == n
    if n > 1:
        p = pd.DataFrame({"i": range(n), "c": [i % 5 for i in range(n)]})
        want = pd.qcut(p.sort_values(["c", "i"]).c.rank(method="first"), 4, labels=[s for s, _ in V.STRATA])
        assert got == {str(i): s for i, s in zip(p.sort_values(["c", "i"]).i, want, strict=True)}


def test_review_and_mining(spark):
    t = spark.createDataFrame([("1", "Visto por Zambrano Perez. Escala de Glasgow normal"), ("2", "TODO EN MAYUSCULAS"), ("3", "glasgow")], "record_id string, texto string")
    assert [r.record_id for r in review.not_shouting(t).collect()] == ["1", "3"]
    found = review.candidates(t, review.document_frequency(t))
    names = {r.entidad for r in found.collect()}
    assert "Zambrano Perez" in names and not any("Glasgow" in n for n in names)
    assert review.candidate_summary(found).count() == len(names)
    b = spark.createDataFrame([(str(i), "remitido de clinica santa ines estable, dra. Perez y doctor tratante en Cali") for i in range(3)], "record_id string, blob string")
    assert [r[0] for r in mining.institutions(b).collect()] == ["santa ines"]
    assert [r[0] for r in mining.doctors(b).collect()] == ["perez"]
    assert [r[0] for r in mining.places(b).collect()] == ["cali"]


def test_whole_documents_are_read_to_their_end(spark, tmp_path):
    head = "Caida de su propia altura\nDolor en hombro\n"
    texts = [head + "a\nb\nc", head + "a\nb\nd", head + "a\nb\nc", "one", "x\ny", None, "short\nlines\n\n" + "long line " * 40]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {int(r.record_id): r for r in S.from_documents(spark, str(tmp_path)).collect()}
    assert ["\n".join(x or "" for x in (rows[i].reason, rows[i].exam, rows[i].stay)).rstrip("\n") for i in range(7)] == [t or "" for t in texts]
    found = {int(r.record_id): r for r in P.flagged(S.from_documents(spark, str(tmp_path))).collect()}
    assert [i for i, r in found.items() if r.duplicate] == [2] and not found[6].too_short and found[6].n_chars > 400


def test_letters_with_marks(spark):
    """Composition and removal of marks against the Unicode tables."""
    import unicodedata

    words = ["ășçă ğüşőű", "Žluťoučký kůň", "tiếng Việt ậ", "ΆέΉώ", "Йё", "Ångström", "ñandú", "plain", "ﬁ ß ø"]
    rows = [(form, unicodedata.normalize(form, w), w) for w in words for form in ("NFC", "NFD")]
    df = spark.createDataFrame(rows, "form string, t string, w string")
    for r in df.select("w", X.compose(F.col("t")).alias("c"), X.unaccent(F.col("t")).alias("u")).collect():
        assert r.c == unicodedata.normalize("NFC", r.w)
        assert r.u == "".join(x for x in unicodedata.normalize("NFD", r.w) if unicodedata.category(x) != "Mn")


def test_sources(spark, tmp_path):
    path = tmp_path / "in.csv"
    head = ";".join([V.ID, V.UNIT, *V.FIELDS])
    path.write_text(f"{head}\n1;;NA;n/a;hospital san rafael\n2;;hospital san rafael;hospital san rafael;", encoding="utf-8")
    loose = S.to_notes(S.read_loose_csv(spark, str(path))).orderBy("record_id").collect()
    assert [tuple(r)[2:] for r in loose] == [(None, None, "hospital san rafael"), ("hospital san rafael", "hospital san rafael", None)]
    assert S.discover(spark, str(tmp_path / "none"), str(path)) == str(path)
    with pytest.raises(FileNotFoundError):
        S.discover(spark, str(tmp_path / "none"))
    assert S.sha256(spark, str(path)) == hashlib.sha256(path.read_bytes()).hexdigest()
    assert len(S.sha256(spark, str(tmp_path))) == 64


def test_command_line(spark, tmp_path, capsys):
    import yaml

    from curalis.__main__ import main

    path = tmp_path / "in.csv"
    head = ";".join([V.ID, V.UNIT, *V.FIELDS])
    rows = [f"{i};Años;Caida de su propia altura {i};Valorado por Zambrana Quintero en hospital santa ines {i};Se da salida con analgesia oral" for i in range(4)]
    path.write_text("\n".join([head, *rows]), encoding="utf-8")
    out, rep = str(tmp_path / "out"), tmp_path / "rep"
    main(["run", "--entrada", str(path), "--salida", out, "--reportes", str(rep), "--incluir-incompletos"], spark)
    manifest = json.loads((tmp_path / "out" / "manifest.json").read_text())
    assert manifest["n_registros"] == manifest["n_indexables"] == 4 and manifest["criterio_indice"] == "indexable" and manifest["n_excluidos_indexables"] == {}
    assert "documentos indexables: <b>4</b>" in (rep / "reporte_anonimizacion.html").read_text()
    assert not (rep / "medicos_no_whitelist.csv").exists() and "[5] 4 documentos" in capsys.readouterr().out
    main(["review", "--corpus", f"{out}/corpus.parquet", "--salida", str(rep / "ner.csv"), "--top", "3"], spark)
    found = spark.read.option("header", True).csv(str(rep / "ner.csv"))
    assert found.columns == ["record_id", "label", "entidad", "df_corpus", "contexto"]
    assert {(r.entidad, r.df_corpus) for r in found.collect()} >= {("Zambrana Quintero", "4")}
    assert spark.read.option("header", True).csv(str(rep / "ner_resumen.csv")).where("entidad = 'Zambrana Quintero'").first().n == "3"
    main(["mine", "--entrada", str(path), "--salida", str(tmp_path / "config" / "gazetteers.yaml")], spark)
    lists = yaml.safe_load((tmp_path / "config" / "gazetteers.yaml").read_text())
    assert lists["instituciones"] == ["santa ines"] and S.read_lists(str(tmp_path / "config" / "gazetteers.yaml"))["instituciones"] == ["santa ines"]
    with pytest.raises(SystemExit, match="not found"):
        main(["run", "--entrada", str(tmp_path / "none.csv")], spark)
    with pytest.raises(SystemExit, match="spaCy"):
        review.model_tagger("none")


def test_review_counts_words_of_all_indexable_documents(spark, tmp_path):
    """Words are counted before documents in capitals go, and in indexable documents only."""
    rows = [(str(i), "VISTO POR QUINTERO" if i % 2 else "Visto por Quintero ayer", i < 40, 20) for i in range(50)]
    corpus_ = spark.createDataFrame(rows, "record_id string, texto string, indexable boolean, n_chars_doc int")
    found, _ = review.run(corpus_, str(tmp_path / "a.csv"), max_df=40)
    assert {(r.entidad, r.df_corpus) for r in found.collect()} == {("Visto", 40), ("Quintero", 40)} and found.count() == 40
    assert review.run(corpus_, str(tmp_path / "b.csv"), max_df=39)[0].count() == 0


def test_duplicates_of_one_text_everywhere(spark):
    rows = [(i, FULL) for i in range(60, 0, -1)] + [(100, (FULL[0] + " otra", *FULL[1:])), (101, (None, None, None)), (102, (None, None, None))]
    f = flagged(spark, rows)
    assert sorted(int(i) for i, r in f.items() if r.duplicate) == list(range(2, 61))
    assert list(P.flagged(notes(spark, rows[:1])).columns)[0] == "record_id"


def test_repeated_and_missing_ids(spark):
    """One row of each text stays: that of the least id, of rows with one id any one, of rows without id only if there is no other."""
    rows = [("5", FULL), ("5", FULL), ("7", FULL), (None, FULL), (None, ("otro " + FULL[0], *FULL[1:])), (None, ("otro " + FULL[0], *FULL[1:])), ("9", (None, None, None)), ("9", (None, None, None))]
    df = spark.createDataFrame([(i, "Años", *r) for i, r in rows], NOTE).repartition(3)
    got = P.flagged(df).groupBy("record_id", "hash_texto").agg(F.count("*").alias("n"), F.count_if("duplicate").alias("d"), F.count_if("empty").alias("e")).collect()
    assert sorted(((r.record_id or "", r.n, r.d, r.e) for r in got)) == sorted([("5", 2, 1, 0), ("7", 1, 1, 0), ("", 1, 1, 0), ("", 2, 1, 0), ("9", 2, 0, 2)])


def test_texts_are_cleaned_once(spark):
    """What is read back holds no cleaning: the plan scans the written rows twice and has no rule of it."""
    plan = P.flagged(notes(spark, [(2, FULL), (10, FULL)]))._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("Scan parquet") <= 2


def test_next_file(spark):
    """Marks of a second file, given the first ids of the first one, are those of both files together."""
    rng = random.Random(5)
    text = lambda i: (f"{FULL[0]} {i}", *FULL[1:])
    rows = [(rng.randint(0, 500), text(rng.randint(0, 30))) for _ in range(200)]
    rows = list(dict.fromkeys((i, t) for i, t in {i: t for i, t in rows}.items()))
    one, two = notes(spark, rows[:80]), notes(spark, rows[80:])
    whole = {r.record_id: r.duplicate for r in P.flagged(one.unionAll(two)).collect()}
    first = P.flagged(one)
    earlier = quality.first_ids(first)
    second = quality.flags(quality.normalise(two), earlier=earlier)
    marks = {r.record_id: r.duplicate for r in first.unionAll(second).collect()}
    gone = {str(r.id) for r in quality.displaced(second, earlier).collect()}
    assert gone and {i: d or i in gone for i, d in marks.items()} == whole
    assert sorted(map(tuple, quality.first_ids(second, earlier).collect())) == sorted(map(tuple, quality.first_ids(P.flagged(one.unionAll(two))).collect()))


def test_strata_without_sorting(spark, monkeypatch):
    monkeypatch.setattr(verify, "BINS", 3)
    rng = random.Random(6)
    for n in (0, 1, 2, 3, 5, 8, 200):
        rows = [(None if i == 3 and n == 8 else str(rng.choice([i, -i, i << 40, (1 << 63) - 1 - i])), rng.choice([10, 10, 10, 11, 4000, i])) for i in range(n)]
        rows = list(dict(rows).items())
        df = spark.createDataFrame(rows, "record_id string, n_chars_doc int").withColumn("apto_rag", F.lit(True)).repartition(3)
        got = {r.record_id: r.estrato for r in verify.review_sample(df, 10**6).collect()}
        order = sorted(rows, key=lambda r: (r[1], verify.LEAST_ID if r[0] is None else int(r[0])))
        names = [s for s, _ in V.STRATA]
        want = {r[0]: names[max(1, -(-i * 4 // max(len(rows) - 1, 1))) - 1] for i, r in enumerate(order)}
        assert {k: v for k, v in got.items()} == {k: v for k, v in want.items() if k is not None}


def test_hashes_of_files_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "WHOLE_BYTES", 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        for i, raw in enumerate([b"", b"\n", b"short", b"\n\n" + b"line\n" * 60, b"a\r\n" * 40 + b"end", b"\xff\xfe\n" * 50, b"x" * 500, b"\n" * 100 + b"x"]):
            path = tmp_path / f"{i}.csv"
            path.write_bytes(raw)
            assert S.sha256(spark, str(path)) == hashlib.sha256(raw).hexdigest(), raw[:20]
        assert len(S.sha256(spark, str(tmp_path))) == 64
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_run_that_is_cut_off_goes_on(spark, tmp_path, monkeypatch):
    """Killed after each phase and within the move, a run that is started again makes the files of a whole run, and completed
    phases are not computed again."""
    S.write_csv(S.from_orders(spark, DATA).limit(150).coalesce(1), f"{tmp_path}/in.csv")
    said = []
    whole = P.run(spark, f"{tmp_path}/in.csv", f"{tmp_path}/a/out", f"{tmp_path}/a/rep", say=said.append)
    assert len(said) > 5 and not list((tmp_path / "a" / "out").glob("_attempt*")) and not list((tmp_path / "a" / "rep").glob("_attempt*"))

    def content(at):
        lines = lambda path: sorted(r[0] for r in spark.read.text(path).collect())
        files = {p.name: p for k in ("out", "rep") for p in (tmp_path / at / k).iterdir() if not p.name.startswith(".")}
        rows = {n: lines(str(p)) for n, p in files.items() if n.endswith((".csv", ".jsonl"))}
        return set(files), rows, sorted(map(str, spark.read.parquet(f"{tmp_path}/{at}/out/corpus.parquet").collect()))

    order, real, moves = [], P.Attempt.phase, []

    class Killed(Exception):
        pass

    def phase(self, name, work, stop=[0]):  # noqa: B006
        if any(n == name for n in order):
            return real(self, name, lambda: pytest.fail(f"{name} again"))
        figures = real(self, name, work)
        order.append(name)
        raise Killed

    def failing_move(self, manifest):
        if not moves:
            moves.append(1)
            there, where = self._store(self.files["corpus.parquet"][0])
            S.write_text(spark, f"{self.folders['out']}/moving", "")
            there.rename(where, self._store(self.files["corpus.parquet"][1])[1])
            raise Killed
        return commit(self, manifest)

    commit = P.Attempt.commit
    monkeypatch.setattr(P.Attempt, "phase", phase)
    monkeypatch.setattr(P.Attempt, "commit", failing_move)
    manifest = None
    for _ in range(12):
        try:
            manifest = P.run(spark, f"{tmp_path}/in.csv", f"{tmp_path}/b/out", f"{tmp_path}/b/rep")
            break
        except Killed:
            assert not (tmp_path / "b" / "out" / "manifest.json").exists()
    assert order == ["enriched", "corpus", "log", "residue", "sample", "tokens"] and moves
    timed = ("generado", "duracion_s")
    assert {k: v for k, v in manifest.items() if k not in timed} == {k: v for k, v in whole.items() if k not in timed}
    assert content("a") == content("b")


def test_another_run_replaces_all_files(spark, tmp_path):
    """Files of an earlier run that the new one does not make are gone."""
    S.write_csv(S.from_orders(spark, DATA).limit(60).coalesce(1), f"{tmp_path}/one.csv")
    S.write_csv(notes(spark, [(1, FULL)]), f"{tmp_path}/two.csv")
    P.run(spark, f"{tmp_path}/one.csv", f"{tmp_path}/out", f"{tmp_path}/rep")
    assert (tmp_path / "out" / "log_reemplazos.csv").exists()
    manifest = P.run(spark, f"{tmp_path}/two.csv", f"{tmp_path}/out", f"{tmp_path}/rep")
    assert manifest["n_registros"] == 1 and not (tmp_path / "out" / "log_reemplazos.csv").exists()
    assert json.loads((tmp_path / "out" / "manifest.json").read_text())["n_registros"] == 1


def test_bloom_filter(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{rng.random()}" for _ in range(3000)] + ["", "ñandú", None]
    df = spark.createDataFrame([(w,) for w in words], "token string")
    others = spark.createDataFrame([(f"x{i}",) for i in range(4000)], "token string")
    for most in (bloom.MOST_BITS, bloom.WORD):
        monkeypatch.setattr(bloom, "MOST_BITS", most)
        made = bloom.build(df, "token")
        assert df.where("token is not null").where(~made.may_hold(F.col("token"))).count() == 0
        assert others.where(made.may_hold(F.col("token"))).count() < (200 if most > bloom.WORD else 1000)
    none = bloom.build(df.limit(0), "token")
    assert others.where(none.may_hold(F.col("token"))).count() == 0


def test_frequency_of_what_is_asked(spark):
    texts = S.from_documents(spark, DATA).select("record_id", F.concat_ws(" ", "reason", "exam", "stay").alias("texto"))
    every = {r.token: r.df for r in review.document_frequency(texts).collect()}
    asked = sorted(every)[::20]
    some = {r.token: r.df for r in review.document_frequency(texts, among=spark.createDataFrame([(t,) for t in asked], "token string")).collect()}
    assert all(some[t] == every[t] for t in asked) and all(every[t] == n for t, n in some.items()) and len(some) < len(every) / 10


def test_quotes_outside_an_export(spark, tmp_path):
    """Quotes at the end of a document are its text, as the queries' SQL has it; in a field of the export they go."""
    import duckdb

    from curalis.plans import catalog

    spark.createDataFrame([(1, 'token = "13df03"'), (2, '"a" 2ABC\n""b""\nuno dos "')], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("clean_text", "quality_flags"):
        got = catalog.QUERIES[name](spark, str(tmp_path))
        want = con.execute(f"select {', '.join(got.columns)} from ({catalog.ORACLE[name]})").fetchall()
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert spark.sql("select '\"a\" b \"' as t").select(X.clean(F.col("t"))).first()[0] == 'a" b'


def test_composition_classes_are_trees():
    """No level of a class has more than two members, so a character is not tried against hundreds of ranges one by one."""
    import re

    for pattern in (X.UNICODE.needed, X.UNICODE.cluster):
        while pattern != (pattern := re.sub(r"\[\\x\{\w+\}-\\x\{\w+\}(&&\[R{1,2}\])?\]", "R", pattern)):
            pass
        assert "x{" not in pattern


def test_corpus_is_made_once_for_its_three_files(spark, tmp_path):
    """A corpus takes redaction and labels: writing its files computes each row once, for the sort of the index too."""
    from curalis.operators import corpus
    from curalis.plans import pipeline as P

    notes = [(str(i), "Años", "Caida de moto", f"paciente de 4{i} años sin otros hallazgos", f"se da salida {i}") for i in range(6)] + [("9", None, "x", None, None)]
    docs = P.documents(spark.createDataFrame(notes, "record_id string, unit string, reason string, exam string, stay string"))
    made = spark.sparkContext.accumulator(0)

    def seen(text):
        made.add(1)
        return text

    corpus.write(docs.withColumn("texto", F.udf(seen, "string").asNondeterministic()("texto")), str(tmp_path))
    assert made.value == len(notes)
    assert spark.read.text(f"{tmp_path}/corpus_indexable.jsonl").count() == 6 and spark.read.option("header", True).csv(f"{tmp_path}/excluidos_rag.csv").count() == 1
