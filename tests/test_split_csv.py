"""The split scan of quoted files against pandas' reader, with ranges of a few bytes."""

import csv
import io
import random

import pandas as pd
import pytest

from curalis.plans import catalog
from curalis.sources import notes as S
from curalis.sources import split_csv as C
from tests.conftest import DATA

@pytest.fixture
def ranges(spark):
    """Sets the size of a byte range."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def size(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "0")

    yield size
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def by_pandas(text, columns=4):
    df = pd.read_csv(io.StringIO(text, newline=""), sep=";", dtype=str, engine="python", keep_default_na=False, index_col=False).replace({"": None})
    df = df.astype(object).where(df.notna(), None)
    return sorted(map(str, df.itertuples(index=False, name=None)))


def by_csv(text, columns=4):
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if len(r) > 1 or (r and r[0].strip())]
    return sorted(str(tuple([*(f or None for f in r), *[None] * (columns - len(r))])) for r in rows[1:])


def got(spark, path):
    return sorted(str(tuple(r)) for r in C.read(spark, str(path)).collect())


def random_file(rng, n, tails):
    """Records of up to four fields, some with unusual quotes."""
    out = ["id;one;two;three"]
    for i in range(n):
        fields = [str(i)]
        for _ in range(rng.randint(0, 3)):
            kind = rng.random()
            inner = "".join(rng.choice(["a", "ñ", " ", "'", "\n", "\r\n", ";", '""', "word"]) for _ in range(rng.randint(0, 12)))
            plain = inner.replace("\n", "").replace("\r", "").replace(";", "").replace('"', "")
            fields.append(f'"{inner}"' if kind < 0.4 else f'"{inner}"tail' if kind < 0.45 and tails else f'x{plain}"y' if kind < 0.55 else plain)
        out.append(";".join(fields))
    return "".join(x + rng.choice(["\n", "\n", "\r\n", "\n\n", "\n \n"]) for x in out)


@pytest.mark.parametrize("size", [16, 61, 400, 100_000])
def test_ranges_of_any_size(spark, tmp_path, ranges, size):
    rng = random.Random(size)
    for i in range(4):
        text = random_file(rng, 60, i > 1)
        path = tmp_path / f"{i}.csv"
        path.write_bytes(text.encode())
        ranges(size)
        lines = C._lines(spark, str(path))
        assert size > 400 or lines.select("start").distinct().count() > 3
        assert got(spark, path) == (by_csv if i > 1 else by_pandas)(text)  # pandas refuses text after a closing quote


def test_a_field_over_many_ranges_and_one_that_never_closes(spark, tmp_path, ranges):
    ranges(50)
    long = "line\n" * 300 + 'and ""quoted""; end'
    text = f'id;text\n1;"{long}"\n2;b\n3;"{long}\n'
    (tmp_path / "a.csv").write_text(text, newline="")
    rows = {r.id: r.text for r in C.read(spark, str(tmp_path / "a.csv")).collect()}
    assert rows == {"1": long.replace('""', '"'), "2": "b", "3": long.replace('""', '"') + "\n"} or rows["3"].rstrip("\n") == long.replace('""', '"')
    assert C._lines(spark, str(tmp_path / "a.csv")).select("start").distinct().count() > 50


def test_header_over_ranges_and_folders(spark, tmp_path, ranges):
    ranges(8)
    for name, rows in (("a", "1;x\n"), ("b", '2;"y\nz"\n')):
        (tmp_path / f"{name}.csv").write_text(f'"long\nname of the first";second\n{rows}', newline="")
    df = C.read(spark, str(tmp_path))
    assert df.columns == ["long\nname of the first", "second"]
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "y\nz")]


def test_errors(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("a;b\n1;2;3\n")
    with pytest.raises(Exception, match="3 fields for 2 columns"):
        C.read(spark, str(tmp_path / "wide.csv")).collect()
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        C.read(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("a;b\n1;2\n")
    (tmp_path / "two" / "b.csv").write_text("a;c\n1;2\n")
    with pytest.raises(Exception, match="first record"):
        C.read(spark, str(tmp_path / "two")).collect()
    (tmp_path / "head.csv").write_text("﻿a;b\r\n")
    assert C.read(spark, str(tmp_path / "head.csv")).columns == ["a", "b"] and C.read(spark, str(tmp_path / "head.csv")).count() == 0


def test_carriage_returns_end_records(spark, tmp_path, ranges):
    ranges(5)
    (tmp_path / "a.csv").write_bytes(b'a;b\r1;"x\ry"\r2;"z\nw"\r\n3;"p\r\nq"\r4;5')
    assert sorted(map(tuple, C.read(spark, str(tmp_path / "a.csv")).collect())) == [("1", "x\ry"), ("2", "z\nw"), ("3", "p\r\nq"), ("4", "5")]


def test_notes_round_trip_in_ranges(spark, tmp_path, ranges):
    rows = S.from_documents(spark, DATA)
    S.write_csv(rows, f"{tmp_path}/notes.csv")
    ranges(20_000)
    back = S.to_notes(S.read_csv(spark, f"{tmp_path}/notes.csv"))
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert "csv_split" in catalog.QUERIES
