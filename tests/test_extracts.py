import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import merge as M
from tallyloom.sources import extracts as E

KEY = "Projekt-Nr"


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def rows(spark, folder, *columns):
    stacked = E.read_extracts(spark, folder, KEY)
    return sorted((tuple(r) for r in stacked.select("_file", "_part", KEY, *columns).collect()))


def test_header_behind_titles_and_empty_rows(spark, tmp_path):
    folder = write(tmp_path, a="Titel;;\n;;\nProjekt-Nr;Name;Ort\nP-1;x;y\n", b=";;\n\n;;\nProjekt-Nr;Name;Ort\nP-2;u;v\n;;\nP-3;w;\n",
                   c="Projekt-Nr;Name;Ort\nP-4;q;r\n", d="Titel;;\n;;\nProjekt-Nr;Name;Ort\nP-5;x;y\nP-6;x;y\n")
    assert rows(spark, folder, "Name", "Ort") == [
        ("a.csv", 0, "P-1", "x", "y"), ("b.csv", 0, "P-2", "u", "v"), ("b.csv", 0, "P-3", "w", ""), ("c.csv", 0, "P-4", "q", "r"),
        ("d.csv", 0, "P-5", "x", "y"), ("d.csv", 0, "P-6", "x", "y")]
    lines = {d.file: d.header_line for d in E.detect_dialects(spark, folder, KEY)}
    assert lines == {"a.csv": 3, "b.csv": 4, "c.csv": 1, "d.csv": 3}


def test_repeated_header_fills_gaps_and_conflicts(spark, tmp_path):
    folder = write(tmp_path, a="Projekt-Nr;Ort;Ort\nP-1;x;y\nP-2;;z\nP-3;x;\nP-4;x;x\n")
    stacked = E.read_extracts(spark, folder, KEY)
    merged = {r[KEY]: r.Ort for r in M.merge_sources(stacked, KEY).collect()}
    assert merged == {"P-1": "x", "P-2": "z", "P-3": "x", "P-4": "x"}
    assert [tuple(r) for r in M.merge_conflicts(stacked, KEY).collect()] == [("P-1", "Ort", "x", "a.csv", "y", "a.csv")]
    assert M.merge_stats(stacked, KEY).first().asDict() == {"rows_in": 4, "rows_out": 4, "blank_keys": 0, "columns": 2, "conflicts": 1}
    assert E.source_manifest(spark, folder, KEY).first().rows == 4


def test_header_behind_a_long_quoted_cell(spark, tmp_path):
    note = '"' + "\n".join(f"line {i}" for i in range(300)) + '"'
    folder = write(tmp_path, a=f"{note},,\nProjekt-Nr,Name,Ort\nP-1,\"a, \"\"b\"\"\",y\n")
    (d,) = E.detect_dialects(spark, folder, KEY)
    assert d.delimiter == "," and d.multiline and d.header_line == 301
    assert rows(spark, folder, "Name") == [("a.csv", 0, "P-1", 'a, "b"')]


def test_dialects(spark, tmp_path):
    folder = write(tmp_path, a="﻿Projekt-Nr\tName\nP-1\tä;ö\n", b="projekt-nr |Straße|x\nP-2|ß|\n".encode("cp1252"), c="Projekt-Nr\nP-3\n")
    found = {d.file: d for d in E.detect_dialects(spark, folder, KEY)}
    assert [found[f].delimiter for f in ("a.csv", "b.csv", "c.csv")] == ["\t", "|", ","]
    assert [found[f].encoding for f in ("a.csv", "b.csv", "c.csv")] == ["utf-8-sig", "cp1252", "utf-8-sig"]
    assert found["b.csv"].key_header == "projekt-nr" and not found["b.csv"].exact and found["b.csv"].header == ("projekt-nr", "Straße", "x")
    assert rows(spark, folder, "Name", "Straße") == [("a.csv", 0, "P-1", "ä;ö", ""), ("b.csv", 0, "P-2", "", "ß"), ("c.csv", 0, "P-3", "", "")]


def test_files_without_the_key_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="b.csv"):
        E.read_extracts(spark, write(tmp_path, a="Projekt-Nr;x\nP-1;1\n", b="Nummer;x\n1;2\n"), KEY)


def test_scans_do_not_grow_with_titled_files(spark, tmp_path):
    text = "Titel;\nProjekt-Nr;Name\nP-1;x\n"
    folder = write(tmp_path, **{f"f{i}": text for i in range(12)})
    plan = E.read_extracts(spark, folder, KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") <= 2 and E.read_extracts(spark, folder, KEY).count() == 12


def plain_rows(text: str, sign: str) -> list[list[str]]:
    """The records behind the header, as a reader that goes through the file from its beginning sees them."""
    found = [[c.strip() for c in r] for r in csv.reader(io.StringIO(text), delimiter=sign)]
    begin = next(i for i, r in enumerate(found) if KEY in r)
    return sorted(r for r in found[begin + 1:] if any(r))


def broken_file(seed: int, n: int, sign: str = ";") -> str:
    """Rows with quoted line breaks, doubled quotes, delimiters in quotes and stray quotes inside cells."""
    rng = random.Random(seed)
    cells = ['"line one\nline two"', '"a ""b""\n\n;;\n""c"""', f'"x{sign}y"', '5" pipe', 'plain', '', '"\n"', 'say "hi"', '"""q"""', '"long\n' + "more\n" * 40 + 'end"']
    lines = ["Titel " + sign, f'"Note\nto {KEY}s"', sign.join([KEY, "Name", "Ort"])]
    lines += [sign.join([f"P-{i}", rng.choice(cells), rng.choice(cells)]) for i in range(n)]
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("size", [200, 1_000, 1 << 20])
def test_quoted_line_breaks_across_splits(spark, tmp_path, size):
    texts = {"a": broken_file(1, 300), "b": broken_file(2, 150), "c": broken_file(3, 100, ","), "d": f'{KEY};Name;Ort\nP-1;2" pipe;x\nP-2;y;z\n'}
    folder = write(tmp_path, **texts)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        dialects = {d.file: d for d in E.detect_dialects(spark, folder, KEY)}
        assert {f for f, d in dialects.items() if d.multiline} == {"a.csv", "b.csv", "c.csv"}  # the odd quote of d opens no cell
        assert dialects["a.csv"].header_line == 4
        stacked = E.read_extracts(spark, folder, KEY)
        if size < 1 << 20:
            assert E._lines(spark, folder).where("file = 'a.csv'").select(F.spark_partition_id()).distinct().count() > 5
        got = stacked.select("_file", KEY, "Name", "Ort").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, sign in (("a", ";"), ("b", ";"), ("c", ","), ("d", ";")):
        assert sorted([r[1], r[2], r[3]] for r in got if r[0] == f"{name}.csv") == plain_rows(texts[name], sign)


def test_a_cell_over_several_splits_and_an_open_end(spark, tmp_path):
    long = "\n".join(f"row {i};{i}" for i in range(2_000))
    folder = write(tmp_path, a=f'{KEY};Name\nP-1;"{long}"\nP-2;x\nP-3;"never\nclosed\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        found = {r[KEY]: r.Name for r in E.read_extracts(spark, folder, KEY).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found["P-1"] == long and found["P-2"] == "x" and found["P-3"].startswith("never\nclosed")


def test_header_behind_a_first_cell_of_many_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(E, "FIRST_LINES", 10)
    note = '"' + "\n".join(f"line {i}" for i in range(5_000)) + '"'
    folder = write(tmp_path, a=f"{note};\n{KEY};Name\nP-1;x\n", b=f"{KEY};Name\nP-2;y\n")
    lines = {d.file: d.header_line for d in E.detect_dialects(spark, folder, KEY)}
    assert lines == {"a.csv": 5001, "b.csv": 1}
    assert rows(spark, folder, "Name") == [("a.csv", 0, "P-1", "x"), ("b.csv", 0, "P-2", "y")]


def test_order_of_rows_is_that_of_the_file(spark, tmp_path):
    folder = write(tmp_path, a=broken_file(5, 200))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1_500)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = [r[KEY] for r in E.read_extracts(spark, folder, KEY).orderBy("_rank", "_row").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [f"P-{i}" for i in range(200)]
