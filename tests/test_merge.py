"""Precedence merge on two small sources, computed by hand."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import merge as M
from tallyloom.sources import extracts as E

KEY = "Projekt-Nr"
FIRST = [(1, "P-1001", "Kundenportal", "MUC-01", "16", "DB2"), (2, "P-1002", "Archiv", "FRA-02", "", "Oracle"),
         (3, "P-1003", "Mahnwesen", "", "4", ""), (4, "", "Ohne Nummer", "MUC-01", "1", "")]
SECOND = [(1, "p-1001", "Kundenportal", "muc-01", "32", "Redis"), (2, "P-1002", "", "", "8", "Oracle"),
          (3, "P-1004", "Neu", "BER-01", "2", ""), (4, " ", "Ohne Nummer", "FRA-02", "", "")]
DDL = f"_row int, `{KEY}` string, Name string, Ort string, CPU string, Datenbank string"


@pytest.fixture(scope="module", params=[1, 7])
def stacked(spark, request):
    parts = {"01-sap.csv": FIRST, "02-cmdb.csv": SECOND}
    frames = {n: spark.createDataFrame(rows, DDL).orderBy(F.rand(request.param)).repartition(request.param)
              for n, rows in parts.items()}
    return M.stack_sources(frames)


def test_first_value_wins_per_cell(stacked):
    rows = [tuple(r) for r in M.ordered_merge(M.merge_sources(stacked, KEY)).collect()]
    assert rows == [("P-1001", "Kundenportal", "MUC-01", "16", "DB2"), ("P-1002", "Archiv", "FRA-02", "8", "Oracle"),
                    ("P-1003", "Mahnwesen", "", "4", ""), ("P-1004", "Neu", "BER-01", "2", ""),
                    ("", "Ohne Nummer", "MUC-01", "1", ""), ("", "Ohne Nummer", "FRA-02", "", "")]


def test_conflicts_are_the_three_real_ones(stacked):
    rows = {tuple(r)[:5] for r in M.merge_conflicts(stacked, KEY).collect()}
    assert rows == {("P-1001", "CPU", "16", "01-sap.csv", "32"), ("P-1001", "Datenbank", "DB2", "01-sap.csv", "Redis"),
                    ("P-1001", "Ort", "MUC-01", "01-sap.csv", "muc-01")}


def test_stats_and_variants(stacked):
    assert M.merge_stats(stacked, KEY).first().asDict() == {
        "rows_in": 8, "rows_out": 6, "blank_keys": 2, "columns": 5, "conflicts": 3}
    assert [tuple(r) for r in M.key_variants(stacked, KEY).collect()] == [("P-1001", "p-1001", 1)]


def test_renaming_a_source_changes_precedence(spark):
    frames = {"09-sap.csv": spark.createDataFrame(FIRST, DDL), "02-cmdb.csv": spark.createDataFrame(SECOND, DDL)}
    merged = M.merge_sources(M.stack_sources(frames), KEY).where("_id = 'p-1001'").first()
    assert (merged["Ort"], merged["CPU"], merged[KEY]) == ("muc-01", "32", "p-1001")


def test_extracts_of_three_dialects(spark, tmp_path):
    (tmp_path / "01-a.csv").write_bytes("Titel\n\nProjekt-Nr;Name;\nP-1;Größe;\n;;\nP-2;Weiß\n".encode("cp1252"))
    (tmp_path / "02-b.csv").write_bytes("﻿projekt-nr,Name,Ort\np-1,x,\"a\nb\"\nP-3,y,z,zu viel\n".encode())
    (tmp_path / "merged.csv").write_text("Projekt-Nr\nP-9\n")
    stacked = E.read_extracts(spark, str(tmp_path), KEY)
    rows = {tuple(r)[1:] for r in stacked.select("_row", "_file", KEY, "Name", "Ort").collect()}
    assert rows == {("01-a.csv", "P-1", "Größe", ""), ("01-a.csv", "P-2", "Weiß", ""),
                    ("02-b.csv", "p-1", "x", "a\nb"), ("02-b.csv", "P-3", "y", "z")}
    found = {d.file: (d.encoding, d.delimiter, d.header_line, d.exact) for d in E.detect_dialects(spark, str(tmp_path), KEY)}
    assert found == {"01-a.csv": ("cp1252", ";", 3, True), "02-b.csv": ("utf-8-sig", ",", 1, False)}


def test_a_source_without_the_key_is_named(spark, tmp_path):
    (tmp_path / "02-keyless.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="02-keyless.csv"):
        E.read_extracts(spark, str(tmp_path), KEY)
