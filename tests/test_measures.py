"""Cross-tabs in long form, axes by source, coverage of missing teams."""

from pyspark.sql import functions as F

from tallyloom.operators import measures as M
from tallyloom.operators.validate import coverage_report
from tallyloom.sources.dimensions import axis, load_dimensions, with_labels

ROWS = M.Definition("n", "t")


def _dims(spark):
    return load_dimensions(spark, {"sites": {"order": ["b", "a"], "codes": {"a": {"label_en": "From the taxonomy"}, "b": {}}}},
                           {"sites": {"a": {"label_en": "From the list"}, "c": {}}})


def test_axis_of_a_name_that_two_sources_share(spark):
    dims = _dims(spark)
    assert [r["code"] for r in axis(dims, "sites").orderBy("position").collect()] == ["b", "a"]
    assert sorted(r["code"] for r in axis(dims, ("reference", "sites")).collect()) == ["a", "c"]
    rows = with_labels(spark.createDataFrame([("a",), ("z",)], "code string"), "code", dims, ("reference", "sites"))
    assert {tuple(r) for r in rows.select("code", "code_label_en").collect()} == {("a", "From the list"), ("z", "z")}


def test_cells_equal_the_wide_form(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), (None, "y"), ("q", "x")], "r string, c string")
    dims = _dims(spark)
    wide = M.cross_tab(df, ROWS, "r", "c", dims, "sites", None)
    names = [c for c in wide.columns if c not in ("r", "position", "total")]
    want = {(w["r"], w["position"], w["total"], c, w[c], i) for w in wide.collect() for i, c in enumerate(names)}
    cells = M.cross_tab_cells(df, ROWS, "r", "c", dims, "sites", None)
    assert {tuple(x) for x in cells.select("r", "position", "total", "c", "value", "column_position").collect()} == want
    few = M.cross_tab_cells(df, ROWS, "r", "c", dims, "sites", None, fill=False)
    assert {tuple(x) for x in few.select("r", "position", "total", "c", "value", "column_position").collect()} == {w for w in want if w[4]}


def test_more_codes_than_columns_can_hold(spark):
    df = spark.range(24_000).select((F.col("id") % 2).cast("string").alias("r"), (F.col("id") % 12_000).cast("string").alias("c"))
    cells = M.cross_tab_cells(df, ROWS, "r", "c", _dims(spark), None, None)
    found = cells.groupBy("r").agg(F.count(F.lit(1)), F.sum("value"), F.max("total"), F.countDistinct("column_position")).collect()
    assert {tuple(x) for x in found} == {(r, 12_001, n, n, 12_001) for r, n in (("0", 12_000), ("1", 12_000), ("unknown", 0))}


def test_empty_and_absent(spark):
    df = spark.createDataFrame([], "r string, c string")
    cells = M.cross_tab_cells(df, ROWS, "r", "c", _dims(spark), ("taxonomy", "sites"), None)
    assert {(x["r"], x["c"], x["value"]) for x in cells.collect()} == {("a", "unknown", 0), ("b", "unknown", 0), ("unknown", "unknown", 0)}
    assert M.cross_tab_cells(df, ROWS, "r", "gone", _dims(spark), "sites", None).count() == 0


def test_a_missing_team_is_unknown_in_both_reports(spark):
    df = spark.createDataFrame([("t", 1, 2, "verified"), (None, 2, 2, None)], "team_id string, fields_filled long, fields_tracked long, confidence string")
    want = {("team", "t", 1, 50.0, 100.0), ("team", "unknown", 1, 100.0, 0.0), ("total", None, 2, 75.0, 50.0)}
    for rows in (M.coverage(df), coverage_report(df)):
        assert {(r["scope"], r["team_id"], r["projects"], float(r["coverage_pct"]), float(r["verified_pct"])) for r in rows.collect()} == want
