import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import convert as C
from tallyloom.operators import profile as P
from tallyloom.operators.keyed import is_small, row_numbers
from tallyloom.functions import text as X


def converted(spark, columns, rows, mapping, profile=None, value_map=None):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    out = C.convert(df, mapping, profile or {}, value_map or {})
    return [json.loads(r[0]) for r in out.select(F.to_json("record")).collect()]


def test_numbers_stay_numbers_and_failures_stay_text(spark):
    kinds = {"a": {"kind": "integer"}, "b": {"kind": "number", "number_locale": "de"}, "c": {"kind": "number"}}
    got = converted(spark, "abc", [("8", "1.234,5", "x"), ("800 GB", None, "007")], {"a": "p.cpu", "b": "p.amount", "c": "p.other"}, kinds)
    assert got[0] == {"p": {"amount": 1234.5, "cpu": 8, "other": "x"}}
    assert got[1]["p"]["cpu"] == 800 and "amount" not in got[1]["p"]


def test_elements_with_different_fields(spark):
    got = converted(spark, "ab", [("x", "y"), ("x", None)], {"a": "l[0].x", "b": "l[1].y"})
    assert got[0] == {"l": [{"x": "x"}, {"y": "y"}]} and got[1]["l"][0] == {"x": "x"}
    assert converted(spark, "ab", [("x", "y")], {"a": "l[0].x", "b": "l[2].x"})[0] == {"l": [{"x": "x"}, None, {"x": "y"}]}


def test_several_values_on_a_single_place_stay_a_list(spark):
    profile = {"a": {"kind": "list", "list_separator": ";"}}
    got = converted(spark, "a", [("x; y",), ("z",)], {"a": "p.name"}, profile)
    assert got == [{"p": {"name": ["x", "y"]}}, {"p": {"name": "z"}}]
    coded = converted(spark, "a", [("both",), ("one",)], {"a": "p.name"}, value_map={"p.name": {"both": ["u", "v"], "one": "w"}})
    assert coded == [{"p": {"name": ["u", "v"]}}, {"p": {"name": "w"}}]


def test_lists_are_zipped_by_position(spark):
    profile = {c: {"kind": "list", "list_separator": ";"} for c in "ab"} | {"c": {"kind": "integer", "list_separator": ";"}}
    got = converted(spark, "abc", [("x;y", "u", "1;2;three")], {"a": "d[].e", "b": "d[].r.s", "c": "n[]"}, profile)
    assert got == [{"d": [{"e": "x", "r": {"s": "u"}}, {"e": "y", "r": {}}], "n": [1, 2, "three"]}]


@pytest.mark.parametrize("mapping", [{"a": "l[].x", "b": "l[0].y"}, {"a": "p", "b": "p.q"}, {"a": "1x"}, {"a": "p..q"}])
def test_mappings_that_contradict_themselves(spark, mapping):
    with pytest.raises(ValueError):
        converted(spark, "ab", [("x", "y")], mapping)


def test_ties_take_the_first_spelling(spark):
    tokens = spark.createDataFrame([("c", "DB2", 3), ("c", "db2", 3), ("c", "d-b-2", 3)], "column string, value string, n bigint")
    assert P.canonical_values(tokens).first().canonical == "DB2"


def test_padded_markers_are_empty(spark):
    df = spark.createDataFrame([("-" + " " * 20,), (" " * 20 + "k.A.",), ("no marker",)], "v string")
    assert [r[0] for r in df.select(X.clean_cell(F.col("v"))).collect()] == [None, None, "no marker"]


def test_used_numbers_of_one_slug_spread_over_ranges(spark):
    taken = spark.range(2, 3001).select(F.concat(F.lit("foo-"), F.col("id").cast("string")).alias("project_id"))
    taken = taken.unionByName(spark.sql("select 'foo' as project_id"))
    keys = spark.createDataFrame([("k1", "foo", 1), ("k2", "foo", 2), ("k3", "bar", 3)], "source_key string, _slug string, _row bigint")
    got = {r.source_key: r.project_id for r in C.number_slugs(keys, taken).collect()}
    assert got == {"k1": "foo-3001", "k2": "foo-3002", "k3": "bar"}


def test_rows_of_equal_order_are_numbered_once_each(spark):
    df = spark.range(2000).withColumn("same", F.lit(1))
    assert sorted(r[0] for r in row_numbers(df, ["same"]).select("row_no").collect()) == list(range(1, 2001))


def test_wide_values_are_not_small(spark):
    wide = spark.range(200).withColumn("t", F.repeat(F.lit("x"), 100_000))
    assert not is_small(wide) and is_small(spark.range(200)) and not is_small(spark.range(200), limit=100)


def test_decimals_can_be_settled(spark):
    counts = P.value_counts(spark.createDataFrame([("1.500",), ("2.500",)], "a string"), ["a"])
    seen = lambda **k: P.profile_columns(counts, **k).first().number_locale
    assert seen() == "ambiguous" and seen(decimals={"a": "de"}) == "de" and seen(decimals={"a": "en", "b": "de"}) == "en"


def test_suggestions_are_one_edit_away(spark):
    from tallyloom.operators.validate import _one_edit_away

    missing = spark.createDataFrame([("paymnt",), ("payments",), ("pay",), ("x",)], "value string")
    ids = spark.createDataFrame([("payment",), ("paymen",), ("pax",), ("",), ("yy",)], "id string")
    assert {r.value: r.near for r in _one_edit_away(missing, ids).collect()} == {"paymnt": "payment", "payments": "payment", "pay": "pax", "x": ""}
