import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import numbers as N
from tallyloom.functions import similarity as S
from tallyloom.functions import text as X
from tallyloom.operators.convert import assign_ids
from tallyloom.operators import keyed
from tallyloom.operators.keyed import attach_by_key, row_numbers


def one(spark, value, expression, ddl="c string"):
    return spark.createDataFrame([(value,)], ddl).select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize("value, expected", [
    ("  a \t b ", "a b"), ("k.A.", None), (" - ", None), ("a\n\n\nb", "a\nb"), ("k.  a.", None), ("x", "x"), ("", None)])
def test_clean_cell(spark, value, expected):
    assert one(spark, value, X.clean_cell("c")) == expected


@pytest.mark.parametrize("value, expected", [
    ("Größe (GB)", "groesse_gb"), ("Éà ß!", "ea_ss"), ("***", "feld"), ("MS-SQL 2", "ms_sql_2")])
def test_slugify(spark, value, expected):
    assert one(spark, value, X.slugify("c")) == expected


@pytest.mark.parametrize("value, locale, expected", [
    ("1.200,5", "de", 1200.5), ("1,5", "en", 1.5), ("2.500", "de", 2500.0), ("2.500", "ambiguous", 2500.0), ("2.500", "en", 2.5),
    ("800 GB", "en", 800.0), ("1.234.567", "en", 1234567.0), ("2.5", "de", 2.5), ("1 200", "en", None), ("abc", "en", None), ("-7", "en", -7.0)])
def test_parse_number(spark, value, locale, expected):
    assert one(spark, value, N.parse_number("c", locale)) == expected


@pytest.mark.parametrize("value, expected", [
    ("30.06.2024", dt.date(2024, 6, 30)), ("1.2.69", dt.date(1969, 2, 1)), ("1.2.68", dt.date(2068, 2, 1)), ("2027-11-30", dt.date(2027, 11, 30)),
    ("31/12/2024", dt.date(2024, 12, 31)), ("12/31/2024", dt.date(2024, 12, 31)), ("31.02.2024", None), ("heute", None)])
def test_parse_date(spark, value, expected):
    assert one(spark, value, N.parse_date("c")) == expected


def test_number_text_keeps_all_digits(spark):
    assert one(spark, "0012345678901234567.50", N.number_text(N.plain_number("c"))) == "12345678901234567.5"
    assert one(spark, "100", N.number_text(N.plain_number("c"))) == "100"


def test_suggestions(spark):
    names = ["security_class", "storage_gb"]
    assert one(spark, "secrutiy_class", S.closest_by_edits("c", names)) == "security_class"
    assert one(spark, "secrutiy_class", S.closest_by_ratio("c", names)) == "security_class"
    assert one(spark, "zzz", S.closest_by_edits("c", names)) is None


def test_row_numbers_of_a_hot_group(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"), "id")
    numbered = row_numbers(rows, ["id"], group=["g"]).where("g = 'hot'").orderBy("id").collect()
    assert [r["row_no"] for r in numbered] == list(range(1, 2001))
    overall = row_numbers(rows, [F.desc("id")]).orderBy("row_no").collect()
    assert [r["id"] for r in overall] == list(range(2999, -1, -1))


@pytest.mark.parametrize("limit", [10, 100_000])
def test_attach_by_key_equals_a_plain_join(spark, monkeypatch, limit):
    monkeypatch.setattr(keyed, "MAX_BROADCAST_ROWS", limit)
    big = spark.range(20000).select(F.when(F.col("id") < 9000, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = attach_by_key(big, small, ["k"], weight="n")
    want = big.join(small.drop("n"), "k")
    assert got.count() == 20000
    assert got.select("k", "id", "top").exceptAll(want.select("k", "id", "top")).count() == 0


def test_ids_count_up_past_taken_ones(spark):
    rows = spark.createDataFrame([("A b", 1), ("a-b", 2), ("A B", 3), ("a b 2", 4), ("zz", 5), (None, 6), ("zz", 7), ("q", 8)], "k string, r long")
    stored = spark.createDataFrame([("q", "my-q"), ("old", "zz"), ("old2", "zz-2")], "source_key string, project_id string")
    got = {r["r"]: r["project_id"] for r in assign_ids(rows, "k", "r", stored).collect()}
    assert got == {1: "a-b", 2: "a-b-3", 3: "a-b-4", 4: "a-b-2", 5: "zz-3", 6: "projekt-6", 7: "zz-3", 8: "my-q"}
    bulk = spark.range(500).select(F.lit("Gleich").alias("n"), F.concat(F.lit("gleich!"), F.repeat(F.lit("!"), F.col("id").cast("int"))).alias("k"), F.col("id").alias("r"))
    ids = [r["project_id"] for r in assign_ids(bulk, "k", "r").orderBy("r").collect()]
    assert ids == ["gleich"] + [f"gleich-{i}" for i in range(2, 501)]


def test_tasks_that_parse_are_even_and_of_bounded_size(spark, tmp_path):
    from tallyloom import session

    spark.range(3 * session.TASK_ROWS * 8).coalesce(1).write.parquet(str(tmp_path / "large"))
    sizes = [len(list(p)) for p in session.spread(spark.read.parquet(str(tmp_path / "large"))).rdd.mapPartitions(lambda p: [[None] * sum(1 for _ in p)]).collect()]
    assert len(sizes) == 24 and max(sizes) <= 1.1 * session.TASK_ROWS
