import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing, shards

from . import cases


def placed(spark, rows, n=4):
    df = spark.createDataFrame(rows, cases.DOCS)
    return shards.with_slots(shards.with_shards(df, n)).toPandas()


def test_shards_are_level_and_keep_equal_texts_together(spark):
    rows = [(i, cases.words(i % 900, 20 + i % 50), "en", "a", 0) for i in range(1500)]
    rows += [(5000 + i, "the very same text", "en", "a", 0) for i in range(40)]
    got = placed(spark, rows, 8)
    assert len(got) == len(rows)
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.02 * sizes.mean() and sizes.min() > 0.98 * sizes.mean()
    assert got.groupby("text").shard.nunique().max() == 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_group_heavier_than_a_shard_is_split_evenly(spark):
    rows = [(i, "copy of one text " * 5, "en", "a", 0) for i in range(900)]
    rows += [(1000 + i, cases.words(i, 15), "en", "a", 0) for i in range(900)]
    sizes = placed(spark, rows, 6).groupby("shard")["size"].sum()
    assert len(sizes) == 6 and sizes.max() < 1.05 * sizes.mean()


def test_sharding_edge_cases(spark):
    got = placed(spark, cases.documents())
    assert len(got) == len(cases.documents())
    assert set(got[got.text.isna()]["size"]) == {8}
    assert placed(spark, []).empty
    assert len(placed(spark, [(1, None, None, None, None)])) == 1
    clash = shards.with_slots(shards.with_shards(cases.clashing(cases.frame(spark)), 4))
    assert clash.count() == len(cases.documents()) and dict(clash.dtypes)["shard"] == "int" and dict(clash.dtypes)["key"] == "string"


def reference_targets(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(sizes)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: cap * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("shape", [{"a": 400, "b": 30, "c": 5, None: 60}, {"a": 3, "b": 300, "c": 300}, {"a": 50}])
def test_mix_comes_near_targets(spark, shape):
    rows, i = [], 0
    for source, n in shape.items():
        for _ in range(n):
            i += 1
            rows.append((i, cases.words(i, 10 + i % 120), "en", source, 0))
    got = mixing.mix(spark.createDataFrame(rows, cases.DOCS)).toPandas()
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in shape}
    want = reference_targets(sizes)
    for source in shape:
        part = got[got.source.isna()] if source is None else got[got.source == source]
        assert part.target.iloc[0] == pytest.approx(want[source])
        assert abs((part.copies * part["size"]).sum() - want[source]) <= 65
        assert part.copies.between(0, 2).all()


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(i, cases.words(i, 40), "en", "a", 0) for i in range(2000)] + [(9999, cases.words(3, 100_000, 9), "en", "b", 0)]
    df = spark.createDataFrame(rows, cases.DOCS)
    got = mixing.mix(df, share=0.25, weight=F.when(F.col("u") >= 0, F.when(F.col("size") == 40, 1.0).otherwise(0.5))).toPandas()
    assert got[got.source == "a"].copies.mean() == pytest.approx(got[got.source == "a"].target.iloc[0] / 80_000, abs=0.02)


def test_mixing_edge_cases(spark):
    df = cases.frame(spark)
    got = mixing.mix(cases.clashing(df))
    assert got.count() == df.count() and dict(got.dtypes)["u"] == "string" and dict(got.dtypes)["size"] == "bigint"
    again = mixing.mix(df.repartition(3)).select("doc_id", "copies").toPandas()
    first = mixing.mix(df).select("doc_id", "copies").toPandas()
    assert sorted(map(str, first.values.tolist())) == sorted(map(str, again.values.tolist()))
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("text is null")).select("copies").first()[0] == 0
    assert mixing.repeated(mixing.mix(df)).columns == df.columns
