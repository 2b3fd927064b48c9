import re
from collections import Counter

import corpus_pipeline
from tallyloom.llm import queries

from . import cases
from .test_ngram_join import brute_force
from .test_sharding_mixing import reference_targets


def world(spark, folder):
    """Documents with toxic ones, near copies and benchmark passages, as tables in ``folder``."""
    passage = cases.words(4242, 14)
    docs, labels = [], []
    for i in range(240):
        text = cases.words(i, 60 + i % 40, 4000)
        if i % 6 == 0:
            text += " what a moron"
        elif i % 20 == 1:
            text += f" {passage} end"
        docs.append((i, text, "en", "abc"[i % 3], len(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    for i in range(240, 270):
        text = docs[i - 200][1] + (" tail" if i % 2 else "")
        docs.append((i, text, "en", "a", len(text)))
    docs += [(400, None, None, None, None), (401, "", "en", "b", 0)]
    for name, rows, schema in (("documents", docs, cases.DOCS), ("labels", labels, "doc_id bigint, quality int, toxic int"),
                               ("benchmark", [(1, passage), (2, None)], "item_id bigint, text string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return docs, passage


def test_stages_against_brute_force(spark, tmp_path):
    docs, passage = world(spark, tmp_path)
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {d[0]: d for d in docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = got.columns
        got = queries.staged(stage(spark, got, str(tmp_path)), name)
        assert got.columns == before == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = [r.doc_id for r in got.select("doc_id").collect()]
        if name == "toxicity":
            kept = {i: d for i, d in kept.items() if not (d[1] and "moron" in d[1])}
        elif name == "ngram_join":
            kept = {i: kept[i] for i, _, c in brute_force(list(kept.values())) if i == c}
        elif name == "decontamination":
            kept = {i: d for i, d in kept.items() if not (d[1] and passage in d[1])}
        if name != "mixing":
            assert sorted(ids) == sorted(kept)
    sizes = Counter()
    for d in kept.values():
        sizes[d[3]] += len(re.findall(r"\S+", d[1] or ""))
    taken, copies = Counter(), Counter(ids)
    for i, n in copies.items():
        assert n <= 2
        taken[kept[i][3]] += n * len((kept[i][1] or "").split())
    for source, want in reference_targets(dict(sizes)).items():
        assert abs(taken[source] - want) <= 60
    name, stage = corpus_pipeline.STAGES[-1]
    out = stage(spark, got, str(tmp_path)).toPandas()
    assert Counter(out.doc_id) == copies and out.shard.between(0, 23).all()
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert out.groupby("text").shard.nunique().max() == 1


def test_run_gives_what_the_stages_give(spark, tmp_path):
    world(spark, tmp_path)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "text", "size", "shard", "slot"} <= set(out.columns) and out.count() > 100


def test_empty_tables_run_through(spark, tmp_path):
    for name, schema in (("documents", cases.DOCS), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_one_query():
    numbers = Counter(re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES)
    assert numbers == {str(k): 1 for k in range(1, 11)} and set(queries.SQL) <= set(queries.QUERIES)
