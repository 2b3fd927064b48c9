"""Documents are read in one step, with the same results as place by place."""

import json

from tallyloom.functions.known import is_known
from tallyloom.functions.text import WHITE_SPACE
from tallyloom.operators import validate as V
from tallyloom.schema import project_schema
from tallyloom.sources.dimensions import load_dimensions
from tallyloom.sources.documents import json_documents

ODD = {"ownership": "x", "classification": {"security_class": 7, "classification_a": None}, "_meta": None, "migration": {"blockers": {}},
       "datastores": [5, None, {"engine": "bad", "role": True}, {"engine": " Unknown "}], "operations": {"tier": "\tgold "},
       "platform": {"storage_classes": ["x", None, 3, "unKnown"], "deployment_model": ["vm"]},
       "placement": {"datacenter": {"a": 1}, "environments": [{"os": {"family": "z"}}, {"os": []}, [1], {"datacenter": "q"}]}}


def documents(spark, *docs):
    return json_documents(spark.createDataFrame([(str(i), d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "file string, body string"))


def test_leaves_are_read_in_one_step(spark):
    docs = documents(spark, ODD)
    plan = docs.select("file", "doc").select(V.results_of(project_schema(), V.leaf_check())).\
        _jdf.queryExecution().analyzed().toString()
    assert plan.count("try_variant_get(doc#") == 1
    rows = {(r.path, r.value) for r in V.coded_leaves(documents(spark, ODD, "[1]", "null", "{"), project_schema()).collect()}
    assert rows == {("datastores[2].engine", "bad"), ("operations.tier", "\tgold "), ("platform.storage_classes[0]", "x"),
                    ("placement.environments[0].os.family", "z"), ("placement.environments[3].datacenter", "q")}


def test_structure_of_odd_documents(spark):
    found = {(r.code, r.path, r.message.split(", ")[-1]) for r in V.check_structure(documents(spark, {"schema_version": 1, "id": "a", **ODD}), project_schema()).collect()}
    assert found == {
        ("structure.type", "ownership", "got string"), ("structure.type", "classification.security_class", "got bigint"),
        ("structure.type", "_meta", "got void"), ("structure.type", "migration.blockers", "got object"),
        ("structure.type", "datastores[0]", "got bigint"), ("structure.type", "datastores[1]", "got void"),
        ("structure.type", "datastores[2].role", "got boolean"), ("structure.type", "platform.storage_classes[2]", "got bigint"),
        ("structure.type", "platform.deployment_model", "got array"), ("structure.type", "placement.datacenter", "got object"),
        ("structure.type", "placement.environments[1].os", "got array"), ("structure.type", "placement.environments[2]", "got array")}


def test_codes_need_no_list_of_lists(spark):
    dims = load_dimensions(spark, {"tier": {"order": ["tier-1"], "codes": {"tier-1": {}}}}, {"sites": {"q": {}}})
    leaves = V.coded_leaves(documents(spark, ODD), project_schema())
    once = lambda df: df._jdf.queryExecution().analyzed().toString().count("Generate explode")
    made = []
    real, V.cut_lineage = V.cut_lineage, lambda df: (made.append(once(df)), real(df))[1]
    try:
        codes, refs = V.check_lists(leaves, dims, "taxonomy"), V.check_lists(leaves, dims, "reference")
    finally:
        V.cut_lineage = real
    assert made == [1, 1]
    assert {r.path for r in codes.collect()} == {"datastores[2].engine", "operations.tier", "platform.storage_classes[0]", "placement.environments[0].os.family"}
    assert refs.collect() == []
    both = V.check_documents(documents(spark, ODD), project_schema(), dims, spark.createDataFrame([], "id string"))
    assert {r.path for r in both.where("code = 'ref.unknown-code'").collect()} == {r.path for r in codes.collect()}


def test_known_as_python_has_it(spark):
    words = ["", "unknown", "unKnown", "UNKNOWN", "unknow", "unknownn", "un known", "x", "unknown x", "x unknown", "İ"]
    texts = [a + w + b for w in words for a in ("", " ", "\n　") for b in ("", "\t ")] + list(WHITE_SPACE) + ["​", "\n", " unknown\n"]
    got = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", is_known("t").alias("k")).collect()
    for r in got:
        assert r.k == (r.t is not None and r.t.strip(WHITE_SPACE).lower() not in ("", "unknown")), repr(r.t)
