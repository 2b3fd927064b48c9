"""Validation and flattening of small document sets."""

import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import flatten as L
from tallyloom.operators import graph as G
from tallyloom.operators import measures as M
from tallyloom.operators import validate as V
from tallyloom.operators.rules import shipped_rules
from tallyloom.schema import column_catalogue, project_schema, table_ddl, tracked_patterns
from tallyloom.sources.dimensions import load_dimensions, scan_dimensions
from tallyloom.sources.documents import json_documents, parse_documents, positions, scan_documents

BARE = {"schema_version": 1, "id": "minimal-record", "name": "Minimal"}
FULL = {"schema_version": 1, "id": "payment-gateway", "name": "Payment", "ownership": {"team_id": "team-alpha"},
        "placement": {"environments": [{"name": "prod", "datacenter": "muc-01", "os": {"family": "windows", "version": "2019"}},
                                       {"name": "test", "datacenter": "muc-01", "os": {"family": "windows"}}]},
        "datastores": [{"engine": "db2", "version": "11.5"}, {"engine": "redis"}],
        "migration": {"status": "migrated", "blockers": [{"id": "BLK-1", "status": "open"}, {"id": "BLK-2", "status": "closed"}]},
        "integration": {"depends_on": ["minimal-record", "unknown"]}, "_meta": {"confidence": "verified", "last_reviewed": "2026-01-01"}}
SCALAR = {"schema_version": 1, "id": "reporting-hub", "placement": {"datacenter": "fra-02"}, "datastores": None,
          "platform": {"cpu_cores": "unknown", "storage_classes": ["file", "block"]}}
DIMS = ({"engine": {"order": ["db2", "redis", "oracle", "unknown"], "codes": {"db2": {"label_de": "DB2"}, "redis": {}, "oracle": {},
                                                                              "unknown": {"label_de": "Unbekannt", "colour": "#999999"}}}},
        {"sites": {"muc-01": {}, "fra-02": {}, "unknown": {}}, "teams": {"team-alpha": {}, "unknown": {}}})


def docs_of(spark, *docs):
    rows = [(f"{i}.json", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return json_documents(spark.createDataFrame(rows, "file string, body string"))


@pytest.fixture(scope="module")
def tables(spark):
    return {n: df.cache() for n, df in L.flatten_all(docs_of(spark, BARE, FULL, SCALAR), project_schema()).items()}


def test_declared_columns(tables):
    for name, ddl in table_ddl(project_schema()).items():
        assert set(tables[name].columns) == {c.split()[0] for c in ddl.split(", ")}
    assert len(tracked_patterns(project_schema())) == 19


def test_bare_document(tables):
    stores = [(r.engine, r.is_placeholder) for r in tables["datastores"].where("project_id = 'minimal-record'").collect()]
    assert stores == [("unknown", True)]
    project = tables["projects"].where("project_id = 'minimal-record'").first()
    assert project.cpu_cores is None and project.fields_filled == 1 and project.team_id == "unknown"


def test_both_placement_shapes(tables):
    rows = {(r.project_id, r.idx, r.name, r.datacenter, r.os_family, r.is_placeholder) for r in tables["environments"].collect()}
    assert rows == {("minimal-record", 0, None, "unknown", "unknown", True), ("payment-gateway", 0, "prod", "muc-01", "windows", False),
                    ("payment-gateway", 1, "test", "muc-01", "windows", False), ("reporting-hub", 0, None, "fra-02", "unknown", False)}


def test_lists_edges_and_numbers(tables):
    hub = tables["projects"].where("project_id = 'reporting-hub'").first()
    assert (hub.storage_classes, hub.cpu_cores) == ("block, file", None)
    assert [(r.from_project, r.to_project, r.idx) for r in tables["dependencies"].collect()] == [("payment-gateway", "minimal-record", 0)]


def test_convenience_columns(tables):
    rows = {r.project_id: r for r in M.enrich_projects(tables["projects"], tables["datastores"], tables["environments"], tables["blockers"]).collect()}
    full = rows["payment-gateway"]
    assert (full.datastore_engines, full.has_db2, full.sites, full.os_families, full.open_blockers) == ("db2, redis", "full", "muc-01", "windows", 1)
    assert rows["minimal-record"].has_db2 == "none" and rows["minimal-record"].open_blockers == 0


def test_distribution_invariants(spark, tables):
    dims = load_dimensions(spark, *DIMS)
    rule = M.Definition("with_engine", "datastores", "projects")
    rows = M.ordered(M.distribution(tables["datastores"], rule, "engine", dims, "engine"), "engine").collect()
    assert [(r.engine, r.value) for r in rows] == [("db2", 1), ("redis", 1), ("oracle", 0), ("unknown", 2)]
    assert [r.engine_label_de for r in rows] == ["DB2", "redis", "oracle", "Unbekannt"] and rows[3].engine_colour == "#999999"
    assert sum(r.value for r in rows) > tables["projects"].count()
    empty = M.distribution(tables["blockers"].where("false"), M.Definition("b", "blockers"), "status", dims, "engine").collect()
    assert sorted(r.value for r in empty) == [0, 0, 0, 0]
    cross = M.cross_tab(tables["environments"], M.Definition("x", "environments"), "datacenter", "os_family", dims, "sites", "engine")
    assert cross.agg(F.sum("total")).first()[0] == tables["environments"].count()


def test_missing_null_and_unknown_cover_the_same(spark):
    variants = docs_of(spark, {"id": "a"}, {"id": "a", "name": None, "datastores": []}, {"id": "a", "name": " Unknown ", "datastores": [{"engine": "unknown"}]})
    assert {r.fields_filled for r in L.coverage_columns(variants, project_schema()).collect()} == {0}


def codes(findings):
    return sorted(r.code for r in findings.collect())


def structure(spark, doc):
    return V.check_structure(docs_of(spark, doc), project_schema())


def test_valid_documents_have_no_findings(spark):
    assert codes(structure(spark, FULL)) == [] and codes(structure(spark, SCALAR)) == []


@pytest.mark.parametrize("change, expected", [
    ({"datastores": [{"version": 7.9}, {"version": 2016}]}, ["structure.type", "structure.type"]),
    ({"classification": {"secrutiy_class": "S1"}}, ["structure.unknown-field"]),
    ({"schema_version": 2}, ["structure.const"]), ({"platform": {"cpu_cores": -1}}, ["structure.anyOf"]),
    ({"platform": {"cpu_cores": 2.5}}, ["structure.anyOf"]), ({"platform": None}, ["structure.type"]),
    ({"datastores": {}}, ["structure.type"]), ({"id": "Not Valid"}, ["structure.pattern"]),
    ({"migration": {"target_date": "14.09.2026"}}, ["structure.pattern"]), ({"name": True}, ["structure.type"]),
    ({"_unmapped": {"any": {"thing": [1]}}, "_meta": {"extra": 1}}, []),
    ({"placement": {"environments": [{"os": {"famly": "x"}}]}}, ["structure.unknown-field"])])
def test_structure_faults(spark, change, expected):
    assert codes(structure(spark, {**BARE, **change})) == expected


def test_required_and_paths(spark):
    rows = structure(spark, {"name": "x"}).collect()
    assert {r.message for r in rows} == {"missing required field 'id'", "missing required field 'schema_version'"}
    nested = structure(spark, {**BARE, "placement": {"environments": [{}, {"os": {"version": 7}}]}}).first()
    assert nested.path == "placement.environments[1].os.version"


def test_references_and_codes(spark):
    dims = load_dimensions(spark, *DIMS)
    bad = {**FULL, "ownership": {"team_id": "team-omega"}, "datastores": [{"engine": "access"}],
           "placement": {"datacenter": "xyz-99"}, "integration": {"depends_on": ["does-not-exist"]}}
    docs = docs_of(spark, bad)
    leaves = V.coded_leaves(docs, project_schema()).where("taxonomy = 'engine' OR ref IS NOT NULL")
    ids = spark.createDataFrame([("payment-gateway",)], "id string")
    found = V.check_lists(leaves, dims).unionByName(V.check_dangling(leaves, ids))
    assert codes(found) == ["ref.unknown-code", "ref.unknown-projects", "ref.unknown-sites", "ref.unknown-teams"]


def test_rules(spark):
    stale = {"id": "a", "platform": {"deployment_model": "container", "containerised": "none", "storage_classes": ["x"], "storage_gb": 0},
             "operations": {"tier": "tier-1", "rto_hours": 168}, "placement": {"datacenter": "m", "environments": [{"name": "test"}]},
             "migration": {"status": "migrated", "blockers": [{"id": "B", "status": "open"}, {"status": "open"}]}, "_meta": {"confidence": "verified"}}
    rows = {r.code: r.message for r in shipped_rules().apply(docs_of(spark, stale)).collect()}
    assert len(rows) == 7
    assert rows["plausible.migrated-with-open-blockers"].endswith("2 blocker(s) are still open: B, ?")
    assert codes(shipped_rules().apply(docs_of(spark, BARE, SCALAR))) == []


def test_yaml_files(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("schema_version: 1\nid: a\nclassification:\n  classification_b: CB-7\nversion: 2026-09-14\nflag: yes\nn: '7'\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.yaml").write_text("platform:\n  x: 1\nplatform:\n  y: 2\n")
    (tmp_path / "c.yaml").write_text("")
    (tmp_path / "d.yaml").write_text("a: [1\n")
    (tmp_path / "e.yaml").write_bytes(b"a: \xff\n")
    (tmp_path / "f.yaml").write_text("- 1\n")
    (tmp_path / "_import_manifest.yaml").write_text("x: 1\n")
    parsed = scan_documents(spark, str(tmp_path)).cache()
    assert {r.file: r.code for r in parsed.collect()} == {
        "a.yaml": None, "sub/b.yaml": "parse.duplicate-key", "c.yaml": "parse.empty", "d.yaml": "parse.invalid-yaml",
        "e.yaml": "parse.unreadable", "f.yaml": "parse.not-a-mapping"}
    value = json.loads(parsed.where("file = 'a.yaml'").select(F.to_json("doc")).first()[0])
    assert (value["version"], value["flag"], value["n"], value["schema_version"]) == ("2026-09-14", "yes", "7", 1)
    found = V.finding(parsed.where("file = 'a.yaml'"), "error", "ref.unknown-code", "classification.classification_b", "x")
    assert V.attach_positions(found, positions(parsed)).select("line", "col").first() == (4, 21)


def test_code_list_files(spark, tmp_path):
    (tmp_path / "taxonomy.yaml").write_text("groups:\n  tier:\n    order: [b, a, unknown]\n    codes:\n      a: {label_de: A}\n      b: {label_de: null}\n      unknown: {colour: '#999999'}\n")
    (tmp_path / "sites.yaml").write_text("entries:\n  z: {label_de: Z}\n  unknown: {}\n")
    rows = {(r.source, r.group, r.code, r.label_de, r.colour) for r in scan_dimensions(spark, str(tmp_path)).collect()}
    assert rows == {("taxonomy", "tier", "b", None, None), ("taxonomy", "tier", "a", "A", None), ("taxonomy", "tier", "unknown", None, "#999999"),
                    ("reference", "sites", "z", "Z", None), ("reference", "sites", "unknown", None, None)}


def test_cycles(spark):
    edges = spark.createDataFrame([
        ("alpha", "beta"), ("beta", "gamma"), ("gamma", "alpha"), ("x", "alpha"), ("gamma", "y"), ("y", "z"),
        ("m", "n"), ("n", "m"), ("m", "o"), ("o", "p"), ("p", "m"), ("alpha", "m"), ("s", "s"), ("s", "unknown")], "src string, dst string")
    found = {r.component: (r.members, r.ring) for r in G.find_cycles(edges).collect()}
    assert found == {"alpha": (3, ["alpha", "beta", "gamma", "alpha"]), "m": (4, ["m", "n", "m"]), "s": (1, ["s", "s"])}
    assert "alpha -> beta -> gamma -> alpha" in {r.message.split(": ")[1] for r in G.cycle_findings(edges).collect()}
    assert G.find_cycles(edges.where("src = 'x'")).count() == 0


def test_catalogue(spark):
    rows = {(r.table, r.column): r for r in column_catalogue(spark, project_schema()).collect()}
    assert rows["datastores", "engine"].taxonomy == "engine" and rows["environments", "datacenter"].reference == "sites"
    assert rows["projects", "migration_status"].source == "migration.status"


def test_broken_yaml_is_a_finding(spark):
    files = spark.createDataFrame([("a", bytearray(b"a: 1\na: 2\n"))], "file string, content binary")
    assert codes(V.check_parse(parse_documents(files))) == ["parse.duplicate-key"]
