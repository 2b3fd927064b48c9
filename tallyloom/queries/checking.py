"""Checks on the documents made from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import SUGGESTION_RATIO, closest_by_edits, closest_by_ratio
from ..operators import graph as G
from ..operators import validate as V
from ..operators.rules import Rules, shipped_rules
from ..schema import field, project_schema
from ..sources.dimensions import load_dimensions
from ..sources.documents import parse_documents, positions
from .documents import BROKEN_SQL, documents, yaml_files
from .registry import query, table

CODES = {
    "security_class": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "unknown"],
    "engine": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "unknown"],
    "datastore_role": ["primary", "unknown"], "os_family": ["O", "F", "unknown"], "storage_class": ["block", "unknown"],
    "deployment_model": ["container", "vm", "unknown"], "completeness_scale": ["none", "full", "unknown"],
    "migration_status": ["migrated", "planned", "unknown"], "blocker_status": ["open", "unknown"],
    "tier": ["tier-1", "tier-2", "unknown"], "confidence": ["verified", "unknown"],
}


def code_lists(spark: SparkSession) -> DataFrame:
    taxonomy = {g: {"order": codes, "codes": {c: {} for c in codes}} for g, codes in CODES.items()}
    return load_dimensions(spark, taxonomy, {"sites": {c: {} for c in ("A", "R", "unknown")},
                                             "teams": {c: {} for c in ("team-P", "team-F", "unknown")}})


def leaves(spark: SparkSession, sf: str) -> DataFrame:
    return V.coded_leaves(documents(spark, sf), project_schema())


def _select(level: str, code: str, path: str, message: str, fix: str, source: str) -> str:
    return (f"SELECT '{level}' AS level, {code} AS code, 'o-' || o_orderkey || '.json' AS file, {path} AS path, "
            f"{message} AS message, {fix} AS fix FROM orders WHERE {source}")


UNKNOWN_SQL = _select("error", "'structure.unknown-field'", "'classification.secrutiy_class'", "'unknown field ''secrutiy_class'''",
                      "'did you mean: security_class'", "o_orderpriority = '5-LOW'")
REQUIRED_SQL = _select("error", "'structure.missing-field'", "''", "'missing required field ''schema_version'''",
                       "'every document needs schema_version'", "o_orderstatus = 'O' AND o_totalprice > 450000")
TYPES_SQL = "\nUNION ALL ".join([
    _select("error", "'structure.type'", "'placement.environments[0].os.version'", "'version: expected version, got decimal(2,1)'",
            "CAST(NULL AS VARCHAR)", "o_orderstatus = 'P' AND o_totalprice < 100000"),
    _select("error", "'structure.pattern'", "'migration.target_date'", "'target_date: expected date, got string'",
            "NULL", "o_orderpriority = '2-HIGH'"),
    _select("error", "'structure.anyOf'", "'platform.cpu_cores'", "'cpu_cores: expected count, got bigint'",
            "NULL", "o_totalprice > 480000"),
    _select("error", "'structure.const'", "'schema_version'", "'schema_version: expected schema_version, got bigint'",
            "NULL", "o_orderstatus = 'F' AND o_totalprice > 450000")])


def _advice(value: str, words: list[str]) -> str:
    """SQL of the closest word, or of all of them."""
    return (f"(SELECT CASE WHEN max(s) >= {SUGGESTION_RATIO} THEN 'did you mean: ' || first(w ORDER BY s DESC, w) "
            f"ELSE 'valid values: ' || string_agg(w, ', ' ORDER BY w) END FROM (SELECT w, 1 - levenshtein({value}, w) / "
            f"greatest(length({value}), length(w))::DOUBLE AS s FROM (SELECT unnest({words}) AS w)))")


def _near_id(value: str) -> str:
    """SQL of the closest id of all."""
    return (f"(SELECT 'did you mean: ' || first(id ORDER BY s DESC, id) FROM (SELECT 'o-' || i.o_orderkey AS id, 1 - levenshtein('o-' || i.o_orderkey, {value}) / "
            f"greatest(length('o-' || i.o_orderkey), length({value}))::DOUBLE AS s FROM orders i) WHERE s >= {SUGGESTION_RATIO})")


def _bad_code(path: str, name: str, value: str, where: str) -> str:
    group = {"role": "datastore_role", "storage_classes": "storage_class", "status": "blocker_status"}.get(name, name)
    return _select("error", "'ref.unknown-code'", path, f"'{name}: ''' || {value} || ''' is not a known code'", _advice(value, CODES[group]), where)


CODES_SQL = "\nUNION ALL ".join([
    _bad_code("'classification.security_class'", "security_class", "o_orderpriority", "o_orderpriority = '4-NOT SPECIFIED'"),
    _bad_code("'datastores[0].engine'", "engine", "o_orderpriority", "o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'"),
    _bad_code("'datastores[1].role'", "role", "'x'", "o_orderstatus = 'P'"),
    _bad_code("'platform.storage_classes[1]'", "storage_classes", "'file'", "o_orderstatus = 'P'"),
    _bad_code("'migration.blockers[1].status'", "status", "'closed'", "o_orderstatus = 'F'"),
    _bad_code("'_meta.confidence'", "confidence", "'imported'", "o_orderstatus <> 'P'")])
DANGLING_SQL = "\nUNION ALL ".join([
    _select("error", "'ref.unknown-projects'", "'integration.depends_on[2]'",
            "'depends_on: depends on ''c-' || o_custkey || ''', which is not a known project'", _near_id("'c-' || orders.o_custkey"), "o_orderpriority = '3-MEDIUM'"),
    _select("error", "'ref.unknown-projects'", "'integration.depends_on[0]'",
            "'depends_on: depends on ''o-' || (o_orderkey + 1) || ''', which is not a known project'", _near_id("'o-' || (orders.o_orderkey + 1)"),
            "o_orderkey + 1 NOT IN (SELECT o_orderkey FROM orders)")])
REFERENCES_SQL = "\nUNION ALL ".join([
    _select("error", "'ref.unknown-teams'", "'ownership.team_id'", "'team_id: ''team-O'' is not in teams'", _advice("'team-O'", ["team-P", "team-F", "unknown"]), "o_orderstatus = 'O'"),
    _select("error", "'ref.unknown-sites'", "'placement.environments[1].datacenter'", "'datacenter: ''Q'' is not in sites'", _advice("'Q'", ["A", "R", "unknown"]), "o_orderstatus = 'P'"),
    DANGLING_SQL])


@query("unknown_fields", UNKNOWN_SQL)
def _unknown(spark, sf):
    return V.check_unknown_fields(documents(spark, sf), project_schema())


@query("required_fields", REQUIRED_SQL)
def _required(spark, sf):
    return V.check_required(documents(spark, sf), project_schema())


@query("type_checks", TYPES_SQL)
def _types(spark, sf):
    return V.check_types(documents(spark, sf), project_schema())


@query("code_membership", CODES_SQL)
def _codes(spark, sf):
    return V.check_codes(leaves(spark, sf), code_lists(spark))


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).alias("id"))


@query("reference_membership", REFERENCES_SQL)
def _references(spark, sf):
    pointing = V.coded_leaves(documents(spark, sf), project_schema(), refs=["sites", "teams", "projects"])
    return V.check_references(pointing, code_lists(spark), _ids(spark, sf))


@query("dangling_dependencies", DANGLING_SQL)
def _dangling(spark, sf):
    return V.check_dangling(V.coded_leaves(documents(spark, sf), project_schema(), refs=["projects"]), _ids(spark, sf))


# Orders of one customer on one day share an id on purpose.
@query("duplicate_ids", """WITH d AS (SELECT 'o-' || o_custkey || '-' || strftime(o_orderdate, '%Y') AS id, 'f' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS file FROM orders),
 f AS (SELECT id, MIN(file) AS first_file FROM d GROUP BY 1 HAVING COUNT(*) > 1)
SELECT 'error' AS level, 'ref.duplicate-id' AS code, file, 'id' AS path, 'project id ''' || id || ''' is also used by ' || first_file AS message,
  CAST(NULL AS VARCHAR) AS fix FROM d JOIN f USING (id) WHERE file <> first_file""")
def _duplicates(spark, sf):
    ids = table(spark, sf, "orders").select(
        F.concat(F.lit("o-"), F.col("o_custkey").cast("string"), F.lit("-"), F.date_format("o_orderdate", "yyyy")).alias("id"),
        F.concat(F.lit("f"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("file"))
    return V.check_duplicate_ids(ids)


# Each order waits for the next one of its block of four; filled orders wait
# for nobody, and urgent ones also for themselves.
EDGES_SQL = """edges AS (SELECT o_orderkey AS src, o_orderkey - o_orderkey % 4 + (o_orderkey + 1) % 4 AS dst FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT o_orderkey, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""


def edges(spark: SparkSession, sf: str) -> DataFrame:
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    ahead = orders.where(~F.col("o_orderstatus").eqNullSafe("F")).select(
        key.alias("src"), (key - key % 4 + (key + 1) % 4).alias("dst"))
    return ahead.unionByName(orders.where("o_orderpriority = '1-URGENT'").select(key.alias("src"), key.alias("dst")))


CYCLES_SQL = f"""RECURSIVE {EDGES_SQL}, walk AS (
  SELECT src AS start, dst AS node, [src, dst] AS ring FROM edges WHERE src <> dst
  UNION ALL SELECT start, dst, list_append(ring, dst) FROM walk JOIN edges ON node = src
  WHERE node <> start AND src <> dst AND len(ring) < 6),
 found AS (SELECT start, arg_min(ring, len(ring)) AS ring FROM walk WHERE node = start GROUP BY 1),
 least AS (SELECT * FROM found WHERE start = list_min(ring))"""


@query("dependency_cycles", f"""WITH {CYCLES_SQL}
SELECT start AS component, CAST(len(ring) - 1 AS BIGINT) AS members, array_to_string(ring, ' -> ') AS ring FROM least
UNION ALL SELECT src, 1, src || ' -> ' || dst FROM edges WHERE src = dst""")
def _cycles(spark, sf):
    return G.find_cycles(edges(spark, sf)).withColumn("ring", F.array_join(F.col("ring").cast("array<string>"), " -> "))


@query("graph_trim", f"""WITH {CYCLES_SQL} SELECT e.src, e.dst FROM edges e JOIN (SELECT unnest(ring[:-2]) AS src FROM least) r USING (src) WHERE e.src <> e.dst""")
def _trim(spark, sf):
    return G.trim(G.clean_edges(edges(spark, sf)).where("src <> dst"))


# Blocks of eight orders: each waits for the next one, and two short cuts close smaller rings that share nodes with the large one.
RINGS_SQL = """e AS (SELECT o_orderkey AS src, o_orderkey - o_orderkey % 8 + (o_orderkey + 1) % 8 AS dst FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION SELECT o_orderkey, o_orderkey - 3 FROM orders WHERE o_orderkey % 8 IN (3, 6)),
 walk AS (SELECT src AS a, dst AS b, dst AS node, [dst] AS path FROM e WHERE dst < src
  UNION ALL SELECT a, b, e.dst, list_append(path, e.dst) FROM walk JOIN e ON e.src = node WHERE node <> a AND NOT list_contains(path, e.dst)),
 least AS (SELECT a, b, arg_min(path, [[len(path)], path]) AS path FROM walk WHERE node = a GROUP BY ALL),
 turned AS (SELECT path[list_position(path, list_min(path)):] || path[:list_position(path, list_min(path)) - 1] AS ring FROM least),
 rings AS (SELECT MIN(ring) AS ring FROM turned GROUP BY list_sort(ring)),
 reach AS (SELECT src AS a, dst AS b FROM e UNION SELECT a, dst FROM reach JOIN e ON src = b),
 strong AS (SELECT x.a AS node, x.b AS other FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a),
 sizes AS (SELECT node, MIN(other) AS component, COUNT(*) AS members FROM strong GROUP BY node)"""


def ring_edges(spark: SparkSession, sf: str) -> DataFrame:
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    return (orders.where("o_orderpriority <> '5-LOW'").select(key.alias("src"), (key - key % 8 + (key + 1) % 8).alias("dst"))
            .unionByName(orders.where("o_orderkey % 8 IN (3, 6)").select(key.alias("src"), (key - 3).alias("dst"))))


@query("dependency_rings", f"""WITH RECURSIVE {RINGS_SQL}
SELECT component, CAST(members AS BIGINT) AS members, array_to_string(list_append(ring, ring[1]), ' -> ') AS ring FROM rings JOIN sizes ON node = ring[1]""")
def _rings(spark, sf):
    """A ring for every edge that closes one."""
    return G.find_rings(ring_edges(spark, sf)).withColumn("ring", F.array_join(F.col("ring").cast("array<string>"), " -> "))


NAMES = ["security_class", "storage_gb", "cpu_cores", "deployment_model", "containerised", "classification_a", "team_id"]
_NAMES_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") o(name)"


@query("closest_option_by_edits", f"""WITH s AS (SELECT p_partkey, name, 1 - levenshtein(replace(p_name, ' ', '_'), name) / greatest(length(p_name), length(name)) AS score
  FROM part, {_NAMES_SQL}), b AS (SELECT p_partkey, name FROM s WHERE score >= 0.2 QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, name) = 1)
SELECT p_partkey, name AS closest FROM part LEFT JOIN b USING (p_partkey)""")
def _closest(spark, sf):
    word = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    return table(spark, sf, "part").select("p_partkey", closest_by_edits(word, NAMES, 0.2).alias("closest"))


@query("closest_option_by_ratio")
def _closest_ratio(spark, sf):
    word = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    return table(spark, sf, "part").select("p_partkey", closest_by_ratio(word, NAMES, 0.3).alias("closest"))


def _rule_sql(code: str, path: str, message: str, where: str) -> str:
    return _select("warning", f"'plausible.{code}'", f"'{path}'", message, "CAST(NULL AS VARCHAR)", where)


RULES_SQL = {
    "container-not-containerised": ("platform.containerised", "'deployment_model is ''container'' but containerised is ''none'''",
                                    "o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"),
    "tier1-long-rto": ("operations.rto_hours", "'tier-1 project with rto_hours: ' || CAST(floor(o_totalprice / 1000) AS BIGINT) || ' (a week or more)'",
                       "o_orderpriority = '1-URGENT' AND floor(o_totalprice / 1000) >= 168"),
    "storage-class-without-size": ("platform.storage_gb", "'storage classes are declared but storage_gb is 0'",
                                   "o_orderstatus = 'P' AND o_totalprice < 100000"),
    "no-prod-environment": ("placement.environments", "'no prod environment (found: test)'", "o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'"),
    "migrated-with-open-blockers": ("migration.blockers", "'status is ''migrated'' but 1 blocker(s) are still open: B-' || o_orderkey", "o_orderstatus = 'F'"),
    "both-placement-shapes": ("placement", "'both a single ''datacenter'' and an ''environments'' list are set'", "o_orderstatus = 'P' AND o_totalprice < 50000"),
    "verified-without-review": ("_meta.last_reviewed", "'confidence is ''verified'' but last_reviewed is empty'", "o_orderstatus = 'P' AND o_totalprice <= 250000"),
}


def _one_rule(code: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        chosen = [r for r in shipped_rules().rules if r.code == f"plausible.{code}"]
        return Rules(chosen).apply(documents(spark, sf))
    return run


for _code, (_path, _message, _where) in RULES_SQL.items():
    query("rule_" + _code.replace("-", "_"), _rule_sql(_code, _path, _message, _where))(_one_rule(_code))

ALL_RULES_SQL = "\nUNION ALL ".join(_rule_sql(c, *rest) for c, rest in RULES_SQL.items())


@query("rule_registry", ALL_RULES_SQL + "\nUNION ALL " + _rule_sql("cheap", "name", "'the order is cheap'", "o_totalprice < 20000")
       .replace("'plausible.cheap'", "'mine.cheap'") + """
UNION ALL SELECT 'warning', 'plausible.rule-crashed', NULL, '', 'plausibility rule ''mine.broken'' crashed: AnalysisException', NULL""")
def _registry(spark, sf):
    rules = shipped_rules()
    rules.register("mine.cheap", "name", lambda p: p.text("platform.cpu_cores") == "unknown", "the order is cheap")
    rules.register("mine.broken", "name", lambda p: F.col("no_such_column") == 1, "never")
    return rules.apply(documents(spark, sf))


def all_findings(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    hits, crashed = shipped_rules().hits(docs)
    return V.check_documents(docs, project_schema(), code_lists(spark), _ids(spark, sf), hits).unionByName(crashed)


ALL_SQL = "\nUNION ALL ".join([UNKNOWN_SQL, REQUIRED_SQL, TYPES_SQL, CODES_SQL, REFERENCES_SQL, ALL_RULES_SQL])


@query("findings_report", f"WITH f AS ({ALL_SQL}) SELECT level, code, COUNT(*) AS n, COUNT(DISTINCT file) AS files FROM f GROUP BY 1, 2")
def _findings(spark, sf):
    return V.findings_by_code(all_findings(spark, sf))


@query("findings_verdict", f"""WITH f AS ({ALL_SQL}) SELECT COUNT(*) FILTER (WHERE level = 'error') AS errors, COUNT(*) FILTER (WHERE level = 'warning') AS warnings,
  COUNT(*) FILTER (WHERE level = 'info') AS infos, CASE WHEN COUNT(*) FILTER (WHERE level = 'error') > 0 THEN 'invalid' ELSE 'ok' END AS verdict FROM f""")
def _verdict(spark, sf):
    return V.summarise(all_findings(spark, sf))


@query("parse_findings", f"""SELECT 'error' AS level, {BROKEN_SQL} AS code, 'c-' || c_custkey || '.yaml' AS file, '' AS path, CAST(NULL AS VARCHAR) AS fix
FROM customer WHERE {BROKEN_SQL} IS NOT NULL""")
def _parse(spark, sf):
    return V.check_parse(parse_documents(yaml_files(spark, sf))).drop("message")


@query("position_join", f"""WITH ok AS (SELECT 'c-' || c_custkey || '.yaml' AS file FROM customer WHERE {BROKEN_SQL} IS NULL)
SELECT file, code, path, CAST(line AS INT) AS line, CAST(col AS INT) AS col FROM ok,
 (VALUES ('structure.type', 'datastores[0].version', 8, 14), ('structure.unknown-field', 'reviewed', 10, 1)) p(code, path, line, col)
UNION ALL SELECT file, 'plausible.nothing', 'ownership.contact', 5, 3 FROM ok""")
def _position_join(spark, sf):
    # Parsing runs Python once; its rows are read by every check.
    parsed = parse_documents(yaml_files(spark, sf)).persist()
    found = V.check_structure(parsed.select("file", "doc"), project_schema())
    rules = Rules().register("plausible.nothing", "ownership.contact", lambda p: p.text("ownership.contact").isNull() & F.col("doc").isNotNull(), "-")
    found = found.unionByName(rules.apply(parsed.select("file", "doc")))
    return V.attach_positions(found, positions(parsed)).select("file", "code", "path", "line", "col")


@query("schema_self_test", """WITH codes AS (SELECT DISTINCT p_type AS g, p_name AS code FROM part), ord AS (SELECT DISTINCT p_type AS g, p_name AS code FROM part WHERE p_size > 5)
SELECT 'error' AS level, 'schema.code-not-in-order' AS code, g || '/' || code AS path FROM (SELECT * FROM codes EXCEPT SELECT * FROM ord)
UNION ALL SELECT 'error', 'schema.order-not-a-code', g || '/' || code FROM (SELECT * FROM ord EXCEPT SELECT * FROM codes)
UNION ALL SELECT 'warning', 'schema.no-unknown-code', g FROM codes GROUP BY g HAVING NOT bool_or(code = 'unknown')
UNION ALL SELECT 'warning', 'schema.unlabelled-codes', '' FROM part HAVING COUNT(*) > 0
UNION ALL SELECT 'error', 'schema.unknown-annotation', 'kind' UNION ALL SELECT 'error', 'schema.unknown-taxonomy-group', 'kind'
UNION ALL SELECT 'error', 'schema.unknown-ref-source', 'team' UNION ALL SELECT 'warning', 'schema.nothing-tracked', ''
UNION ALL SELECT 'warning', 'schema.provisional-reference', 'sites'""")
def _self_test(spark, sf):
    part = table(spark, sf, "part")
    none = F.lit(None).cast("string")
    lists = part.select(F.lit("taxonomy").alias("source"), F.col("p_type").alias("group"), F.col("p_name").alias("code"), none.alias("label_de")).distinct()
    order = part.where("p_size > 5").select(F.col("p_type").alias("group"), F.col("p_name").alias("code")).distinct()
    faulty = T.StructType([field("kind", "code", taxonomy="nowhere", colour="red"), field("team", "code", ref="nobody")])
    return V.check_schema(lists, order, faulty, provisional=["sites"]).select("level", "code", "path")
