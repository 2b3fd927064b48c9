"""Nested documents made from orders, row by row, and flattened again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.known import as_code, as_number, as_text, is_known
from ..functions.numbers import iso_date
from ..functions.paths import Paths
from ..operators import flatten as L
from ..schema import CHILD_TABLES, project_schema
from ..session import spread
from ..sources.documents import json_documents, parse_documents, positions
from .registry import query, table

def _literal(*cases: tuple[Column, Column], otherwise: Column | None = None) -> Column:
    """A JSON value whose type differs from row to row."""
    out = None
    for when, text in cases:
        out = F.when(when, text) if out is None else out.when(when, text)
    return F.parse_json(out if otherwise is None else out.otherwise(otherwise))


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per order, with every kind of fault the checks look for."""
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    paid, filled, is_open = status == "P", status == "F", status == "O"
    key = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    environments = F.array(
        F.struct(F.when(priority == "1-URGENT", F.lit("prod")).otherwise(F.lit("test")).alias("name"),
                 F.lit("A").alias("datacenter"),
                 F.struct(F.lit("O").alias("family"),
                          _literal((price < 100000, F.lit("7.9")), otherwise=F.lit('"7.9"')).alias("version"),
                          F.lit("2026-01-01").alias("eol")).alias("os")),
        F.struct(F.lit(None).cast("string").alias("name"), F.lit("Q").alias("datacenter"),
                 F.lit(None).cast("struct<family:string,version:variant,eol:string>").alias("os")))
    datastores = F.array(
        F.struct(priority.alias("engine"), F.lit("7.9").alias("version"), F.lit(None).cast("string").alias("role")),
        F.struct(F.lit("unknown").alias("engine"), F.lit(None).cast("string").alias("version"), F.lit("x").alias("role")))
    opened = F.struct(F.concat(F.lit("B-"), key).alias("id"), F.lit("open").alias("status"))
    closed = F.struct(F.lit(None).cast("string").alias("id"), F.lit("closed").alias("status"))
    targets = F.array_compact(F.array(
        F.concat(F.lit("o-"), (F.col("o_orderkey") + 1).cast("string")), F.lit("unknown"),
        F.when(priority == "3-MEDIUM", F.concat(F.lit("c-"), F.col("o_custkey").cast("string")))))
    low = priority == "5-LOW"
    doc = F.struct(
        F.when(filled & (price > 450000), 2).when(~(is_open & (price > 450000)), 1).alias("schema_version"),
        F.concat(F.lit("o-"), key).alias("id"),
        F.when(filled, F.lit("unknown")).otherwise(priority).alias("name"),
        F.struct(F.concat(F.lit("team-"), status).alias("team_id")).alias("ownership"),
        F.struct(F.when(low, F.lit("S1")).alias("secrutiy_class"), F.when(~low, priority).alias("security_class")).alias("classification"),
        F.when(~filled, F.struct(
            F.when(is_open, F.lit("R")).when(price < 50000, F.lit("A")).alias("datacenter"),
            F.when(paid, environments).alias("environments"))).alias("placement"),
        F.struct(
            _literal((price < 20000, F.lit('"unknown"')), (price > 480000, F.lit("-1")),
                     otherwise=F.floor(price / 1000).cast("string")).alias("cpu_cores"),
            F.when(price < 100000, 0).otherwise(F.floor(price / 100)).alias("storage_gb"),
            F.when(paid, F.array(F.lit("block"), F.lit("file"))).when(is_open, F.array().cast("array<string>")).alias("storage_classes"),
            F.when(priority == "1-URGENT", F.lit("container")).otherwise(F.lit("vm")).alias("deployment_model"),
            F.when(paid, F.lit("none")).otherwise(F.lit("full")).alias("containerised")).alias("platform"),
        F.when(paid, datastores).when(is_open, F.slice(datastores, 1, 0)).alias("datastores"),
        F.struct(
            F.when(filled, F.lit("migrated")).otherwise(F.lit("planned")).alias("status"),
            F.when(priority == "2-HIGH", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(day).alias("target_date"),
            F.when(filled, F.array(opened, closed)).when(paid, F.array(opened)).alias("blockers")).alias("migration"),
        F.struct(targets.alias("depends_on")).alias("integration"),
        F.struct(F.when(priority == "1-URGENT", F.lit("tier-1")).otherwise(F.lit("tier-2")).alias("tier"),
                 F.floor(price / 1000).alias("rto_hours")).alias("operations"),
        F.struct(key.alias("note")).alias("_unmapped"),
        F.struct(F.when(paid, F.lit("verified")).otherwise(F.lit("imported")).alias("confidence"),
                 F.when(price > 250000, day).alias("last_reviewed")).alias("_meta"))
    return spread(table(spark, sf, "orders")).select(F.concat(F.lit("o-"), key, F.lit(".json")).alias("file"), F.to_json(doc).alias("body"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return json_documents(order_documents(spark, sf))


COVERAGE_SQL = """CAST(CAST(o_orderstatus <> 'F' AS INT) + 1 + CAST(o_orderpriority <> '5-LOW' AS INT)
  + CAST(o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_totalprice < 50000) AS INT) + 2 * CAST(o_orderstatus = 'P' AS INT)
  + CAST(o_totalprice >= 20000 AS INT) + 1 + CAST(o_orderstatus = 'P' AS INT) + 1 + CAST(o_orderstatus = 'P' AS INT) + 3 AS BIGINT)"""


@query("document_scan_json", """SELECT 'o-' || o_orderkey || '.json' AS file, 'o-' || o_orderkey AS id, CAST(NULL AS VARCHAR) AS code FROM orders""")
def _json_scan(spark, sf):
    docs = documents(spark, sf)
    return docs.select("file", Paths(docs).text("id").alias("id"), "code")


@query("path_extract", """SELECT 'o-' || o_orderkey AS id, 'team-' || o_orderstatus AS team_id, CAST(NULL AS VARCHAR) AS nothing,
  CAST(CASE WHEN o_totalprice < 20000 THEN NULL WHEN o_totalprice > 480000 THEN -1 ELSE floor(o_totalprice / 1000) END AS BIGINT) AS cpu_cores FROM orders""")
def _dig(spark, sf):
    docs = documents(spark, sf)
    p = Paths(docs)
    return docs.select(p.text("id").alias("id"), p.text("ownership.team_id").alias("team_id"),
                       p.text("ownership.nobody.there").alias("nothing"), p.whole("platform.cpu_cores").alias("cpu_cores"))


@query("known_test", """SELECT 'o-' || o_orderkey AS id, o_orderstatus <> 'F' AS name, o_orderstatus = 'P' AS storage_classes,
  o_orderstatus = 'P' AS engine, TRUE AS unmapped, FALSE AS contact FROM orders""")
def _known(spark, sf):
    docs = documents(spark, sf)
    p = Paths(docs)
    return docs.select(p.text("id").alias("id"), *[L.pattern_known(p, pattern).alias(name) for name, pattern in (
        ("name", "name"), ("storage_classes", "platform.storage_classes"), ("engine", "datastores[].engine"),
        ("unmapped", "_unmapped"), ("contact", "ownership.contact"))])


@query("scalar_normalisers", """SELECT doc_id, CASE WHEN quality IS NULL THEN 'unknown' ELSE CAST(quality AS VARCHAR) END AS code,
  CAST(quality AS BIGINT) AS number, CAST(CASE WHEN quality = 1 THEN 'good' END AS VARCHAR) AS text
  FROM documents LEFT JOIN labels USING (doc_id)""")
def _scalars(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    quality = F.col("quality").cast("string")
    word = F.when(F.col("quality") == 1, F.lit("good")).when(F.col("quality") == 0, F.lit(" Unknown "))
    return joined.select("doc_id", as_code(F.concat(F.lit(" "), quality)).alias("code"), as_number(quality).alias("number"),
                         as_text(word).alias("text"))


@query("date_normalisation", "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipdate FROM lineitem")
def _dates(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", iso_date("l_shipdate").alias("shipdate"))


@query("flatten_projects", f"""SELECT 'o-' || o_orderkey AS project_id, 'o-' || o_orderkey || '.json' AS file, {COVERAGE_SQL} AS fields_filled,
  CAST(19 AS BIGINT) AS fields_tracked, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS name,
  CAST(NULL AS VARCHAR) AS my_optional_field, CAST(NULL AS VARCHAR) AS my_mandatory_field, 'team-' || o_orderstatus AS team_id,
  'unknown' AS classification_a, 'unknown' AS classification_b, CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE o_orderpriority END AS security_class,
  CAST(CASE WHEN o_totalprice < 20000 THEN NULL WHEN o_totalprice > 480000 THEN -1 ELSE floor(o_totalprice / 1000) END AS BIGINT) AS cpu_cores,
  CAST(CASE WHEN o_totalprice < 100000 THEN 0 ELSE floor(o_totalprice / 100) END AS BIGINT) AS storage_gb,
  CASE o_orderstatus WHEN 'P' THEN 'block, file' WHEN 'O' THEN 'unknown' END AS storage_classes,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'container' ELSE 'vm' END AS deployment_model, CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE 'full' END AS containerised,
  'unknown' AS migration_strategy, CASE WHEN o_orderstatus = 'F' THEN 'migrated' ELSE 'planned' END AS migration_status,
  CASE WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%d.%m.%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS target_date,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'tier-1' ELSE 'tier-2' END AS tier, CAST(floor(o_totalprice / 1000) AS BIGINT) AS rto_hours, CAST(NULL AS BIGINT) AS rpo_hours,
  CAST(NULL AS VARCHAR) AS imported_at, CASE WHEN o_orderstatus = 'P' THEN 'verified' ELSE 'imported' END AS confidence,
  CASE WHEN o_totalprice > 250000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS last_reviewed FROM orders""")
def _projects(spark, sf):
    return L.flatten_projects(documents(spark, sf), project_schema())


@query("field_coverage", f"SELECT 'o-' || o_orderkey || '.json' AS file, {COVERAGE_SQL} AS fields_filled, CAST(19 AS BIGINT) AS fields_tracked FROM orders")
def _coverage(spark, sf):
    return L.coverage_columns(documents(spark, sf), project_schema()).select("file", "fields_filled", "fields_tracked")


@query("flatten_children", """SELECT 'o-' || o_orderkey AS project_id, CAST(0 AS BIGINT) AS idx, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'unknown' END AS engine,
  CASE WHEN o_orderstatus = 'P' THEN '7.9' END AS version, 'unknown' AS role, o_orderstatus <> 'P' AS is_placeholder FROM orders
UNION ALL SELECT 'o-' || o_orderkey, 1, 'unknown', NULL, 'x', FALSE FROM orders WHERE o_orderstatus = 'P'""")
def _children(spark, sf):
    path, columns = CHILD_TABLES["datastores"]
    return L.flatten_children(documents(spark, sf), path, columns)


@query("flatten_environments", """SELECT 'o-' || o_orderkey AS project_id, CAST(0 AS BIGINT) AS idx,
  CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'prod' ELSE 'test' END END AS name,
  CASE o_orderstatus WHEN 'P' THEN 'A' WHEN 'O' THEN 'R' ELSE 'unknown' END AS datacenter, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE 'unknown' END AS os_family,
  CASE WHEN o_orderstatus = 'P' THEN '7.9' END AS os_version, CASE WHEN o_orderstatus = 'P' THEN '2026-01-01' END AS os_eol, o_orderstatus = 'F' AS is_placeholder FROM orders
UNION ALL SELECT 'o-' || o_orderkey, 1, NULL, 'Q', 'unknown', NULL, NULL, FALSE FROM orders WHERE o_orderstatus = 'P'""")
def _environments(spark, sf):
    return L.flatten_environments(documents(spark, sf))


@query("flatten_children_bare", """SELECT 'o-' || o_orderkey AS project_id, CAST(0 AS BIGINT) AS idx, 'B-' || o_orderkey AS blocker_id, 'unknown' AS type, 'unknown' AS severity, 'open' AS status
FROM orders WHERE o_orderstatus IN ('F', 'P') UNION ALL SELECT 'o-' || o_orderkey, 1, NULL, 'unknown', 'unknown', 'closed' FROM orders WHERE o_orderstatus = 'F'""")
def _blockers(spark, sf):
    path, columns = CHILD_TABLES["blockers"]
    return L.flatten_children(documents(spark, sf), path, columns, placeholder=False)


@query("flatten_edges", """SELECT 'o-' || o_orderkey AS project_id, CAST(0 AS BIGINT) AS idx, 'o-' || o_orderkey AS from_project, 'o-' || (o_orderkey + 1) AS to_project FROM orders
UNION ALL SELECT 'o-' || o_orderkey, 2, 'o-' || o_orderkey, 'c-' || o_custkey FROM orders WHERE o_orderpriority = '3-MEDIUM'""")
def _edges(spark, sf):
    return L.flatten_edges(documents(spark, sf))


# Documents of customers as YAML text; some segments are broken files.
def yaml_files(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    good = F.concat(F.lit("schema_version: 1\nid: c-"), key, F.lit("\nname: "), F.col("c_name"),
                    F.lit("\nownership:\n  team_id: n-"), F.col("c_nationkey").cast("string"),
                    F.lit("\ndatastores:\n  - engine: db2\n    version: 7.9\n  - engine: yes\nreviewed: 2026-09-14\n"))
    segment = F.col("c_mktsegment")
    content = (F.when(segment == "BUILDING", F.concat(good, F.lit("id: again\n")))
               .when((segment == "MACHINERY") & (F.col("c_acctbal") < 0), F.lit("")).when(segment == "MACHINERY", F.lit("- a\n- b\n"))
               .when((segment == "FURNITURE") & (F.col("c_acctbal") < 0), F.lit("a: [1, 2\n")).otherwise(good))
    return spread(table(spark, sf, "customer")).select(F.concat(F.lit("c-"), key, F.lit(".yaml")).alias("file"), content.cast("binary").alias("content"))


BROKEN_SQL = """CASE WHEN c_mktsegment = 'BUILDING' THEN 'parse.duplicate-key' WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'parse.empty'
  WHEN c_mktsegment = 'MACHINERY' THEN 'parse.not-a-mapping' WHEN c_mktsegment = 'FURNITURE' AND c_acctbal < 0 THEN 'parse.invalid-yaml' END"""


@query("document_scan_yaml", f"""SELECT 'c-' || c_custkey || '.yaml' AS file, {BROKEN_SQL} AS code,
  CASE WHEN {BROKEN_SQL} IS NULL THEN c_name END AS name, CASE WHEN {BROKEN_SQL} IS NULL THEN 'yes' END AS second_engine,
  CASE WHEN {BROKEN_SQL} IS NULL THEN '2026-09-14' END AS reviewed FROM customer""")
def _yaml_scan(spark, sf):
    parsed = parse_documents(yaml_files(spark, sf))
    p = Paths(parsed)
    engines = F.transform(p.items("datastores"), lambda e: p.inside(e, "engine"))
    return parsed.select("file", "code", p.text("name").alias("name"), F.get(engines, F.lit(1)).alias("second_engine"),
                         p.text("reviewed").alias("reviewed"))


@query("document_positions", f"""WITH ok AS (SELECT 'c-' || c_custkey || '.yaml' AS file FROM customer WHERE {BROKEN_SQL} IS NULL)
SELECT file, path, CAST(line AS INT) AS line, CAST(col AS INT) AS col FROM ok,
 (VALUES ('id', 2, 5), ('ownership.team_id', 5, 12), ('datastores[0].version', 8, 14), ('datastores[1].engine', 9, 13)) p(path, line, col)""")
def _positions(spark, sf):
    return positions(parse_documents(yaml_files(spark, sf))).where(
        F.col("path").isin("id", "ownership.team_id", "datastores[0].version", "datastores[1].engine"))


__all__ = ["documents", "is_known", "order_documents", "yaml_files"]
