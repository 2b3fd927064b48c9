"""Counting rules, distributions, cross-tabs, coverage, labels.

Stand-ins: projects = customer, datastores = orders waiting for payment (a
customer without one gets the placeholder), environments = lineitem, blockers =
filled orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import UNKNOWN
from ..operators import measures as M
from ..operators.flatten import with_placeholders
from ..operators.validate import coverage_by_project, coverage_report
from ..plans.report import build_model, table_info
from ..sources.dimensions import axis, dimension_from, load_dimensions, with_colour, with_labels
from ..sources.tables import model_lines
from .registry import query, table

# Code lists of the stand-in tables. "none" and "X" never occur: zero rows.
TAXONOMY = {
    "priority": {
        "order": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "none", UNKNOWN],
        "codes": {"1-URGENT": {"label_de": "Dringend", "label_en": "Urgent", "colour": "#cc0000"},
                  "2-HIGH": {"label_de": "Hoch", "label_en": "High"},
                  "3-MEDIUM": {"label_de": None, "label_en": "Medium"}, "5-LOW": {}, "none": {"label_de": "Keine"},
                  UNKNOWN: {"label_de": "Unbekannt", "label_en": "Unknown", "colour": "#999999"}}},
    "system": {
        "order": ["O", "F", "Z", UNKNOWN],
        "codes": {"O": {"label_de": "Offen", "label_en": "Open"}, "F": {"label_de": "Fertig", "label_en": "Done"},
                  "Z": {}, UNKNOWN: {"label_de": "Unbekannt", "label_en": "Unknown", "colour": "#999999"}}},
}
REFERENCES = {
    "sites": {"R": {"label_de": "Retour", "label_en": "Returned"}, "A": {"label_de": "Annahme", "label_en": "Accepted"},
              "X": {"label_de": "Leer", "label_en": "Empty"}, UNKNOWN: {"label_de": "Unbekannt", "label_en": "Unknown"}},
}

# The same lists for SQL.
PRIORITY_SQL = """(VALUES ('1-URGENT', 0, 'Dringend', 'Urgent', '#cc0000'), ('2-HIGH', 1, 'Hoch', 'High', NULL),
  ('3-MEDIUM', 2, '3-MEDIUM', 'Medium', NULL), ('5-LOW', 3, '5-LOW', '5-LOW', NULL), ('none', 4, 'Keine', 'none', NULL),
  ('unknown', 5, 'Unbekannt', 'Unknown', '#999999')) AS axis(code, position, label_de, label_en, colour)"""
SITES_SQL = """(VALUES ('A', 0, 'Annahme', 'Accepted'), ('R', 1, 'Retour', 'Returned'), ('X', 2, 'Leer', 'Empty'),
  ('unknown', 3, 'Unbekannt', 'Unknown')) AS axis(code, position, label_de, label_en)"""

DATASTORES_SQL = """datastores AS (
  SELECT o_custkey AS project_id, o_orderpriority AS engine, FALSE AS is_placeholder FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT c_custkey, 'unknown', TRUE FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'))"""
PROJECTS_SQL = """projects AS (
  SELECT c_custkey AS project_id, n_name AS team_id, c_mktsegment AS segment,
         CASE WHEN c_acctbal > 7000 THEN 'verified' ELSE 'imported' END AS confidence,
         CAST(1 + CAST(c_acctbal > 0 AS INT) + CAST(c_mktsegment <> 'BUILDING' AS INT) AS BIGINT) AS fields_filled,
         CAST(3 AS BIGINT) AS fields_tracked
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def dims(spark: SparkSession) -> DataFrame:
    return load_dimensions(spark, TAXONOMY, REFERENCES)


def projects(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    # nation has 25 rows at every scale
    joined = table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    filled = 1 + (F.col("c_acctbal") > 0).cast("int") + (F.col("c_mktsegment") != "BUILDING").cast("int")
    return joined.select(
        F.col("c_custkey").alias("project_id"), F.col("n_name").alias("team_id"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") > 7000, F.lit("verified")).otherwise(F.lit("imported")).alias("confidence"),
        filled.cast("bigint").alias("fields_filled"), F.lit(3).cast("bigint").alias("fields_tracked"))


def datastores(spark: SparkSession, sf: str) -> DataFrame:
    rows = (table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
            .select(F.col("o_custkey").alias("project_id"), F.col("o_orderpriority").alias("engine")))
    owners = table(spark, sf, "customer").select(F.col("c_custkey").alias("project_id"))
    return with_placeholders(rows, owners, "project_id", {"engine": F.lit(UNKNOWN)})


def environments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("project_id"),
                                               F.col("l_returnflag").alias("datacenter"),
                                               F.col("l_linestatus").alias("os_family"))


def customer_environments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("project_id"),
                                             F.col("o_orderstatus").alias("datacenter"),
                                             F.col("o_orderpriority").alias("os_family"))


def blockers(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
            .select(F.col("o_custkey").alias("project_id"), F.col("o_orderpriority").alias("severity"),
                    F.when(F.col("o_totalprice") > 250000, F.lit("open")).otherwise(F.lit("closed")).alias("status")))


WITH_ENGINE = M.Definition("projects_with_engine", "datastores", "projects")
INSTANCES = M.Definition("datastore_instances", "datastores", "rows", exclude_placeholders=True)
ALL_ROWS = M.Definition("datastore_rows", "datastores", "rows")
TOTAL = M.Definition("projects_total", "projects", "projects")
BY_SITE = M.Definition("environments_by_site", "environments", "rows")
SITE_OS = M.Definition("environments_by_site_and_os", "environments", "rows")
BLOCKERS = M.Definition("blockers_by_status", "blockers", "rows")
DEFINITIONS = [WITH_ENGINE, INSTANCES, ALL_ROWS, TOTAL, BY_SITE, SITE_OS, BLOCKERS]


def projects_by_engine(spark: SparkSession, sf: str) -> DataFrame:
    """Projects by datastore engine, in code order, with zeros and unknown."""
    return M.distribution(datastores(spark, sf), WITH_ENGINE, "engine", dims(spark), "priority")


query("projects_by_engine", f"""
WITH {DATASTORES_SQL}, counted AS (SELECT engine, COUNT(DISTINCT project_id) AS n FROM datastores GROUP BY 1)
SELECT COALESCE(axis.code, engine) AS engine, CAST(position AS INT) AS position,
       COALESCE(label_de, engine) AS engine_label_de, COALESCE(label_en, engine) AS engine_label_en,
       colour AS engine_colour, COALESCE(n, 0) AS value
FROM counted FULL OUTER JOIN {PRIORITY_SQL} ON engine = axis.code""")(projects_by_engine)


@query("child_rows_with_placeholder", f"WITH {DATASTORES_SQL} SELECT project_id, engine, is_placeholder FROM datastores")
def _placeholder_rows(spark, sf):
    return datastores(spark, sf)


@query("counting_rule", f"""WITH {DATASTORES_SQL}
SELECT engine, COUNT(DISTINCT project_id) AS projects, COUNT(*) AS entries FROM datastores GROUP BY 1""")
def _counting_rule(spark, sf):
    df = datastores(spark, sf)
    return df.groupBy("engine").agg(M.measure(WITH_ENGINE).alias("projects"), M.measure(ALL_ROWS).alias("entries"))


@query("placeholder_exclusion", f"""WITH {DATASTORES_SQL}
SELECT engine, COUNT(*) AS value FROM datastores WHERE NOT is_placeholder GROUP BY 1""")
def _exclusion(spark, sf):
    return M.count_by(datastores(spark, sf), INSTANCES, "engine")


@query("headline_total", "SELECT 'projects_total' AS key, 'projects_total' AS definition, COUNT(DISTINCT c_custkey) AS value FROM customer")
def _headline(spark, sf):
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias("project_id"))
    return M.headline(df, TOTAL)


@query("headline_equality", f"""WITH {DATASTORES_SQL}
SELECT 'urgent' AS key, 'projects_with_engine' AS definition, COUNT(DISTINCT project_id) AS value FROM datastores WHERE engine = '1-URGENT'
UNION ALL SELECT 'high', 'datastore_rows', COUNT(*) FROM datastores WHERE engine = '2-HIGH'
UNION ALL SELECT 'absent', 'datastore_rows', CAST(NULL AS BIGINT)
UNION ALL SELECT 'instances', 'datastore_instances', COUNT(*) FROM datastores WHERE NOT is_placeholder
UNION ALL SELECT 'blockers_open', 'blockers_by_status', COUNT(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000""")
def _headline_equality(spark, sf):
    items = [{"key": "urgent", "definition": "projects_with_engine", "column": "engine", "equals": "1-URGENT"},
             {"key": "high", "definition": "datastore_rows", "column": "engine", "equals": "2-HIGH"},
             {"key": "absent", "definition": "datastore_rows", "column": "backup", "equals": "x"},
             {"key": "instances", "definition": "datastore_instances"},
             {"key": "blockers_open", "definition": "blockers_by_status", "column": "status", "equals": "open"}]
    return M.headlines({"datastores": datastores(spark, sf), "blockers": blockers(spark, sf)}, items,
                       {d.key: d for d in DEFINITIONS})


@query("group_count", "SELECT c_mktsegment AS segment, COUNT(DISTINCT c_custkey) AS value FROM customer GROUP BY 1")
def _group_count(spark, sf):
    df = table(spark, sf, "customer").select(F.col("c_custkey").alias("project_id"), F.col("c_mktsegment").alias("segment"))
    return M.count_by(df, TOTAL, "segment")


@query("distribution_by_reference", f"""
WITH counted AS (SELECT l_returnflag AS datacenter, COUNT(*) AS n FROM lineitem GROUP BY 1)
SELECT COALESCE(axis.code, datacenter) AS datacenter, CAST(position AS INT) AS position,
       COALESCE(label_de, datacenter) AS datacenter_label_de, COALESCE(label_en, datacenter) AS datacenter_label_en,
       CASE WHEN axis.code = 'unknown' THEN '#999999' END AS datacenter_colour, COALESCE(n, 0) AS value
FROM counted FULL OUTER JOIN {SITES_SQL} ON datacenter = axis.code""")
def _by_site(spark, sf):
    return M.distribution(environments(spark, sf), BY_SITE, "datacenter", dims(spark), "sites")


@query("cross_tab", f"""
WITH counted AS (SELECT l_returnflag AS r, COUNT(*) FILTER (WHERE l_linestatus = 'O') AS o,
                        COUNT(*) FILTER (WHERE l_linestatus = 'F') AS f, COUNT(*) AS n FROM lineitem GROUP BY 1)
SELECT COALESCE(axis.code, r) AS datacenter, CAST(position AS INT) AS position, COALESCE(o, 0) AS "O", COALESCE(f, 0) AS "F",
       CAST(0 AS BIGINT) AS "Z", CAST(0 AS BIGINT) AS unknown, COALESCE(n, 0) AS total
FROM counted FULL OUTER JOIN {SITES_SQL} ON r = axis.code""")
def _cross_tab(spark, sf):
    return M.cross_tab(environments(spark, sf), SITE_OS, "datacenter", "os_family", dims(spark), "sites", "system")


@query("cross_tab_cells", f"""
WITH counted AS (SELECT l_returnflag AS r, l_linestatus AS c, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
     rws AS (SELECT code AS r, position FROM {SITES_SQL} UNION ALL
             SELECT DISTINCT l_returnflag, NULL FROM lineitem WHERE l_returnflag NOT IN ('A', 'R', 'X', 'unknown')),
     cls AS (SELECT * FROM (VALUES ('O', 0), ('F', 1), ('Z', 2), ('unknown', 3)) AS c(c, column_position))
SELECT r AS datacenter, CAST(position AS INT) AS position, c AS os_family, CAST(column_position AS INT) AS column_position,
       COALESCE(n, 0) AS value, CAST(SUM(COALESCE(n, 0)) OVER (PARTITION BY r) AS BIGINT) AS total
FROM rws CROSS JOIN cls LEFT JOIN counted USING (r, c)""")
def _cross_tab_cells(spark, sf):
    return M.cross_tab_cells(environments(spark, sf), SITE_OS, "datacenter", "os_family", dims(spark), ("reference", "sites"), ("taxonomy", "system"))


@query("cross_tab_large", """
WITH counted AS (SELECT l_returnflag AS flag, CAST(l_partkey AS VARCHAR) AS part, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
 cols AS (SELECT part, CAST(row_number() OVER (ORDER BY part) - 1 AS INT) AS column_position FROM (SELECT DISTINCT part FROM counted)),
 rws AS (SELECT code AS flag, position FROM """ + SITES_SQL + """ UNION ALL SELECT DISTINCT flag, NULL FROM counted WHERE flag NOT IN ('A', 'R', 'X', 'unknown')),
 grid AS (SELECT flag, position, part, column_position FROM rws, (SELECT * FROM cols UNION ALL SELECT 'unknown', CAST((SELECT COUNT(*) FROM cols) AS INT)) c)
SELECT flag, CAST(position AS INT) AS position, CAST(SUM(COALESCE(n, 0)) OVER (PARTITION BY flag) AS BIGINT) AS total, part, column_position,
 COALESCE(n, 0) AS value FROM grid LEFT JOIN counted USING (flag, part)""")
def _cross_tab_large(spark, sf):
    """Every part is a column code: far more than columns can hold."""
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_partkey").cast("string").alias("part"))
    return M.cross_tab_cells(rows, SITE_OS, "flag", "part", dims(spark), ("reference", "sites"), None)


@query("absent_column", """SELECT CAST(NULL AS VARCHAR) AS backup_class, CAST(NULL AS INT) AS position,
  CAST(NULL AS VARCHAR) AS backup_class_label_de, CAST(NULL AS VARCHAR) AS backup_class_label_en,
  CAST(NULL AS VARCHAR) AS backup_class_colour, CAST(NULL AS BIGINT) AS value FROM customer WHERE FALSE""")
def _absent(spark, sf):
    return M.distribution(projects(spark, sf), TOTAL, "backup_class", dims(spark), "priority")


@query("absent_column_note", f"""WITH {DATASTORES_SQL}
SELECT 'by_backup' AS "table", FALSE AS available, 'Field backup is not present in the data.' AS note, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS total
UNION ALL SELECT 'by_engine', TRUE, NULL, 6 + COUNT(DISTINCT engine) FILTER (WHERE engine NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW','none','unknown')),
  (SELECT SUM(v) FROM (SELECT COUNT(DISTINCT project_id) AS v FROM datastores GROUP BY engine)) FROM datastores
UNION ALL SELECT 'by_site', TRUE, NULL, 4 + COUNT(DISTINCT l_returnflag) FILTER (WHERE l_returnflag NOT IN ('A','R','X','unknown')), COUNT(*) FROM lineitem""")
def _absent_note(spark, sf):
    """A field that nobody has collected stands as not available, beside tables that have theirs."""
    model = report_model(spark, sf)
    counted = None
    for name in ("by_backup", "by_engine", "by_site"):
        one = model.tables[name].agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("value"), F.lit(0)).alias("total")).withColumn("table", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    return counted.join(table_info(spark, model), "table").select("table", "available", "note", "n", "total")


@query("label_lookup", f"""
SELECT o_orderkey, o_orderpriority, COALESCE(label_de, o_orderpriority) AS o_orderpriority_label_de,
       COALESCE(label_en, o_orderpriority) AS o_orderpriority_label_en
FROM orders LEFT JOIN {PRIORITY_SQL} ON o_orderpriority = axis.code""")
def _labels(spark, sf):
    return with_labels(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                       dims(spark), "priority")


@query("colour_lookup", f"""
WITH {DATASTORES_SQL} SELECT project_id, engine, colour AS engine_colour
FROM datastores LEFT JOIN {PRIORITY_SQL} ON engine = axis.code""")
def _colours(spark, sf):
    return with_colour(datastores(spark, sf).select("project_id", "engine"), "engine", dims(spark), "priority")


@query("dimension_scan", """
SELECT 'reference' AS source, 'teams' AS "group", n_name AS code, 0 AS position, n_name AS label_de, r_name AS label_en,
       CAST(NULL AS VARCHAR) AS colour FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _dimension(spark, sf):
    # nation and region have 25 and 5 rows at every scale
    named = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return dimension_from(named, "teams", "n_name", "n_name", "r_name")


@query("axis_order", """
SELECT code, CAST(position AS INT) AS position, COALESCE(n, 0) AS value FROM (
  SELECT n_name AS code, 0 AS position FROM nation UNION ALL SELECT 'unknown', NULL) a
LEFT JOIN (SELECT n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) c ON code = n_name""")
def _axis(spark, sf):
    teams = dimension_from(table(spark, sf, "nation"), "teams", "n_name")
    counted = M.distribution(projects(spark, sf), TOTAL, "team_id", teams, "teams")
    return M.ordered(counted, "team_id").select(F.col("team_id").alias("code"), "position", "value")


@query("coverage_totals", f"""WITH {PROJECTS_SQL}
SELECT CASE WHEN GROUPING(team_id) = 1 THEN 'total' ELSE 'team' END AS scope, team_id, COUNT(*) AS projects,
       ROUND(100.0 * SUM(fields_filled) / SUM(fields_tracked), 1) AS coverage_pct,
       ROUND(100.0 * COUNT(*) FILTER (WHERE confidence = 'verified') / COUNT(*), 1) AS verified_pct
FROM projects GROUP BY GROUPING SETS ((team_id), ())""")
def _coverage(spark, sf):
    return M.coverage(projects(spark, sf))


DOCUMENT_PROJECTS_SQL = """projects AS (
  SELECT d.doc_id AS project_id, lang AS team_id, source AS file, CASE WHEN quality = 1 THEN 'verified' END AS confidence,
         CAST(1 + CAST(quality IS NOT NULL AS INT) + CAST(toxic IS NOT NULL AS INT) AS BIGINT) AS fields_filled,
         CAST(3 AS BIGINT) AS fields_tracked FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def document_projects(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    filled = 1 + F.col("quality").isNotNull().cast("int") + F.col("toxic").isNotNull().cast("int")
    return joined.select(F.col("doc_id").alias("project_id"), F.col("lang").alias("team_id"), F.col("source").alias("file"),
                         F.when(F.col("quality") == 1, F.lit("verified")).alias("confidence"),
                         filled.cast("bigint").alias("fields_filled"), F.lit(3).cast("bigint").alias("fields_tracked"))


@query("coverage_report", f"""WITH {DOCUMENT_PROJECTS_SQL}
SELECT CASE WHEN GROUPING(team_id) = 1 THEN 'total' ELSE 'team' END AS scope, team_id, COUNT(*) AS projects,
       ROUND(100.0 * SUM(fields_filled) / SUM(fields_tracked), 1) AS coverage_pct,
       ROUND(100.0 * COUNT(*) FILTER (WHERE confidence = 'verified') / COUNT(*), 1) AS verified_pct
FROM projects GROUP BY GROUPING SETS ((team_id), ())""")
def _coverage_report(spark, sf):
    return coverage_report(document_projects(spark, sf))


@query("coverage_by_project", f"""WITH {DOCUMENT_PROJECTS_SQL}
SELECT project_id, file, fields_filled, fields_tracked, ROUND(100.0 * fields_filled / fields_tracked, 1) AS coverage_pct FROM projects""")
def _coverage_by_project(spark, sf):
    return coverage_by_project(document_projects(spark, sf))


@query("convenience_columns", f"""WITH {PROJECTS_SQL}, {DATASTORES_SQL},
 d AS (SELECT project_id, string_agg(DISTINCT engine, ', ' ORDER BY engine) AS engines, bool_or(engine = '2-HIGH') AS s FROM datastores GROUP BY 1),
 e AS (SELECT o_custkey AS project_id, string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) AS sites,
              string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS os FROM orders GROUP BY 1),
 b AS (SELECT o_custkey AS project_id, COUNT(*) FILTER (WHERE o_totalprice > 250000) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT p.*, COALESCE(engines, 'unknown') AS datastore_engines, CASE WHEN s THEN 'full' ELSE 'none' END AS "has_2-HIGH",
       COALESCE(sites, 'unknown') AS sites, COALESCE(os, 'unknown') AS os_families, COALESCE(n, 0) AS open_blockers
FROM projects p LEFT JOIN d USING (project_id) LEFT JOIN e USING (project_id) LEFT JOIN b USING (project_id)""")
def _convenience(spark, sf):
    return M.enrich_projects(projects(spark, sf), datastores(spark, sf), customer_environments(spark, sf),
                             blockers(spark, sf), special="2-HIGH")


@query("flat_export", 'SELECT l_orderkey AS "from", l_partkey AS "to" FROM lineitem')
def _flat(spark, sf):
    edges = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("project_id"), F.col("l_linenumber").alias("idx"),
                                                F.col("l_orderkey").alias("from_project"), F.col("l_partkey").alias("to_project"))
    return M.flat(edges, "dependencies")


@query("coded_label_columns", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
  CASE l_returnflag WHEN 'R' THEN 'Retour' WHEN 'A' THEN 'Annahme' ELSE l_returnflag END AS l_returnflag_label_de,
  CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' ELSE l_returnflag END AS l_returnflag_label_en,
  CASE l_linestatus WHEN 'O' THEN 'Offen' WHEN 'F' THEN 'Fertig' ELSE l_linestatus END AS l_linestatus_label_de,
  CASE l_linestatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Done' ELSE l_linestatus END AS l_linestatus_label_en
FROM lineitem""")
def _coded(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return M.label_coded(rows, {"l_returnflag": "sites", "l_linestatus": "system"}, dims(spark))


SPEC = {
    "headline": [{"key": "total", "definition": "projects_total"},
                 {"key": "open", "definition": "blockers_by_status", "column": "status", "equals": "open"}],
    "tables": {
        "by_engine": {"kind": "distribution", "definition": "projects_with_engine", "column": "engine", "taxonomy": "priority"},
        "by_site": {"kind": "distribution", "definition": "environments_by_site", "column": "datacenter", "reference": "sites"},
        "by_backup": {"kind": "distribution", "definition": "projects_total", "column": "backup", "taxonomy": "priority"},
        "site_x_os": {"kind": "cross_tab", "definition": "environments_by_site_and_os", "rows": "datacenter",
                      "columns": "os_family", "rows_reference": "sites", "columns_taxonomy": "system"}},
    "charts": ["by_engine", "by_site"],
}


def report_model(spark: SparkSession, sf: str):
    tables = {"projects": projects(spark, sf), "datastores": datastores(spark, sf),
              "environments": environments(spark, sf), "blockers": blockers(spark, sf)}
    return build_model(tables, SPEC, DEFINITIONS, dims(spark))


@query("spec_driven_run", f"""WITH {DATASTORES_SQL}, {PROJECTS_SQL}
SELECT 'coverage' AS section, 'coverage' AS "table", COUNT(DISTINCT team_id) + 1 AS n FROM projects
UNION ALL SELECT 'headline', 'headline', 2
UNION ALL SELECT 'definitions', 'definitions', 7
UNION ALL SELECT 'table', 'by_engine', 6 + COUNT(DISTINCT engine) FILTER (WHERE engine NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW','none','unknown')) FROM datastores
UNION ALL SELECT 'table', 'by_site', 4 + COUNT(DISTINCT l_returnflag) FILTER (WHERE l_returnflag NOT IN ('A','R','X','unknown')) FROM lineitem
UNION ALL SELECT 'table', 'site_x_os', 4 + COUNT(DISTINCT l_returnflag) FILTER (WHERE l_returnflag NOT IN ('A','R','X','unknown')) FROM lineitem""")
def _spec_run(spark, sf):
    lines = model_lines(report_model(spark, sf))
    return lines.groupBy("section", "table").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["axis", "projects_by_engine", "report_model"]
