"""The data behind sheets, charts, pages and text reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import measures as M
from ..operators import presentation as P
from .registry import query, table
from .report import (BY_SITE, DATASTORES_SQL, PRIORITY_SQL, SITE_OS, SITES_SQL, WITH_ENGINE, datastores, dims, environments)


@query("code_label_sheet", """SELECT l_orderkey, l_linenumber, l_returnflag AS l_returnflag_code,
  CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' ELSE l_returnflag END AS l_returnflag_label FROM lineitem""")
def _sheet(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return P.sheet(M.label_coded(rows, {"l_returnflag": "sites"}, dims(spark)), ["l_returnflag"], lang="en")


@query("language_fallback", f"""SELECT o_orderkey, COALESCE(label_fr, label_de, label_en, o_orderpriority) AS label FROM (
  SELECT o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS label_fr, nullif(label_de, axis.code) AS label_de, label_en
  FROM orders LEFT JOIN {PRIORITY_SQL} ON o_orderpriority = axis.code)""")
def _fallback(spark, sf):
    codes = dims(spark).where("`group` = 'priority'").select(F.col("code").alias("o_orderpriority"), "label_de", "label_en")
    # the code list above has six rows
    joined = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").join(F.broadcast(codes), "o_orderpriority", "left")
    named = joined.withColumn("label_fr", F.lit(""))
    return named.select("o_orderkey", P.pick_lang("label", "fr", "o_orderpriority").alias("label"))


@query("stacked_counts", f"""WITH {DATASTORES_SQL}, e AS (SELECT engine, COUNT(DISTINCT project_id) AS n FROM datastores GROUP BY 1),
 s AS (SELECT l_returnflag AS site, COUNT(*) AS n FROM lineitem GROUP BY 1)
SELECT 'by_engine' AS "table", CAST(position AS INT) AS position, COALESCE(axis.code, engine) AS code, COALESCE(label_de, engine) AS label, COALESCE(n, 0) AS count
FROM e FULL OUTER JOIN {PRIORITY_SQL} ON engine = axis.code
UNION ALL SELECT 'by_site', CAST(position AS INT), COALESCE(axis.code, site), COALESCE(label_de, site), COALESCE(n, 0) FROM s FULL OUTER JOIN {SITES_SQL} ON site = axis.code""")
def _stacked(spark, sf):
    engines = M.distribution(datastores(spark, sf), WITH_ENGINE, "engine", dims(spark), "priority")
    sites = M.distribution(environments(spark, sf), BY_SITE, "datacenter", dims(spark), "sites")
    return P.stacked_counts({"by_engine": (engines, "engine"), "by_site": (sites, "datacenter")})


@query("pivot_count", """SELECT l_returnflag, COUNT(l_orderkey) FILTER (WHERE l_linestatus = 'O') AS "O", COUNT(l_orderkey) FILTER (WHERE l_linestatus = 'F') AS "F",
  CAST(0 AS BIGINT) AS "Z" FROM lineitem GROUP BY 1""")
def _pivot(spark, sf):
    return P.pivot_count(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey"),
                         "l_returnflag", "l_linestatus", "l_orderkey", ["O", "F", "Z"])


@query("bar_series", f"""WITH counted AS (SELECT l_returnflag AS r, l_linestatus AS c, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
 rws AS (SELECT code AS r FROM {SITES_SQL} UNION SELECT l_returnflag FROM lineitem), cls AS (SELECT * FROM (VALUES ('O', 0), ('F', 1), ('Z', 2), ('unknown', 3)) c(c, p)),
 g AS (SELECT r, c, p, COALESCE(n, 0) AS value, CAST(SUM(COALESCE(n, 0)) OVER (PARTITION BY r) AS BIGINT) AS total FROM rws CROSS JOIN cls LEFT JOIN counted USING (r, c))
SELECT r AS datacenter, c AS os_family, value, CAST(COALESCE(SUM(value) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
  total, ROUND(total / (SELECT MAX(total) FROM g), 4) AS share FROM g""")
def _bars(spark, sf):
    cells = M.cross_tab_cells(environments(spark, sf), SITE_OS, "datacenter", "os_family", dims(spark), "sites", "system")
    return P.bar_series(cells, "datacenter", "os_family")


@query("row_paging", """SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1) / 10) + 1 AS BIGINT) AS page,
  CAST((row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1) % 10 + 1 AS BIGINT) AS line FROM customer""")
def _paging(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return P.paginate(rows, [F.desc("c_acctbal"), "c_custkey"]).select("c_custkey", "page", "line")


LINES_SQL = """SELECT rpad(CASE WHEN length(p_name) <= 9 THEN p_name ELSE left(p_name, 8) || '…' END, 10, ' ')
  || lpad(CASE WHEN p_size > 40 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END, 7, ' ') || ' ' AS value FROM part"""


@query("text_report", LINES_SQL)
def _lines(spark, sf):
    rows = table(spark, sf, "part").select("p_name", F.when(F.col("p_size") <= 40, F.col("p_size")).alias("p_size"))
    return P.text_lines(rows, {"p_name": 10, "p_size": 8}, numbers=["p_size"])


def _two_runs(spark, sf):
    orders = table(spark, sf, "orders")
    count = lambda df: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return count(orders.where("o_orderdate < '2000-01-01'")), count(orders.where("o_orderpriority <> '5-LOW'"))


@query("report_difference", """WITH a AS (SELECT o_custkey, COUNT(*) AS old_n FROM orders WHERE o_orderdate < '2000-01-01' GROUP BY 1),
 b AS (SELECT o_custkey, COUNT(*) AS new_n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, old_n, new_n, CASE WHEN old_n IS NULL THEN 'added' WHEN new_n IS NULL THEN 'removed' ELSE 'changed' END AS state
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey WHERE old_n IS DISTINCT FROM new_n""")
def _difference(spark, sf):
    old, new = _two_runs(spark, sf)
    return P.diff_reports(old, new, ["o_custkey"], ["n"])


@query("text_difference", """WITH a AS (SELECT o_custkey, CAST(COUNT(*) AS VARCHAR) AS n FROM orders WHERE o_orderdate < '2000-01-01' GROUP BY 1),
 b AS (SELECT o_custkey, CAST(COUNT(*) AS VARCHAR) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1),
 al AS (SELECT rpad(CAST(o_custkey AS VARCHAR), 12, ' ') || lpad(n, 7, ' ') || ' ' AS value FROM a), bl AS (SELECT rpad(CAST(o_custkey AS VARCHAR), 12, ' ') || lpad(n, 7, ' ') || ' ' AS value FROM b)
SELECT value, '-' AS side FROM (SELECT value FROM al EXCEPT ALL SELECT value FROM bl) UNION ALL SELECT value, '+' FROM (SELECT value FROM bl EXCEPT ALL SELECT value FROM al)""")
def _text_difference(spark, sf):
    old, new = (P.text_lines(df, {"o_custkey": 12, "n": 8}, numbers=["n"]) for df in _two_runs(spark, sf))
    return P.diff_lines(old, new)
