"""Sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge as M
from ..session import stage_path
from ..sources import extracts as E
from ..sources import tables as S
from .merging import STACKED_SQL
from .registry import query, table
from .report import DATASTORES_SQL, DEFINITIONS, WITH_ENGINE, datastores, dims, report_model

KEY = "Kunden-Nr"


def write_extracts(spark: SparkSession, sf: str) -> str:
    """Customers, orders and suppliers as CSV folders of three dialects.

    Spark writes each as part files, so every part is one extract.
    """
    base = stage_path(spark, "extracts")
    customer = table(spark, sf, "customer").orderBy("c_custkey").select(
        F.col("c_name").alias(KEY), F.col("c_mktsegment").alias("Segment"),
        F.when(F.col("c_acctbal") > 0, F.lit('Müller; "GmbH"')).otherwise(F.lit("-")).alias("Firma"))
    shop = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("Auftrag"), F.concat(F.lit(" Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias(KEY),
        F.col("o_orderpriority").alias("Segment"))
    (customer.write.option("header", True).option("sep", ";").option("escape", '"').option("encoding", "ISO-8859-1").csv(f"{base}/a"))
    (shop.write.option("header", True).option("sep", "\t").csv(f"{base}/b"))
    return base


def _stacked(spark: SparkSession, base: str) -> DataFrame:
    parts = {name: E.read_extracts(spark, f"{base}/{name}", KEY) for name in ("a", "b")}
    return parts["a"].unionByName(parts["b"].withColumn("_rank", F.col("_rank") + 1000), allowMissingColumns=True)


@query("extract_scan", """SELECT c_name AS "Kunden-Nr", c_mktsegment AS "Segment", CASE WHEN c_acctbal > 0 THEN 'Müller; "GmbH"' ELSE '-' END AS "Firma", NULL AS "Auftrag" FROM customer
UNION ALL SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), o_orderpriority, NULL, CAST(o_orderkey AS VARCHAR) FROM orders""")
def _scan(spark, sf):
    return _stacked(spark, write_extracts(spark, sf)).where("_part = 0").drop("_rank", "_file", "_row", "_part")


@query("extract_scan_line_breaks", """SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS "Kunden-Nr", CAST(o_orderkey AS VARCHAR) AS "Auftrag",
  'sagt "' || o_orderpriority || '";' || chr(10) || repeat('und ' || o_orderstatus || chr(10), CAST(o_orderkey % 4 AS INTEGER)) || 'Ende' AS "Notiz" FROM orders""")
def _scan_line_breaks(spark, sf):
    """Cells with quoted line breaks, read split by split."""
    base = stage_path(spark, "extracts")
    note = F.concat(F.lit('sagt "'), "o_orderpriority", F.lit('";\n'), F.expr("repeat(concat('und ', o_orderstatus, '\n'), cast(o_orderkey % 4 as int))"), F.lit("Ende"))
    (table(spark, sf, "orders").select(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias(KEY),
                                       F.col("o_orderkey").cast("string").alias("Auftrag"), note.alias("Notiz"))
     .write.option("header", True).option("sep", ";").option("escape", '"').csv(base))
    return E.read_extracts(spark, base, KEY).select(KEY, "Auftrag", "Notiz")


@query("extract_merge", """WITH o AS (SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS k, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT COALESCE(c_name, k) AS "Kunden-Nr", c_mktsegment AS "Segment", CASE WHEN c_acctbal > 0 THEN 'Müller; "GmbH"' ELSE '-' END AS "Firma", k IS NOT NULL AS has_order
FROM customer FULL OUTER JOIN o ON c_name = k""")
def _scan_merge(spark, sf):
    merged = M.merge_sources(_stacked(spark, write_extracts(spark, sf)), KEY)
    return merged.select(KEY, "Segment", "Firma", (F.col("Auftrag") != "").alias("has_order"))


@query("header_lookup", """SELECT 'Kunden-Nr' AS key_header, 'a' AS source, 'Firma,Kunden-Nr,Segment' AS headers, 'cp1252' AS encoding, ';' AS delimiter, TRUE AS exact FROM customer HAVING COUNT(*) > 0
UNION ALL SELECT 'Kunden-Nr', 'b', 'Auftrag,Kunden-Nr,Segment', 'utf-8-sig', chr(9), TRUE FROM orders HAVING COUNT(*) > 0""")
def _headers(spark, sf):
    base = write_extracts(spark, sf)
    both = [E.file_dialects(spark, f"{base}/{name}", KEY).withColumn("source", F.lit(name)) for name in ("a", "b")]
    return both[0].unionByName(both[1]).select(
        "key_header", "source", F.array_join(F.array_sort("header"), ",").alias("headers"), "encoding", "delimiter", "exact").distinct()


@query("source_manifest", """SELECT 'a' AS source, COUNT(*) AS rows, TRUE AS checked FROM customer UNION ALL SELECT 'b', COUNT(*), TRUE FROM orders""")
def _manifest(spark, sf):
    base = write_extracts(spark, sf)
    both = [E.source_manifest(spark, f"{base}/{n}", KEY).withColumn("source", F.lit(n)) for n in ("a", "b")]
    return both[0].unionByName(both[1]).groupBy("source").agg(
        F.sum("rows").alias("rows"), F.bool_and(F.length("sha256") == 64).alias("checked"))


@query("table_scan", f"WITH {DATASTORES_SQL} SELECT project_id, engine, is_placeholder, CAST(NULL AS VARCHAR) AS version FROM datastores")
def _table_scan(spark, sf):
    path = stage_path(spark, "datastores")
    S.write_table(datastores(spark, sf).withColumn("version", F.lit(None).cast("string")), path, ["project_id", "engine"])
    return S.read_table(spark, path, "project_id BIGINT, engine STRING, version STRING, is_placeholder BOOLEAN")


@query("ordered_sink", """SELECT CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS ordered, 'amount,id,note' AS columns FROM orders""")
def _sink(spark, sf):
    path = stage_path(spark, "orders")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.lit(None).cast("string").alias("note"))
    S.write_table(rows, path, ["amount", "id"])
    # Part files are in order when each one ends before the next begins.
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    body = lines.select("file", F.get_json_object("value", "$.amount").cast("double").alias("amount"),
                        F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("columns"))
    ends = body.groupBy("file").agg(F.min("amount").alias("low"), F.max("amount").alias("high"), F.count(F.lit(1)).alias("n"), F.min("columns").alias("columns"))
    from pyspark.sql import Window as W
    before = F.lag("high").over(W.orderBy("file"))  # one row per part file
    return ends.withColumn("ok", F.coalesce(before <= F.col("low"), F.lit(True))).agg(
        F.sum("n").alias("rows"), F.bool_and("ok").alias("ordered"), F.min("columns").alias("columns"))


@query("delimited_sink", """SELECT c_name AS "Kunden-Nr", c_mktsegment || '; "x"' AS "Segment", '' AS "Leer" FROM customer""")
def _delimited(spark, sf):
    path = stage_path(spark, "merged")
    S.write_csv(table(spark, sf, "customer").select(F.col("c_name").alias(KEY), F.concat("c_mktsegment", F.lit('; "x"')).alias("Segment"), F.lit("").alias("Leer")), path)
    return E.read_extracts(spark, path, KEY).where("_part = 0").drop("_rank", "_file", "_row", "_part")


@query("record_sink", """SELECT replace(lower(c_mktsegment), ' ', '-') AS "group", c_custkey AS project_id, c_name AS name FROM customer""")
def _records(spark, sf):
    path = stage_path(spark, "records")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("project_id"), F.struct(F.col("c_name").alias("name")).alias("record"), F.col("c_mktsegment").alias("segment"))
    S.write_records(rows, path, group="segment")
    back = spark.read.schema("project_id BIGINT, record STRUCT<name: STRING>, segment STRING, `group` STRING").json(path)
    return back.select("group", "project_id", "record.name")


@query("table_manifest", f"""WITH {DATASTORES_SQL} SELECT COUNT(*) AS rows_datastores, (SELECT COUNT(*) FROM customer) AS rows_projects,
  (SELECT COUNT(*) FROM lineitem) AS rows_environments, 19 AS fields_tracked FROM datastores""")
def _table_manifest(spark, sf):
    return S.table_manifest({"projects": table(spark, sf, "customer"), "datastores": datastores(spark, sf), "environments": table(spark, sf, "lineitem")}, fields_tracked=19)


@query("model_sink", f"""WITH {DATASTORES_SQL} SELECT COALESCE(code, engine) AS engine, COALESCE(n, 0) AS value
FROM (SELECT engine, COUNT(DISTINCT project_id) AS n FROM datastores GROUP BY 1)
FULL OUTER JOIN (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW', 'none', 'unknown']) AS code) ON engine = code""")
def _model(spark, sf):
    path = stage_path(spark, "model")
    S.write_model(report_model(spark, sf), path)
    return S.read_table(spark, f"{path}/tables/by_engine", "engine STRING, value BIGINT")


__all__ = ["DEFINITIONS", "STACKED_SQL", "WITH_ENGINE", "dims"]
