"""Conversion of the messy orders into nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import convert as C
from ..operators import flatten as L
from ..operators import validate as V
from ..schema import project_schema
from ..session import stage_path
from ..sources.documents import read_json_documents
from .profiling import MESSY_SQL, messy
from .registry import query, table
from .report import PRIORITY_SQL, dims

MAPPING = {
    "Order Nr": None, "Status": "migration.status", "Priority": "datastores[].engine", "Betrag (EUR)": "platform.amount",
    "Menge": "platform.storage_gb", "Datum": "target.days[0].day", "Codes": "datastores[].role", "Team": "ownership.team_id",
}
PROFILE = {
    "Status": {"kind": "boolish"}, "Betrag (EUR)": {"kind": "number", "number_locale": "de"}, "Menge": {"kind": "integer"},
    "Datum": {"kind": "date"}, "Codes": {"kind": "list", "list_separator": ";"},
}
VALUE_MAP = {
    "migration.status": {"yes": "migrated"},
    "datastores[].engine": {"1-URGENT": ["db2", "redis"], "2-HIGH": "mssql", "4 not specified": None},
    "ownership.team_id": {"TEAM-P": "team-alpha"},
}
# What the value map makes of a priority: exact spelling, then its letters.
ENGINES_SQL = """CASE regexp_replace(lower("Priority"), '[^a-z0-9]+', '', 'g') WHEN '1urgent' THEN ['db2', 'redis'] WHEN '2high' THEN ['mssql']
  WHEN '4notspecified' THEN [] ELSE ["Priority"] END"""
ROLES_SQL = """string_split("Codes", '; ')"""


@query("slugify", """SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_type || '#' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  regexp_replace(lower(p_brand), '[^a-z0-9]+', '', 'g') AS key FROM part""")
def _slug(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", X.slugify(F.concat("p_name", F.lit(" "), "p_type", F.lit("#"), "p_brand"), "-").alias("slug"),
        X.spelling_key("p_brand").alias("key"))


@query("transliterate")
def _transliterate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.transliterate("text").alias("text"))


@query("column_mapping", f"""WITH {MESSY_SQL}
SELECT rw, CASE o.o_orderstatus WHEN 'P' THEN 'migrated' WHEN 'F' THEN 'no' END AS status,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount, CAST(replace("Menge", ' GB', '') AS BIGINT) AS storage_gb, strftime(o_orderdate, '%Y-%m-%d') AS day,
  CASE WHEN "Team" = ' - ' THEN NULL WHEN o.o_orderstatus = 'P' THEN 'team-alpha' ELSE replace("Team", '  ', ' ') END AS team_id,
  CAST(greatest(len({ENGINES_SQL}), len({ROLES_SQL})) AS INT) AS datastores,
  array_to_string({ENGINES_SQL}, '|') AS engines, array_to_string({ROLES_SQL}, '|') AS roles
FROM messy JOIN orders o ON o_orderkey = rw""")
def _mapping(spark, sf):
    records = C.convert(messy(spark, sf), MAPPING, PROFILE, VALUE_MAP, keep=["rw"])
    r = F.col("record")
    return records.select("rw", r["migration"]["status"].alias("status"), F.try_variant_get(r["platform"]["amount"], "$", "double").alias("amount"),
                          F.try_variant_get(r["platform"]["storage_gb"], "$", "bigint").alias("storage_gb"), r["target"]["days"][0]["day"].alias("day"),
                          r["ownership"]["team_id"].alias("team_id"), F.size(r["datastores"]).alias("datastores"),
                          F.array_join(r["datastores"]["engine"], "|").alias("engines"),
                          F.array_join(r["datastores"]["role"], "|").alias("roles"))


@query("round_trip", """SELECT 'o-' || o_orderkey AS project_id, CAST(floor(o_totalprice / 1000) AS BIGINT) AS storage_gb,
  0::BIGINT AS type_findings FROM orders""")
def _round_trip(spark, sf):
    """Messy rows to records, written as JSON, scanned, flattened and checked: numbers arrive as numbers."""
    rows = messy(spark, sf).withColumn("Order Nr", F.concat(F.lit("o-"), F.col("rw").cast("string")))
    records = C.convert(rows, {"Order Nr": "id", "Menge": "platform.storage_gb", "Team": "ownership.team_id"}, PROFILE, VALUE_MAP)
    path = stage_path(spark, "records")
    records.select("record.*").write.json(path)
    docs = read_json_documents(spark, path).withColumn("file", F.try_variant_get("doc", "$.id", "string"))
    found = V.check_types(docs, project_schema()).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    flat = L.flatten_projects(docs, project_schema()).select("project_id", "storage_gb")
    return (flat.join(found, F.col("file") == F.col("project_id"), "left")
            .select("project_id", F.col("storage_gb").cast("bigint"), F.coalesce("n", F.lit(0).cast("bigint")).alias("type_findings")))


@query("value_map", f"""WITH {MESSY_SQL} SELECT rw, unnest({ENGINES_SQL}) AS code FROM messy""")
def _value_map(spark, sf):
    codes = C.mapped_codes(X.clean_cell("Priority"), VALUE_MAP["datastores[].engine"])
    return messy(spark, sf).select("rw", F.explode(codes).alias("code"))


@query("coercion", """SELECT o_orderkey AS rw, strftime(o_orderdate, '%Y-%m-%d') AS day,
  CASE o_orderstatus WHEN 'P' THEN 'yes' WHEN 'F' THEN 'no' END AS answer,
  CASE o_orderstatus WHEN 'P' THEN lower(o_orderpriority) WHEN 'F' THEN o_orderpriority
    ELSE CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4 NOT SPECIFIED' ELSE left(o_orderpriority, 1) END END AS kept FROM orders""")
def _coerce(spark, sf):
    clean = C.clean_table(messy(spark, sf), keep=["rw"])
    return clean.select("rw", C.coerce("Datum", "date").alias("day"), C.coerce("Status", "boolish").alias("answer"),
                        C.coerce("Priority", "number").alias("kept"))


@query("list_assembly", f"""WITH {MESSY_SQL}, l AS (SELECT rw, {ENGINES_SQL} AS e, {ROLES_SQL} AS r FROM messy),
 p AS (SELECT rw, e, r, unnest(range(greatest(len(e), len(r)))) + 1 AS i FROM l)
SELECT rw, i - 1 AS idx, e[i] AS engine, r[i] AS role FROM p""")
def _zip(spark, sf):
    clean = C.clean_table(messy(spark, sf), keep=["rw"])
    lists = clean.select("rw", C.pieces("Priority", {}, VALUE_MAP["datastores[].engine"]).alias("e"),
                         C.pieces("Codes", PROFILE["Codes"], {}).alias("r"))
    zipped = C.zip_lists({"engine": F.col("e"), "role": F.col("r")})
    return lists.select("rw", F.posexplode(zipped).alias("idx", "z")).select("rw", F.col("idx").cast("bigint"), "z.*")


@query("misaligned_lists", f"""WITH {MESSY_SQL} SELECT 'datastores[]' AS prefix, COUNT(*) AS rows FROM messy
WHERE len({ENGINES_SQL}) > 0 AND len({ENGINES_SQL}) <> len({ROLES_SQL})""")
def _misaligned(spark, sf):
    return C.misaligned_lists(messy(spark, sf), MAPPING, PROFILE, VALUE_MAP)


@query("unmapped_capture", f"""WITH {MESSY_SQL} SELECT rw, 'Order Nr' AS header, "Order Nr" AS value FROM clean
UNION ALL SELECT rw, 'Team', "Team" FROM clean WHERE "Team" IS NOT NULL""")
def _unmapped(spark, sf):
    kept = C.capture_unmapped(messy(spark, sf), {**MAPPING, "Team": None}, PROFILE, keep=["rw"])
    return kept.select("rw", F.explode("_unmapped").alias("header", "value"))


@query("json_map_capture", """SELECT event_id, k AS header, json_extract_string(props, '$.' || k) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def _json_map(spark, sf):
    props = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select("event_id", F.explode(F.map_filter(props, lambda k, v: v.isNotNull())).alias("header", "value"))


@query("stable_ids", """WITH k AS (SELECT p_partkey, p_name || '#' || p_partkey AS source_key, p_name AS slug0 FROM part),
 s AS (SELECT p_partkey, replace(slug0, ' ', '-') AS slug FROM k)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY slug ORDER BY p_partkey) AS BIGINT) AS n,
  CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY p_partkey) = 1 THEN slug
       ELSE slug || '-' || row_number() OVER (PARTITION BY slug ORDER BY p_partkey) END AS project_id FROM s""")
def _ids(spark, sf):
    keys = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("source_key"),
                                           X.slugify("p_name", "-").alias("_slug"), F.col("p_partkey").alias("_row"))
    ids = C.number_slugs(keys)
    suffix = F.coalesce(F.nullif(F.regexp_extract("project_id", r"-(\d+)$", 1), F.lit("")).cast("bigint"), F.lit(1))
    return ids.select(F.col("source_key").cast("bigint").alias("p_partkey"), suffix.alias("n"), "project_id")


@query("stable_ids_with_map", """
WITH kept AS (SELECT c_name, 'stored-' || c_custkey AS id FROM customer WHERE c_acctbal < 0)
SELECT c_custkey AS rw, c_name AS source_key, COALESCE(id, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-')) AS project_id
FROM customer LEFT JOIN kept USING (c_name)""")
def _ids_map(spark, sf):
    customer = table(spark, sf, "customer")
    stored = customer.where("c_acctbal < 0").select(F.col("c_name").alias("source_key"),
                                                    F.concat(F.lit("stored-"), F.col("c_custkey").cast("string")).alias("project_id"))
    rows = customer.select(F.col("c_custkey").alias("rw"), "c_name")
    return C.assign_ids(rows, "c_name", "rw", stored).select("rw", "source_key", "project_id")


@query("id_collisions", """SELECT replace(p_name, ' ', '-') AS slug, COUNT(DISTINCT p_partkey) AS keys FROM part GROUP BY 1 HAVING COUNT(DISTINCT p_partkey) > 1""")
def _collisions(spark, sf):
    return C.id_collisions(table(spark, sf, "part").select(F.col("p_partkey").alias("source_key"), X.slugify("p_name", "-").alias("slug")))


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders stored earlier (reviewed, with other prices for filled ones) and
    orders of a new run."""
    orders = table(spark, sf, "orders")
    base = [F.col("o_orderkey").alias("project_id"), F.col("o_orderstatus").alias("status")]
    new = C.stamp_meta(orders.where("o_orderpriority <> '5-LOW'").select(*base, F.col("o_totalprice").alias("amount")),
                       "orders.csv", "orders", "project_id", "2026-02-01")
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    old = C.stamp_meta(orders.where("o_orderpriority <> '1-URGENT'").select(*base, price.alias("amount")),
                       "orders.csv", "orders", "project_id", "2026-01-01")
    return new, old.withColumn("_meta", F.col("_meta").withField("reviewed_by", F.lit("ann")))


@query("change_detection", """SELECT o_orderkey AS project_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'removed' WHEN o_orderpriority = '1-URGENT' THEN 'new' WHEN o_orderstatus = 'F' THEN 'changed' ELSE 'unchanged' END AS state,
  CASE WHEN o_orderpriority = '1-URGENT' OR (o_orderstatus = 'F' AND o_orderpriority <> '5-LOW') THEN '2026-02-01' ELSE '2026-01-01' END AS imported_at,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN 'ann' END AS reviewed_by FROM orders""")
def _changes(spark, sf):
    new, old = versions(spark, sf)
    return C.diff_records(new, old).select("project_id", "state", "_meta.imported_at", "_meta.reviewed_by")


@query("provenance_stamp", """SELECT o_orderkey AS project_id, 'orders.csv' AS source, 'orders' AS source_sheet, o_orderkey AS source_row,
  '2026-02-01' AS imported_at, 'imported' AS confidence, CAST(NULL AS VARCHAR) AS last_reviewed, CAST(NULL AS VARCHAR) AS reviewed_by
  FROM orders WHERE o_orderpriority <> '5-LOW'""")
def _stamp(spark, sf):
    return versions(spark, sf)[0].select("project_id", "_meta.*")


@query("conversion_report", f"""WITH {MESSY_SQL}, t AS (SELECT COUNT(*) AS all_rows FROM messy),
 f AS (SELECT 'field' AS section, 'migration.status' AS name, COUNT("Status") AS n FROM clean
  UNION ALL SELECT 'field', 'datastores[].engine', COUNT(*) FILTER (WHERE len({ENGINES_SQL}) > 0) FROM clean
  UNION ALL SELECT 'field', 'platform.amount', COUNT("Betrag (EUR)") FROM clean UNION ALL SELECT 'field', 'platform.storage_gb', COUNT("Menge") FROM clean
  UNION ALL SELECT 'field', 'target.days[0].day', COUNT("Datum") FROM clean UNION ALL SELECT 'field', 'datastores[].role', COUNT("Codes") FROM clean
  UNION ALL SELECT 'field', 'ownership.team_id', COUNT("Team") FROM clean
  UNION ALL SELECT 'unmapped', 'Order Nr', COUNT("Order Nr") FROM clean UNION ALL SELECT 'unmapped', 'Leer', COUNT("Leer") FROM clean)
SELECT section, name, n, all_rows AS records, all_rows AS rows_read, ROUND(100.0 * n / all_rows, 1) AS pct FROM f, t""")
def _conversion(spark, sf):
    return C.conversion_report(messy(spark, sf), MAPPING, PROFILE, VALUE_MAP, keep=["rw"])


@query("coercion_failures", f"""WITH {MESSY_SQL}, bad AS (SELECT "Priority" AS value, COUNT(*) AS n FROM messy
  WHERE NOT regexp_matches("Priority", '^\\d [A-Za-z]{{1,6}}$') GROUP BY 1)
SELECT 'Priority' AS "column", CAST(SUM(n) AS BIGINT) AS cells, (SELECT string_agg(value, '|' ORDER BY value) FROM (SELECT value FROM bad ORDER BY value LIMIT 8)) AS samples FROM bad""")
def _failures(spark, sf):
    checked = {"Priority": {"kind": "number"}, "Datum": {"kind": "date"}, "Betrag (EUR)": {"kind": "number", "number_locale": "de"}}
    return C.coercion_failures(messy(spark, sf), checked).withColumn("samples", F.array_join("samples", "|"))


@query("blank_row_skip", f"""WITH {MESSY_SQL} SELECT rw, "Team" IS NOT NULL AS has_team FROM clean WHERE "Status" IS NOT NULL OR "Team" IS NOT NULL""")
def _blank_rows(spark, sf):
    rows = messy(spark, sf).select("rw", "Status", "Leer", "Team")
    records = C.convert(rows, {"Status": "status"}, {}, {}, keep=["rw"])
    return records.select("rw", F.map_contains_key("_unmapped", "Team").alias("has_team"))


@query("new_values", f"""SELECT o_orderpriority AS value, COUNT(*) AS n FROM orders
WHERE o_orderpriority NOT IN (SELECT code FROM {PRIORITY_SQL}) GROUP BY 1""")
def _new_values(spark, sf):
    return C.new_values(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("value")), dims(spark), "priority")
