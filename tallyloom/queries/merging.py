"""Precedence merge. Sources: customers, their orders and the suppliers as
extracts of three systems that spell one key in three ways and contradict each
other; expensive open orders carry no key at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import norm_key
from ..operators import merge as M
from ..session import spread
from .registry import query, table

KEY = "Customer No"

STACKED_SQL = """stacked AS (
  SELECT 1 AS rnk, 'a-crm' AS file, c_custkey AS rw, c_name AS k,
         CASE WHEN c_acctbal < 2000 THEN '' ELSE c_mktsegment END AS segment, '' AS status, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
  UNION ALL
  SELECT 2, 'b-shop', o_orderkey,
         CASE WHEN o_orderstatus = 'O' AND o_totalprice > 400000 THEN '' ELSE 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END, o_orderstatus, '' FROM orders
  UNION ALL
  SELECT 3, 'c-erp', s_suppkey, ' CUSTOMER#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), 'SUPPLIER', '', CAST(s_nationkey AS VARCHAR) FROM supplier),
ident AS (SELECT *, trim(k) AS key, CASE WHEN trim(k) = '' THEN '#' || rnk || '#' || rw ELSE lower(trim(k)) END AS id,
                 trim(k) = '' AS blank FROM stacked),
shown AS (SELECT id, arg_min(key, rnk * 1000000000000 + rw) AS kept FROM ident WHERE NOT blank GROUP BY 1),
cells AS (SELECT id, blank, rnk, file, rw, 'Segment' AS "column", segment AS value FROM ident WHERE segment <> ''
  UNION ALL SELECT id, blank, rnk, file, rw, 'Status', status FROM ident WHERE status <> ''
  UNION ALL SELECT id, blank, rnk, file, rw, 'Nation', nation FROM ident WHERE nation <> ''),
winners AS (SELECT id, "column", arg_min(value, rnk * 1000000000000 + rw) AS winning_value,
                   arg_min(file, rnk * 1000000000000 + rw) AS winning_file FROM cells WHERE NOT blank GROUP BY 1, 2),
conflicts AS (SELECT kept AS key, c."column", winning_value, winning_file, value AS discarded_value, file AS discarded_file
  FROM cells c JOIN winners w ON c.id = w.id AND c."column" = w."column" JOIN shown s ON s.id = c.id
  WHERE NOT blank AND value <> winning_value)"""


def sources(spark: SparkSession, sf: str) -> DataFrame:
    number = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    crm = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("_row"), F.col("c_name").alias(KEY),
        F.when(F.col("c_acctbal") < 2000, F.lit("")).otherwise(F.col("c_mktsegment")).alias("Segment"),
        F.col("c_nationkey").alias("Nation"))
    nameless = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000)
    shop = spread(table(spark, sf, "orders")).select(
        F.col("o_orderkey").alias("_row"),
        F.when(nameless, F.lit("")).otherwise(F.concat(F.lit("customer#"), number("o_custkey"))).alias(KEY),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderpriority")).alias("Segment"),
        F.col("o_orderstatus").alias("Status"))
    erp = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("_row"), F.concat(F.lit(" CUSTOMER#"), number("s_suppkey")).alias(KEY),
        F.lit("SUPPLIER").alias("Segment"), F.col("s_nationkey").alias("Nation"))
    return M.stack_sources({"b-shop": shop, "c-erp": erp, "a-crm": crm})


@query("key_normalisation", """
SELECT p_partkey, lower(trim(regexp_replace('  ' || p_name || '  ' || p_brand, '\\s+', ' ', 'g'))) AS key FROM part""")
def _norm(spark, sf):
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit("  "), F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", norm_key(raw).alias("key"))


@query("blank_key_isolation", f"WITH {STACKED_SQL} SELECT rnk AS _rank, rw AS _row, id AS _id, blank AS _blank FROM ident")
def _blank(spark, sf):
    return M.identify(sources(spark, sf), KEY).select("_rank", "_row", "_id", "_blank")


@query("cell_melt", f'WITH {STACKED_SQL} SELECT id AS _id, file AS _file, rw AS _row, "column", value FROM cells')
def _melt(spark, sf):
    return M.melt_cells(sources(spark, sf), KEY).where(F.col("column") != KEY).select("_id", "_file", "_row", "column", "value")


@query("merge_first_wins", f"""WITH {STACKED_SQL},
  won AS (SELECT id, blank, arg_min(key, rnk * 1000000000000 + rw) AS key,
    arg_min(segment, rnk * 1000000000000 + rw) FILTER (WHERE segment <> '') AS segment,
    arg_min(status, rnk * 1000000000000 + rw) FILTER (WHERE status <> '') AS status,
    arg_min(nation, rnk * 1000000000000 + rw) FILTER (WHERE nation <> '') AS nation FROM ident GROUP BY 1, 2)
SELECT key AS "Customer No", COALESCE(segment, '') AS "Segment", COALESCE(status, '') AS "Status", COALESCE(nation, '') AS "Nation" FROM won""")
def _merge(spark, sf):
    return M.ordered_merge(M.merge_sources(sources(spark, sf), KEY))


@query("key_display_and_order", f"""WITH {STACKED_SQL} SELECT id AS _id, kept AS key FROM shown""")
def _display(spark, sf):
    return M.key_spelling(sources(spark, sf), KEY)


@query("merge_conflicts", f"WITH {STACKED_SQL} SELECT * FROM conflicts")
def _conflicts(spark, sf):
    return M.merge_conflicts(sources(spark, sf), KEY)


@query("conflict_summary", f'WITH {STACKED_SQL} SELECT "column", COUNT(*) AS conflicts FROM conflicts GROUP BY 1')
def _summary(spark, sf):
    return M.conflict_summary(M.merge_conflicts(sources(spark, sf), KEY))


@query("key_variants", f"""WITH {STACKED_SQL}
SELECT kept, key AS other, COUNT(*) AS n FROM ident JOIN shown USING (id) WHERE NOT blank AND key <> kept GROUP BY 1, 2""")
def _variants(spark, sf):
    return M.key_variants(sources(spark, sf), KEY)


@query("contributors", f"""WITH {STACKED_SQL}
SELECT kept AS key, string_agg(DISTINCT file, ', ' ORDER BY file) AS sources FROM ident JOIN shown USING (id) WHERE NOT blank GROUP BY id, kept""")
def _contributors(spark, sf):
    return M.contributors(sources(spark, sf), KEY).select("key", F.array_join("sources", ", ").alias("sources"))


@query("merge_stats", f"""WITH {STACKED_SQL}
SELECT COUNT(*) AS rows_in, COUNT(DISTINCT id) AS rows_out, COUNT(*) FILTER (WHERE blank) AS blank_keys,
       CAST(4 AS BIGINT) AS columns, (SELECT COUNT(*) FROM conflicts) AS conflicts FROM ident""")
def _stats(spark, sf):
    return M.merge_stats(sources(spark, sf), KEY)


@query("source_precedence", """
SELECT doc_id, source, CAST(dense_rank() OVER (ORDER BY source) AS BIGINT) AS _rank FROM documents""")
def _rank(spark, sf):
    return M.rank_rows(table(spark, sf, "documents").select("doc_id", "source"), "source")


# Part names as headers: each brand is a file, economy parts are shouted.
HEADERS_SQL = """headers AS (SELECT p_size AS rnk, p_brand || '/' || p_size AS file, p_partkey AS position,
  CASE WHEN p_type = 'ECONOMY' THEN upper(p_name) ELSE p_name END AS header FROM part)"""


def headers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_size").alias("_rank"), F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("_file"),
        F.col("p_partkey").alias("position"),
        F.when(F.col("p_type") == "ECONOMY", F.upper("p_name")).otherwise(F.col("p_name")).alias("header"))


@query("column_union", f"""WITH {HEADERS_SQL}
SELECT header, rnk AS first_rank, position AS first_position FROM headers
QUALIFY row_number() OVER (PARTITION BY header ORDER BY rnk, position) = 1""")
def _union(spark, sf):
    return M.union_columns(headers(spark, sf))


@query("near_identical_headers", f"""WITH {HEADERS_SQL},
 s AS (SELECT lower(header) AS norm, header, rnk, file, MIN(position) AS position FROM headers GROUP BY ALL),
 f AS (SELECT norm, header AS first_header, file AS first_file FROM s QUALIFY row_number() OVER (PARTITION BY norm ORDER BY rnk, position) = 1)
SELECT first_header, first_file, header, file FROM s JOIN f USING (norm) WHERE header <> first_header""")
def _near(spark, sf):
    return M.near_miss_columns(headers(spark, sf))
