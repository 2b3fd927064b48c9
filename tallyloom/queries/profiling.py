"""Column profiling on orders written the way an office would write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from ..operators import profile as P
from ..operators.keyed import row_numbers
from ..session import spread
from .registry import query, table

COLUMNS = ("Order Nr", "Status", "Priority", "Betrag (EUR)", "Menge", "Datum", "Codes", "Leer", "Team")

MESSY_SQL = """messy AS (SELECT o_orderkey AS rw, CAST(o_orderkey AS VARCHAR) AS "Order Nr",
  CASE o_orderstatus WHEN 'P' THEN 'ja' WHEN 'F' THEN 'Nein' ELSE '?' END AS "Status",
  CASE o_orderstatus WHEN 'P' THEN lower(o_orderpriority) WHEN 'F' THEN o_orderpriority ELSE replace(o_orderpriority, '-', ' ') END AS "Priority",
  replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS "Betrag (EUR)",
  CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ' GB' AS "Menge",
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d.%m.%Y') END AS "Datum",
  CASE WHEN o_orderstatus = 'O' THEN o_orderpriority || '/' || o_orderstatus ELSE o_orderpriority || '; ' || o_orderstatus END AS "Codes",
  CASE WHEN o_orderstatus = 'O' THEN 'k.A.' ELSE '' END AS "Leer",
  CASE WHEN o_totalprice < 20000 THEN ' - ' ELSE 'Team  ' || o_orderstatus END AS "Team" FROM orders),
clean AS (SELECT rw, "Order Nr", nullif("Status", '?') AS "Status", "Priority", "Betrag (EUR)", "Menge", "Datum", "Codes",
  CAST(NULL AS VARCHAR) AS "Leer", CASE WHEN "Team" = ' - ' THEN NULL ELSE replace("Team", '  ', ' ') END AS "Team" FROM messy),
cells AS (SELECT 0 AS index, 'Order Nr' AS "column", "Order Nr" AS value FROM clean UNION ALL SELECT 1, 'Status', "Status" FROM clean
  UNION ALL SELECT 2, 'Priority', "Priority" FROM clean UNION ALL SELECT 3, 'Betrag (EUR)', "Betrag (EUR)" FROM clean
  UNION ALL SELECT 4, 'Menge', "Menge" FROM clean UNION ALL SELECT 5, 'Datum', "Datum" FROM clean
  UNION ALL SELECT 6, 'Codes', "Codes" FROM clean UNION ALL SELECT 7, 'Leer', "Leer" FROM clean UNION ALL SELECT 8, 'Team', "Team" FROM clean),
counts AS (SELECT index, "column", value, COUNT(*) AS n FROM cells GROUP BY ALL),
tokens AS (SELECT index, "column", value, CAST(SUM(n) AS BIGINT) AS n FROM (
  SELECT index, "column", value, n FROM counts WHERE value IS NOT NULL AND "column" <> 'Codes'
  UNION ALL SELECT index, "column", trim(unnest(string_split(value, ';'))), n FROM counts WHERE "column" = 'Codes') GROUP BY ALL)"""


def messy(spark: SparkSession, sf: str) -> DataFrame:
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    return spread(table(spark, sf, "orders")).select(
        F.col("o_orderkey").alias("rw"), F.col("o_orderkey").cast("string").alias("Order Nr"),
        F.when(status == "P", F.lit("ja")).when(status == "F", F.lit("Nein")).otherwise(F.lit("?")).alias("Status"),
        F.when(status == "P", F.lower(priority)).when(status == "F", priority)
        .otherwise(F.replace(priority, F.lit("-"), F.lit(" "))).alias("Priority"),
        F.replace(price.cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias("Betrag (EUR)"),
        F.concat(F.floor(price / 1000).cast("string"), F.lit(" GB")).alias("Menge"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("Datum"),
        F.when(status == "O", F.concat_ws("/", priority, status)).otherwise(F.concat_ws("; ", priority, status)).alias("Codes"),
        F.when(status == "O", F.lit("k.A.")).otherwise(F.lit("")).alias("Leer"),
        F.when(price < 20000, F.lit(" - ")).otherwise(F.concat(F.lit("Team  "), status)).alias("Team"))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.value_counts(messy(spark, sf), COLUMNS)


def stages(spark: SparkSession, sf: str) -> P.Stages:
    return P.Stages(P.stored_counts(messy(spark, sf), COLUMNS))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return stages(spark, sf).tokens


@query("clean_cell", f"""WITH {MESSY_SQL} SELECT rw, "Status", "Codes", "Leer", "Team" FROM clean""")
def _clean(spark, sf):
    return messy(spark, sf).select("rw", *[X.clean_cell(F.col(c)).alias(c) for c in ("Status", "Codes", "Leer", "Team")])


@query("distinct_values", f'WITH {MESSY_SQL} SELECT index, "column", value, n FROM counts')
def _counts(spark, sf):
    return counts(spark, sf)


@query("fill_statistics", f"""WITH {MESSY_SQL}
SELECT index, "column", COUNT(*) AS total, COUNT(value) AS filled, COUNT(DISTINCT value) AS "distinct",
       COUNT(value) / COUNT(*) AS fill_rate FROM cells GROUP BY 1, 2""")
def _fill(spark, sf):
    return P.fill_statistics(counts(spark, sf))


@query("fill_statistics_estimated")
def _approx(spark, sf):
    return P.approx_fill_statistics(messy(spark, sf), COLUMNS)


@query("top_values", f"""WITH {MESSY_SQL}
SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INT) AS position FROM tokens
QUALIFY position <= 41""")
def _top(spark, sf):
    return P.top_values(tokens(spark, sf))


@query("number_locale", f"""WITH {MESSY_SQL},
body AS (SELECT index, "column", CASE WHEN regexp_matches(value, '^\\s*[\\d.,\\s]+\\s*[A-Za-z€$%]{{1,6}}\\s*$')
   THEN replace(regexp_extract(value, '^\\s*([\\d.,\\s]+)\\s*([A-Za-z€$%]{{1,6}})\\s*$', 1), ' ', '') ELSE value END AS b FROM counts WHERE value IS NOT NULL),
e AS (SELECT index, "column", bool_or(regexp_matches(b, '^-?\\d+,\\d+$') OR regexp_matches(b, '^-?\\d{{1,3}}(\\.\\d{{3}}){{2,}}$')) AS de,
   bool_or(regexp_matches(b, '^-?\\d+\\.(\\d{{1,2}}|\\d{{4,}})$')) AS en, bool_or(regexp_matches(b, '^-?\\d{{1,3}}\\.\\d{{3}}$')) AS o FROM body GROUP BY 1, 2)
SELECT index, "column", CASE WHEN de AND NOT en THEN 'de' WHEN en AND NOT de THEN 'en' WHEN de THEN 'ambiguous' WHEN o THEN 'ambiguous' ELSE 'en' END AS number_locale FROM e""")
def _locale(spark, sf):
    return P.number_locale(counts(spark, sf))


@query("parse_number", f"""WITH {MESSY_SQL}
SELECT rw, CAST(replace("Betrag (EUR)", ',', '.') AS DOUBLE) AS amount, CAST(replace("Menge", ' GB', '') AS DOUBLE) AS size,
       'GB' AS unit, CASE WHEN regexp_matches("Priority", '^\\d [A-Z]{{1,6}}$') THEN CAST(left("Priority", 1) AS DOUBLE) END AS leading FROM messy""")
def _number(spark, sf):
    return messy(spark, sf).select("rw", N.parse_number("Betrag (EUR)", "de").alias("amount"), N.parse_number("Menge").alias("size"),
                                   N.number_unit("Menge").alias("unit"), N.parse_number("Priority").alias("leading"))


@query("parse_date", "SELECT o_orderkey AS rw, CAST(o_orderdate AS DATE) AS day FROM orders")
def _date(spark, sf):
    return messy(spark, sf).select("rw", N.parse_date("Datum").alias("day"))


@query("parse_boolish", """SELECT o_orderkey AS rw, CASE o_orderstatus WHEN 'P' THEN 'yes' WHEN 'F' THEN 'no' END AS answer FROM orders""")
def _boolish(spark, sf):
    return messy(spark, sf).select("rw", X.parse_boolish("Status").alias("answer"))


@query("list_separator", """SELECT 6 AS index, 'Codes' AS "column", ';' AS list_separator FROM orders WHERE o_orderstatus <> 'O'
HAVING COUNT(*) >= 0.15 * (SELECT COUNT(*) FROM orders)""")
def _separator(spark, sf):
    return stages(spark, sf).separators


@query("token_explode", f'WITH {MESSY_SQL} SELECT index, "column", value, n FROM tokens')
def _tokens(spark, sf):
    return tokens(spark, sf)


@query("separator_hints", f"""WITH {MESSY_SQL} SELECT 6 AS index, 'Codes' AS "column", ';' AS list_separator,
  string_agg(DISTINCT '/', ' ') AS also FROM clean WHERE contains("Codes", '/')""")
def _hints(spark, sf):
    steps = stages(spark, sf)
    return P.separator_hints(steps.votes, steps.separators).withColumn("also", F.array_join("also", " "))


@query("unit_detection", """SELECT * FROM (VALUES (0, 'Order Nr', NULL, FALSE), (1, 'Status', NULL, FALSE), (2, 'Priority', NULL, FALSE),
 (3, 'Betrag (EUR)', 'eur', FALSE), (4, 'Menge', 'gb', FALSE), (5, 'Datum', NULL, FALSE), (6, 'Codes', NULL, FALSE), (8, 'Team', NULL, FALSE)) u(index, "column", unit, mixed_units)
WHERE (SELECT COUNT(*) FROM orders) > 0""")
def _unit(spark, sf):
    return P.detect_unit(P.cell_votes(counts(spark, sf)))


PROFILE_SQL = f"""WITH {MESSY_SQL}, fill AS (SELECT index, "column", COUNT(*) AS total, COUNT(value) AS filled, COUNT(value) / COUNT(*) AS fill_rate FROM cells GROUP BY 1, 2),
d AS (SELECT index, COUNT(*) AS n FROM tokens GROUP BY 1)
SELECT index, "column", field, total, filled, fill_rate, COALESCE(n, 0) AS "distinct", kind, unit, FALSE AS mixed_units, number_locale, list_separator
FROM fill LEFT JOIN d USING (index) JOIN (VALUES (0, 'order_nr', 'integer', NULL, 'en', NULL), (1, 'status', 'boolish', NULL, 'en', NULL),
 (2, 'priority', 'enum', NULL, 'en', NULL), (3, 'betrag_eur', 'number', 'eur', 'de', NULL), (4, 'menge_gb', 'integer', 'gb', 'en', NULL),
 (5, 'datum', 'date', NULL, 'en', NULL), (6, 'codes', 'list', NULL, 'en', ';'), (7, 'leer', 'empty', NULL, 'en', NULL),
 (8, 'team', 'enum', NULL, 'en', NULL)) k(index, field, kind, unit, number_locale, list_separator) USING (index)"""


@query("kind_classification", PROFILE_SQL)
def _profile(spark, sf):
    return stages(spark, sf).profile


CLUSTERS_SQL = """small AS (SELECT index FROM tokens GROUP BY 1 HAVING COUNT(*) <= 40 AND MAX(length(value)) <= 60),
clusters AS (SELECT index, "column", regexp_replace(lower(value), '[^a-z0-9]+', '', 'g') AS cluster,
  string_agg(DISTINCT value, '|' ORDER BY value) AS spellings, MIN(value) AS first_value, CAST(SUM(n) AS BIGINT) AS n
  FROM tokens WHERE index IN (SELECT index FROM small) GROUP BY 1, 2, 3)"""


@query("spelling_clusters", f'WITH {MESSY_SQL}, {CLUSTERS_SQL} SELECT index, "column", cluster, spellings, n FROM clusters')
def _clusters(spark, sf):
    return P.spelling_clusters(tokens(spark, sf)).withColumn("spellings", F.array_join("spellings", "|"))


@query("similar_values_by_edits", f"""WITH {MESSY_SQL}, {CLUSTERS_SQL}
SELECT x."column", x.cluster AS a, x.first_value AS value_a, y.cluster AS b, y.first_value AS value_b,
       1 - levenshtein(x.cluster, y.cluster) / greatest(length(x.cluster), length(y.cluster)) AS score
FROM clusters x JOIN clusters y ON x.index = y.index AND x.cluster < y.cluster AND abs(length(x.cluster) - length(y.cluster)) <= 6
WHERE 1 - levenshtein(x.cluster, y.cluster) / greatest(length(x.cluster), length(y.cluster)) >= 0.3""")
def _similar(spark, sf):
    return P.similar_values(P.spelling_clusters(tokens(spark, sf)), measure="edits", threshold=0.3)


@query("similar_values_by_ratio")
def _similar_ratio(spark, sf):
    return P.similar_values(P.spelling_clusters(tokens(spark, sf)), threshold=0.3)


@query("canonical_spelling", f"""WITH {MESSY_SQL}, k AS (SELECT *, regexp_replace(lower(value), '[^a-z0-9]+', '', 'g') AS cluster FROM tokens)
SELECT "column", cluster, value AS canonical, COUNT(*) OVER w AS spellings, CAST(SUM(n) OVER w AS BIGINT) AS n FROM k WINDOW w AS (PARTITION BY "column", cluster)
QUALIFY row_number() OVER (PARTITION BY "column", cluster ORDER BY n DESC, length(value), value) = 1""")
def _canonical(spark, sf):
    return P.canonical_values(tokens(spark, sf))


@query("value_map_starter", f"""WITH {MESSY_SQL}, k AS (SELECT *, regexp_replace(lower(value), '[^a-z0-9]+', '', 'g') AS cluster FROM tokens WHERE index IN (1, 2, 6, 8)),
 best AS (SELECT "column", cluster, value AS canonical FROM k QUALIFY row_number() OVER (PARTITION BY "column", cluster ORDER BY n DESC, length(value), value) = 1)
SELECT "column", value, n, trim(regexp_replace(lower(canonical), '[^a-z0-9]+', '_', 'g'), '_') AS code FROM k JOIN best USING ("column", cluster)""")
def _value_map(spark, sf):
    steps = stages(spark, sf)
    return P.propose_value_map(steps.profile, steps.tokens)


@query("column_pick", """SELECT 'id' AS role, 'Order Nr' AS "column" FROM orders HAVING COUNT(*) = COUNT(DISTINCT o_orderkey)
UNION ALL SELECT 'group', 'Team' FROM orders HAVING COUNT(*) FILTER (WHERE o_totalprice >= 20000) >= 0.9 * COUNT(*)""")
def _pick(spark, sf):
    profile = stages(spark, sf).profile
    return (P.pick_column(profile, "id").withColumn("role", F.lit("id"))
            .unionByName(P.pick_column(profile, "group").withColumn("role", F.lit("group"))))


@query("saturation", f"""WITH {MESSY_SQL}, q AS (SELECT rw, ceil(row_number() OVER (ORDER BY rw) * 4 / (SELECT COUNT(*) FROM clean)) AS q FROM clean),
 f AS (SELECT 'Order Nr' AS "column", "Order Nr" AS value, MIN(q) AS q FROM clean JOIN q USING (rw) GROUP BY 2
   UNION ALL SELECT 'Priority', "Priority", MIN(q) FROM clean JOIN q USING (rw) GROUP BY 2
   UNION ALL SELECT 'Betrag (EUR)', "Betrag (EUR)", MIN(q) FROM clean JOIN q USING (rw) GROUP BY 2
   UNION ALL SELECT 'Datum', "Datum", MIN(q) FROM clean JOIN q USING (rw) GROUP BY 2)
SELECT "column", COUNT(*) FILTER (WHERE q <= 1) AS distinct_25, COUNT(*) FILTER (WHERE q <= 2) AS distinct_50, COUNT(*) AS distinct_100 FROM f GROUP BY 1""")
def _saturation(spark, sf):
    numbered = row_numbers(messy(spark, sf), ["rw"])
    return P.saturation(numbered, ["Order Nr", "Priority", "Betrag (EUR)", "Datum"])


@query("profile_report", PROFILE_SQL.replace("SELECT index, \"column\", field,", """SELECT CASE index WHEN 1 THEN 'looks like yes/no'
  WHEN 2 THEN '5 value(s) appear in several spellings' WHEN 6 THEN 'other separators also appear' WHEN 7 THEN 'column is completely empty' ELSE '' END AS hints,
  index, \"column\", field,"""))
def _report(spark, sf):
    steps = stages(spark, sf)
    return P.profile_report(steps.counts, steps).withColumn("hints", F.array_join("hints", ", "))


@query("schema_derivation", f"""WITH {MESSY_SQL}
SELECT 'state' AS field, 'string' AS type, (SELECT string_agg(DISTINCT value, '|' ORDER BY value) FROM (
   SELECT CASE value WHEN 'ja' THEN 'yes' ELSE value END AS value FROM tokens WHERE index = 1 UNION ALL SELECT 'unknown')) AS codes
UNION ALL SELECT 'amount', 'double', '' UNION ALL SELECT 'day', 'string', ''
UNION ALL SELECT 'codes', 'array<string>', (SELECT string_agg(DISTINCT value, '|' ORDER BY value) FROM (SELECT value FROM tokens WHERE index = 6 UNION ALL SELECT 'unknown'))""")
def _schema(spark, sf):
    steps = stages(spark, sf)
    derived = P.derive_schema(steps.profile, steps.tokens, {"Status": "state", "Betrag (EUR)": "amount", "Datum": "day", "Codes": "codes"},
                              {"state": {"ja": "yes"}})
    rows = [(f.name, f.dataType.simpleString(), "|".join(f.metadata.get("enum", []))) for f in derived.fields]
    return spark.createDataFrame(rows, "field string, type string, codes string")
