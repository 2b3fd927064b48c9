"""Counting rules and the tables built from them.

A rule (``Definition``) says which grain a number counts and how. It turns into
an aggregate in one place, ``measure``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import percent
from ..functions.text import UNKNOWN
from ..session import cut_lineage
from ..sources.dimensions import Group, axis, with_colour, with_labels
from .keyed import row_numbers, small_side


@dataclass(frozen=True)
class Definition:
    """grain: table the rows come from; count: ``projects`` or ``rows``."""

    key: str
    grain: str
    count: str = "rows"
    exclude_placeholders: bool = False
    text_de: str = ""
    text_en: str = ""


def measure(definition: Definition, when: Column | None = None, key: str = "project_id") -> Column:
    """``projects`` counts distinct projects, ``rows`` counts rows."""
    if definition.count == "projects":
        return F.countDistinct(F.col(key) if when is None else F.when(when, F.col(key)))
    return F.count(F.lit(1)) if when is None else F.count_if(when)


def restrict(df: DataFrame, definition: Definition) -> DataFrame:
    """Leave placeholder rows out when the rule asks for it."""
    if definition.exclude_placeholders and "is_placeholder" in df.columns:
        return df.where(~F.col("is_placeholder"))
    return df


def headlines(tables: Mapping[str, DataFrame], items: Sequence[Mapping], definitions: Mapping[str, Definition],
              key: str = "project_id") -> DataFrame:
    """All headline numbers (key, definition, value), one aggregate per grain.

    A column that does not exist gives NULL, not 0.
    """
    by_grain: dict[tuple, list] = {}
    for item in items:
        d = _resolve(definitions, item["definition"])
        by_grain.setdefault((d.grain, d.exclude_placeholders), []).append((item, d))
    parts = []
    for (grain, _), group in by_grain.items():
        df = restrict(tables[grain], group[0][1])
        numbers = []
        for item, d in group:
            column = item.get("column")
            if column and column not in df.columns:
                value = F.max(F.lit(None)).cast("bigint")
            elif column and "equals" in item:
                value = measure(d, F.col(f"`{column}`") == item["equals"], key)
            else:
                value = measure(d, None, key)
            numbers.append(F.struct(F.lit(item["key"]).alias("key"), F.lit(d.key).alias("definition"),
                                    value.cast("bigint").alias("value")))
        parts.append(df.agg(F.array(*numbers).alias("h")).select(F.inline("h")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def headline(df: DataFrame, definition: Definition, column: str | None = None, equals=None,
             key: str = "project_id") -> DataFrame:
    item = {"key": definition.key, "definition": definition.key}
    if column:
        item.update(column=column, equals=equals)
    return headlines({definition.grain: df}, [item], {definition.key: definition}, key)


def count_by(df: DataFrame, definition: Definition, *columns: str, key: str = "project_id") -> DataFrame:
    """Counts per code; a missing value counts as ``unknown``."""
    codes = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(UNKNOWN)).alias(c) for c in columns]
    slim = restrict(df, definition)
    keep = [F.col(key).alias(key)] if definition.count == "projects" and key not in columns else []
    return slim.select(*codes, *keep).groupBy(*columns).agg(measure(definition, None, key).alias("value"))


def distribution(df: DataFrame, definition: Definition, column: str, dims: DataFrame, group: Group,
                 key: str = "project_id") -> DataFrame:
    """Every code of the axis in order with zeros, then codes nobody declared,
    and always ``unknown``. Columns: the code, position, labels, colour, value.

    A column the table does not have gives an empty table of the same shape.
    """
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], _distribution_ddl(column))
    counted = count_by(df, definition, column, key=key)
    codes = _with_unknown(axis(dims, group).select("code", "position"))
    joined = counted.withColumnRenamed(column, "code").join(codes, "code", "full_outer")
    out = joined.select(F.col("code").alias(column), "position", F.coalesce("value", F.lit(0)).alias("value"))
    out = with_colour(with_labels(out, column, dims, group), column, dims, group)
    return out.select(column, "position", f"{column}_label_de", f"{column}_label_en", f"{column}_colour", "value")


def _distribution_ddl(column: str) -> str:
    return (f"`{column}` string, position int, `{column}_label_de` string, `{column}_label_en` string, "
            f"`{column}_colour` string, value bigint")


def _with_unknown(codes: DataFrame) -> DataFrame:
    """Append ``unknown`` to an axis that lacks it, after everything else."""
    lone = codes.sparkSession.createDataFrame([(UNKNOWN, None)], "code string, position int")
    return codes.unionByName(lone).groupBy("code").agg(F.min("position").alias("position"))


def ordered(table: DataFrame, column: str) -> DataFrame:
    """Report order: declared codes, then observed extras, by name."""
    late = F.col("position").isNull() & (F.col(column) == UNKNOWN)
    return table.orderBy(late, F.col("position").asc_nulls_last(), column)


def axis_codes(df: DataFrame, definition: Definition, column: str, dims: DataFrame, group: Group,
               limit: int = 10_000) -> list[str]:
    """All codes of one axis in order, for use as columns.

    Fails when there are more than columns can hold.
    """
    codes = axis(dims, group).orderBy("position", "code").select("code").limit(limit + 1)
    declared = [r["code"] for r in codes.collect()]
    seen = (restrict(df, definition).select(F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("c")).distinct()
            .where(~F.col("c").isin(*declared, UNKNOWN)).limit(limit + 1))
    extra = sorted(r["c"] for r in seen.collect())
    if len(declared) + len(extra) > limit:
        raise ValueError(f"{column!r} has more than {limit} codes and cannot be the columns of a table")
    return declared + extra + ([UNKNOWN] if UNKNOWN not in declared else [])


def cross_tab(df: DataFrame, definition: Definition, row: str, column: str, dims: DataFrame,
              row_group: Group, column_group: Group, key: str = "project_id",
              columns: Sequence[str] | None = None) -> DataFrame:
    """Counts of two codes against each other, zero-filled, with a row total.

    Wide: one column per code. ``columns`` lists them; by default the axis plus
    whatever else occurs.
    """
    if row not in df.columns or column not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{row}` string, position int, total bigint")
    columns = list(columns) if columns else axis_codes(df, definition, column, dims, column_group)
    counted = count_by(df, definition, row, column, key=key)
    wide = counted.groupBy(row).pivot(column, columns).agg(F.sum("value"))
    codes = _with_unknown(axis(dims, row_group).select("code", "position")).withColumnRenamed("code", row)
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in columns]
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in columns), F.lit(0))
    return wide.join(codes, row, "full_outer").select(row, "position", *cells, total.cast("bigint").alias("total"))


# Blocks of a zero-filled cross-tab: its columns are spread over them, and each row goes to all.
BLOCKS = 64


def cross_tab_cells(df: DataFrame, definition: Definition, row: str, column: str, dims: DataFrame,
                    row_group: Group, column_group: Group, key: str = "project_id", fill: bool = True) -> DataFrame:
    """The cells of a cross-tab as rows: row code, its position, column code, its place among the columns, value, and
    the total of the row. For any number of codes: nothing becomes a column.

    ``df`` is read once. ``fill`` gives a row for every row code and column code, as the wide form does; without it only
    cells that occur have one. Codes are those of the axis, what else occurs, and ``unknown``.
    """
    if row not in df.columns or column not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{row}` string, position int, total bigint, `{column}` string, value bigint, "
                                                   "column_position int")
    counted = cut_lineage(count_by(df, definition, row, column, key=key))
    rows = _codes_seen(counted, row, dims, row_group).join(
        counted.groupBy(F.col(row).alias("code")).agg(F.sum("value").alias("total")), "code", "left")
    rows = rows.select(F.col("code").alias(row), "position", F.coalesce("total", F.lit(0)).alias("total"))
    late = F.col("position").isNull() & (F.col("code") == UNKNOWN)
    columns = row_numbers(_codes_seen(counted, column, dims, column_group), [late, F.col("position").asc_nulls_last(), "code"])
    columns = columns.select(F.col("code").alias(column), (F.col("row_no") - 1).cast("int").alias("column_position"))
    if fill:
        block = F.pmod(F.xxhash64(column), F.lit(BLOCKS)).cast("int").alias("_block")
        rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
        cells = rows.join(small_side(columns.select("*", block)), "_block").drop("_block").join(counted, [row, column], "left")
    else:
        cells = counted.join(rows, row).join(columns, column)
    return cells.select(row, "position", "total", column, F.coalesce("value", F.lit(0)).alias("value"), "column_position")


def _codes_seen(counted: DataFrame, column: str, dims: DataFrame, group: Group) -> DataFrame:
    """Codes of an axis with their positions, and those that occur without one."""
    seen = counted.select(F.col(column).alias("code"), F.lit(None).cast("int").alias("position"))
    return (_with_unknown(axis(dims, group).select("code", "position")).unionByName(seen)
            .groupBy("code").agg(F.min("position").alias("position")))


def coverage(projects: DataFrame, team: str = "team_id", confidence: str = "confidence") -> DataFrame:
    """Raw and verified coverage, two numbers, per team and in total. A missing team counts as ``unknown``."""
    named = projects.withColumn(team, F.coalesce(F.col(team).cast("string"), F.lit(UNKNOWN)))
    rolled = (named.rollup(team)
              .agg(F.grouping(team).alias("_all"), F.count(F.lit(1)).alias("projects"),
                   F.coalesce(F.sum("fields_filled"), F.lit(0)).alias("_filled"),
                   F.coalesce(F.sum("fields_tracked"), F.lit(0)).alias("_tracked"),
                   F.count_if(F.col(confidence) == "verified").alias("_verified")))
    return rolled.select(
        F.when(F.col("_all") == 1, F.lit("total")).otherwise(F.lit("team")).alias("scope"), F.col(team).alias("team_id"),
        "projects", percent("_filled", "_tracked").alias("coverage_pct"),
        percent("_verified", "projects").alias("verified_pct"))


def enrich_projects(projects: DataFrame, datastores: DataFrame, environments: DataFrame, blockers: DataFrame,
                    key: str = "project_id", special: str = "db2") -> DataFrame:
    """Convenience columns for people who filter a sheet: distinct engines,
    sites and systems as text, one yes/no engine, open blockers.

    Children are reduced to one row per project before they are joined. Codes
    are made distinct first, so a project with a third of all rows arrives as a
    handful.
    """
    def text_of(df: DataFrame, columns: Mapping[str, str], *more: Column) -> DataFrame:
        return df.groupBy(key).agg(*[F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(n)
                                     for n, c in columns.items()], *more)

    stores = text_of(datastores, {"datastore_engines": "engine"}, F.bool_or(F.col("engine") == special).alias("_special"))
    places = text_of(environments, {"sites": "datacenter", "os_families": "os_family"})
    open_ones = blockers.groupBy(key).agg(F.count_if(F.col("status") == "open").alias("open_blockers"))
    joined = projects.join(stores, key, "left").join(places, key, "left").join(open_ones, key, "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in projects.columns],
        F.coalesce("datastore_engines", F.lit(UNKNOWN)).alias("datastore_engines"),
        F.when(F.col("_special"), F.lit("full")).otherwise(F.lit("none")).alias(f"has_{special}"),
        F.coalesce("sites", F.lit(UNKNOWN)).alias("sites"),
        F.coalesce("os_families", F.lit(UNKNOWN)).alias("os_families"),
        F.coalesce("open_blockers", F.lit(0)).alias("open_blockers"))


# Export order of each table, renamed and dropped columns.
FLAT_ORDER = {"projects": ("project_id",), "datastores": ("project_id", "idx"),
              "environments": ("project_id", "idx"), "blockers": ("project_id", "idx"),
              "dependencies": ("from", "to")}
FLAT_RENAME = {"dependencies": {"from_project": "from", "to_project": "to"}}
FLAT_DROP = {"dependencies": ("project_id", "idx")}


def flat(df: DataFrame, table: str, order: bool = True) -> DataFrame:
    """A grain table as it is exported."""
    out = df.drop(*FLAT_DROP.get(table, ())).withColumnsRenamed(FLAT_RENAME.get(table, {}))
    keys = [c for c in FLAT_ORDER[table] if c in out.columns]
    return out.orderBy(*keys) if order else out


def label_coded(df: DataFrame, coded: Mapping[str, str], dims: DataFrame) -> DataFrame:
    """``<column>_label_de`` and ``_en`` for every coded column (column -> group)."""
    for column, group in coded.items():
        df = with_labels(df, column, dims, group)
    return df


def flat_columns(catalogue: DataFrame, dims: DataFrame) -> DataFrame:
    """Export metadata: key, kind and whether the column carries labels."""
    named = dims.select(F.col("group").alias("_g")).distinct()
    joined = catalogue.withColumn("_g", F.coalesce("taxonomy", "reference")).join(
        named.withColumn("coded", F.lit(True)), "_g", "left")
    kind = F.coalesce("kind", F.when(F.col("type") == "bigint", F.lit("count"))
                      .when(F.col("type") == "boolean", F.lit("flag")).otherwise(F.lit("text")))
    return joined.select("table", F.col("column").alias("key"), kind.alias("kind"),
                         (F.coalesce("coded", F.lit(False)) & (kind == "code")).alias("coded"))


def definitions_df(spark: SparkSession, definitions: Sequence[Definition]) -> DataFrame:
    rows = [(d.key, d.grain, d.count, d.exclude_placeholders, d.text_de, d.text_en)
            for d in sorted(definitions, key=lambda d: d.key)]
    return spark.createDataFrame(rows, "key string, grain string, counts string, exclude_placeholders boolean, "
                                       "text_de string, text_en string")


def _resolve(definitions: Mapping[str, Definition], key: str) -> Definition:
    if key not in definitions:
        raise ValueError(f"unknown definition {key!r}, known: {', '.join(sorted(definitions))}")
    return definitions[key]
