"""Documents to tables at declared grains. Narrow plans: no shuffle at all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.known import any_known, as_code, as_number, as_text, is_known, joined_codes
from ..functions.paths import Paths
from ..functions.text import UNKNOWN
from ..schema import CHILD_TABLES, TABLES, project_columns, tracked_patterns


def _reader(kind: str):
    return {"code": as_code, "number": as_number, "count": as_number}.get(kind, as_text)


def pattern_known(paths: Paths, pattern: str) -> Column:
    """Is any value at this schema pattern known?"""
    head, mark, rest = pattern.partition("[]")
    if not mark:
        if paths.variant:
            text = paths.text(head)
            kind = F.schema_of_variant(paths.raw(head))
            nested = (F.when(kind.startswith("ARRAY"), any_known(paths.texts(head)))
                      .when(kind.startswith("OBJECT"), kind != "OBJECT<>").otherwise(is_known(text)))
            # Only what prints like a list or a block is looked at again.
            return F.when(F.left(text, F.lit(1)).isin("[", "{"), nested).otherwise(is_known(text))
        raw = paths.raw(head)
        return any_known(raw.cast("array<string>")) if paths.is_list(head) else is_known(raw.cast("string"))
    if not rest:
        return any_known(paths.texts(head))
    below = rest.lstrip(".")
    return F.coalesce(F.exists(paths.items(head), lambda e: is_known(paths.inside(e, below))), F.lit(False))


def coverage_columns(docs: DataFrame, schema: T.StructType, column: str = "doc") -> DataFrame:
    """Add ``fields_filled`` and ``fields_tracked``.

    A repeated field counts once when any of its values is known.
    """
    paths = Paths(docs, column)
    tracked = tracked_patterns(schema)
    filled = F.lit(0)
    for pattern in tracked:
        filled = filled + pattern_known(paths, pattern).cast("int")
    return docs.withColumn("fields_filled", filled.cast("bigint")).withColumn(
        "fields_tracked", F.lit(len(tracked)).cast("bigint"))


def flatten_projects(docs: DataFrame, schema: T.StructType, file: str = "file", column: str = "doc") -> DataFrame:
    """One row per document; the columns follow the schema annotations."""
    paths = Paths(docs, column)
    columns = []
    for name, path, node in project_columns(schema):
        if node.shape == "list":
            value = joined_codes(paths.texts(path))
            if paths.variant:  # a scalar where the list belongs reads as one code
                value = F.coalesce(value, as_code(paths.text(path)) if node.get("kind") == "code"
                                   else as_text(paths.text(path)))
        elif node.get("kind") == "count":
            value = paths.whole(path)
        else:
            value = _reader(node.get("kind"))(paths.text(path))
        columns.append(value.alias(name))
    covered = coverage_columns(docs, schema, column)
    return covered.select(F.coalesce(paths.text("id"), F.lit("")).alias("project_id"),
                          F.col(file).alias("file"), "fields_filled", "fields_tracked", *columns)


def flatten_children(docs: DataFrame, path: str, columns: Sequence[tuple[str, str, str]],
                     placeholder: bool = True, column: str = "doc", items: Column | None = None) -> DataFrame:
    """One row per element of a list.

    With ``placeholder`` a document whose list is empty, missing or no list
    gets one row with ``is_placeholder`` set and every code ``unknown``.
    """
    paths = Paths(docs, column)
    items = paths.items(path) if items is None else items
    base = docs.select(F.coalesce(paths.text("id"), F.lit("")).alias("project_id"), items.alias("_items"))
    rows = base.select("project_id", F.posexplode_outer("_items").alias("idx", "_item"))
    if not placeholder:
        rows = rows.where(F.col("idx").isNotNull())
    values = [_reader(kind)(paths.inside(F.col("_item"), below)).alias(name) for name, below, kind in columns]
    out = [F.col("project_id"), F.coalesce(F.col("idx").cast("bigint"), F.lit(0)).alias("idx"), *values]
    if placeholder:
        out.append(F.col("idx").isNull().alias("is_placeholder"))
    return rows.select(*out)


def flatten_environments(docs: DataFrame, list_path: str = "placement.environments",
                         scalar_path: str = "placement.datacenter",
                         columns: Sequence[tuple[str, str, str]] = CHILD_TABLES["environments"][1],
                         scalar_column: str = "datacenter", column: str = "doc") -> DataFrame:
    """Two shapes, one table: the list when it has elements, else the single
    value as one unnamed row, else a placeholder."""
    paths = Paths(docs, column)
    site = paths.text(scalar_path)
    listed = paths.items(list_path)
    base = docs.select(F.coalesce(paths.text("id"), F.lit("")).alias("project_id"), site.alias("_site"),
                       listed.alias("_items"))
    rows = base.select("project_id", "_site", F.posexplode_outer("_items").alias("idx", "_item"))
    single = F.col("idx").isNull() & is_known("_site")
    values = []
    for name, below, kind in columns:
        value = _reader(kind)(paths.inside(F.col("_item"), below))
        if name == scalar_column:
            value = F.when(single, as_code("_site")).otherwise(value)
        values.append(value.alias(name))
    return rows.select("project_id", F.coalesce(F.col("idx").cast("bigint"), F.lit(0)).alias("idx"), *values,
                       (F.col("idx").isNull() & ~single).alias("is_placeholder"))


def flatten_edges(docs: DataFrame, path: str = "integration.depends_on", column: str = "doc") -> DataFrame:
    """One row per edge; unknown targets go, positions stay."""
    paths = Paths(docs, column)
    base = docs.select(F.coalesce(paths.text("id"), F.lit("")).alias("project_id"), paths.texts(path).alias("_t"))
    return (base.select("project_id", F.posexplode_outer("_t").alias("idx", "to_project"))
            .where(is_known("to_project"))
            .select("project_id", F.col("idx").cast("bigint").alias("idx"),
                    F.col("project_id").alias("from_project"), "to_project"))


def flatten_all(docs: DataFrame, schema: T.StructType, column: str = "doc") -> dict[str, DataFrame]:
    """The five tables, each a lazy plan over the same documents."""
    tables = {"projects": flatten_projects(docs, schema, column=column),
              "environments": flatten_environments(docs, column=column),
              "dependencies": flatten_edges(docs, column=column)}
    for name in ("datastores", "blockers"):
        path, columns = CHILD_TABLES[name]
        tables[name] = flatten_children(docs, path, columns, placeholder=name == "datastores", column=column)
    return {name: tables[name] for name in TABLES}


def with_placeholders(children: DataFrame, parents: DataFrame, key: str,
                      defaults: Mapping[str, Column]) -> DataFrame:
    """The same guarantee for child rows that are already a table.

    Only distinct keys are shuffled, the child rows themselves stay in place.
    """
    present = children.select(key).distinct()
    missing = parents.select(key).join(present, key, "left_anti")
    filler = missing.select(*[F.col(c) if c == key else defaults.get(c, F.lit(None)).alias(c)
                              for c in children.columns], F.lit(True).alias("is_placeholder"))
    return children.withColumn("is_placeholder", F.lit(False)).unionByName(filler)


__all__ = ["UNKNOWN", "coverage_columns", "flatten_all", "flatten_children", "flatten_edges",
           "flatten_environments", "flatten_projects", "pattern_known", "with_placeholders"]
