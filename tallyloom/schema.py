"""Annotated document schemas.

A schema is a Spark ``StructType``; annotations live in the field metadata:

    kind      text | code | version | date | count | id | schema_version | any
    taxonomy  group whose codes are valid
    ref       reference list (or "projects") a value must exist in
    tracked   counts toward coverage
    column    gets a column of the projects table (True or its name)
    graph     list values are edges of that graph
    required  must be present when the parent is
    open      extra keys are allowed inside
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The value shapes of each kind.
VERSION_SHAPE = r"^([0-9][0-9A-Za-z.+_~-]*|unknown)$"
DATE_SHAPE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|unknown)$"
ID_SHAPE = r"^[a-z0-9][a-z0-9-]*$"
SCHEMA_VERSION = 1

ANNOTATIONS = ("kind", "taxonomy", "ref", "tracked", "column", "graph", "required", "open", "doc")
_STORAGE = {"count": T.LongType(), "schema_version": T.IntegerType()}


def field(name: str, kind: str = "text", **annotations) -> T.StructField:
    return T.StructField(name, _STORAGE.get(kind, T.StringType()), True, {"kind": kind, **annotations})


def block(name: str, *fields: T.StructField, **annotations) -> T.StructField:
    return T.StructField(name, T.StructType(list(fields)), True, annotations)


def records(name: str, *fields: T.StructField, **annotations) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StructType(list(fields))), True, annotations)


def codes(name: str, kind: str = "code", tracked: bool = False, column=None, graph: str | None = None,
          **item) -> T.StructField:
    """A list of scalars; ``tracked``, ``column`` and ``graph`` belong to the list."""
    meta = {"item": {"kind": kind, **item}}
    meta.update({k: v for k, v in (("tracked", tracked), ("column", column), ("graph", graph)) if v})
    return T.StructField(name, T.ArrayType(T.StringType()), True, meta)


def anything(name: str) -> T.StructField:
    return T.StructField(name, T.MapType(T.StringType(), T.StringType()), True, {"kind": "any"})


@dataclass(frozen=True)
class Node:
    """One place of the schema; ``pattern`` marks lists with ``[]``."""

    pattern: str
    shape: str            # scalar | block | records | list | any
    meta: dict
    children: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.pattern.split(".")[-1].replace("[]", "")

    def get(self, key: str, default=None):
        return self.meta.get(key, default)


def walk(schema: T.StructType, prefix: str = "") -> Iterator[Node]:
    """Every place of the schema, outer ones first."""
    for f in schema.fields:
        pattern = f"{prefix}{f.name}"
        kind = f.dataType
        if isinstance(kind, T.StructType):
            yield Node(pattern, "block", f.metadata, tuple(kind.names))
            yield from walk(kind, f"{pattern}.")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            yield Node(pattern, "records", f.metadata, tuple(kind.elementType.names))
            yield from walk(kind.elementType, f"{pattern}[].")
        elif isinstance(kind, T.ArrayType):
            yield Node(pattern, "list", f.metadata)
            yield Node(f"{pattern}[]", "scalar", f.metadata.get("item", {}))
        elif isinstance(kind, T.MapType):
            yield Node(pattern, "any", f.metadata)
        else:
            yield Node(pattern, "scalar", f.metadata)


def tracked_patterns(schema: T.StructType) -> list[str]:
    return [n.pattern for n in walk(schema) if n.get("tracked")]


def project_columns(schema: T.StructType) -> list[tuple[str, str, Node]]:
    """(column name, path, place) of every field that asks for a column."""
    out = []
    for node in walk(schema):
        wanted = node.get("column")
        if not wanted:
            continue
        if "[]" in node.pattern:
            raise ValueError(f"column on {node.pattern!r}: a repeated field has no single value per document")
        out.append((wanted if isinstance(wanted, str) else node.name, node.pattern, node))
    return sorted(out, key=lambda c: c[0])


# Columns of the child tables: name, path below the element, kind.
CHILD_TABLES: dict[str, tuple[str, tuple[tuple[str, str, str], ...]]] = {
    "datastores": ("datastores", (("engine", "engine", "code"), ("version", "version", "text"),
                                  ("role", "role", "code"))),
    "environments": ("placement.environments", (
        ("name", "name", "text"), ("datacenter", "datacenter", "code"), ("os_family", "os.family", "code"),
        ("os_version", "os.version", "text"), ("os_eol", "os.eol", "text"))),
    "blockers": ("migration.blockers", (("blocker_id", "id", "text"), ("type", "type", "code"),
                                        ("severity", "severity", "code"), ("status", "status", "code"))),
}

TABLE_DDL = {
    "datastores": "project_id STRING, idx BIGINT, engine STRING, version STRING, role STRING, is_placeholder BOOLEAN",
    "environments": ("project_id STRING, idx BIGINT, name STRING, datacenter STRING, os_family STRING, "
                     "os_version STRING, os_eol STRING, is_placeholder BOOLEAN"),
    "blockers": "project_id STRING, idx BIGINT, blocker_id STRING, type STRING, severity STRING, status STRING",
    "dependencies": "project_id STRING, idx BIGINT, from_project STRING, to_project STRING",
}
TABLES = ("projects", *TABLE_DDL)


def table_ddl(schema: T.StructType) -> dict[str, str]:
    """Declared columns of all tables; the projects table follows the schema."""
    fixed = "project_id STRING, file STRING, fields_filled BIGINT, fields_tracked BIGINT"
    derived = [f"{name} {'BIGINT' if node.get('kind') == 'count' else 'STRING'}"
               for name, _, node in project_columns(schema)]
    return {"projects": ", ".join([fixed, *derived]), **TABLE_DDL}


def column_catalogue(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per table column: type, kind, taxonomy, reference, source path."""
    places = {n.pattern: n for n in walk(schema)}
    paths = {"projects": {name: path for name, path, _ in project_columns(schema)},
             "dependencies": {"from_project": "id", "to_project": "integration.depends_on[]"}}
    for table, (root, columns) in CHILD_TABLES.items():
        paths[table] = {name: f"{root}[].{below}" for name, below, _ in columns}
    rows = []
    for table, ddl in table_ddl(schema).items():
        for f in T.StructType.fromDDL(ddl).fields:
            source = paths.get(table, {}).get(f.name)
            meta = places[source].meta if source in places else {}
            meta = {**meta, **meta.get("item", {})}
            rows.append((table, f.name, f.dataType.simpleString(), meta.get("kind"),
                         meta.get("taxonomy"), meta.get("ref"), source))
    return spark.createDataFrame(rows, "table string, column string, type string, kind string, "
                                       "taxonomy string, reference string, source string")


def project_schema() -> T.StructType:
    """The shipped schema of a project document."""
    return T.StructType([
        field("schema_version", "schema_version", required=True),
        field("id", "id", required=True),
        field("name", tracked=True, column=True),
        field("my_optional_field", tracked=True, column=True),
        field("my_mandatory_field", tracked=True, column=True),
        block("ownership",
              field("team_id", "code", ref="teams", tracked=True, column=True),
              field("contact")),
        block("classification", *[field(n, "code", taxonomy=n, tracked=True, column=True)
                                  for n in ("classification_a", "classification_b", "security_class")]),
        block("placement",
              field("datacenter", "code", ref="sites", tracked=True),
              records("environments", field("name"),
                      field("datacenter", "code", ref="sites", tracked=True),
                      block("os", field("family", "code", taxonomy="os_family", tracked=True),
                            field("version", "version"), field("eol", "date")))),
        block("platform",
              field("cpu_cores", "count", tracked=True, column=True),
              field("storage_gb", "count", tracked=True, column=True),
              codes("storage_classes", taxonomy="storage_class", tracked=True, column=True),
              field("deployment_model", "code", taxonomy="deployment_model", tracked=True, column=True),
              field("containerised", "code", taxonomy="completeness_scale", column=True)),
        records("datastores", field("engine", "code", taxonomy="engine", tracked=True),
                field("version", "version"), field("role", "code", taxonomy="datastore_role")),
        block("migration",
              field("strategy", "code", taxonomy="migration_strategy", tracked=True, column="migration_strategy"),
              field("status", "code", taxonomy="migration_status", tracked=True, column="migration_status"),
              field("target_date", "date", column=True),
              records("blockers", field("id"), field("type", "code", taxonomy="blocker_type"),
                      field("severity", "code", taxonomy="severity"),
                      field("status", "code", taxonomy="blocker_status"))),
        block("integration", codes("depends_on", ref="projects", graph="depends_on", tracked=True)),
        block("operations", field("tier", "code", taxonomy="tier", tracked=True, column=True),
              field("rto_hours", "count", column=True), field("rpo_hours", "count", column=True)),
        anything("_unmapped"),
        block("_meta", field("source"), field("source_sheet"), field("source_row", "count"),
              field("source_sha256"), field("imported_at", "date", column=True),
              field("confidence", "code", taxonomy="confidence", column=True),
              field("last_reviewed", "date", column=True), field("reviewed_by"), open=True),
    ])
