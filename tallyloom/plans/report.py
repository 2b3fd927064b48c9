"""The whole report from a spec: headlines, tables, coverage, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.measures import (Definition, _resolve, coverage, cross_tab, definitions_df, distribution,
                                  enrich_projects, flat, headlines)

KINDS = ("distribution", "cross_tab")


@dataclass
class Model:
    """Lazy DataFrames; nothing has run yet."""

    headline: DataFrame | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    info: dict[str, dict] = field(default_factory=dict)
    coverage: DataFrame | None = None
    flat: dict[str, DataFrame] = field(default_factory=dict)
    definitions: DataFrame | None = None
    charts: list[str] = field(default_factory=list)


def build_model(tables: Mapping[str, DataFrame], spec: Mapping, definitions: Sequence[Definition],
                dims: DataFrame) -> Model:
    """Build every table a spec names. An unknown definition or kind, or a
    chart without a table, is an error; a column without data is a note."""
    known = {d.key: d for d in definitions}
    spark = dims.sparkSession
    model = Model()
    if spec.get("headline"):
        model.headline = headlines(tables, spec["headline"], known)
    for key in sorted(spec.get("tables") or {}):
        item = spec["tables"][key]
        d = _resolve(known, item["definition"])
        kind = item.get("kind", "distribution")
        df = tables[d.grain]
        if kind == "distribution":
            wanted = [item["column"]]
            model.tables[key] = distribution(df, d, item["column"], dims, _group(item))
        elif kind == "cross_tab":
            wanted = [item["rows"], item["columns"]]
            model.tables[key] = cross_tab(df, d, item["rows"], item["columns"], dims,
                                          _group(item, "rows_"), _group(item, "columns_"))
        else:
            raise ValueError(f"table {key!r} has unknown kind {kind!r}, known: {', '.join(KINDS)}")
        missing = [c for c in wanted if c not in df.columns]
        model.info[key] = {"kind": kind, "definition": d.key, "grain": d.grain, "counts": d.count,
                           "available": not missing, "column": wanted[0],
                           "note": f"Field {', '.join(missing)} is not present in the data." if missing else None}
    for key in spec.get("charts") or []:
        if key not in model.tables:
            raise ValueError(f"charts names {key!r}, which is not a table")
        model.charts.append(key)
    if "projects" in tables:
        projects = tables["projects"]
        if {"fields_filled", "fields_tracked", "team_id", "confidence"} <= set(projects.columns):
            model.coverage = coverage(projects)
        if all(t in tables for t in ("datastores", "environments", "blockers")):
            projects = enrich_projects(projects, tables["datastores"], tables["environments"], tables["blockers"])
        model.flat = {name: flat(projects if name == "projects" else df, name) for name, df in tables.items()}
    model.definitions = definitions_df(spark, definitions)
    return model


def _group(item: Mapping, prefix: str = "") -> tuple[str, str] | None:
    for source in ("taxonomy", "reference"):
        if item.get(prefix + source):
            return source, item[prefix + source]
    return None


def table_info(spark, model: Model) -> DataFrame:
    rows = [(k, i["kind"], i["definition"], i["grain"], i["counts"], i["available"], i["note"])
            for k, i in sorted(model.info.items())]
    return spark.createDataFrame(rows, "table string, kind string, definition string, grain string, "
                                       "counts string, available boolean, note string")
