"""Code lists: taxonomy groups and reference lists as one small dimension.

    source  group  code  position  label_de  label_en  colour

``source`` is ``taxonomy`` or ``reference``. Taxonomy groups keep their
declared order; reference lists sort by code with ``unknown`` last.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import UNKNOWN, first_text
from ..operators.keyed import small_side

DIM_DDL = ("source string, group string, code string, position int, label_de string, "
           "label_en string, colour string")


def load_dimensions(spark: SparkSession, taxonomy: Mapping[str, Mapping] | None = None,
                    references: Mapping[str, Mapping] | None = None) -> DataFrame:
    """From config: ``taxonomy`` = group -> {order, codes}, ``references`` =
    list -> entries. The file content, parsed, can be passed as it is."""
    rows = []
    for group, spec in (taxonomy or {}).items():
        codes = spec.get("codes") or {}
        for position, code in enumerate(spec.get("order") or list(codes)):
            entry = codes.get(code) or {}
            rows.append(("taxonomy", group, str(code), position, entry.get("label_de"),
                         entry.get("label_en"), entry.get("colour")))
    for name, entries in (references or {}).items():
        ordered = sorted(entries, key=lambda c: (c == UNKNOWN, c))
        for position, code in enumerate(ordered):
            entry = entries[code] or {}
            rows.append(("reference", name, str(code), position, entry.get("label_de"),
                         entry.get("label_en"), entry.get("colour")))
    return spark.createDataFrame(rows, DIM_DDL)


def scan_dimensions(spark: SparkSession, directory: str) -> DataFrame:
    """The code-list files of a directory: ``taxonomy.yaml`` and reference
    lists. These are a handful of small config files."""
    from .documents import scan_documents

    docs = scan_documents(spark, directory)
    as_map = "map<string,variant>"
    groups = (docs.where(F.regexp_extract("file", r"([^/]+)\.yaml$", 1) == "taxonomy")
              .select(F.explode(F.try_variant_get("doc", "$.groups", as_map)).alias("group", "g"))
              .select("group", F.posexplode(F.try_variant_get("g", "$.order", "array<string>")).alias("position", "code"),
                      F.try_variant_get("g", "$.codes", as_map).alias("codes"))
              .select(F.lit("taxonomy").alias("source"), "group", "code", "position",
                      F.try_element_at("codes", "code").alias("e")))
    lists = (docs.where(F.regexp_extract("file", r"([^/]+)\.yaml$", 1) != "taxonomy")
             .select(F.regexp_extract("file", r"([^/]+)\.yaml$", 1).alias("group"),
                     F.explode(F.try_variant_get("doc", "$.entries", as_map)).alias("code", "e")))
    lists = lists.select(F.lit("reference").alias("source"), "group", "code", _last_unknown(), "e")
    return groups.unionByName(lists).select(
        "source", "group", "code", "position", *[F.try_variant_get("e", f"$.{c}", "string").alias(c)
                                                 for c in ("label_de", "label_en", "colour")])


def dimension_from(df: DataFrame, group: str, code: str, label_de: str | None = None,
                   label_en: str | None = None, source: str = "reference") -> DataFrame:
    """A reference list that is itself a table."""
    label = lambda name: (F.min(name) if name else F.lit(None)).cast("string")
    codes = df.groupBy(F.col(code).cast("string").alias("code")).agg(
        label(label_de).alias("label_de"), label(label_en).alias("label_en"))
    return codes.select(F.lit(source).alias("source"), F.lit(group).alias("group"), "code", _last_unknown(),
                        "label_de", "label_en", F.lit(None).cast("string").alias("colour"))


def _last_unknown():
    """Codes of one position sort by name, so two positions are enough."""
    return (F.col("code") == UNKNOWN).cast("int").alias("position")


Group = str | tuple[str, str] | None


def axis(dims: DataFrame, group: Group) -> DataFrame:
    """Codes of one axis in order: (code, position, label_de, label_en, colour).

    ``group`` is (source, name), or a name alone; a name that both sources have
    then means the taxonomy group."""
    columns = ("code", "position", "label_de", "label_en", "colour")
    if isinstance(group, tuple):
        return dims.where((F.col("source") == group[0]) & (F.col("group") == group[1])).select(*columns)
    named = dims.where(F.col("group") == group)
    return named.where(F.col("source") == named.agg(F.max("source")).scalar()).select(*columns)


def unknown_colour(dims: DataFrame) -> DataFrame:
    """The colour all taxonomy groups give ``unknown``, if they agree (1 row)."""
    shades = dims.where((F.col("source") == "taxonomy") & (F.col("code") == UNKNOWN)
                        & (F.coalesce("colour", F.lit("")) != ""))
    return shades.agg(F.when(F.min("colour") == F.max("colour"), F.min("colour")).alias("colour"))


def with_labels(df: DataFrame, column: str, dims: DataFrame, group: Group,
                languages: tuple[str, ...] = ("de", "en")) -> DataFrame:
    """Add ``<column>_label_<lang>``; a code without label shows itself."""
    codes = axis(dims, group).select(F.col("code").alias(column), *[f"label_{lang}" for lang in languages])
    joined = df.join(small_side(codes), column, "left")
    return joined.select(*df.columns, *[first_text(F.col(f"label_{lang}"), F.col(column)).alias(f"{column}_label_{lang}")
                                        for lang in languages])


def with_colour(df: DataFrame, column: str, dims: DataFrame, group: Group) -> DataFrame:
    """Add ``<column>_colour``: the code's own, or the shared one of unknown."""
    codes = axis(dims, group).select(F.col("code").alias(column), F.nullif(F.col("colour"), F.lit("")).alias("_own"))
    shared = unknown_colour(dims).scalar()
    joined = df.join(small_side(codes), column, "left")
    return joined.select(*df.columns, F.coalesce("_own", F.when(F.col(column) == UNKNOWN, shared))
                         .alias(f"{column}_colour"))
