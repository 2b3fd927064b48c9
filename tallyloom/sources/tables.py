"""Reading and writing the grain tables, records, models and text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slugify

# The delimited output is made for a German spreadsheet.
CSV_SEPARATOR = ";"
CSV_LINE_END = "\r\n"
BYTE_ORDER_MARK = "﻿"


def read_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines with declared columns: an empty table keeps its shape and an
    all-null column its type."""
    return spark.read.schema(ddl).json(path)


def write_table(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "json", mode: str = "errorifexists") -> None:
    """Rows in key order, columns by name. The part files are in order, too."""
    out = df.select(*sorted(df.columns)).orderBy(*keys)
    writer = out.write.mode(mode)
    writer.json(path, ignoreNullFields=False) if fmt == "json" else writer.format(fmt).save(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Semicolons, CRLF, UTF-8 with a byte order mark, minimal quoting."""
    first, *rest = df.columns
    (df.withColumnRenamed(first, BYTE_ORDER_MARK + first).write.mode(mode)
     .option("header", True).option("sep", CSV_SEPARATOR).option("lineSep", CSV_LINE_END)
     .option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path))


def write_records(df: DataFrame, path: str, group: str | None = None, mode: str = "errorifexists") -> None:
    """One record per line, in folders by the slug of ``group`` if given.

    The default mode refuses a target that holds records already.
    """
    if group:
        df.withColumn("group", slugify(group, "-")).write.mode(mode).partitionBy("group").json(path)
    else:
        df.write.mode(mode).json(path)


def table_manifest(tables: Mapping[str, DataFrame], **facts) -> DataFrame:
    """One row: rows per table, plus whatever facts are passed in."""
    counts = [df.select(F.lit(name).alias("table")) for name, df in tables.items()]
    stacked = reduce(DataFrame.unionByName, counts)
    out = stacked.agg(*[F.count_if(F.col("table") == name).alias(f"rows_{name}") for name in tables])
    return out.select("*", *[F.lit(v).alias(k) for k, v in sorted(facts.items())])


def write_model(model, path: str, mode: str = "errorifexists") -> None:
    """Every report table as a dataset, and the small ones once more together
    as JSON lines (table, row)."""
    for name, df in model.tables.items():
        df.write.mode(mode).json(f"{path}/tables/{name}", ignoreNullFields=False)
    for name, df in model.flat.items():
        df.write.mode(mode).json(f"{path}/flat/{name}", ignoreNullFields=False)
    for name in ("headline", "coverage", "definitions"):
        if getattr(model, name) is not None:
            getattr(model, name).write.mode(mode).json(f"{path}/{name}", ignoreNullFields=False)
    model_lines(model).write.mode(mode).json(f"{path}/model")


def model_lines(model) -> DataFrame:
    """The report as one long table: (section, table, row as JSON)."""
    parts = [("headline", "headline", model.headline), ("coverage", "coverage", model.coverage),
             ("definitions", "definitions", model.definitions)]
    parts += [("table", name, df) for name, df in sorted(model.tables.items())]
    rows = [df.select(F.lit(s).alias("section"), F.lit(n).alias("table"),
                      F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])).alias("row"))
            for s, n, df in parts if df is not None]
    return reduce(DataFrame.unionByName, rows)
