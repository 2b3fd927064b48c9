"""Data behind the rendered reports. Nothing is drawn here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import first_text, left_cell, right_cell
from .keyed import row_numbers


def pick_lang(name: str, lang: str, *fallback: str) -> Column:
    """The asked language, then German, then English, then ``fallback``."""
    order = list(dict.fromkeys([lang, "de", "en"]))
    return first_text(*[F.col(f"{name}_{code}") for code in order], *[F.col(c) for c in fallback])


def sheet(df: DataFrame, coded: Sequence[str], lang: str = "de") -> DataFrame:
    """Coded columns as ``<c>_code`` and ``<c>_label``; the rest unchanged."""
    labels = {f"{c}_label_{code}" for c in coded for code in ("de", "en")}
    out = []
    for c in df.columns:
        if c in coded:
            out += [F.col(c).alias(f"{c}_code"), pick_lang(f"{c}_label", lang, c).alias(f"{c}_label")]
        elif c not in labels:
            out.append(F.col(c))
    return df.select(*out)


def stacked_counts(tables: Mapping[str, tuple[DataFrame, str]], lang: str = "de") -> DataFrame:
    """All distributions in one long table; ``tables``: name -> (table, column)."""
    parts = [df.select(F.lit(name).alias("table"), F.col("position"), F.col(c).alias("code"),
                       pick_lang(f"{c}_label", lang, c).alias("label"), F.col("value").alias("count"))
             for name, (df, c) in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts)


def pivot_count(df: DataFrame, rows: str, columns: str, measure: str, codes: Sequence[str]) -> DataFrame:
    """Rows against columns, counting non-null values of a measure."""
    counted = df.groupBy(rows, columns).agg(F.count(measure).alias("n"))
    return counted.groupBy(rows).pivot(columns, list(codes)).agg(F.sum("n")).na.fill(0, list(codes))


def bar_series(cells: DataFrame, row: str, column: str, order: str = "column_position") -> DataFrame:
    """Stacked bars from the cells of a cross-tab: each segment's offset and
    the row total as a share of the largest total."""
    before = W.partitionBy(row).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    largest = cells.agg(F.max("total")).scalar()
    return cells.select(row, column, "value", F.coalesce(F.sum("value").over(before), F.lit(0)).alias("start"),
                        "total", F.when(largest > 0, F.round(F.col("total") / largest, 4))
                        .otherwise(F.lit(0.0)).alias("share"))


def paginate(df: DataFrame, order: Sequence[str | Column], k: int = 10) -> DataFrame:
    """Add ``page`` and ``line``: k rows a page, nothing left out."""
    numbered = row_numbers(df, order, name="_no")
    return (numbered.withColumn("page", F.floor((F.col("_no") - 1) / k) + 1)
            .withColumn("line", (F.col("_no") - 1) % k + 1).drop("_no"))


def text_lines(df: DataFrame, widths: Mapping[str, int], numbers: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Fixed-width lines, so that two reports can be compared line by line."""
    cells = [right_cell(c, w) if c in numbers else left_cell(c, w) for c, w in widths.items()]
    return df.select(F.concat(*cells).alias(name))


def diff_reports(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows that came, went or changed, with both values."""
    keys, values = list(keys), list(values)
    left = old.select(*keys, *[F.col(v).alias(f"old_{v}") for v in values], F.lit(True).alias("_o"))
    right = new.select(*keys, *[F.col(v).alias(f"new_{v}") for v in values], F.lit(True).alias("_n"))
    both = left.join(right, keys, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}")) for v in values])
    state = (F.when(F.col("_o").isNull(), F.lit("added")).when(F.col("_n").isNull(), F.lit("removed"))
              .when(~same, F.lit("changed")))
    return both.withColumn("state", state).where(F.col("state").isNotNull()).drop("_o", "_n")


def diff_lines(old: DataFrame, new: DataFrame) -> DataFrame:
    """Lines only one of two text reports has, counting repeats."""
    return (old.exceptAll(new).withColumn("side", F.lit("-"))
            .unionByName(new.exceptAll(old).withColumn("side", F.lit("+"))))
