"""Precedence merge: many overlapping sources to one row per key.

Rows come stacked, one all-text DataFrame with these service columns:

    _rank  precedence of the source, 1 first
    _file  name of the source
    _row   position of the row in its source
    _part  0, or 1, 2 ... for further cells of a row whose column repeats in its
           source (may be left out)

The first non-empty value in (rank, row, part) order wins, cell by cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, norm_key, squeeze, strip
from .keyed import attach_by_key, row_numbers

SERVICE = ("_rank", "_file", "_row", "_part")


def rank_names(names: Sequence[str]) -> dict[str, int]:
    """Sources rank by sorted name."""
    return {name: i for i, name in enumerate(sorted(names), start=1)}


def rank_rows(df: DataFrame, name: str, rank: str = "_rank") -> DataFrame:
    """The same for sources that are rows of one table: add their rank."""
    names = df.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    return attach_by_key(df, row_numbers(names, [name], name=rank), [name], weight="_n")


def stack_sources(sources: Mapping[str, DataFrame], row: str = "_row") -> DataFrame:
    """Stack the sources in precedence order; columns keep first-seen order."""
    stacked = None
    for name, rank in rank_names(list(sources)).items():
        df = sources[name]
        cells = [strip(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns if c != row]
        part = df.select(F.lit(rank).alias("_rank"), F.lit(name).alias("_file"),
                         F.col(row).cast("bigint").alias("_row"), *cells)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no sources to merge")
    return stacked


def data_columns(stacked: DataFrame) -> list[str]:
    return [c for c in stacked.columns if c not in SERVICE]


def identify(stacked: DataFrame, key: str) -> DataFrame:
    """Add ``_id``: the normalised key; a row without key is only itself."""
    blank = is_blank(F.col(f"`{key}`"))
    if "_part" not in stacked.columns:
        stacked = stacked.withColumn("_part", F.lit(0))
    return (stacked.withColumn("_blank", blank)
            .withColumn("_id", F.when(blank, F.concat_ws("#", F.lit(""), "_rank", "_row"))
                        .otherwise(norm_key(F.col(f"`{key}`")))))


def _position() -> Column:
    return F.struct("_rank", "_row", "_part")


def merge_sources(stacked: DataFrame, key: str) -> DataFrame:
    """One row per key: per column the first non-empty value.

    One shuffle on the key. Each task first reduces its own rows to one per
    key, so a hot key arrives as one row per task.
    """
    rows = identify(stacked, key)
    columns = data_columns(stacked)
    winners = [F.min_by(F.when(~is_blank(F.col(f"`{c}`")), F.col(f"`{c}`")),
                        F.when(~is_blank(F.col(f"`{c}`")), _position())).alias(c)
               for c in columns]
    first = F.min(F.when(F.col("_blank"), _position()))
    return (rows.groupBy("_blank", "_id").agg(*winners, first.alias("_first"))
            .select("_blank", "_id", "_first", *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns]))


def ordered_merge(merged: DataFrame) -> DataFrame:
    """Keyed rows by key, rows without key last in source order."""
    return (merged.orderBy("_blank", F.when(~F.col("_blank"), F.col("_id")), "_first")
            .drop("_blank", "_id", "_first"))


def melt_cells(stacked: DataFrame, key: str) -> DataFrame:
    """One row per non-empty cell."""
    rows = identify(stacked, key)
    columns = data_columns(stacked)
    return (rows.unpivot(["_id", "_blank", "_rank", "_file", "_row", "_part"], columns, "column", "value")
            .where(~is_blank("value")))


def merge_conflicts(stacked: DataFrame, key: str) -> DataFrame:
    """Every later value that differs from the winner, one row per occurrence.

    Only contested cells take part in the join back. The key column itself is
    exempt.
    """
    cells = melt_cells(stacked, key).where((F.col("column") != key) & ~F.col("_blank"))
    contested = (cells.groupBy("_id", "column")
                 .agg(F.min_by(F.struct("value", "_file"), _position()).alias("win"),
                      F.min("value").alias("_low"), F.max("value").alias("_high"),
                      F.count(F.lit(1)).alias("_n"))
                 .where(F.col("_low") != F.col("_high")))
    shown = key_spelling(stacked, key)
    winners = contested.join(shown, "_id").select("_id", "column", "win", "key", "_n")
    rows = attach_by_key(cells.select("_id", "column", "value", "_file"), winners,
                         ["_id", "column"], weight="_n")
    return (rows.where(F.col("value") != F.col("win.value"))
            .select("key", "column", F.col("win.value").alias("winning_value"),
                    F.col("win._file").alias("winning_file"),
                    F.col("value").alias("discarded_value"),
                    F.col("_file").alias("discarded_file")))


def order_conflicts(conflicts: DataFrame) -> DataFrame:
    return conflicts.orderBy("key", "column", "discarded_file", "discarded_value")


def conflict_summary(conflicts: DataFrame) -> DataFrame:
    """Which columns the sources disagree on most."""
    return (conflicts.groupBy("column").agg(F.count(F.lit(1)).alias("conflicts"))
            .orderBy(F.desc("conflicts"), "column"))


def key_spelling(stacked: DataFrame, key: str) -> DataFrame:
    """The spelling a key is shown with: the first one seen."""
    rows = identify(stacked, key).where(~F.col("_blank"))
    return rows.groupBy("_id").agg(F.min_by(F.col(f"`{key}`"), _position()).alias("key"))


def key_variants(stacked: DataFrame, key: str) -> DataFrame:
    """Keys that met only because of normalisation: kept, other, how often."""
    rows = identify(stacked, key).where(~F.col("_blank") & (F.col("_part") == 0))
    spellings = (rows.groupBy("_id", F.col(f"`{key}`").alias("other"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(_position()).alias("_at")))
    kept = (spellings.groupBy("_id")
            .agg(F.min_by("other", "_at").alias("kept"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1))
    return (attach_by_key(spellings, kept, ["_id"], weight="_n")
            .where(F.col("other") != F.col("kept")).select("kept", "other", "n"))


def contributors(stacked: DataFrame, key: str) -> DataFrame:
    """The sources behind each key, in rank order."""
    rows = identify(stacked, key).where(~F.col("_blank"))
    return (rows.groupBy("_id")
            .agg(F.min_by(F.col(f"`{key}`"), _position()).alias("key"),
                 F.array_sort(F.collect_set(F.struct("_rank", "_file"))).alias("_by"))
            .select("key", F.transform("_by", lambda s: s["_file"]).alias("sources")))


def merge_stats(stacked: DataFrame, key: str) -> DataFrame:
    """Rows in and out, columns, blank keys and conflicts as one row."""
    rows = identify(stacked, key)
    whole = F.col("_part") == 0
    totals = rows.agg(F.count_if(whole).alias("rows_in"),
                      F.countDistinct("_id").alias("rows_out"),
                      F.count_if(F.col("_blank") & whole).alias("blank_keys"))
    lost = merge_conflicts(stacked, key).agg(F.count(F.lit(1)).alias("n"))
    return totals.select("rows_in", "rows_out", "blank_keys",
                         F.lit(len(data_columns(stacked))).cast("bigint").alias("columns"),
                         lost.scalar().alias("conflicts"))


# Headers come as rows (_rank, _file, position, header).

def union_columns(headers: DataFrame) -> DataFrame:
    """Every header once, in first-seen order."""
    named = headers.where(~is_blank("header"))
    return (named.groupBy("header")
            .agg(F.min(F.struct("_rank", "position")).alias("_at"))
            .select("header", F.col("_at._rank").alias("first_rank"),
                    F.col("_at.position").alias("first_position"))
            .orderBy("first_rank", "first_position"))


def near_miss_columns(headers: DataFrame) -> DataFrame:
    """Headers that differ from the first spelling only in case or spacing."""
    named = headers.where(~is_blank("header")).withColumn("_norm", norm_key(squeeze("header")))
    spellings = (named.groupBy("_norm", "header", "_rank", "_file")
                 .agg(F.min("position").alias("position")))
    first = (spellings.groupBy("_norm")
             .agg(F.min_by(F.struct("header", "_file"), F.struct("_rank", "position")).alias("first"),
                  F.min("header").alias("_low"), F.max("header").alias("_high"),
                  F.count(F.lit(1)).alias("_n"))
             .where(F.col("_low") != F.col("_high")).drop("_low", "_high"))
    return (attach_by_key(spellings, first, ["_norm"], weight="_n")
            .where(F.col("header") != F.col("first.header"))
            .select(F.col("first.header").alias("first_header"), F.col("first._file").alias("first_file"),
                    "header", F.col("_file").alias("file")))
