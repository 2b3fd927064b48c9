"""Mixing sources to target word counts by Pareto order sampling.

A source's target is its share of the mix, no more than ``cap`` times its own
size. A document's expected number of copies is ``min(cap, c * weight)`` with
``c`` set so that the source's words come to its target. The whole part of that
is certain; the rest is an inclusion probability p. Documents are ranked by
(u / (1 - u)) / (p / (1 - p)), where u is a random number taken from the MD5 of
id and text, and the first ones are taken until the words still missing are
there. The document in which that falls is taken if more than half of it fits,
so a source is off by half a document at most.

No source is ever sorted whole: ranks are cut into ``bins`` of q / (1 + q), the
words per bin are summed, and only the bin in which the target falls is ordered.

Null text has size 0 and gets nothing; null source is a source, the last one.
Rows that repeat are documents of their own; among equal ranks text and id decide,
and equal rows are interchangeable. Other columns pass through; columns named like
outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def length_weight(size: str = "size") -> Column:
    """How eagerly a document is repeated: fragments and very long documents half as much."""
    return F.when(F.col(size).between(64, 4096), 1.0).otherwise(0.5)


def source_targets(sources: DataFrame, share: float, cap: float, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``source, source_size`` (one row per source) with ``target``.

    Sorted by size over weight, the capped sources are a prefix; each row tests
    whether the level that is left for the rest stays under its own cap. One row
    per source and a few numbers: the list of sources is taken to fit one task."""
    code_points = W.orderBy(F.col("source").asc_nulls_last())
    fill = W.orderBy("_need", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = (sources.withColumn("_weight", F.element_at(F.lit([float(w) for w in weights]),
                                                         ((F.row_number().over(code_points) - 1) % len(weights) + 1)))
              .withColumn("_need", F.col("source_size") * cap / F.col("_weight"))
              .withColumn("_all", F.sum("source_size").over(everything) * share)
              .withColumn("_w", F.sum("_weight").over(everything))
              .withColumn("_capped", F.coalesce(F.sum(F.col("source_size") * cap).over(fill), F.lit(0.0)))
              .withColumn("_before", F.coalesce(F.sum("_weight").over(fill), F.lit(0.0)))
              .withColumn("_level", (F.col("_all") - F.col("_capped")) / (F.col("_w") - F.col("_before"))))
    level = F.min(F.when(F.col("_level") <= F.col("_need"), F.struct("_need", "_level"))).over(everything)["_level"]
    return (ranked.withColumn("_found", level)
            .withColumn("target", F.least(F.col("source_size") * float(cap),
                                          F.coalesce(F.col("_found") * F.col("_weight"),
                                                     F.col("source_size") * float(cap))))
            .select("source", "source_size", "target"))


def copies_per_level(levels: DataFrame, cap: float) -> DataFrame:
    """Expected copies for each ``source, weight`` with its ``words`` and ``target``: the same filling inside a source."""
    heavy = W.partitionBy("source").orderBy(F.desc("weight")).rowsBetween(W.unboundedPreceding, -1)
    source = W.partitionBy("source")
    out = (levels.withColumn("_capped", F.coalesce(F.sum(F.col("words") * cap).over(heavy), F.lit(0.0)))
           .withColumn("_mass", F.sum(F.col("words") * F.col("weight")).over(source))
           .withColumn("_gone", F.coalesce(F.sum(F.col("words") * F.col("weight")).over(heavy), F.lit(0.0)))
           .withColumn("_c", F.try_divide(F.col("target") - F.col("_capped"), F.col("_mass") - F.col("_gone"))))
    # The heaviest level that stays under the cap sets c; nothing does when all are capped.
    c = F.max(F.when(F.col("_c") * F.col("weight") <= cap, F.struct("weight", "_c"))).over(source)["_c"]
    copies = F.least(F.lit(float(cap)), F.coalesce(c * F.col("weight"), F.lit(float(cap))))
    # Within rounding of a whole number: that number.
    whole = F.when(F.abs(copies - F.round(copies)) < 1e-9, F.round(copies)).otherwise(copies)
    out = out.withColumn("copies", whole).withColumn("whole", F.floor("copies"))
    return out.select("source", "weight", "words", "source_size", "target", "whole", (F.col("copies") - F.col("whole")).alias("p"))


def uniform(doc_id: str, text: str, seed: str) -> Column:
    """A random number inside (0, 1) that follows from the row alone."""
    row = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                      F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    number = F.conv(F.substring(F.md5(row.cast("binary")), 1, 12), 16, 10).cast("double")
    return (number + 0.5) / float(1 << 48)


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[int] = WEIGHTS,
        weight: Column | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = "mix", bins: int = 4096) -> DataFrame:
    """Every row of ``docs`` with ``size, source_size, target, copies``.

    ``weight`` may use ``size``; it should take few values, as words are summed
    per source and value. Three small aggregates decide; then each row tells its
    copies from the plan of its source, and only rows of the deciding bin move."""
    weight = weight if weight is not None else length_weight()
    rows = (docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].alias("id"),
                        docs[source].alias("source"), n_words(text).alias("size"), uniform(doc_id, text, seed).alias("u"))
            .withColumn("weight", weight))
    facts = staged(rows.drop("row", "id"), "mix-rows")
    per_level = staged(facts.groupBy("source", "weight").agg(F.sum("size").alias("words")), "mix-levels")
    targets = source_targets(per_level.groupBy("source").agg(F.sum("words").alias("source_size")), share, cap, weights)
    plan = staged(copies_per_level(_with(per_level, targets, "source"), cap), "mix-plan")
    sums = (_ranked(facts, plan, bins).where("bin is not null")
            .groupBy("source", "bin").agg(F.sum("size").alias("words")))
    before = F.sum("words").over(W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
    missing = plan.groupBy("source").agg(F.first("target").alias("_t"), F.sum(F.col("words") * F.col("whole")).alias("_w"))
    edges = staged(_with(sums.withColumn("start", F.coalesce(before, F.lit(0))), missing, "source")
                   .withColumn("missing", F.col("_t") - F.col("_w")).groupBy("source")
                   .agg(F.first("missing").alias("missing"),
                        F.max(F.when(F.col("start") <= F.col("missing"), F.struct("bin", "start"))).alias("edge"))
                   .select("source", "missing", F.col("edge.bin").alias("edge"), F.col("edge.start").alias("start")),
                   "mix-edges")
    known = _with(_ranked(rows, plan, bins), edges, "source", how="left")
    running = F.sum("size").over(W.partitionBy("source").orderBy("q", "u", "id", "size")
                                 .rowsBetween(W.unboundedPreceding, -1))
    half = F.col("start") + F.coalesce(running, F.lit(0)) + F.col("size") / 2
    at_edge = known.where("bin = edge").withColumn("extra", (half <= F.col("missing")).cast("bigint"))
    rest = (known.where("bin is null or edge is null or bin <> edge")
            .withColumn("extra", F.coalesce((F.col("bin") < F.col("edge")).cast("bigint"), F.lit(0))))
    outputs = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
               "copies": F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).cast("bigint")}
    return at_edge.unionByName(rest).select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in outputs],
                                            *[v.alias(k) for k, v in outputs.items()])


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``mix`` takes it, with the columns of the documents."""
    return (mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .drop("_copy", "size", "source_size", "target", "copies"))


def _with(rows: DataFrame, small: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on keys of which null is one. ``small`` has a row or two per source, and Spark's
    size threshold decides on a broadcast."""
    met = rows.alias("l").join(small.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], how)
    return met.select("l.*", *[f"r.{c}" for c in small.columns if c not in keys])


def _ranked(rows: DataFrame, plan: DataFrame, bins: int) -> DataFrame:
    """Rows with their plan, the Pareto rank ``q`` and its bin (none where nothing is left to chance)."""
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return (_with(rows, plan.drop("words"), "source", "weight").withColumn("q", F.when(F.col("p") > 0, odds))
            .withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * bins).cast("int")))
