"""Quotation linking: who answers whom, told by what is quoted, with column functions only.

A line that begins with ``>`` signs, with or without blanks between them, is
quoted, as many levels deep as there are signs. Quoted passages are taken line by
line, so a reply that quotes in part still finds its source: each line is
normalised (case, white space) and hashed, and joined with the same line in the
own text of the latest earlier message of the conversation. The message with most
lines among those of the lowest level quoted is the one replied to; among equals
the latest. A message that quotes nothing known replies to the one before it.

A conversation comes out as its messages without quotes, each with the message
it replies to and its place in an order in which every message stands behind
that one.

"Latest earlier" is never sought over a whole conversation or a whole line in one
task: turns are cut into ranges of ``RANGE``, the latest of each range is carried
over to the next ones, and within a range it is a window of its own.

Null text is empty. Empty lines link nothing. Null conversations or turns: such a
message has no neighbours; it replies to none and its place is null. Rows that
repeat conversation and turn are all kept; they link as one message, and their
places are in the order of role and text. Columns but the four named are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RANGE = 512
SIGNS = r"^((?:>[ \t]?)*)"


def _lines(text: Column) -> Column:
    """``level, line`` of every line."""
    def parsed(line: Column) -> Column:
        signs = F.regexp_extract(line, SIGNS, 1)
        return F.struct((F.length(signs) - F.length(F.replace(signs, F.lit(">"), F.lit("")))).alias("level"),
                        F.substring(line, F.length(signs) + 1, F.length(line)).alias("line"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), parsed)


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def own_text(lines: Column) -> Column:
    """What is not quoted, without the empty lines around it."""
    own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["line"])
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def latest_before(rows: DataFrame, keys: Sequence[str], value: str = "source") -> DataFrame:
    """``rows`` (keys, turn, ``value`` or null) with ``latest``: the largest value at an earlier turn of the same keys."""
    keys = list(keys)
    ranged = rows.withColumn("_range", F.floor(F.col("turn") / RANGE))
    tops = ranged.groupBy(*keys, "_range").agg(F.max(value).alias("_top"))
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = tops.select(*keys, "_range", F.max("_top").over(before).alias("_carried"))
    inside = W.partitionBy(*keys, "_range").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    return (ranged.withColumn("_near", F.max(value).over(inside)).join(carried, [*keys, "_range"])
            .withColumn("latest", F.coalesce("_near", "_carried")).drop("_range", "_near", "_carried"))


def quoted_lines(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, level, latest``: every quoted line that an earlier message of the conversation says itself."""
    lines = (messages.where("conv_id is not null and turn is not null")
             .select("conv_id", "turn", F.explode(_lines(F.col("text"))).alias("l")).select("conv_id", "turn", "l.*")
             .withColumn("line", normalised(F.col("line"))).where("line <> ''")
             .select("conv_id", "turn", "level", F.xxhash64("line").alias("line")))
    said = lines.where("level = 0").select("conv_id", "turn", "level", "line", F.col("turn").alias("source")).distinct()
    quoted = lines.where("level > 0").withColumn("source", F.lit(None).cast("bigint"))
    return latest_before(said.unionByName(quoted), ["conv_id", "line"]).where("level > 0").drop("source", "line")


def link(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, reply_to, position, n_quoted, n_linked, text`` of every message."""
    messages = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    found = quoted_lines(messages)
    per_source = (found.groupBy("conv_id", "turn", "level", "latest").agg(F.count(F.lit(1)).alias("n")))
    # Lowest level first, then most lines, then the latest message.
    links = per_source.groupBy("conv_id", "turn").agg(
        F.min(F.when(F.col("latest").isNotNull(), F.struct("level", (-F.col("n")).alias("n"), (-F.col("latest")).alias("source")))).alias("best"),
        F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("latest").isNotNull(), F.col("n"))).alias("n_linked"))
    turns = messages.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("rows"))
    turns = latest_before(turns.withColumn("source", F.col("turn")), ["conv_id"]).drop("source")
    ranged = turns.withColumn("_range", F.floor(F.col("turn") / RANGE))
    sums = ranged.groupBy("conv_id", "_range").agg(F.sum("rows").alias("_n"))
    earlier = W.partitionBy("conv_id").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv_id", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    inside = W.partitionBy("conv_id", "_range").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    placed = (ranged.withColumn("_at", F.coalesce(F.sum("rows").over(inside), F.lit(0))).join(sums, ["conv_id", "_range"])
              .select("conv_id", "turn", F.col("latest").alias("previous"), (F.col("_shift") + F.col("_at")).alias("first")))
    known = placed.join(links, ["conv_id", "turn"], "left")
    same = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    numbered = messages.where("conv_id is not null and turn is not null").withColumn("_k", F.row_number().over(same) - 1)
    zero = F.lit(0).cast("bigint")
    out = numbered.join(known, ["conv_id", "turn"]).select(
        "conv_id", "turn", "role", F.coalesce(-F.col("best.source"), F.col("previous")).alias("reply_to"),
        (F.col("first") + F.col("_k")).alias("position"), F.coalesce("n_quoted", zero).alias("n_quoted"),
        F.coalesce("n_linked", zero).alias("n_linked"), own_text(_lines(F.col("text"))).alias("text"))
    none = F.lit(None).cast("bigint")
    loose = messages.where("conv_id is null or turn is null").select(
        "conv_id", "turn", "role", none.alias("reply_to"), none.alias("position"), zero.alias("n_quoted"), zero.alias("n_linked"),
        own_text(_lines(F.col("text"))).alias("text"))
    return out.unionByName(loose)


def quote(text: Column, signs: str) -> Column:
    """``text`` as it stands in a reply."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit(signs), x)), "\n")


def as_replies(messages: DataFrame) -> DataFrame:
    """Conversations as mail: each message quotes the one it answers, and in that the one before.

    Every third message answers the last but one instead of the last."""
    turn = F.col("turn")
    target = lambda t: t - F.when(t % 3 == 2, 2).otherwise(1)
    said = messages.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    first = said.select("conv_id", F.col("turn").alias("a"), F.col("text").alias("text_a"))
    second = said.select("conv_id", F.col("turn").alias("b"), F.col("text").alias("text_b"))
    met = (messages.withColumn("a", target(turn)).withColumn("b", target(target(turn)))
           .join(first, ["conv_id", "a"], "left").join(second, ["conv_id", "b"], "left"))
    return met.select("conv_id", "turn", "role", F.concat_ws(
        "\n", F.when(F.col("text_a").isNotNull(), quote(F.col("text_b"), "> > ")), quote(F.col("text_a"), "> "),
        F.col("text")).alias("text"))
