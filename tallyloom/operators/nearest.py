"""The closest word of a large table for each of many values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import SUGGESTION_RATIO, edit_similarity
from ..session import cut_lineage


def nearest_words(values: DataFrame, words: DataFrame, cutoff: float = SUGGESTION_RATIO) -> DataFrame:
    """``value, near``: for each value the word of highest edit similarity, if that is ``cutoff`` or more; of equal ones
    the first by name. Values without such a word have no row.

    ``values`` and ``words`` have one text column each; repeats and NULL do not count. Rounds look for all words at most 1, 2,
    4, 8 ... edits away. A word cut into one piece more than there are edits keeps a piece whole, so a value meets it by
    an equal piece near the same place. A value leaves when no word further away can be as close, so only the few
    values that resemble nothing reach the rounds of short pieces. Exact: nothing is capped or sampled.
    """
    left = values.select(F.col(values.columns[0]).alias("value")).where("value IS NOT NULL").distinct()
    known = words.select(F.col(words.columns[0]).alias("near")).where("near IS NOT NULL").distinct()
    done, edits = [], 1
    slack = round(1 - cutoff, 9)
    left = cut_lineage(left)
    while not left.isEmpty():
        met = _value_pieces(left, edits, slack).join(_word_pieces(known, edits, slack), ["m", "i", "piece"])
        close = met.where(F.levenshtein("value", "near", edits) >= 0).select("value", "near", edit_similarity("value", "near").alias("s"))
        best = (close.where(F.col("s") >= cutoff).groupBy("value").agg(F.min(F.struct((-F.col("s")).alias("cost"), "near")).alias("best"))
                .select("value", "best.near", (1 + F.col("best.cost")).alias("far")))
        # What a later round could find costs at least this much.
        beyond = (edits + 1) / (F.length("value") + edits + 1)
        met_all = cut_lineage(left.join(best, "value", "left").select(
            "value", "near", ((beyond > slack + 1e-9) | F.coalesce(F.col("far") + 1e-9 < beyond, F.lit(False))).alias("settled")))
        done.append(met_all.where("settled AND near IS NOT NULL").select("value", "near"))
        left = met_all.where("NOT settled").select("value")
        edits *= 2
    if not done:
        return left.select("value", F.col("value").alias("near"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _most_edits(m: Column, edits: int, slack: float) -> Column:
    """Edits that a pair within the cutoff can have when the word has ``m`` letters: at most slack * (m + edits)."""
    return F.least(F.lit(edits), F.floor(m * (slack / (1 - slack)) + 1e-9).cast("int"))


def _piece(m: Column, e: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of piece ``i`` of ``e`` + 1 even pieces of ``m`` letters; the last ones are longer."""
    base = F.floor(m / (e + 1)).cast("int")
    short = e + 1 - m % (e + 1)
    return i * base + F.greatest(i - short, F.lit(0)), base + (i >= short).cast("int")


def _word_pieces(known: DataFrame, edits: int, slack: float) -> DataFrame:
    sized = known.where(F.length("near") > 0).withColumn("m", F.length("near"))
    cut = sized.withColumn("e", _most_edits(F.col("m"), edits, slack)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("e"))))
    start, length = _piece(F.col("m"), F.col("e"), F.col("i"))
    return cut.select("near", "m", "i", F.substring("near", start + 1, length).alias("piece"))


def _value_pieces(left: DataFrame, edits: int, slack: float) -> DataFrame:
    """Pieces of a value where a word of ``m`` letters could have them: shifted by no more than the edits allow."""
    n, m, e = F.length("value"), F.col("m"), F.col("e")
    lengths = F.sequence(F.greatest(n - edits, F.lit(1)), n + edits)
    cut = (left.where(n > 0).withColumn("m", F.explode(lengths)).withColumn("e", _most_edits(m, edits, slack))
           .where(F.abs(n - m) <= e).withColumn("i", F.explode(F.sequence(F.lit(0), e))))
    start, length = _piece(m, e, F.col("i"))
    low = F.greatest(start - F.floor((e - (n - m)) / 2).cast("int"), F.lit(0))
    high = F.least(start + F.floor((e + (n - m)) / 2).cast("int"), n - length)
    placed = cut.withColumn("low", low).withColumn("high", high).withColumn("length", length).where("low <= high")
    return placed.select("value", "m", "i", "length", F.explode(F.sequence("low", "high")).alias("at")).select(
        "value", "m", "i", F.substring("value", F.col("at") + 1, F.col("length")).alias("piece")).distinct()
