"""How alike two words are."""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Thresholds for "possibly the same" and "did you mean".
SAME_VALUE_RATIO = 0.86
SUGGESTION_RATIO = 0.6
MAX_LENGTH_GAP = 6


def match_ratio(a, b) -> Column:
    """Share of matching characters, 0 to 1 (longest matching blocks)."""
    @F.pandas_udf("double")
    def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None
                          else difflib.SequenceMatcher(None, x, y).ratio()
                          for x, y in zip(left, right)], dtype="float64")

    return ratio(col(a), col(b))


def edit_similarity(a, b) -> Column:
    """1 minus edit distance over the longer length. Stays in the JVM."""
    a, b = col(a), col(b)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer > 0, 1 - F.levenshtein(a, b) / longer).otherwise(F.lit(1.0))


def closest_by_ratio(c, options: Sequence[str], cutoff: float = SUGGESTION_RATIO) -> Column:
    """The best match among a fixed list of words, or NULL."""
    words = [str(o) for o in options]

    @F.pandas_udf("string")
    def closest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            found = {}
            for v in values.dropna().unique():
                hit = difflib.get_close_matches(v, words, n=1, cutoff=cutoff)
                found[v] = hit[0] if hit else None
            yield values.map(found).astype(object).where(values.notna(), None)

    return closest(col(c))


def closest_by_edits(c, options: Sequence[str], cutoff: float = SUGGESTION_RATIO) -> Column:
    """As above with edit similarity: the best, then the first by name."""
    return closest_word(col(c), F.array(*[F.lit(str(o)) for o in sorted(set(options))]), cutoff)


def closest_word(c: Column, words: Column, cutoff: float = SUGGESTION_RATIO) -> Column:
    """As above, among the words of an array column."""
    scored = F.transform(words, lambda w: F.struct((-edit_similarity(c, w)).alias("score"),
                                                   w.alias("word")))
    best = F.array_min(scored)
    return F.when(-best["score"] >= cutoff, best["word"])
