"""One-permutation MinHash fingerprints, with column functions only.

The 5-word shingles of a text are hashed once (a text of fewer words, but not
none, is one shingle). The top bits of a hash are its bin; a bin keeps its
smallest hash. An empty bin borrows from a bin drawn for it at random, again and
again until one that is not empty comes up (optimal densification); the draws of
bin ``b`` are ``a(b) + t * s(b)`` modulo the number of bins with an odd step, so
every bin comes up in the end and the first one that is not empty is the one of
smallest ``t``, which takes no loop. Of each bin's hash the low four bits are
kept, 16 bins to a 64-bit number. Two different hashes agree in those bits once
in 16 times, and the likeness is corrected for that.

Null and empty texts, and texts of white space only, have no shingle: their
fingerprint is ``''`` and its words are null. Two such are alike (1), such and
any other are not (0). Ids may repeat or be null; columns but id and text are
not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import M64, staged

BINS = 128
BIN_BITS = 7
BITS = 4
PER_WORD = 16
SHINGLE = 5


def shingle_hashes(text: Column) -> Column:
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(words: Column) -> Column:
        n = F.size(words)
        return (F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1))),
                                                 lambda i: F.xxhash64(F.slice(words, i, SHINGLE))))
                .when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>")))

    return _let(words, of)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")


def _draws() -> tuple[list[int], list[int]]:
    """For each bin its first draw, and the inverse of its odd step."""
    first, inverse = [], []
    for b in range(BINS):
        x = (b + 1) * 0x9E3779B97F4A7C15 & M64
        x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & M64
        first.append(x >> 40 & BINS - 1)
        inverse.append(pow((x >> 20 & BINS - 1) | 1, -1, BINS))
    return first, inverse


FIRST, INVERSE = _draws()


def nibbles(hashes: Column) -> Column:
    """The low bits of every bin after densification; null without hashes."""
    def smallest(ordered: Column) -> Column:
        # The first of each bin is its smallest: two neighbours are of one bin if their top bits agree.
        before = lambda i: F.coalesce(F.get(ordered, i - 1), F.bitwise_not(F.get(ordered, i)))
        return F.filter(ordered, lambda h, i: F.shiftrightunsigned(h.bitwiseXOR(before(i)), 64 - BIN_BITS) != 0)

    def filled(kept: Column) -> Column:
        def of(bins: Column) -> Column:
            low = F.transform(kept, lambda h: h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("bigint"))

            def dense(low: Column) -> Column:
                def value(b: Column) -> Column:
                    own = F.array_position(bins, b)
                    first, inverse = F.get(F.lit(FIRST), b), F.get(F.lit(INVERSE), b)
                    # Draw number of each bin that has a hash, with its place: the smallest decides.
                    draws = F.transform(bins, lambda c, i: F.pmod((c - first) * inverse, F.lit(BINS)) * BINS + i)
                    lent = F.array_min(draws) % BINS
                    return F.get(low, F.when(own > 0, own.cast("int") - 1).otherwise(lent))
                return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)
            return _let(low, dense)
        return _let(F.transform(kept, _bin), of)

    return _let(_let(F.sort_array(hashes), smallest), lambda kept: F.when(F.size(kept) > 0, filled(kept)))


def packed(values: Column) -> Column:
    """16 bins of 4 bits to each of 8 numbers."""
    def word(values: Column, k: int) -> Column:
        parts = [F.shiftleft(F.get(values, F.lit(PER_WORD * k + j)), BITS * (PER_WORD - 1 - j)) for j in range(PER_WORD)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)
    return _let(values, lambda v: F.when(v.isNotNull(), F.array(*[word(v, k) for k in range(BINS // PER_WORD)])))


def fingerprint(text: Column) -> Column:
    return packed(nibbles(shingle_hashes(F.coalesce(text, F.lit("")))))


def as_text(words: Column) -> Column:
    digits = F.transform(words, lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.coalesce(F.array_join(digits, ""), F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, corrected for chance agreement of the kept bits."""
    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x1111111111111111))
        return F.bit_count(d)
    agree = 1 - sum(differing(F.get(a, F.lit(k)), F.get(b, F.lit(k))) for k in range(BINS // PER_WORD)) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return (F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))))


def id_ranges(docs: DataFrame, doc_id: str, rows_per_range: int, most: int) -> Column:
    """The number of the id range of a row, falling in its id. Ranges hold about equally many rows:
    512 quantiles at most, each divided evenly by value."""
    stats = docs.agg(F.count(F.lit(1)).alias("n"),
                     F.percentile_approx(doc_id, [k / 512 for k in range(513)], 10_000).alias("q")).first()
    bounds = sorted(set(stats.q or [0]))
    wanted = max(1, min(most, stats.n // rows_per_range))
    inner = max(1, round(wanted / max(1, len(bounds) - 1)))
    if inner == 1:  # fewer ranges than quantiles
        bounds = bounds[::max(1, (len(bounds) - 1) // wanted)]
    x = F.col(doc_id)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            if lo + 1 >= len(bounds):
                return F.lit(lo * inner)
            width = max(1, -(-(bounds[lo + 1] - bounds[lo]) // inner))
            step = F.floor((x - F.lit(bounds[lo])) / F.lit(width))
            return F.lit(lo * inner) + F.greatest(F.lit(0), F.least(F.lit(inner - 1), step)).cast("int")
        mid = (lo + hi + 1) // 2
        return F.when(x < bounds[mid], tree(lo, mid - 1)).otherwise(tree(mid, hi))

    return -F.coalesce(tree(0, len(bounds) - 1), F.lit(-1))  # null ids come last


def with_next(docs: DataFrame, doc_id: str = "doc_id", carry: tuple[str, ...] = ("text",), rows_per_range: int = 4096,
              most_ranges: int = 65_536) -> DataFrame:
    """``doc_id``, the ``carry`` columns, and those of the next row in descending id order (after the
    last: of the first) as ``next_...``. Among equal ids the first carried column decides.

    Rows go to id ranges in one shuffle. The next row of a range's last one is the first of the next
    range: that one is sent to both, known from the largest id of each range (a small table, at most
    ``most_ranges`` rows)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry).withColumn("range", id_ranges(docs, doc_id, rows_per_range, most_ranges))
    tops = staged(rows.groupBy("range").agg(F.max("doc_id").alias("top")), "ranges")
    order = W.orderBy("range")
    # Where the first rows of a range are needed again; the first range's, at the end of the last.
    again = tops.select(F.col("range").alias("range_"), F.col("top"),
                        F.coalesce(F.lag("range").over(order), F.max("range").over(W.rowsBetween(
                            W.unboundedPreceding, W.unboundedFollowing))).alias("to"),
                        F.lag("range").over(order).isNull().alias("wrap"))
    met = rows.join(F.broadcast(again), (rows["range"] == again["range_"]) & rows["doc_id"].eqNullSafe(again["top"]), "left")
    places = F.when(F.col("to").isNull(), F.array(F.struct("range", F.lit(0).alias("lent")))).otherwise(
        F.array(F.struct("range", F.lit(0).alias("lent")),
                F.struct(F.col("to").alias("range"), F.when(F.col("wrap"), 2).otherwise(1).alias("lent"))))
    dealt = met.withColumn("place", F.explode(places)).select("doc_id", *carry, "place.*")
    inside = W.partitionBy("range").orderBy(F.col("lent") == 2, F.desc_nulls_last("doc_id"), *carry[:1])
    return (dealt.select("*", *[F.lead(c).over(inside).alias(f"next_{c}") for c in carry])
            .where("lent = 0").drop("range", "lent"))


def edited(text: Column, donor: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by as many first ones of ``donor``, or all it has."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(donor, F.lit(1), half))
