"""Language of pages and documents by Bayesian fusion of evidence.

* Text: a naive Bayes model over letter trigrams, whose counts per language come
  from labelled texts by grouped aggregation. Neighbouring trigrams are not
  independent, so the evidence of a long text levels off.
* Declared language of the markup, and the suffix of the address: how often each
  value goes with each language is counted over all rows, weighed with what the
  texts alone say, so a site generator that declares ``en`` everywhere counts for little.
* Host prior: the shares of the languages among a host's other pages, smoothed
  towards its domain, which is smoothed towards all.

The product of these is normalised to a posterior. Everything counted is a sum
per host, domain, suffix or declared value, reduced before it moves; hot hosts
are one row each in a join whose other side Spark may split.

Null or empty texts say nothing: their language is that of the other evidence.
Missing markup is a value like others, a null host has no share of its own and
the domain prior is used. Repeated rows count as often as they stand. Without
labelled texts every language column is null. Columns but those named are not
looked at; the given id columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces

BINS = 1 << 14
LEVEL_OFF = 300  # trigrams after which more text adds little
CORRELATION = 4.0  # neighbouring trigrams share letters
STRENGTH = 20.0  # pages that the prior of the next higher level weighs

LETTERS = np.zeros(256, np.uint32)
LETTERS[list(range(97, 123)) + list(range(128, 256))] = list(range(97, 123)) + list(range(128, 256))
LETTERS[65:91] = np.arange(97, 123)


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of the trigram that begins at each byte of a buffer of texts, and whether it ends in the same text."""
    part = LETTERS[data[bounds[0]:bounds[-1]]]
    if len(part) < 3:
        return np.zeros(len(part), np.int64), np.zeros(len(part), bool)
    value = np.zeros(len(part), np.uint32)
    value[:-2] = part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]
    inside = np.zeros(len(part), bool)
    inside[:-2] = (part[1:-1] > 0) & ((part[:-2] > 0) | (part[2:] > 0))
    ends = bounds[1:] - bounds[0]
    for back in (1, 2):
        at = ends - back
        inside[at[at >= 0]] = False
    return (value * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64), inside


def train(texts: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and the log probability of each trigram bin under each: bounded by languages times BINS."""
    langs = [r[0] for r in texts.where(F.col(lang).isNotNull()).groupBy(lang).count().orderBy(lang).select(lang).collect()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: k for k, name in enumerate(langs)}
        total = np.zeros(len(langs) * BINS, np.int64)
        for rows, data, bounds in pieces(batches, "text"):
            bins, inside = trigrams(data, bounds)
            of = np.array([place.get(x, -1) for x in rows.column("lang").to_pylist()])
            of = np.repeat(of, np.diff(bounds))
            inside &= of >= 0
            total += np.bincount(of[inside] * BINS + bins[inside], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    if not langs:
        return [], np.zeros((BINS, 0), np.float32)
    counted = (texts.select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInArrow(count, "cell bigint, n bigint")
               .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    table = np.full(len(langs) * BINS, 0.5)
    for r in counted:
        table[r.cell] += r.n
    table = table.reshape(len(langs), BINS)
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32)


def text_evidence(rows: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """The rows without the text, and ``t0 .. tn``: log likelihood of each language, the best one 0."""
    langs, table = model
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = [f"t{k}" for k in range(len(langs))]
    schema = rows.drop(text).withColumns({n: F.lit(0.0) for n in names}).schema

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for piece, data, bounds in pieces(batches, text):
            bins, inside = trigrams(data, bounds)
            sums = np.zeros((len(bins) + 1, table.shape[1]))
            np.cumsum(table[bins] * inside[:, None], axis=0, dtype=np.float64, out=sums[1:])
            n = np.concatenate([np.zeros(1, np.int64), np.cumsum(inside)])
            at = bounds - bounds[0]
            total, length = np.diff(sums[at], axis=0), np.diff(n[at])
            weight = 1 / (CORRELATION * (1 + length / LEVEL_OFF))
            logs = total * weight[:, None]
            logs -= logs.max(axis=1, keepdims=True)
            kept = [c for c in piece.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in kept], *[pa.array(logs[:, k]) for k in range(len(names))]],
                                             [*kept, *names])

    return rows.mapInArrow(weigh, schema)


def _shares(logs: Sequence[Column]) -> list[Column]:
    """Normalised exponentials."""
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - top) for x in logs]
    total = sum(parts)
    return [p / total for p in parts]


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], ids: Sequence[str], text: str = "text",
             declared: str | None = None, suffix: str | None = None, host: str | None = None,
             domain: str | None = None) -> DataFrame:
    """``ids``, ``text_lang`` (by the text alone), ``lang`` and its posterior ``confidence``."""
    langs = model[0]
    if not langs:
        none = F.lit(None).cast("string")
        return rows.select(*ids, none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("confidence"))
    size = len(langs)
    evidence = {"declared": declared, "suffix": suffix, "host": host, "domain": domain}
    wanted = rows.select(*ids, F.col(text).alias("text"), *[F.col(c).alias(f"e_{k}") for k, c in evidence.items() if c])
    weighed = text_evidence(wanted, model)
    t = [F.col(f"t{k}") for k in range(size)]
    weighed = weighed.withColumns({f"g{k}": g for k, g in enumerate(_shares(t))})
    sums = lambda prefix: [F.sum(f"g{k}").alias(f"{prefix}{k}") for k in range(size)]
    joined, scores = weighed, list(t)
    total = weighed.agg(*sums("a")).first()
    overall = [((total[k] or 0.0) + 1) / (sum(x or 0.0 for x in total) + size) for k in range(size)]

    for k_, key in (("d", "declared"), ("s", "suffix")):
        if not evidence[key]:
            continue
        table = weighed.groupBy(F.coalesce(f"e_{key}", F.lit("")).alias(f"k_{key}")).agg(*sums(k_))
        joined = joined.join(table, F.coalesce(f"e_{key}", F.lit("")) == F.col(f"k_{key}"))
        # Share of the value among a language's rows, without this row, smoothed towards the value's overall share.
        own = sum(F.col(f"{k_}{k}") for k in range(size))
        everything = sum(x or 0.0 for x in total)
        for k in range(size):
            count = F.col(f"{k_}{k}") - F.col(f"g{k}")
            scores[k] = scores[k] + F.log((count + STRENGTH * own / max(everything, 1.0)) / ((total[k] or 0.0) + STRENGTH))
    prior = [F.lit(p) for p in overall]
    for k_, key in (("m", "domain"), ("h", "host")):
        if not evidence[key]:
            continue
        table = weighed.where(F.col(f"e_{key}").isNotNull()).groupBy(F.col(f"e_{key}").alias(f"k_{key}")).agg(*sums(k_))
        joined = joined.join(table, F.col(f"e_{key}") == F.col(f"k_{key}"), "left")
        others = [F.coalesce(F.col(f"{k_}{k}") - F.col(f"g{k}"), F.lit(0.0)) for k in range(size)]
        n = sum(others)
        prior = [(o + STRENGTH * p) / (n + STRENGTH) for o, p in zip(others, prior, strict=True)]
    scores = [s + F.log(F.greatest(p, F.lit(1e-12))) for s, p in zip(scores, prior, strict=True)]
    named = joined.select(*ids, *[f"t{k}" for k in range(size)], *[s.alias(f"s{k}") for k, s in enumerate(scores)])
    best = lambda prefix: F.greatest(*[F.struct(F.col(f"{prefix}{k}").alias("v"), F.lit(-k).alias("k")) for k in range(size)])
    name = lambda b: F.element_at(F.lit(langs), 1 - b["k"])
    if size == 1:
        return named.select(*ids, F.lit(langs[0]).alias("text_lang"), F.lit(langs[0]).alias("lang"), F.lit(1.0).alias("confidence"))
    shares = _shares([F.col(f"s{k}") for k in range(size)])
    return (named.withColumn("_t", best("t")).withColumn("_s", best("s"))
            .select(*ids, F.when(sum(F.abs(F.col(f"t{k}")) for k in range(size)) > 0, name(F.col("_t"))).alias("text_lang"),
                    name(F.col("_s")).alias("lang"), F.greatest(*shares).alias("confidence")))


# --- what pages give ---------------------------------------------------------------------------------------------

MARKUP = r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[#\w]+;"


def page_evidence(pages: DataFrame, langs: Sequence[str]) -> DataFrame:
    """``page_id, text, declared, suffix, host, domain`` of raw pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    code = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    host = F.when(host != "", host)
    labels = F.split(host, r"\.")
    return pages.select("page_id", F.regexp_replace("html", MARKUP, " ").alias("text"),
                        F.when(code.isin(list(langs)), code).when(code != "", F.lit("other")).otherwise("none").alias("declared"),
                        F.coalesce(F.element_at(labels, -1), F.lit("none")).alias("suffix"), host.alias("host"),
                        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"))
