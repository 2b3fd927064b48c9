"""A toxicity classifier that swapping identity terms does not move.

Features are the words of a text and their beginnings, each counted once per
document. The words and beginnings that tell the classes apart are chosen from
counts by grouped aggregation; a logistic regression is fitted on them. Each
labelled document comes with a counterfactual: its identity terms are swapped
for others of the same list, or, where it has none, one is put in. The squared
change of its logit is a penalty, so a term earns no weight from the company it
keeps, and neutral mentions of a group do not raise a score.

What is bounded: the fit uses at most ``per_class`` labelled documents of each
class (those of smallest MD5 of their id) and ``n_features`` features. Scoring
reads every whole text.

Null and empty texts have no features and get the score of the bias. Rows whose
label is null teach nothing; an id labelled twice counts as toxic if any label
says so. Repeated rows are scored alike. Without labels of both classes the
model is the prior, 0.5 without labels at all. Columns but id, text and label
are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
KNOWN_WORDS = 300_000  # per worker; when full, forgotten

IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "catholics", "atheists", "sikhs"),
    ("man", "woman", "girl", "boy"), ("men", "women", "girls", "boys"), ("male", "female", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer"), ("transgender", "cisgender", "trans"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "mexican", "american", "chinese", "indian"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly", "teenage"), ("deaf", "blind", "disabled", "autistic"),
    ("frauen", "männer", "juden", "christen", "muslime", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "juifs", "chrétiens", "musulmans", "étrangers", "réfugiés"),
    ("mujeres", "hombres", "judíos", "cristianos", "musulmanes", "extranjeros", "refugiados"),
)


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def counterfactual(words: set[str], key: str, groups=IDENTITY_TERMS) -> set[str]:
    """The words with every identity term swapped; with one put in where there is none."""
    draw = int(md5(key.encode()).hexdigest()[:8], 16)
    swaps = {w: g[(g.index(w) + 1 + draw % (len(g) - 1)) % len(g)] for g in groups for w in words.intersection(g)}
    if swaps:
        return (words - swaps.keys()) | set(swaps.values())
    group = groups[draw % len(groups)]
    return words | {group[draw // len(groups) % len(group)]}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def logit(self, words: set[str]) -> float:
        found: set[str] = set()
        known = self.known
        for word in words:
            own = known.get(word)
            if own is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                own = known[word] = tuple(f for f in features(word) if f in self.weights)
            if own:
                found.update(own)
        return self.bias + math.fsum(self.weights[f] for f in found)

    def score(self, text: str | None) -> float:
        z = self.logit(set(words_of(text)))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int, doc_id: str, text: str, label: str) -> DataFrame:
    """``id, text, toxic`` of the documents to learn from, at most ``per_class`` of each class."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("toxic"))
    order = F.md5(F.col("id").cast("string").cast("binary"))
    chosen = [known.where(F.col("toxic") == c).orderBy(order, "id").limit(per_class) for c in (0, 1)]
    chosen = staged(chosen[0].unionByName(chosen[1]), "labelled-ids")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return staged(rows.join(F.broadcast(chosen), "id"), "labelled")  # at most 2 * per_class pairs of numbers


def choose(rows: DataFrame, n_features: int, least: int, least_z: float) -> list[str]:
    """The features in at least ``least`` documents whose share of documents differs most between the
    classes, and by ``least_z`` standard errors, which chance does not reach among all words there are."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                               *[pa.array([v[c] for v in seen.values()], pa.int64()) for c in (0, 1)]],
                                              ["feature", "clean", "toxic"])
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for f in {f for w in set(words_of(text)) for f in features(w)}:
                    seen.setdefault(f, [0, 0])[toxic] += 1
                if len(seen) > 1_000_000:
                    yield out()
                    seen.clear()
        yield out()

    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return []
    total = (rows.repartition("id").mapInArrow(counts, "feature string, clean bigint, toxic bigint")
             .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .where(F.col("clean") + F.col("toxic") >= least))
    p, q = F.col("toxic") / n[1], F.col("clean") / n[0]
    both = (F.col("toxic") + F.col("clean")) / (n[0] + n[1])
    z = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]) + 1e-12)
    return [r.feature for r in total.where(z >= least_z).orderBy(z.desc(), "feature").limit(n_features).collect()]


def _incidence(rows: DataFrame, chosen: list[str]) -> tuple[np.ndarray, ...]:
    """Labels, and the chosen features of each document and of its counterfactual. Bounded by the sample."""
    shared = rows.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(chosen)})

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        find = lambda words: sorted({number[f] for w in words for f in features(w) if f in number})
        for batch in batches:
            words = [set(words_of(t)) for t in batch.column("text").to_pylist()]
            keys = [str(i) for i in batch.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), pa.array([find(w) for w in words], pa.list_(pa.int32())),
                 pa.array([find(counterfactual(w, k)) for w, k in zip(words, keys, strict=True)], pa.list_(pa.int32()))],
                ["id", "toxic", "own", "swapped"])

    found = (rows.select("id", F.col("toxic").cast("int").alias("toxic"), "text").repartition("id")
             .mapInArrow(sets, "id bigint, toxic int, own array<int>, swapped array<int>")).toArrow().sort_by("id")
    flat = []
    for name in ("own", "swapped"):
        column = found.column(name).combine_chunks()
        lengths = np.asarray(column.value_lengths().fill_null(0)) if len(column) else np.zeros(0, int)
        flat += [np.repeat(np.arange(len(lengths)), lengths), np.asarray(column.flatten(), dtype=np.int64)]
    return (np.asarray(found.column("toxic"), dtype=float), *flat)


def _fit(y: np.ndarray, row: np.ndarray, col: np.ndarray, row2: np.ndarray, col2: np.ndarray, d: int,
         penalty: float, ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Mean log loss + ridge + penalty * mean squared change of the logit, by accelerated gradient steps."""
    n = len(y)
    w = look = np.zeros(d + 1)
    add = lambda r, v: np.bincount(r, v, n)
    back = lambda c, v: np.bincount(c, v, d)
    # Of a document and its counterfactual only what differs.
    own, swapped = row * d + col, row2 * d + col2
    lost, gained = np.setdiff1d(own, swapped), np.setdiff1d(swapped, own)
    row1, col1, row2, col2 = lost // d, lost % d, gained // d, gained % d
    # Steps that cannot overshoot: the row sums of the curvature bound it.
    moved = np.bincount(row1, minlength=n) + np.bincount(row2, minlength=n)
    curve = (0.25 * back(col, 1.0 + np.bincount(row, minlength=n)[row])
             + 2 * penalty * (back(col1, moved[row1]) + back(col2, moved[row2]))) / n
    step = 1 / np.append(curve + ridge, 0.25 * (1 + len(row) / n))
    for k in range(rounds):
        z = add(row, look[col]) + look[d]
        change = add(row2, look[col2]) - add(row1, look[col1])
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = (back(col, error[row]) + 2 * penalty * (back(col2, change[row2]) - back(col1, change[row1]))) / n
        grad = np.append(grad + ridge * look[:d], error.mean())
        new = look - step * grad
        look = new + k / (k + 3) * (new - w)
        w = new
    return w[:d], float(w[d])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 10_000, n_features: int = 20_000, least: int = 4, least_z: float = 5.0,
        penalty: float = 1.0,
        ridge: float = 1e-4, rounds: int = 300) -> Model:
    """The classifier, from the given labels and at most ``2 * per_class`` documents."""
    share = labels.where(F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double"))).first()[0]
    rows = labelled(docs, labels, per_class, doc_id, text, label)
    chosen = choose(rows, n_features, least, least_z)
    if not chosen:
        prior = 0.5 if share is None else min(max(share, 1e-3), 1 - 1e-3)
        return Model({}, math.log(prior / (1 - prior)))
    y, row, col, row2, col2 = _incidence(rows, chosen)
    weights, bias = _fit(y, row, col, row2, col2, len(chosen), penalty, ridge, rounds)
    # The sample has its own share of toxic documents; the bias goes back to that of the labels.
    bias += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    return Model({f: float(w) for f, w in zip(chosen, weights, strict=True) if abs(w) > 1e-6}, bias)


def with_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row with its ``score`` (a column of that name is replaced); nothing is shuffled."""
    rows = docs.drop("score")
    shared = rows.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    schema = rows.withColumn("score", F.lit(0.0)).schema

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            found = [model.score(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             [*batch.schema.names, "score"])

    return rows.mapInArrow(scores, schema)


def teachable(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels that may be learned from: not those held out."""
    return labels.where(~held_out(doc_id))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
