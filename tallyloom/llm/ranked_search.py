"""Ranked lexical search in an index stratified by document length.

A document's score for an item sums, over the item's terms, a weight of the term
times an impact, and the impact depends on nothing but the term's frequency in
the document and the document's length normaliser m. So documents of equal m form
a stratum; inside it the postings of a term are kept by frequency, and an impact
is worked out once for each frequency instead of once for each posting.

``build_index`` counts the terms of every document, groups documents by m
(strata with more text than a share of a partition are cut into pieces by a hash,
so a third of the corpus in one stratum is many pieces), and writes each piece as
one row: documents, terms in order, frequencies of each term from the highest
down, and the documents of each. ``search`` takes the items in blocks of bounded
size. A first pass sums document frequencies of the block's terms, a second one
scores: for each piece the highest frequency of each term gives an upper bound
for every item; pieces are visited from the highest bounds down, and an item
passes over a piece whose bound lies below the score of its last kept document.
Bounds, impacts and scores are 64-bit integers, so passing over loses nothing.

The terms of a document are 64-bit hashes of its words; equal hashes are taken
for equal words. Null, empty and term-free texts are in no stratum and counted
nowhere. Documents that repeat an id are documents each; equal scores go by
ascending id, null last. Rows of the items that repeat an id are one item with
the terms of all of them; an item without terms has no rows. Other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PIECE, Words, pieces, short, staged

TERM = Words([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # a run of TERM's bytes
STRETCH = 8 * PIECE  # text of a piece of a stratum, at most on average
BLOCK_TERMS = 500_000  # (item, term) rows that go to the index at once, on average

INDEX = ("m bigint, ids array<bigint>, terms binary, levels binary, tf binary, sizes binary, places binary")


def _n_terms(text: str):
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(PATTERN)).cast("bigint")


class Stratum:
    """Postings of the documents of one piece: for each of ``terms`` (in order) ``levels`` frequencies, for each of
    these ``tf`` and ``sizes``, and for all of them in turn the ``places`` of the documents."""

    NAMES = (("terms", np.uint64), ("levels", np.int32), ("tf", np.int32), ("sizes", np.int32), ("places", np.int32))

    def __init__(self, m: int, ids: pa.Array, *lists: np.ndarray):
        self.m, self.ids = m, ids
        self.terms, self.levels, self.tf, self.sizes, self.places = lists

    @classmethod
    def of(cls, m: int, ids: pa.Array, words: np.ndarray, counts: np.ndarray) -> Stratum:
        """From the word hashes of all documents in turn, ``counts`` of them in each."""
        place = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        order = np.argsort(words, kind="stable")
        words, place = words[order], place[order]
        begin = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (place[1:] != place[:-1])))
        tf = np.diff(np.append(begin, len(words))).astype(np.int32)
        words, place = words[begin], place[begin]
        first = np.append(True, words[1:] != words[:-1])
        number = np.cumsum(first) - 1
        order = np.lexsort((place, -tf, number))
        number, tf, place = number[order], tf[order], place[order]
        level = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | (tf[1:] != tf[:-1])))
        return cls(m, ids, words[first], np.bincount(number[level]).astype(np.int32), tf[level],
                   np.diff(np.append(level, len(tf))).astype(np.int32), place)

    def frequencies(self) -> np.ndarray:
        """Documents that hold each term."""
        return np.add.reduceat(self.sizes, np.cumsum(self.levels) - self.levels, dtype=np.int64)

    def impacts(self) -> np.ndarray:
        tf = self.tf.astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 20 * self.m)

    @classmethod
    def of_batch(cls, batch: pa.RecordBatch) -> Iterator[Stratum]:
        columns = [(batch.column(n), t) for n, t in cls.NAMES if n in batch.schema.names]
        ids = batch.column("ids") if "ids" in batch.schema.names else None
        for k, m in enumerate(batch.column("m").to_pylist()):
            lists = [np.frombuffer(c[k].as_buffer(), t) for c, t in columns]
            yield cls(m, ids[k].values if ids is not None else None, *lists, *[None] * (len(cls.NAMES) - len(lists)))


def strata(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int, int]:
    """``n, m, parts`` for each number of terms that documents have; the number of documents that have terms, and of
    their terms. ``parts``: into how many pieces the stratum m is cut."""
    spark = docs.sparkSession
    lengths = staged(docs.select(_n_terms(text).alias("n"), F.octet_length(text).alias("bytes")).where("n > 0")
                     .groupBy("n").agg(F.count(F.lit(1)).alias("docs"), F.sum("bytes").alias("bytes")), "lengths")
    total = lengths.agg(F.sum("docs").alias("docs"), F.sum(F.col("n") * F.col("docs")).alias("terms"), F.sum("bytes").alias("bytes")).first()
    if not total.docs:
        return lengths.select("n", F.lit(0).cast("bigint").alias("m"), F.lit(1).cast("bigint").alias("parts")), 0, 0
    share = max(1, min(STRETCH, total.bytes // (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    m = F.expr(f"50 + (50 * n * {total.docs}L) div {total.terms}L")
    lengths = lengths.withColumn("m", m)
    parts = lengths.groupBy("m").agg((1 + F.floor(F.sum("bytes") / share)).alias("parts"))
    return lengths.select("n", "m").join(parts, "m").select("n", "m", "parts"), total.docs, total.terms


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """The index, written to the shared folder, and the number of documents in it."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    lengths, n_docs, _ = strata(docs)
    rows = (docs.withColumn("n", _n_terms("text")).join(short(staged(lengths, "strata")), "n")
            .withColumn("part", F.pmod(F.xxhash64("id", "text"), "parts"))
            .select("m", "part", "id", "text").repartition("m", "part").sortWithinPartitions("m", "part"))

    def pieces_of_strata(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def written() -> pa.RecordBatch:
            ids, words, counts = zip(*held, strict=True)
            s = Stratum.of(key[0], pa.concat_arrays(ids), np.concatenate(words), np.concatenate(counts))
            return pa.RecordBatch.from_arrays(
                [pa.array([s.m], pa.int64()), pa.ListArray.from_arrays([0, len(s.ids)], s.ids),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (s.terms, s.levels, s.tf, s.sizes, s.places))],
                ["m", "ids", *(n for n, _ in Stratum.NAMES)])

        for rows, data, bounds in pieces(batches, "text"):
            words, firsts = TERM.hashes(data, bounds)
            m, part = (rows.column(c).to_numpy() for c in ("m", "part"))
            new = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (part[1:] != part[:-1])))
            for lo, hi in zip(new.tolist(), [*new[1:].tolist(), rows.num_rows], strict=True):
                if held and (key != (m[lo], part[lo]) or size > 2 * STRETCH):
                    yield written()
                    held, size = [], 0
                key = (m[lo], part[lo])
                held.append((rows.column("id").slice(lo, hi - lo), words[firsts[lo]:firsts[hi]], np.diff(firsts[lo:hi + 1])))
                size += int(bounds[hi] - bounds[lo])
        if held:
            yield written()

    return staged(rows.mapInArrow(pieces_of_strata, INDEX), "strata-index", compression="zstd"), n_docs


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, term``, each pair once."""
    kind = items.schema[item_id].dataType.simpleString()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in pieces(batches, "text"):
            words, firsts = TERM.hashes(data, bounds)
            which = np.repeat(np.arange(rows.num_rows), np.diff(firsts))
            yield pa.RecordBatch.from_arrays([rows.column("item").take(pa.array(which)), pa.array(words.view(np.int64))], ["item", "term"])

    return (items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
            .mapInArrow(terms, f"item {kind}, term bigint").distinct())


class Block:
    """A block of items: their distinct terms in order, and which of these each item has."""

    def __init__(self, items: pa.Array, terms: np.ndarray, which: np.ndarray, first: np.ndarray):
        self.items, self.terms, self.which, self.first = items, terms, which, first

    @classmethod
    def of(cls, pairs: pa.Table) -> Block:
        item = pairs.column("item").combine_chunks().dictionary_encode("encode")
        if isinstance(item, pa.ChunkedArray):
            item = item.combine_chunks()
        terms, which = np.unique(pairs.column("term").to_numpy().view(np.uint64), return_inverse=True)
        owner = item.indices.to_numpy()
        order = np.argsort(owner, kind="stable")
        return cls(item.dictionary, terms, which[order], np.searchsorted(owner[order], np.arange(len(item.dictionary))))

    def parts(self) -> tuple:
        """What workers make it from again."""
        return self.items, self.terms, self.which, self.first

    def own(self, i: int) -> np.ndarray:
        return self.which[self.first[i]:self.first[i + 1] if i + 1 < len(self.first) else None]


def _where(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among ``terms`` (both in order), and where."""
    if len(terms) < len(wanted):
        at, of = _where(wanted, terms)
        return of, at
    at = np.minimum(np.searchsorted(terms, wanted), max(len(terms) - 1, 0))
    hit = np.flatnonzero(terms[at] == wanted) if len(terms) else np.zeros(0, np.int64)
    return hit, at[hit]


def _frequencies(index: DataFrame, block: Block) -> np.ndarray:
    """Documents that hold each of the block's terms."""
    shared = index.sparkSession.sparkContext.broadcast(block.terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = shared.value, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for s in Stratum.of_batch(batch):
                hit, at = _where(s.terms, wanted)
                total[hit] += s.frequencies()[at]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["number", "n"])

    sums = (index.select("m", "terms", "levels", "tf", "sizes").mapInArrow(counted, "number bigint, n bigint")
            .groupBy("number").agg(F.sum("n").alias("n")).toArrow())  # no more rows than the block has terms
    out = np.zeros(len(block.terms), np.int64)
    out[sums.column("number").to_numpy()] = sums.column("n").to_numpy()
    return out


class Best:
    """The ``k`` best documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1  # a document of a lower score than ``least`` cannot come in
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def take(self, score: np.ndarray, ids: pa.Array) -> None:
        found = np.flatnonzero(score >= self.least)
        if len(found) > self.k:
            found = found[score[found] >= np.partition(score[found], -self.k)[-self.k]]
        if not len(found):
            return
        new = ids.take(pa.array(found))
        null = np.asarray(new.is_null())
        every = (np.concatenate([self.score, score[found]]), np.concatenate([self.id, np.asarray(new.fill_null(0))]),
                 np.concatenate([self.null, null]))
        order = np.lexsort((every[1], every[2], -every[0]))[:self.k]
        self.score, self.id, self.null = (x[order] for x in every)
        if len(order) == self.k:
            self.least = int(self.score[-1])


def score_stratum(s: Stratum, block: Block, weights: np.ndarray, hit: np.ndarray, at: np.ndarray, bounds: np.ndarray, best: list[Best]) -> None:
    """Score the documents of ``s`` for each item whose bound can still bring one in."""
    level = np.cumsum(s.levels) - s.levels
    begin = np.cumsum(s.sizes) - s.sizes
    impact = np.repeat(s.impacts(), s.sizes)
    first, size = begin[level].astype(np.int64), s.frequencies()
    here = np.full(len(block.terms), -1)
    here[hit] = at
    for i in np.flatnonzero(bounds >= [b.least for b in best]).tolist():
        own = block.own(i)
        spot = here[own]
        own, spot = own[spot >= 0], spot[spot >= 0]
        n = size[spot]
        posting = np.repeat(first[spot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        part = np.repeat(weights[own], n) * impact[posting]
        if bounds[i] < 1 << 53:  # then sums of doubles are exact
            score = np.bincount(s.places[posting], part, len(s.ids)).astype(np.int64)
        else:
            score = np.zeros(len(s.ids), np.int64)
            np.add.at(score, s.places[posting], part)
        best[i].take(score, s.ids)


def _search(index: DataFrame, block: Block, weights: np.ndarray, k: int, kind: str) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((block.parts(), weights))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weights = shared.value
        block = Block(*parts)
        best = [Best(k) for _ in range(len(block.items))]
        for batch in batches:
            visits = []
            for s in Stratum.of_batch(batch):
                hit, at = _where(s.terms, block.terms)
                highest = np.zeros(len(block.terms), np.int64)
                highest[hit] = weights[hit] * s.impacts()[(np.cumsum(s.levels) - s.levels)[at]]
                visits.append((s, hit, at, np.add.reduceat(highest[block.which], block.first)))
            for s, hit, at, bounds in sorted(visits, key=lambda v: -float(v[3].sum(dtype=float))):
                score_stratum(s, block, weights, hit, at, bounds, best)
        which = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        yield pa.RecordBatch.from_arrays(
            [block.items.take(pa.array(which)), pa.array(np.concatenate([b.id for b in best]), mask=np.concatenate([b.null for b in best])),
             pa.array(np.concatenate([b.score for b in best]))], ["item", "doc_id", "score"])

    return index.mapInArrow(ranked, f"item {kind}, doc_id bigint, score bigint")


def search(index: tuple[DataFrame, int], items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 50,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 of every item."""
    table, n_docs = index
    pairs = staged(item_terms(items, item_id, text), "item-terms")
    kind = items.schema[item_id].dataType.simpleString()
    n_blocks, found = 1 + pairs.count() // block_terms, None
    for number in range(n_blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == number).toArrow()
        if not own.num_rows:
            continue
        block = Block.of(own)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in _frequencies(table, block).tolist()], np.int64)
        part = _search(table, block, weights, k, kind)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = pairs.select("item", F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).where("false")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item").alias("item_id"), "rank", "doc_id", "score"))
