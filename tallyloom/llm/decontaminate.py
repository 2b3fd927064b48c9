"""Benchmark passages in training text, found in a distributed positional inverted index.

``build_index`` turns documents into index segments of about a megabyte of text:
each holds its terms (64-bit word hashes) in order, the list of positions of
each term, and which positions are which document. Segments are rows of a table,
so the index grows and is searched as any table is, and no list of a common word
is ever in one place.

``search`` slides windows over the benchmark items. In a segment, a window whose
rarest term is absent is done at once; else the positions of its rarest term,
less the term's offset, are the places where the window may begin, and each next
rarer list strikes out the places it does not confirm. With ``slop`` the terms
may stand apart: in their order, with up to ``slop`` other words in between.

The benchmark goes to the segments in blocks of bounded size. Equal 64-bit word
hashes are taken for equal words. Null or empty texts have no words; they get a
row and no hit. A null item id reads ``null``. Documents that repeat an id keep a
row each; items that repeat an id are one item. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, buffers, pieces, short, staged

# Digits, letters and all that is beyond ASCII.
TERM = Words([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

WINDOW = 10
BLOCK_BYTES = 4 << 20

SEGMENT = ("segment string, ids array<bigint>, firsts array<bigint>, "
           "terms binary, lists binary, gaps binary")


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, written to the shared folder. Each segment: document ids, the position of each
    document's first word (one more at the end), terms, where each term's list begins, and the
    lists as differences of positions."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for rows, data, bounds in pieces(batches, "text"):
            words, firsts = TERM.hashes(data, bounds)
            order = np.argsort(words, kind="stable").astype(np.int32)
            ranked = words[order]
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            lists = np.flatnonzero(new).astype(np.int32)
            gaps = order.copy()
            gaps[1:] -= order[:-1]
            gaps[lists] = order[lists]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{part}-{number}"]), pa.ListArray.from_arrays([0, rows.num_rows], rows.column("id")),
                 pa.array([firsts], pa.list_(pa.int64())),
                 *[pa.array([x.tobytes()], pa.binary()) for x in (ranked[lists], lists, gaps)]],
                ["segment", "ids", "firsts", "terms", "lists", "gaps"])
            number += 1

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return staged(narrow.mapInArrow(segments, SEGMENT), "index", compression="zstd")


class Block:
    """Items of the benchmark as one run of words, and where windows begin in it."""

    def __init__(self, items: list[str], texts: list[str], width: int):
        data, bounds = buffers(pa.array(texts, pa.large_string()))
        words, firsts = TERM.hashes(data, bounds)
        self.items, self.terms, self.word = items, *np.unique(words, return_inverse=True)
        lengths = np.diff(firsts)
        self.windows = []  # (words in the window, first words, item of each)
        for n in np.unique(np.minimum(lengths[lengths > 0], width)):
            own = np.flatnonzero(np.minimum(lengths, width) == n)
            counts = lengths[own] - n + 1
            first = np.concatenate([np.arange(f, f + c) for f, c in zip(firsts[own], counts, strict=True)])
            self.windows.append((int(n), first, np.repeat(own, counts)))


def _lists(terms: np.ndarray, lists: np.ndarray, gaps: np.ndarray, wanted: np.ndarray) -> tuple[list, np.ndarray]:
    """Positions of each wanted term in this segment, and how many there are."""
    if not len(terms):
        return [None] * len(wanted), np.zeros(len(wanted), np.int64)
    at = np.searchsorted(terms, wanted)
    at[at == len(terms)] = 0
    ends = np.append(lists[1:], len(gaps))
    sizes = np.where(terms[at] == wanted, ends[at] - lists[at], 0)
    found = [np.cumsum(gaps[lists[i]:ends[i]], dtype=np.int64) if n else None for i, n in zip(at, sizes, strict=True)]
    return found, sizes


def _confirm(starts: np.ndarray, positions: np.ndarray, offset: int) -> np.ndarray:
    """The starts that have one of ``positions`` at ``offset``."""
    at = np.searchsorted(positions, starts + offset)
    at[at == len(positions)] = 0
    return starts[positions[at] == starts + offset]


def _phrase(terms: np.ndarray, found: list, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rarest_first = np.argsort(sizes[terms], kind="stable")
    starts = found[terms[rarest_first[0]]] - rarest_first[0]
    for offset in rarest_first[1:]:
        if not len(starts):
            break
        starts = _confirm(starts, found[terms[offset]], int(offset))
    return starts, starts + len(terms)


def _near(terms: np.ndarray, found: list, sizes: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    anchor = int(np.argmin(sizes[terms]))
    rare, starts = found[terms[anchor]], found[terms[0]]
    # Only first terms from which the rarest one is within reach.
    at = np.searchsorted(rare, starts + anchor)
    at[at == len(rare)] = 0
    starts = starts[(rare[at] >= starts + anchor) & (rare[at] <= starts + anchor + slop)]
    ends, alive = starts, np.ones(len(starts), bool)
    for term in terms[1:]:
        positions = found[term]
        at = np.searchsorted(positions, ends, "right")
        alive &= at < len(positions)
        ends = positions[np.minimum(at, len(positions) - 1)]
    alive &= ends - starts < len(terms) + slop
    return starts[alive], ends[alive] + 1


def search(index: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
           width: int = WINDOW, slop: int = 0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of the benchmark's windows: ``segment, place`` (of the document in it), ``doc_id,
    item_id, start, end`` (words; windows of an item that touch are one occurrence)."""
    spark = index.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(text, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n_blocks = 1 + size // block_bytes
    out = []
    for number in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == number).collect()
        shared = spark.sparkContext.broadcast(Block([r.item for r in rows], [r.text for r in rows], width))

        def matches(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                for row in batch.to_pylist():
                    yield pa.RecordBatch.from_pylist(list(_matches(block, row, slop)), schema=pa.schema(
                        [("segment", pa.string()), ("place", pa.int64()), ("doc_id", pa.int64()),
                         ("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

        out.append(index.mapInArrow(matches, "segment string, place bigint, doc_id bigint, item_id string, "
                                             "start bigint, end bigint"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _matches(block: Block, row: dict, slop: int) -> Iterator[dict]:
    firsts = np.array(row["firsts"], np.int64)
    found, sizes = _lists(*[np.frombuffer(row[k], t) for k, t in
                            (("terms", np.uint64), ("lists", np.int32), ("gaps", np.int32))], block.terms)
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for n, first, item in block.windows:
        present = sizes[block.word] > 0
        whole = np.lib.stride_tricks.sliding_window_view(present, n).all(axis=1)
        for k in np.flatnonzero(whole[first]):
            terms = block.word[first[k]:first[k] + n]
            starts, ends = _near(terms, found, sizes, slop) if slop else _phrase(terms, found, sizes)
            if len(starts):
                place = np.searchsorted(firsts, starts, "right") - 1
                same = place == np.searchsorted(firsts, ends - 1, "right") - 1
                for p, s, e in zip(place[same], starts[same], ends[same], strict=True):
                    spans.setdefault((int(p), int(item[k])), []).append((int(s), int(e)))
    for (place, item), each in spans.items():
        at = int(firsts[place])
        for start, end in merged(each):
            yield {"segment": row["segment"], "place": place, "doc_id": row["ids"][place],
                   "item_id": block.items[item], "start": start - at, "end": end - at}


def merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans that touch or overlap as one."""
    low = high = None
    for start, end in sorted(spans):
        if high is not None and start <= high:
            high = max(high, end)
        else:
            if high is not None:
                yield low, high
            low, high = start, end
    if high is not None:
        yield low, high


def _covered(spans: Column) -> Column:
    """Words inside any of the spans ``start, end``."""
    begin = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("upto"))
    step = lambda acc, s: F.struct(
        (acc["words"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("words"),
        F.greatest(acc["upto"], s["end"]).alias("upto"))
    return F.aggregate(F.array_sort(spans), begin, step, lambda acc: acc["words"])


def contamination(index: DataFrame, occurrences: DataFrame) -> DataFrame:
    """One row per document of the index: ``segment, place, doc_id, n_words, n_hit, items``."""
    docs = (index.select("segment", "firsts", F.posexplode("ids").alias("place", "doc_id"))
            .select("segment", F.col("place").cast("bigint").alias("place"), "doc_id",
                    (F.get("firsts", F.col("place") + 1) - F.get("firsts", "place")).alias("n_words")))
    hits = (occurrences.groupBy("segment", "place")
            .agg(F.collect_set(F.struct("start", "end")).alias("spans"),
                 F.array_sort(F.collect_set("item_id")).alias("items"))
            .select("segment", "place", _covered(F.col("spans")).alias("n_hit"), "items"))
    return (docs.join(hits, ["segment", "place"], "left")
            .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")),
                          "items": F.coalesce("items", F.array().cast("array<string>"))}))


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark (exact phrases).

    By id: where an id repeats, one contaminated row takes the others along. Rows without an id are kept."""
    hits = search(build_index(docs, doc_id, text), benchmark).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(short(staged(hits, "contaminated")), docs[doc_id].cast("bigint") == F.col("_hit"), "left_anti")
