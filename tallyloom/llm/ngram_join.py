"""Near-duplicate documents by a blocked sparse product of the document by n-gram matrix.

Two documents link when the Jaccard similarity of their n-gram sets reaches
``threshold`` (in whole percent). Nothing is approximate: every step only drops
what a size-derived bound shows to be without a partner.

1. Documents with equal sets are one row of the matrix from here on.
2. The *head* of a row are its n-grams of smallest hash. A set of ``a`` n-grams
   and a partner share at least ``need(a)`` of them; with heads of
   ``a - need(a) + extra(a)`` n-grams, the heads of linked rows share at least
   ``extra`` of the smaller one. So a row whose head has fewer n-grams in common
   with all other rows together has no partner and leaves. This is one count
   per column of the incidence matrix and one per row.
3. For the rows that are left the whole matrix is counted the same way. An
   n-gram that no other row has is *private*. A row with fewer than ``need``
   others leaves; of the rest only the columns with fewest rows are kept, as
   many as make sure that one of them is shared with every partner.
4. Rows that these columns connect are a *family*; different families share
   nothing. A family is cut into blocks of rows of one size class, and the
   product runs block by block, accumulating the overlap of each pair of rows
   over their common columns. Blocks whose sizes forbid a link are not
   multiplied. In a family of several blocks every row first meets one *lead*
   row, and blocks of rows that link with it are not multiplied with each other,
   being of one component already: a thousand copies cost a thousand
   comparisons and the blocks of those few that do not link.
   Small families share a block. A block pair gives a spanning forest of its links.

Hash columns and rows are spread by hash; a column of a third of all rows is
counted with pre-aggregation and joined with a side that Spark may split.

Null or empty texts, and texts without a word, have no n-gram and link with
nothing; fewer words than ``n`` are one n-gram. Documents that repeat an id are
one document as to links: they are reached through each other. A null id gets
its row, its component is null unless a linked document has an id. Rows are told
apart by 64 bits of their set's hash. Columns but id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, pieces, shingles, short, staged

# All but ASCII white space; A-Z count as a-z.
TOKEN = Words([b for b in range(256) if b not in (0x20, *range(0x09, 0x0E))])

N = 5
THRESHOLD = 80
EXTRA = 10  # the head is longer by one n-gram in so many
BLOCK = 256  # rows in a block


def need(a):
    """n-grams that a set of ``a`` shares with any partner, at least."""
    return -(-a * THRESHOLD // 100)


def extra(a):
    return np.maximum(1, a // EXTRA)


def shared_heads(a):
    """n-grams that the heads of ``a`` and of any partner share at least: a partner has ``need(a)`` n-grams or more."""
    return extra(need(a))


def _sets(rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """The n-gram hashes of each text, in order, each once."""
    grams, firsts = shingles(*TOKEN.hashes(data, bounds), N)
    for k in range(rows.num_rows):
        yield np.unique(grams[firsts[k]:firsts[k + 1]])


def _row(grams: np.ndarray) -> int | None:
    """The number of a set."""
    if not len(grams):
        return None
    return int.from_bytes(blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def matrix_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n`` of every document (``docs``: doc_id, text)."""
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in pieces(batches, "text"):
            sets = list(_sets(rows, data, bounds))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([_row(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())],
                ["doc_id", "row", "n"])
    return docs.mapInArrow(rows_of, "doc_id bigint, row bigint, n bigint")


def heads(docs: DataFrame) -> DataFrame:
    """Incidence of the heads: ``gram, row, n``. Equal sets that one task meets are written once."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for rows, data, bounds in pieces(batches, "text"):
            grams, numbers, sizes = [], [], []
            for s in _sets(rows, data, bounds):
                row = _row(s)
                if row is None or row in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(row)
                grams.append(s[:len(s) - need(len(s)) + int(extra(len(s)))])
                numbers.append(row)
                sizes.append(len(s))
            if grams:
                lengths = [len(g) for g in grams]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.repeat(np.array(numbers, np.int64), lengths)),
                     pa.array(np.repeat(np.array(sizes, np.int32), lengths))], ["gram", "row", "n"])
    return docs.select("text").mapInArrow(entries, "gram bigint, row bigint, n int")


def _shared_heads(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.ceil(n * THRESHOLD / 100) / EXTRA)).cast("int")


def _shared_columns(entries: DataFrame) -> DataFrame:
    """``gram, rows`` of the columns with more than one row."""
    # A column of one row (or of copies of it) has its smallest and largest row the same.
    return (entries.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("a"), F.max("row").alias("b"))
            .where("a <> b").select("gram", "rows"))


def candidate_rows(docs: DataFrame) -> DataFrame:
    """``row`` of all that step 2 leaves."""
    entries = heads(docs)
    shared = entries.join(_shared_columns(entries), "gram")
    counted = shared.groupBy("row").agg(F.first("n").alias("n"), F.size(F.collect_set("gram")).alias("shared"))
    return staged(counted.where(F.col("shared") >= _shared_heads(F.col("n"))).select("row"), "candidates")


def candidate_columns(texts: DataFrame) -> DataFrame:
    """The columns that step 3 keeps: ``gram, row, n``. ``texts``: row, text, each row once."""
    def entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in pieces(batches, "text"):
            sets = list(_sets(rows, data, bounds))
            lengths = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets).view(np.int64)), pa.array(np.repeat(np.array(rows.column("row")), lengths)),
                 pa.array(np.repeat(np.array(lengths, np.int32), lengths))], ["gram", "row", "n"])

    entries = texts.mapInArrow(entries_of, "gram bigint, row bigint, n int")
    keep = F.size("own") - F.ceil(F.col("n") * THRESHOLD / 100).cast("int") + 1
    kept = (entries.join(_shared_columns(entries), "gram")
            .groupBy("row").agg(F.first("n").alias("n"), F.collect_list(F.struct("rows", "gram")).alias("own"))
            .where(keep > 0).withColumn("own", F.slice(F.array_sort("own"), F.lit(1), F.greatest(keep, F.lit(0))))
            .select("row", "n", F.explode("own.gram").alias("gram")))
    return staged(kept, "columns")


def _overlaps(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows (i < j) with a common n-gram, and how many they have."""
    r = len(sets)
    grams = np.concatenate(sets)
    row = np.repeat(np.arange(r), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(grams)))
    column, size = np.cumsum(new) - 1, np.repeat(size, size)
    total = np.zeros(r * r, np.int64)
    few = (size > 1) & (size <= 16)
    c, x = column[few], row[few]
    for k in range(1, 16):  # the rows of a column stand side by side, in order
        same = c[k:] == c[:-k]
        if not same.any():
            break
        total += np.bincount(x[:-k][same] * r + x[k:][same], minlength=r * r)
    many = size > 16
    _, c = np.unique(column[many], return_inverse=True)
    x, width = row[many], 4096
    for lo in range(0, int(c.max()) + 1 if len(c) else 0, width):
        part = (c >= lo) & (c < lo + width)
        block = np.zeros((r, width), np.float32)
        block[x[part], c[part] - lo] = 1
        total += (block @ block.T).astype(np.int64).ravel()
    i, j = np.divmod(np.flatnonzero(total), r)
    upper = i < j
    return i[upper], j[upper], total.reshape(r, r)[i[upper], j[upper]]


def _forest(links: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those links that connect what was not connected yet."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while x in up:
            x = up[x]
        return x
    for a, b in links:
        a_, b_ = find(a), find(b)
        if a_ != b_:
            up[max(a_, b_)] = min(a_, b_)
            yield a, b


def _text_sets(texts: pa.Array | list) -> list[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    return [s for rows, data, bounds in pieces([batch], "text") for s in _sets(rows, data, bounds)]


def _block_links(rows: pa.Table) -> pa.Table:
    """Spanning links of the rows of one pair of blocks."""
    number = rows.column("row").to_pylist()
    sets = _text_sets(rows.column("text").to_pylist())
    n = np.array([len(s) for s in sets])
    i, j, both = _overlaps(sets)
    good = 100 * both >= THRESHOLD * (n[i] + n[j] - both)
    found = list(_forest(zip(i[good].tolist(), j[good].tolist(), strict=True)))
    return pa.table({"a": pa.array([number[x] for x, _ in found], pa.int64()), "b": pa.array([number[y] for _, y in found], pa.int64())})


def _lead_links(met: DataFrame) -> DataFrame:
    """Which rows (row, text) link with the lead of their family (lead, lead_text)."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            leads = batch.column("lead").to_pylist()
            at = {x: k for k, x in enumerate(leads)}  # one text of each lead is enough
            for x, s in zip(at, _text_sets([batch.column("lead_text")[k].as_py() for k in at.values()]), strict=True):
                known[x] = s
            good = []
            for x, s in zip(leads, _text_sets(batch.column("text").to_pylist()), strict=True):
                both = len(np.intersect1d(known[x], s, assume_unique=True))
                good.append(100 * both >= THRESHOLD * (len(known[x]) + len(s) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in (batch.column("lead"), batch.column("row"))], ["a", "b"])
    return met.select("row", "text", "lead", "lead_text").mapInArrow(test, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``row, label`` of every row of a link; rows that links connect have one label, the smallest of their rows.

    Each round hands every row the smallest label next to it, then the label of
    that label, so chains shorten to half; each round is written down."""
    edges = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("row"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("row", "b"), "b").groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near.withColumnRenamed("a", "row"), "row")
                .select("row", F.least("label", "near").alias("label"), F.col("label").alias("was")))
        up = step.select(F.col("row").alias("label"), F.col("label").alias("top"))
        new = staged(step.join(up, "label", "left").select("row", F.least("label", F.coalesce("top", "label")).alias("label"), "was"),
                     "labels")
        labels = new.select("row", "label")
        if not new.where("label <> was").limit(1).count():
            return labels


def row_links(columns: DataFrame, texts: DataFrame) -> DataFrame:
    """``row, label`` of all rows with a link: step 4."""
    leads = columns.groupBy("gram").agg(F.min("row").alias("b"))
    stars = columns.join(leads, "gram").where(F.col("row") != F.col("b")).select(F.col("row").alias("a"), "b")
    families = components(stars).withColumnRenamed("label", "family")
    rows = staged(columns.groupBy("row").agg(F.first("n").alias("n")).join(families, "row"), "families")
    sizes = staged(rows.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("n", "row")).alias("lead"))
                   .select("family", "members", F.col("lead.row").alias("lead")), "family-sizes")
    large = sizes.where(F.col("members") > BLOCK)

    # Large families: who links with the lead.
    members = rows.join(large, "family")
    lead_texts = large.select("lead").join(texts.select(F.col("row").alias("lead"), F.col("text").alias("lead_text")), "lead")
    starred = staged(_lead_links(members.where(F.col("row") != F.col("lead")).select("row", "lead").join(texts, "row").join(lead_texts, "lead")),
                     "lead-links")
    core = starred.select(F.col("b").alias("row")).unionByName(large.select(F.col("lead").alias("row"))).withColumn("core", F.lit(True))
    # Neighbouring classes may link; a row of the next but one is more than a quarter larger.
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / THRESHOLD)) + 1e-9).cast("int")
    members = (members.join(core, "row", "left").withColumn("core", F.coalesce("core", F.lit(False)))
               .withColumn("class", size_class).select("row", "family", "core", "class"))
    counts = members.groupBy("family", "core", "class").agg(F.count(F.lit(1)).alias("count"))
    counts = staged(counts.withColumn("parts", F.ceil(F.col("count") / BLOCK).cast("int")), "blocks")
    members = (members.join(counts.drop("count"), ["family", "core", "class"])
               .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")))
    blocks = counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("family", "core", "class", "part")
    name = F.xxhash64("family", "core", "class", "part")
    left, right = blocks.withColumn("x", name), blocks.withColumn("y", name)
    pairs = (left.alias("l").join(right.alias("r"), "family")
             .where((F.col("x") <= F.col("y")) & ~(F.col("l.core") & F.col("r.core"))
                    & (F.abs(F.col("l.class") - F.col("r.class")) <= 1)).select("x", "y"))
    pairs = pairs.withColumn("pair", F.xxhash64("x", "y"))
    sides = pairs.select(F.col("x").alias("block"), "pair").unionByName(pairs.where("x <> y").select(F.col("y").alias("block"), "pair"))
    placed = members.select("row", name.alias("block")).join(sides, "block").select("row", "pair")

    # Small families: whole, several to a block.
    small = rows.join(sizes.where(F.col("members") <= BLOCK), "family").select("row", "family")
    groups = 1 + small.count() // BLOCK
    placed = placed.unionByName(small.select("row", F.pmod(F.xxhash64("family"), F.lit(groups)).alias("pair")))
    found = placed.join(texts, "row").groupBy("pair").applyInArrow(_block_links, "a bigint, b bigint")
    return components(staged(found, "block-links").unionByName(starred))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = staged(matrix_rows(docs), "matrix-rows")
    wanted = candidate_rows(docs)
    # One document for each row that is still in question; its text is what pairs are verified on.
    speakers = staged(rows.join(short(wanted), "row").groupBy("row").agg(F.min("doc_id").alias("doc_id")), "speakers")
    met = docs.join(short(speakers.where("doc_id is not null")), "doc_id").select("row", "text")
    nameless = speakers.where("doc_id is null").select("row")
    met = met.unionByName(docs.where("doc_id is null").select("text").mapInArrow(_numbered, "row bigint, text string")
                          .join(nameless, "row"))
    texts = staged(_own_rows(met), "texts")
    labels = row_links(candidate_columns(texts), texts)
    named = rows.join(labels, "row", "left").withColumn("label", F.coalesce("label", "row"))
    return _with_components(named)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in pieces(batches, "text"):
        numbers = [_row(s) for s in _sets(rows, data, bounds)]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), rows.column("text")], ["row", "text"])


def _own_rows(met: DataFrame) -> DataFrame:
    """Where an id repeats with other texts, only the text that is the row's own; one text for each row."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in pieces(batches, "text"):
            numbers = rows.column("row").to_pylist()
            mask = [_row(s) == r for s, r in zip(_sets(rows, data, bounds), numbers, strict=True)]
            yield rows.filter(pa.array(mask))
    return met.mapInArrow(own, met.schema).dropDuplicates(["row"])


def _with_components(named: DataFrame) -> DataFrame:
    """Labels of rows to smallest document ids."""
    # Ids that repeat with different texts join the components of all their texts.
    several = (named.where("doc_id is not null and label is not null").groupBy("doc_id")
               .agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b"))
    several = staged(several, "several")
    if several.limit(1).count():
        bridges = named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("label").alias("b")).where("a <> b").distinct()
        over = components(bridges).select(F.col("row").alias("label"), F.col("label").alias("top"))
        named = (named.join(over, "label", "left").withColumn("label", F.coalesce("top", "label")).drop("top"))
    smallest = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component"))
    return (named.join(smallest, "label", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one of smallest id, and of rows that repeat it, one.

    Rows without an id cannot be told apart by it and stay."""
    found = staged(near_duplicates(docs, doc_id, text), "near-duplicates")
    gone = staged(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(short(gone), docs[doc_id].cast("bigint") == F.col("_gone"), "left_anti")
    several = staged(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id"),
                     "repeated-ids")
    if not several.limit(1).count():
        return kept
    same = kept[doc_id].cast("bigint") == F.col("_id")
    return (kept.join(short(several), same, "left_anti")
            .unionByName(kept.join(short(several), same, "left_semi").dropDuplicates([doc_id])))
