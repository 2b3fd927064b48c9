"""CSV extracts of many origins, each with its own dialect.

Encoding and quoting are voted on over all lines of a file. Delimiter and header
are found in its first records by column functions: the delimiter is the sign
that stands equally often, outside quotes, in most of them; the header is the
first record with a cell that names the key. Files of one layout are then one
read, split across tasks, with or without lines above the header.

Without quoted line breaks that is Spark's CSV reader. With them, whether a line
begins inside quotes depends on everything before it. So each split is first read
both ways, begun outside and begun inside quotes, which gives a map of two states;
the maps of a file's splits compose in order, and then every split knows how it
begins. It puts the lines of a record together by itself, and only the records
that cross a border between splits (one at either end) meet once more. A quote
opens a cell only where a cell begins, so one that stands inside a cell is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import norm_key, strip
from ..operators.keyed import is_small, small_side
from ..operators.merge import rank_names
from ..session import stage_path

# Fixed values of the extract format.
DELIMITERS = ";,\t|"
HEADER_SEARCH_ROWS = 50
# Lines looked at for those records at first; where they do not suffice, WIDER times as many, and so on.
FIRST_LINES, WIDER = 1_000, 16
OUTPUT_NAMES = ("merged.csv", "merge_conflicts.csv", "merge_manifest.json")

# The 32 code points where cp1252 and latin-1 differ, from the codec itself.
_C1 = [bytes([b]) for b in range(0x80, 0xA0)]
_CP1252 = [(b.decode("latin-1"), b.decode("cp1252")) for b in _C1 if b.decode("cp1252", "ignore")]
_NOT_CP1252 = "".join(b.decode("latin-1") for b in _C1 if not b.decode("cp1252", "ignore"))


@dataclass(frozen=True)
class Dialect:
    file: str
    path: str
    rank: int
    encoding: str
    delimiter: str
    multiline: bool
    header_row: int           # records above the header that the CSV reader sees
    header_line: int          # 1-based, in the file
    exact: bool
    key_header: str
    header: tuple[str, ...]


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (spark.read.option("pathGlobFilter", "*.csv").text(paths)
            .select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("start"), "value")
            .where(~F.col("file").isin(*OUTPUT_NAMES)).withColumn("at", F.monotonically_increasing_id()))


def file_splits(spark: SparkSession, directory: str) -> DataFrame:
    """Per split of a file: do all lines decode, has it quotes, how many lines, and the first of them."""
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return _lines(spark, directory).groupBy("file", "path", "start").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(latin.rlike(f"[{_NOT_CP1252}]")).alias("latin_only"),
        F.bool_or(latin.contains('"')).alias("quoted"), F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _decoded(encoding: Column) -> Column:
    raw = F.col("value").cast("binary")
    latin = F.decode(raw, "ISO-8859-1")
    cp1252 = F.translate(latin, "".join(a for a, _ in _CP1252), "".join(b for _, b in _CP1252))
    utf8 = F.regexp_replace(F.decode(raw, "UTF-8"), "^\ufeff", "")
    return F.when(encoding == "utf-8-sig", utf8).when(encoding == "cp1252", cp1252).otherwise(latin)


def _first_records(spark: SparkSession, directory: str, splits: DataFrame, votes: DataFrame) -> DataFrame:
    """Per file its first HEADER_SEARCH_ROWS records, and the line each begins in. A line with a quote left open
    goes on in the next one."""
    order = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.select("path", "start", "first", F.coalesce(F.sum("lines").over(order), F.lit(0)).alias("before"))
    numbered = Window.partitionBy("path").orderBy("number")
    bound, files, found = FIRST_LINES, votes.select("file", "path", "encoding"), None
    while True:
        near = (_lines(spark, directory).join(small_side(begun.where(F.col("before") < bound)), ["path", "start"])
                .withColumn("number", F.col("before") + F.col("at") - F.col("first")).where(F.col("number") < bound)
                .join(small_side(files), ["file", "path"]).select("file", "path", "number", _decoded(F.col("encoding")).alias("v")))
        odd = F.sum(_odd_quotes(F.col("v")).cast("int")).over(numbered.rowsBetween(Window.unboundedPreceding, 0))
        ended = F.sum((F.col("odd") % 2 == 0).cast("int")).over(numbered.rowsBetween(Window.unboundedPreceding, -1))
        records = (near.withColumn("odd", odd).withColumn("record", F.coalesce(ended, F.lit(0)))
                   .where(F.col("record") < HEADER_SEARCH_ROWS).groupBy("file", "path", "record")
                   .agg(F.array_sort(F.collect_list(F.struct("number", "v"))).alias("l"))
                   .select("file", "path", "record", F.get("l", F.lit(0))["number"].alias("line"), F.element_at("l", -1)["number"].alias("last"),
                           F.concat_ws("\n", F.transform("l", lambda x: x["v"])).alias("text")))
        heads = _staged(records.groupBy("file", "path").agg(
            F.array_sort(F.collect_list(F.struct("record", "line", "text"))).alias("l"), F.max("last").alias("last")), "heads")
        more = (F.size("l") < HEADER_SEARCH_ROWS) & (F.col("last") == bound - 1)
        found = heads.where(~more) if found is None else found.unionByName(heads.where(~more))
        files = files.join(heads.where(more).select("path"), "path", "left_semi").select("file", "path", "encoding")
        if heads.where(more).limit(1).count() == 0:
            return found.select("file", "path", F.transform("l", lambda x: x["text"]).alias("records"), F.transform("l", lambda x: x["line"]).alias("lines"))
        bound *= WIDER


# A quoted part, matched without going back, however long it is.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def _best_delimiter(records: Column) -> Column:
    """The sign with the same number in most records, then the one with most of them; a comma if none occurs."""
    bare = F.filter(F.transform(records, lambda r: F.regexp_replace(r, _QUOTED + "?", "")), lambda r: F.trim(r) != "")

    def vote(rank: int, sign: str) -> Column:
        counts = F.filter(F.transform(bare, lambda r: F.length(r) - F.length(F.replace(r, F.lit(sign), F.lit("")))), lambda n: n > 0)
        return F.array_max(F.transform(F.array_distinct(counts), lambda n: F.struct(
            F.size(F.filter(counts, lambda m: m == n)).alias("records"), n.alias("signs"), F.lit(-rank).alias("rank"),
            F.lit(sign).alias("sign"))))
    votes = F.array(*[vote(rank, sign) for rank, sign in enumerate(DELIMITERS)])
    return F.coalesce(F.array_max(F.array_compact(votes))["sign"], F.lit(","))


def _cells(record: Column, sign: str) -> Column:
    """Cells of one record, quotes taken off, white space trimmed."""
    other = f"[^\\{sign}]*+"
    parts = F.regexp_extract_all(F.concat(F.lit(sign), record), F.lit(f"\\{sign}(\\s*+{_QUOTED}{other}|{other})"), F.lit(1))
    parts = F.transform(parts, lambda c: strip(c))
    plain = lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(parts, lambda c: strip(plain(c)))


def file_dialects(spark: SparkSession, directory: str, key: str) -> DataFrame:
    """One row per source file: how it is written, and where its header is (``header`` NULL: nowhere)."""
    splits = _staged(file_splits(spark, directory), "splits")
    encoding = F.when(F.col("utf8"), "utf-8-sig").when(F.col("latin_only"), "latin-1").otherwise("cp1252")
    votes = (splits.groupBy("file", "path").agg(F.bool_and("utf8").alias("utf8"), F.bool_or("latin_only").alias("latin_only"),
                                                F.bool_or("quoted").alias("quoted")).withColumn("encoding", encoding))
    heads = _first_records(spark, directory, splits, votes)
    found = heads.withColumn("delimiter", _best_delimiter(F.col("records")))
    split = lambda sign: F.transform("records", lambda r: _cells(r, sign))
    found = found.withColumn("cells", F.coalesce(*[F.when(F.col("delimiter") == sign, split(sign)) for sign in DELIMITERS]))
    wanted = F.lit(key)
    place = lambda test: F.array_min(F.filter(F.transform("cells", lambda c, i: F.when(F.exists(c, test), i)), lambda i: i.isNotNull()))
    exactly, alike = place(lambda c: c == wanted), place(lambda c: norm_key(c) == norm_key(wanted))
    found = found.withColumn("at", F.coalesce(exactly, alike)).withColumn("exact", exactly.isNotNull())
    header = F.get("cells", F.col("at"))
    named = F.array_max(F.filter(F.transform(header, lambda c, i: F.when(c != "", i)), lambda i: i.isNotNull()))
    header = F.slice(header, F.lit(1), named + 1)  # without the empty cells at its end
    above = F.slice("records", F.lit(1), F.greatest(F.col("at"), F.lit(0)))
    seen = F.size(F.filter(above, lambda r: F.trim(r, F.lit(" \t\r")) != ""))
    found = _staged(votes.join(found, ["file", "path"], "left").select(
        "file", "path", "encoding", "delimiter", "quoted", F.when(F.col("at").isNotNull(), seen).alias("header_row"),
        (F.get("lines", F.col("at")) + 1).cast("int").alias("header_line"), "exact",
        F.get(F.filter(header, lambda c: F.when(F.col("exact"), c == wanted).otherwise(norm_key(c) == norm_key(wanted))),
              F.lit(0)).alias("key_header"), header.alias("header"),
        F.array_join(F.slice(F.get("cells", F.lit(0)), 1, 12), ", ").alias("first_cells")), "dialects")
    if found.where("quoted").limit(1).count() == 0:
        return found.withColumn("multiline", F.col("quoted")).drop("quoted")
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    leaves_open = F.coalesce(*[F.when(F.col("delimiter") == sign, _leaves_open(latin, sign)) for sign in DELIMITERS])
    broken = (_lines(spark, directory).where(latin.contains('"')).join(small_side(found.where("quoted").select("path", "delimiter")), "path")
              .where(leaves_open).select("path").distinct().withColumn("multiline", F.lit(True)))
    return found.join(broken, "path", "left").withColumn("multiline", F.coalesce("multiline", F.lit(False))).drop("quoted")


# Quoted cells of a line, from where a cell begins to the end of the quotes or of the line; {0} is the delimiter.
_QUOTED_CELLS = '(^|\\{0})"[^"]*+(?:""[^"]*+)*+"'
_OPEN_CELL = '(?:^|\\{0})"'


def _leaves_open(line: Column, sign: str) -> Column:
    """Does a line that begins outside quotes end inside them."""
    return line.contains('"') & F.regexp_replace(line, _QUOTED_CELLS.format(sign), "$1").rlike(_OPEN_CELL.format(sign))


class _Reading:
    """How lines with quotes move between outside and inside, for one delimiter."""

    def __init__(self, sign: str):
        self.cells, self.open = re.compile(_QUOTED_CELLS.format(sign)), re.compile(_OPEN_CELL.format(sign))

    def after(self, line: str, inside: bool) -> bool:
        # Inside is as if the line began with the quote that opened the cell.
        return self.open.search(self.cells.sub(r"\1", '"' + line if inside else line)) is not None


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut where a new split begins."""
    for batch in batches:
        path, start = batch.column("path"), batch.column("start")
        cuts = [0, batch.num_rows]
        if batch.num_rows > 1:
            new = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1]))
            cuts[1:1] = [i + 1 for i, x in enumerate(new.to_pylist()) if x] if pc.any(new).as_py() else []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def _split_maps(lines: DataFrame, sign: str) -> DataFrame:
    """``path, start, lines, from_outside, from_inside``: is the end of a split inside quotes, by how it begins."""
    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, at, ends, n = _Reading(sign), None, [False, True], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, n, *ends)], ["path", "start", "lines", "from_outside", "from_inside"])

        for batch in _by_split(batches):
            here = batch.column("path")[0].as_py(), batch.column("start")[0].as_py()
            if at is not None and here != at:
                yield row()
                ends, n = [False, True], 0
            at = here
            n += batch.num_rows
            for line in batch.column("value").filter(pc.match_substring(batch.column("value"), '"')).to_pylist():
                ends = [reading.after(line, inside) for inside in ends] if ends[0] != ends[1] else [reading.after(line, ends[0])] * 2
        if at is not None:
            yield row()
    return lines.select("path", "start", "value").mapInArrow(maps, "path string, start bigint, lines bigint, from_outside boolean, from_inside boolean")


def _entries(maps: DataFrame) -> DataFrame:
    """``path, start, inside, before``: does a split begin inside quotes, and how many lines lie before it."""
    order = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A map that leads to one state whatever came before settles all that follows; those in between keep or swap.
    same = F.col("from_outside") == F.col("from_inside")
    swaps = F.sum(F.when(same, 0).otherwise(F.col("from_outside").cast("int")))
    so_far = swaps.over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    marked = maps.withColumn("swaps", so_far).withColumn(
        "settled", F.when(same, F.struct(F.col("from_outside").alias("inside"), F.col("swaps").alias("swaps"))))
    last = F.last("settled", ignorenulls=True).over(order)
    before = F.coalesce(F.last("swaps").over(order), F.lit(0))
    inside = (F.coalesce(last["inside"].cast("int"), F.lit(0)) + before - F.coalesce(last["swaps"], F.lit(0))) % 2 == 1
    return marked.select("path", "start", inside.alias("inside"), F.coalesce(F.sum("lines").over(order), F.lit(0)).alias("before"))


def records(lines: DataFrame, sign: str, header_line: int) -> DataFrame:
    """``file, start, at, value``: the records of files with quoted line breaks behind their header, from ``lines``
    (``file, path, start, at, value``) as they are read, split by split."""
    entries = _staged(_entries(_staged(_split_maps(lines, sign), "maps")), "entries")
    # Most splits begin outside quotes and behind the header; only the others need to be told.
    told = entries.where(F.col("inside") | (F.col("before") < header_line))
    if is_small(told):
        rows = lines.join(F.broadcast(told), ["path", "start"], "left")
    else:
        rows = lines.join(told, ["path", "start"], "left").repartition("path", "start").sortWithinPartitions("path", "start", "at")
    rows = rows.select("file", "path", "start", "at", "value", F.coalesce("inside", F.lit(False)).alias("inside"), F.coalesce("before", F.lit(header_line)).alias("before"))

    WHOLE, HEAD, MIDDLE, TAIL = range(4)
    names = ["file", "path", "start", "at", "kind", "value"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, here, n, where, inside, held, began = _Reading(sign), None, 0, ("", ""), False, [], None

        def rest() -> pa.RecordBatch | None:
            """What is still open where a split ends."""
            if not held:
                return None
            kind = MIDDLE if began is None else TAIL
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                (*where, began if began is not None else -1, kind, "\n".join(held)), types, strict=True)], ["file", "path", "start", "at", "kind", "value"])

        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        for batch in _by_split(batches):
            split = batch.column("path")[0].as_py(), batch.column("start")[0].as_py()
            if split != here:
                if (left := rest()) is not None:
                    yield left
                here, n, held, began = split, batch.column("before")[0].as_py(), [], None
                inside = batch.column("inside")[0].as_py()
            where = (batch.column("file")[0].as_py(), *split)
            value, at = batch.column("value"), batch.column("at")
            marks = pc.indices_nonzero(pc.match_substring(value, '"')).to_pylist()
            out: list[tuple[int, int, str]] = []
            plain, done = [], 0  # stretches of whole lines

            for i in [*marks, None]:
                end = len(value) if i is None else i
                if inside:
                    held += value.slice(done, end - done).to_pylist()
                elif end > done:
                    plain.append((done, end - done))
                if i is None:
                    break
                line, done = value[i].as_py(), i + 1
                after = reading.after(line, inside)
                if inside:
                    held.append(line)
                    if not after:
                        out.append((HEAD if began is None else WHOLE, -1 if began is None else began, "\n".join(held)))
                        held = []
                elif after:
                    held, began = [line], (at[i].as_py() if n + i >= header_line else -2)
                else:
                    plain.append((i, 1))
                inside = after
            keep = [(lo, k) for lo, k in ((max(lo, header_line - n), lo + k - max(lo, header_line - n)) for lo, k in plain) if k > 0]
            for lo, k in keep:
                part = batch.slice(lo, k)
                yield pa.RecordBatch.from_arrays([part.column("file"), part.column("path"), part.column("start"), part.column("at"),
                                                  pa.array([WHOLE] * k, pa.int32()), part.column("value")], names)
            out = [x for x in out if x[1] != -2]
            if out:
                kinds, places, texts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array([x] * len(out), t) for x, t in zip(where, types, strict=False)), pa.array(places, pa.int64()),
                                                  pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], names)
            n += batch.num_rows
        if (left := rest()) is not None:
            yield left

    made = _staged(rows.mapInArrow(assemble, "file string, path string, start bigint, at bigint, kind int, value string"), "records")
    # Pieces of records that cross borders: an open end, whole splits inside quotes, and the piece that closes it.
    order = Window.partitionBy("path").orderBy("start", "kind")
    pieces = made.where(F.col("kind") != WHOLE).withColumn("chain", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    first = F.min_by(F.struct("start", "at", "kind"), F.struct("start", "kind"))
    joined = (pieces.groupBy("file", "path", "chain").agg(first.alias("first"), F.array_sort(F.collect_list(F.struct("start", "kind", "value"))).alias("l"))
              .where((F.col("first.kind") == TAIL) & (F.col("first.at") >= 0))
              .select("file", "first.start", "first.at", F.concat_ws("\n", F.transform("l", lambda x: x["value"])).alias("value")))
    return made.where(F.col("kind") == WHOLE).select("file", "start", "at", "value").unionByName(joined)


def detect_dialects(spark: SparkSession, directory: str, key: str) -> list[Dialect]:
    """One dialect per source file. Only these few facts reach the driver."""
    rows = file_dialects(spark, directory, key).collect()
    if not rows:
        raise FileNotFoundError(f"no source CSVs in {directory}")
    lost = sorted(r["file"] + ": " + (f"no cell {key!r} in the first {HEADER_SEARCH_ROWS} records; it begins with {r['first_cells']}"
                                      if r["first_cells"] else "nothing in it") for r in rows if r["header"] is None)
    if lost:
        raise ValueError("\n".join(lost))
    ranks = rank_names([r["file"] for r in rows])
    return [Dialect(r["file"], r["path"], ranks[r["file"]], r["encoding"], r["delimiter"], r["multiline"], r["header_row"],
                    r["header_line"], r["exact"], r["key_header"], tuple(r["header"]))
            for r in sorted(rows, key=lambda r: r["file"])]


def read_dialect(spark: SparkSession, files: list[Dialect]) -> DataFrame:
    """Files of one dialect as trimmed text: ``_rank, _file, _row``, columns.

    ``_row`` orders the rows of a file: where its split starts, then the place
    in the split.
    """
    d = files[0]
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(d.header))])
    options = {"sep": d.delimiter, "quote": '"', "escape": '"'}
    start = lambda c: c.cast("decimal(19,0)") * F.lit("9223372036854775808").cast("decimal(19,0)")
    if d.multiline:
        whole = records(_lines(spark, [f.path for f in files]).withColumn("value", _decoded(F.lit(d.encoding))), d.delimiter, d.header_line)
        rows = (whole.select(F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), options | {"maxCharsPerColumn": "-1"}).alias("_r"),
                             F.col("file").alias("_file"), (start(F.col("start")) + F.col("at")).cast("decimal(38,0)").alias("_row"))
                .select("_r.*", "_file", "_row"))
    else:
        raw = (spark.read.schema(schema).options(**options)
               .option("encoding", "UTF-8" if d.encoding.startswith("utf") else "ISO-8859-1")
               .option("header", d.header_row == 0).csv([f.path for f in files]))
        at = F.monotonically_increasing_id()
        rows = raw.select("*", F.col("_metadata.file_name").alias("_file"), at.alias("_at"), F.col("_metadata.file_block_start").alias("_start"),
                          (start(F.col("_metadata.file_block_start")) + at).cast("decimal(38,0)").alias("_row"))
    if d.header_row and not d.multiline:
        # Records are counted from the first one of each file, wherever a task begins.
        first = (rows.where(F.col("_start") == 0).groupBy("_file").agg(F.min("_at").alias("_first"))
                 .withColumnRenamed("_file", "_of"))
        rows = (rows.join(small_side(first), F.col("_file") == F.col("_of"))
                .where((F.col("_start") != 0) | (F.col("_at") - F.col("_first") > d.header_row)))
    cells: list[tuple[str, Column]] = []
    for i, name in enumerate(d.header):
        cell = F.coalesce(F.col(f"_c{i}"), F.lit(""))
        if d.encoding == "cp1252" and not d.multiline:
            cell = F.translate(cell, "".join(a for a, _ in _CP1252), "".join(b for _, b in _CP1252))
        if name:
            cells.append((name, strip(cell)))
    filled = F.lit(False)
    for c in schema.names:
        filled = filled | (strip(F.coalesce(F.col(c), F.lit(""))) != "")
    ranks = spark.createDataFrame([(f.file, f.rank) for f in files], "_file string, _rank int")
    rows = rows.where(filled).join(small_side(ranks), "_file")
    once: dict[str, Column] = {}
    again: dict[str, list[Column]] = {}
    for name, cell in cells:
        if name in once:
            again.setdefault(name, []).append(cell)
        else:
            once[name] = cell
    if not again:
        return rows.select("_rank", "_file", "_row", F.lit(0).alias("_part"), *[c.alias(n) for n, c in once.items()])
    # A header that repeats in a file: each further cell is a row part of its own, so that it
    # fills a gap or shows as a conflict like the cell of a later source.
    depth = max(map(len, again.values()))
    parts = [F.struct(F.lit(0).alias("_part"), *[c.alias(n) for n, c in once.items()])]
    for k in range(depth):
        more = {n: c[k] for n, c in again.items() if k < len(c)}
        own = [more.get(n, once[n] if n == d.key_header else F.lit("")).alias(n) for n in once]
        some = F.lit(False)
        for c in more.values():
            some = some | (c != "")
        parts.append(F.when(some, F.struct(F.lit(k + 1).alias("_part"), *own)))
    return (rows.select("_rank", "_file", "_row", F.explode(F.array_compact(F.array(*parts))).alias("_p"))
            .select("_rank", "_file", "_row", "_p.*"))


def read_extracts(spark: SparkSession, directory: str, key: str) -> DataFrame:
    """All sources of a directory, stacked in precedence order.

    A file that spells the key column differently still fills ``key``. ``_part`` is 0
    but for the further cells of a header that repeats in a file (1, 2, ...).
    """
    dialects = detect_dialects(spark, directory, key)
    # Files that look alike are one read.
    alike: dict[tuple, list[Dialect]] = {}
    for d in dialects:
        alike.setdefault((d.encoding, d.delimiter, d.multiline, d.header, d.header_line if d.multiline else d.header_row), []).append(d)
    stacked = None
    for files in alike.values():
        part = read_dialect(spark, files)
        if files[0].key_header != key:
            part = part.withColumnRenamed(files[0].key_header, key)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    columns = list(dict.fromkeys(key if h == d.key_header else h for d in dialects for h in d.header if h))
    return stacked.select("_rank", "_file", "_row", "_part", *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def extract_headers(spark: SparkSession, dialects: list[Dialect]) -> DataFrame:
    return spark.createDataFrame([(d.rank, d.file, i, h) for d in dialects for i, h in enumerate(d.header)],
                                 "_rank int, _file string, position int, header string")


def source_manifest(spark: SparkSession, directory: str, key: str, digest: bool = True) -> DataFrame:
    """Provenance per source: rank, checksum, dialect, rows. No clock.

    A checksum needs its file as a whole; switch it off for very large files.
    """
    dialects = detect_dialects(spark, directory, key)
    facts = spark.createDataFrame([(d.file, d.rank, d.encoding, d.delimiter, d.header_line) for d in dialects],
                                  "file string, rank int, encoding string, delimiter string, header_row int")
    rows = read_extracts(spark, directory, key).where("_part = 0").groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    out = facts.join(rows, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    if digest:
        sums = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(directory)
                .select(F.col("_metadata.file_name").alias("file"), F.sha2("content", 256).alias("sha256")))
        out = out.join(sums, "file")
    return out
