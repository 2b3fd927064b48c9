"""Contiguous shards of equal bytes from global prefix sums of sizes.

Rows stand in the order of the MD5 of their text, which puts equal texts side
by side and has nothing to do with where a row was read. The sizes are summed
per range of that order, the running totals of the ranges give where each cut
falls, and only the ranges with a cut in them are looked at row by row. A shard
is then an interval between two cut keys: assigning a row is a comparison, no join.

Equal texts stay in one shard. Groups of copies that weigh more than ``fine`` of
a shard would make the cuts uneven; there are at most ``n / fine`` of them, and
they are dealt out first, the heaviest to the lightest shard, before the cuts
fill each shard up to the common target. A group heavier than a whole shard
(over ``1 + slack`` targets) cannot stay whole: it is cut like all else, by the
MD5 of its ids.

Null text: no bytes, size 8, a group of its own. Null ids order as empty text.
Rows that repeat are rows like all others. Columns but id and text are not
looked at; an input column named like an output column is replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import staged

ROW_BYTES = 8
NO_TEXT = "0" * 32


def row_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def group_key(text: str = "text") -> Column:
    """Equal for equal texts, spread evenly over 128 bits, in hexadecimal digits."""
    return F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(NO_TEXT))


def id_key(doc_id: str) -> Column:
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def deal(sizes: list[int], n: int) -> tuple[list[int], list[int]]:
    """Sizes, heaviest first, each to the lightest shard: the shard of each, and the loads."""
    heap, where, loads = [(0, s) for s in range(n)], [], [0] * n
    for size in sizes:
        load, shard = heapq.heappop(heap)
        loads[shard] = load + size
        heapq.heappush(heap, (loads[shard], shard))
        where.append(shard)
    return where, loads


def cut_places(loads: list[int], total: int) -> list[int]:
    """Where the cuts fall among ``total`` bytes, so that shards with these loads end up level."""
    room = total + sum(loads)
    gaps = [max(0.0, room / len(loads) - x) for x in loads]
    scale = total / sum(gaps) if sum(gaps) else 0
    places, at = [], 0.0
    for gap in gaps[:-1]:
        at += gap * scale
        places.append(round(at))
    return places


def cut_keys(keys: DataFrame, places: list[int], prefix: int) -> list[str]:
    """The first key at or behind each place. ``keys``: key, bytes (a key may repeat)."""
    ranges = keys.groupBy(F.substring("key", 1, prefix).alias("range")).agg(F.sum("bytes").alias("bytes"))
    # One row per range of the order: at most 16 ** prefix, whatever the input.
    before = F.sum("bytes").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    ranges = [(r.range, r.start, r.start + r.bytes) for r in
              ranges.withColumn("start", F.coalesce(before, F.lit(0))).orderBy("range").collect()]
    inside = {}
    for place in places:
        hit = next(((r, s) for r, s, e in ranges if s <= place < e), None)
        if hit:
            inside[hit[0]] = hit[1]
    if not inside:
        return ["g"] * len(places)
    start = F.element_at(F.create_map(*[F.lit(x) for pair in inside.items() for x in pair]), F.col("range"))
    running = F.sum("bytes").over(W.partitionBy("range").orderBy("key"))
    cells = (keys.withColumn("range", F.substring("key", 1, prefix)).where(F.col("range").isin(list(inside)))
             .groupBy("range", "key").agg(F.sum("bytes").alias("bytes"))
             .withColumn("end", start + running).withColumn("start", F.col("end") - F.col("bytes")))
    # A cut goes behind the key in whose middle it falls, or before it, whichever is nearer.
    wanted = [F.min(F.when(F.col("start") + F.col("bytes") / 2 >= F.lit(p), F.col("key"))).alias(f"c{i}")
              for i, p in enumerate(places)]
    found = list(cells.agg(*wanted).first())
    # A place behind the middle of its range's last key: the cut is where the next range begins.
    out = []
    for key, place in zip(found, places, strict=True):
        behind = next((r for r, s, e in ranges if s >= place and r not in inside), None)
        options = [k for k in (key, behind) if k is not None]
        out.append(min(options) if options else "g")
    return sorted(out)


def with_shards(docs: DataFrame, n: int, doc_id: str = "doc_id", text: str = "text", prefix: int = 3,
                fine: float = 0.01, slack: float = 0.05) -> DataFrame:
    """Every row with its ``size``, and the ``shard`` of [0, n) it goes to.

    Reads the texts twice: for the sizes of all groups (pre-aggregated where
    they lie), and to tell each row its shard, which moves nothing. The driver
    sees the ranges' totals, ``n`` cuts and at most ``n / fine`` sizes."""
    rows = docs.select(group_key(text).alias("key"), row_size(text).alias("bytes"), id_key(doc_id).alias("id"))
    groups = staged(rows.groupBy("key").agg(F.sum("bytes").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    target = total / n
    heavy = groups.where((F.col("bytes") > fine * target) & (F.col("bytes") <= (1 + slack) * target))
    order = [F.desc("bytes"), F.asc("key")]
    sizes = [r.bytes for r in heavy.orderBy(*order).select("bytes").collect()]
    where, loads = deal(sizes, n)
    split = [r.key for r in groups.where(F.col("bytes") > (1 + slack) * target).select("key").collect()]

    light = groups.where((F.col("bytes") <= fine * target) & ~F.col("key").isin(split) if split
                         else F.col("bytes") <= fine * target)
    if split:
        parts = (rows.where(F.col("key").isin(split))
                 .select(F.concat("key", F.substring("id", 1, prefix)).alias("key"), "bytes"))
        light = light.unionByName(parts)
    cuts = cut_keys(light, cut_places(loads, total - sum(loads)), prefix)

    out = docs.drop("size", "shard").withColumn("_shard_key", group_key(text))
    place = F.col("_shard_key")
    if split:
        place = F.when(place.isin(split), F.concat(place, F.substring(id_key(doc_id), 1, prefix))).otherwise(place)
    shard = sum((place >= F.lit(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    if where:
        dealt = (heavy.select(F.col("key").alias("_shard_key"),
                              F.row_number().over(W.orderBy(*order)).alias("_shard_rank"))
                 .select("_shard_key", F.element_at(F.lit(where), F.col("_shard_rank")).alias("_dealt")))
        out = out.join(F.broadcast(dealt), "_shard_key", "left")  # at most n / fine rows
        shard = F.coalesce("_dealt", shard)
    return (out.withColumn("size", row_size(text)).withColumn("shard", shard.cast("int"))
            .drop("_shard_key", "_dealt"))


def with_slots(rows: DataFrame, doc_id: str = "doc_id", lanes: int = 256) -> DataFrame:
    """Every row with its ``slot``, 0, 1, 2 ... within its shard.

    A shard's rows are dealt over ``lanes`` by the MD5 of their id and numbered
    inside each; the lanes' counts (shards times lanes rows) shift them."""
    rows = rows.drop("slot").withColumn("_lane", F.conv(F.substring(id_key(doc_id), 1, 6), 16, 10).cast("int") % lanes)
    counts = rows.groupBy("shard", "_lane").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("shard").orderBy("_lane").rowsBetween(W.unboundedPreceding, -1))
    shifts = counts.select("shard", "_lane", F.coalesce(before, F.lit(0)).alias("_shift"))
    at = F.row_number().over(W.partitionBy("shard", "_lane").orderBy(doc_id))
    return (rows.withColumn("_at", at).join(F.broadcast(shifts), ["shard", "_lane"])
            .withColumn("slot", F.col("_at") - 1 + F.col("_shift")).drop("_lane", "_at", "_shift"))


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder per shard."""
    rows.repartition("shard", "slot").write.partitionBy("shard").parquet(path)
