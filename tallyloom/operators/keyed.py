"""Two building blocks that stay even when one key holds a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from ..session import cut_lineage

# A key is hot when it holds more than 1/HOT_KEYS of the rows, so there are
# never more than HOT_KEYS of them: that bounds what is broadcast.
HOT_KEYS = 2048


# A table up to this many rows and bytes is broadcast; a larger one is joined by shuffle.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 8 << 20


def is_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS, most: int = MAX_BROADCAST_BYTES) -> bool:
    """At most ``limit`` rows, and at most ``most`` bytes in them. Looks at no more than ``limit`` + 1 rows."""
    width = F.lit(0)
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            width = width + 8
    found = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return found["n"] <= limit and (found["bytes"] or 0) <= most


def small_side(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it is shown to be small."""
    return F.broadcast(df) if is_small(df, limit) else df


def attach_by_key(big: DataFrame, small: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Inner join of ``small`` (one row per key) onto ``big``.

    ``weight`` is the number of rows each key has in ``big``. ``small`` is
    written once and looked at: a short one is broadcast; without hot keys one
    shuffle join does; else rows of hot keys meet a broadcast of at most
    ``HOT_KEYS`` rows and stay where they are, and only the others are shuffled.
    """
    keys = list(keys)
    small = cut_lineage(small)
    if is_small(small):
        return big.join(F.broadcast(small.drop(weight)), keys)
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_KEYS > total
    if small.where(hot).limit(1).count() == 0:
        return big.join(small.drop(weight), keys)
    hot_rows = F.broadcast(small.where(hot).drop(weight))
    spread = big.join(hot_rows, keys)
    shuffled = big.join(F.broadcast(small.where(hot).select(*keys)), keys, "left_anti").join(
        small.where(~hot).drop(weight), keys)
    return spread.unionByName(shuffled)


def row_numbers(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (),
                name: str = "row_no") -> DataFrame:
    """Number rows 1, 2, 3 ... by ``order``, restarting for each ``group``.

    Rows are range-partitioned, numbered inside each range, and shifted by the
    counts of the earlier ranges. A group spread over several ranges is the
    exception, and at most one group crosses each range border, so the table of
    shifts has no more rows than there are ranges.
    """
    spark = df.sparkSession
    group = list(group)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    # Rows of equal order would all fall into one range: the rest of the row spreads them.
    hashed = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    order = [*order, F.xxhash64(*hashed)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *group, *order).withColumn("_range", F.spark_partition_id())
    # The ranges come from a sample: fix them before they are read twice.
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = (counts.withColumn("_shift", F.sum("_n").over(before))
              .where(F.col("_shift") > 0).select(*group, "_range", "_shift"))
    inside = W.partitionBy("_range", *group).orderBy(*order)
    numbered = ranged.withColumn("_at", F.row_number().over(inside).cast("bigint"))
    return (numbered.join(F.broadcast(shifts), [*group, "_range"], "left")
            .withColumn(name, F.col("_at") + F.coalesce("_shift", F.lit(0)))
            .drop("_range", "_at", "_shift"))
