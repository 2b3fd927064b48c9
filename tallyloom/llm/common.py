"""What the operators share: tables in the shared folder, and hashed words in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, stage_path

# Texts are worked on in pieces of about this many bytes, which bounds a task's memory.
PIECE = 1 << 20

# A table that counting shows to be no longer than this may be broadcast (rows of one or two numbers).
BROADCAST_ROWS = 1_000_000

M64 = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the files.

    The files outlive executors, so a lost one costs no recomputation of what
    lies before, and a random-free copy is what every later branch reads."""
    shared_dir(df.sparkSession)
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(*tables: DataFrame) -> None:
    """Delete the files of ``staged`` tables that nothing reads any more; what was made of them is staged itself. The
    shuffle files of the jobs before go, too: Spark deletes them once the driver has collected its garbage."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for file in table.inputFiles()[:1]:
            folder = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    for context in {id(t.sparkSession.sparkContext): t.sparkSession.sparkContext for t in tables}.values():
        context._jvm.System.gc()


def short(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` (rows of a few numbers) if it has at most ``limit`` rows; else leave it to a shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Words:
    """A kind of word, given by its bytes, and the hash of each one.

    ``word_bytes`` are the bytes a word is made of; A-Z count as a-z. A word's
    hash is a polynomial over its bytes, so all words of a piece come from one
    running sum."""

    def __init__(self, word_bytes: Iterable[int], seed: int = 7):
        self.inside = np.zeros(256, bool)
        self.inside[list(word_bytes)] = True
        value = seeds(256, seed)
        value[65:91] = value[97:123]
        self.value = value
        self.base = 0x9E3779B97F4A7C15 | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._powers = self._inverses = np.zeros(0, np.uint64)

    def __getstate__(self):
        return self.__dict__ | {"_powers": np.zeros(0, np.uint64), "_inverses": np.zeros(0, np.uint64)}

    def _up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            for name, base in (("_powers", self.base), ("_inverses", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self._powers, self._inverses

    def _segments(self, data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """[lo, hi) in segments that end outside a word."""
        while lo < hi:
            end = min(lo + PIECE, hi)
            while end < hi:
                gap = np.flatnonzero(~self.inside[data[end:min(end + PIECE, hi)]])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(end + PIECE, hi)
            yield lo, end
            lo = end

    def spans(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """First byte, byte behind the end, and hash of the words of a buffer of
        texts, text ``k`` from ``bounds[k]`` to ``bounds[k + 1]``; segment by segment."""
        for lo, hi in self._segments(data, int(bounds[0]), int(bounds[-1])):
            part = data[lo:hi]
            inside = self.inside[part]
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            cut = bounds[np.searchsorted(bounds, lo, "right"):np.searchsorted(bounds, hi, "left")] - lo
            first[cut] |= inside[cut]
            last[cut - 1] |= inside[cut - 1]
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            powers, inverses = self._up_to(len(part))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.value[part] * powers[:len(part)], out=total[1:])
            hashes = (total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64)
            yield starts + lo, ends + lo, mix(hashes)

    def hashes(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and the number of the first word of each text (one more at the end)."""
        starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for s, _, h in self.spans(data, bounds):
            starts.append(s)
            hashes.append(h)
        return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds, "left")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null as empty), and where each text begins (one more at the end)."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = (np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
              if len(column) else np.zeros(1, np.int64))
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


def pieces(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The rows in pieces of about PIECE bytes of text (a longer text is a piece of its own), with their ``buffers``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = buffers(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE, "right")) - 1)
            yield batch.slice(row, end - row), data, bounds[row:end + 1]
            row = end


def shingles(hashes: np.ndarray, firsts: np.ndarray, width: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words, and the number of the first one of
    each text. A text of fewer words, but not none, gives its whole sequence."""
    factor = seeds(width, seed)
    n = len(hashes)
    lengths = np.diff(firsts)
    counts = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    at = np.repeat(firsts[:-1] - starts[:-1], counts) + np.arange(starts[-1])
    out = np.full(len(at), np.uint64(width), np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    limit = np.repeat(firsts[1:], counts)
    partial = lengths[(lengths > 0)].min(initial=width) < width
    for k in range(width):
        word = padded[at + k]
        if partial:
            word = np.where(at + k < limit, word, np.uint64(0))
        out += word * factor[k]
    return (mix(out) if n else out), starts
