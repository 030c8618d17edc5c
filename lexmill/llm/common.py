"""Shared plumbing: table access, lineage cuts and vectorised text hashing.

Text hashing works on UTF-8 bytes of many documents at once.  A prefix sum of
``table[byte] * M**i`` (mod 2**64) gives the hash of any byte range in O(1),
so words, lines and fixed windows cost a few numpy passes and no Python loop
over words.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1
#: Texts are hashed in packs of about this many bytes, so that arrays stay in cache.
PACK_BYTES = 1 << 17


# ------------------------------------------------------------------ Spark side


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a local one is made only where none is set and all runs on one machine."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    return where


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the file system that Spark knows it by."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Lets Spark drop the shuffle files of a query once its result is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` on shared storage: later stages never recompute what is above.

    The shuffle files behind it go as soon as it is written.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new plan, which reads the setting
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def count_of(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_rows(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A mapInArrow function that applies `fn` to slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                yield fn(part)

    return run


def sliced(batch: pa.RecordBatch, column: str = "text", limit: int = PACK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices whose `column` holds at most `limit` bytes, one row at least."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each row; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [b or b"" for b in col.cast(pa.large_binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal `key`, a table each, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.flatnonzero(col[1:] != col[:-1]) + 1, [len(col)]))
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if held and col[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = col[lo]
    if held:
        yield pa.Table.from_batches(held)


# ------------------------------------------------------------------ hashing

_RNG = np.random.Generator(np.random.PCG64(20240917))
BYTE_TABLE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x5851F42D4C957F2D
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if len(_powers[0]) < n:
        size = max(n, PACK_BYTES + 4096)
        for k, base in enumerate((BASE, _INVERSE)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Pack:
    """Byte texts joined by one separator byte, with hashes of any range."""

    def __init__(self, texts: list[bytes], separator: bytes = b" ", table: np.ndarray = BYTE_TABLE):
        self.sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes + 1) - 1
        self.starts = self.ends - self.sizes
        self.raw = separator.join(texts) + separator
        self.bytes = np.frombuffer(self.raw, np.uint8)
        n = len(self.bytes)
        power, self.inverse = powers(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.bytes] * power[:n], out=self.prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]

    def hash_fixed(self, size: int) -> np.ndarray:
        """Hash of the `size` bytes from each position on."""
        if len(self.bytes) < size:
            return np.zeros(0, np.uint64)
        return (self.prefix[size:] - self.prefix[:-size]) * self.inverse[: len(self.prefix) - size]


#: The white space bytes 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(pack: Pack) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word [^\\x20\\x09-\\x0D]+."""
    space = SPACE[pack.bytes]
    edge = np.ones(len(space) + 1, bool)
    edge[1:] = space
    start = np.flatnonzero(edge[:-1] & ~space)
    end = np.flatnonzero(space & ~edge[:-1])
    counts = np.diff(np.searchsorted(start, pack.ends), prepend=0)
    return start, end, np.repeat(np.arange(len(counts)), counts)


def rolled(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes (runs may cross documents)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += words[k : len(words) - n + 1 + k]
    return mix64(h)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text, A-Z lower-cased.

    A text with fewer than n words, but one at least, has one shingle: all of them.
    """
    pack = Pack([t.lower() for t in texts])
    start, end, doc = word_spans(pack)
    words = mix64(pack.hash(start, end))
    grams = rolled(words, n)
    counts = np.bincount(doc, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(counts)))
    out = []
    for k in range(len(texts)):
        lo, hi = at[k], at[k + 1]
        if hi - lo >= n:
            g = np.sort(grams[lo : hi - n + 1])
            keep = np.ones(len(g), bool)
            keep[1:] = g[1:] != g[:-1]
            out.append(g[keep])
        elif hi > lo:
            out.append(rolled(words[lo:hi], int(hi - lo)) ^ np.uint64(hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
