"""Mixing sources to target weights by Pfair scheduling.

A source of weight w owes its j-th block (from 0) not before slot floor(j / w)
and before slot ceil((j + 1) / w).  In every slot the released block with the
earliest deadline goes out.  The weights are taken exactly (a float is a ratio of
whole numbers), and the driver schedules every block there is, so that no source
is ever a block or more away from its target, however many blocks there are.  A block
has BLOCK_ROWS rows, or as many times two more as it takes for the table to have no more than
MAX_BLOCKS blocks: the driver holds, and the tasks are sent, 8 bytes a block.

Ranks inside a source need no global sort: rows are dealt into BUCKETS hashed
buckets per source, a bucket's rank offset is a running sum over bucket counts,
and only the rows of one bucket are sorted together.
"""

from __future__ import annotations

import heapq
from array import array
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import count_of, cut

BUCKETS = 4096
BLOCK_ROWS = 16
MAX_BLOCKS = 1 << 22
#: Slots of consecutive blocks of a source that go to the tasks as one row.
SLOTS = 512
#: The list of sources is held on the driver; more than this many is an error.
MAX_SOURCES = 1_000_000
#: Rank offsets of so many buckets at most are sent to all executors (60 bytes each).
MAX_SENT_STARTS = 500_000
#: Target weights go as this power of the rows, where none are given.
TEMPERATURE = 0.7


def exact_parts(weights: dict) -> dict:
    """Whole numbers in exactly the proportion of the weights."""
    ratios = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(r.denominator for r in ratios.values()))
    return {s: r.numerator * (scale // r.denominator) for s, r in ratios.items()}


def schedule_blocks(parts: dict, blocks: dict) -> dict:
    """The slots of the first `blocks` blocks of each source, earliest deadline first.

    Until the first source is through, a block is released in every slot; after
    that the clock jumps to the next release where none is, and no slot stays empty.
    """
    total = sum(parts.values())
    names = sorted(parts, key=str)
    share, left = [parts[s] for s in names], [blocks[s] for s in names]
    slots = [array("q") for _ in names]
    waiting = [(0, -(-total // p), k) for k, p in enumerate(share) if left[k]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    slot = now = 0
    while waiting or ready:
        if not ready:
            now = max(now, waiting[0][0])
        while waiting and waiting[0][0] <= now:
            _, deadline, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, k))
        k = heapq.heappop(ready)[1]
        slots[k].append(slot)
        j = len(slots[k])
        if j < left[k]:
            heapq.heappush(waiting, (j * total // share[k], -(-(j + 1) * total // share[k]), k))
        slot, now = slot + 1, now + 1
    return dict(zip(names, slots, strict=True))


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int | None = None, columns: tuple[str, ...] | None = None) -> DataFrame:
    """`columns` of every input row with mix_rank, mix_slot, mix_position and on_target.

    docs: source and `columns` (all by default).  mix_rank is the row's
    place in its source in hashed order, mix_slot the slot of its block,
    mix_position = mix_slot * block_rows + place in the block: sorted by it, the
    rows are the mixture.  on_target is false from the first slot on in which some source had
    no row left for its due block: the target can't be met there.

    weights: source -> positive weight (int, float or Fraction), all sources of `docs` that have no
    weight get the smallest one; null is a source of its own (key None).  No row
    is dropped or repeated.  Null, empty and very long texts count as any other row.  Rows are ordered by all
    their columns (but maps), so only equal rows tie; they take a place each.  An empty table
    gives no rows.  Columns named like the four new ones are replaced; no other name clashes.
    """
    spark = docs.sparkSession
    new = ("mix_rank", "mix_slot", "mix_position", "on_target")
    names = [c for c in (columns or docs.columns) if c not in new]
    every = [F.col(f"`{f.name}`") for f in docs.select(*(f"`{c}`" for c in names)).schema.fields if f.dataType.typeName() != "map"]
    data = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("source").cast("string").alias("owner"), F.xxhash64(*every).alias("mark"))
    data = data.withColumn("bucket", F.pmod("mark", F.lit(BUCKETS)).cast("int"))
    sizes = cut(data.groupBy("owner", "bucket").agg(F.count(F.lit(1)).alias("size")))
    counts = {r["owner"]: r["n"] for r in sizes.groupBy("owner").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if block_rows is None:
        block_rows = BLOCK_ROWS
        while sum(counts.values()) // block_rows > MAX_BLOCKS:
            block_rows *= 2
    plan, horizon = _plan(counts, weights, block_rows)
    plan = spark.createDataFrame(plan)
    by_bucket = Window.partitionBy("owner").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("owner").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("size").over(by_bucket), F.lit(0)).alias("start"))
    if count_of(sizes) <= MAX_SENT_STARTS:
        starts = F.broadcast(starts)
    in_bucket = Window.partitionBy("owner", "bucket").orderBy(F.xxhash64("mark", F.lit(7)), "mark")
    ranked = data.withColumn("place", F.row_number().over(in_bucket) - 1)
    ranked = ranked.join(starts, F.col("owner").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select("row", "owner", (F.col("start") + F.col("place")).alias("rank"))
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block_rows))
    out = ranked.join(F.broadcast(plan), F.col("owner").eqNullSafe(F.col("s")) & (F.floor(F.col("block") / SLOTS) == F.col("list")))
    out = out.withColumn("slot", F.get("slots", (F.col("block") % SLOTS).cast("int")))
    return out.select("row.*", F.col("rank").alias("mix_rank"), F.col("slot").alias("mix_slot"), (F.col("slot") * block_rows + F.col("rank") % block_rows).alias("mix_position"), (F.col("slot") < horizon).alias("on_target"))


def _plan(counts: dict, weights: dict | None, block_rows: int) -> tuple[pa.Table, int]:
    """(s, list, slots) of every source, and the first slot that is off target."""
    heads: list[tuple] = []
    values, sizes = [np.zeros(0, np.int64)], [0]
    horizon = 0
    if counts:
        target = {s: n**TEMPERATURE for s, n in counts.items()}
        if weights:
            least = min(weights.values())
            target = {s: weights.get(s, least) for s in counts}
        if min(target.values()) <= 0:
            raise ValueError("a weight isn't positive")
        # one block more than is full: where it is due, the source has too few rows
        slots = schedule_blocks(exact_parts(target), {s: n // block_rows + 1 for s, n in counts.items()})
        horizon = min(each[-1] for each in slots.values())
        for s, each in slots.items():
            values.append(np.frombuffer(each, np.int64))
            for k in range(0, len(each), SLOTS):
                heads.append((s, k // SLOTS))
                sizes.append(min(SLOTS, len(each) - k))
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(values)))
    return pa.table({"s": pa.array([h[0] for h in heads], pa.string()), "list": pa.array([h[1] for h in heads], pa.int64()), "slots": lists}), horizon
