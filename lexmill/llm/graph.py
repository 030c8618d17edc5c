"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so nothing is gathered in one place:
a vertex with very many edges is combined map-side for the minimum. The minima are
sent to all tasks while they are few; beyond that they are materialised first, so that the adaptive
planner sees two plain shuffles and can split the join of such a vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Minima of so many nodes at most are sent to all tasks (50 bytes each).
MAX_SENT_NODES = 1_000_000


def _mark(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free digest of (node, root)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64("node", "root"), F.lit(1 << 31))), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) that isn't the smallest of its component.

    Nodes are longs; a null end drops the edge.  Loops and repeated edges are
    allowed.  Without edges the result is empty.
    """
    now = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct()
    )
    now = cut(now)
    seen = _mark(now)
    while seen[0]:
        # every row points from a larger node to a smaller one, so a node without rows is its own minimum
        ready = F.broadcast if 2 * seen[0] <= MAX_SENT_NODES else cut
        low = ready(now.groupBy("node").agg(F.min("root").alias("m")))
        around = now.select(F.col("root").alias("node"), F.col("node").alias("root")).join(low, "node", "left")
        large = around.select(F.col("root").alias("node"), F.coalesce("m", "node").alias("root")).distinct()
        large = cut(large)
        low = ready(large.groupBy("node").agg(F.min("root").alias("m")))
        small = (
            large.join(low, "node")
            .select(F.when(F.col("root") == F.col("m"), F.col("node")).otherwise(F.col("root")).alias("node"), F.col("m").alias("root"))
            .distinct()
        )
        now = cut(small)
        before, seen = seen, _mark(now)
        if before == seen:
            break
    return now
