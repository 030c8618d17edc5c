"""Ranks without a task that holds a whole stratum.

A row's rank in its stratum, in the order of a number in [0, 1), is the count of rows in
lower buckets of that number plus its place in its own bucket.  Buckets are
counted first; offsets are running sums over bucket counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a stratum: a task sorts this part of one.
BUCKETS = 1024


def ranked(rows: DataFrame, strata: list[str], draw: Column, *ties: str, buckets: int = BUCKETS) -> DataFrame:
    """`rows` with rank (from 1) and population within each stratum, in the order of `draw` (a number in [0, 1)), then `ties`.

    Nulls in a stratum's columns are a value.  Rows that tie in everything take consecutive ranks.
    """
    data = rows.withColumn("_draw", draw).withColumn("_bucket", F.floor(F.col("_draw") * buckets).cast("int"))
    counts = data.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(*strata)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*(F.col(s).alias(f"_s{k}") for k, s in enumerate(strata)), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_before"), F.sum("_size").over(whole).alias("population"))
    inside = Window.partitionBy(*strata, "_bucket").orderBy("_draw", *ties)
    placed = data.withColumn("_place", F.row_number().over(inside))
    on = F.col("_bucket") == F.col("_b")
    for k, s in enumerate(strata):
        on &= F.col(s).eqNullSafe(F.col(f"_s{k}"))
    out = placed.join(offsets, on).withColumn("rank", F.col("_before") + F.col("_place"))
    return out.select(*rows.columns, "rank", "population")


def by_value(rows: DataFrame, value: str, *ties: str, parts: int = 256) -> DataFrame:
    """`rows` with rank (from 1) and population over the whole table, in the order of a number and then `ties`.

    Parts are cut at approximate quantiles of the value, so that they are of like size however it is
    distributed; equal values lie in one part.  Nulls come first.
    """
    cuts = rows.agg(F.percentile_approx(F.col(value).cast("double"), [k / parts for k in range(1, parts)], 100 * parts).alias("c")).first()["c"]
    edges = sorted(set(cuts or []))
    part = F.when(F.col(value).isNull(), -1).otherwise(F.size(F.filter(F.lit(edges) if edges else F.array().cast("array<double>"), lambda e: e < F.col(value).cast("double"))))
    data = rows.withColumn("_part", part)
    counts = data.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # `parts` rows
    offsets = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy()).alias("population"))
    placed = data.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(F.asc_nulls_first(value), *ties)))
    out = placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p")).withColumn("rank", F.col("_before") + F.col("_place"))
    return out.select(*rows.columns, "rank", "population")


def ntile(rank: Column, population: Column, n: int) -> Column:
    """The n-th part that a rank lies in, the first parts larger by one, as SQL's ntile."""
    small, large = F.floor(population / n), population % n
    edge = large * (small + 1)
    return F.when(rank <= edge, F.floor((rank - 1) / (small + 1)) + 1).otherwise(large + F.floor((rank - 1 - edge) / F.greatest(small, F.lit(1))) + 1).cast("long")


def largest_remainder(rows: DataFrame, strata: list[str], parts: dict[str, int], size: str = "population", within: tuple[str, ...] = ()) -> DataFrame:
    """`rows` (a row per stratum, with its size) with upto_<part>: up to which rank a part's rows go, the parts one after another.

    The running sums of the parts' numbers are shared over the strata (of each value of `within`) in proportion to size, by largest
    remainder; where there are fewer rows than the parts hold together, the numbers shrink in
    proportion.  The table of strata is small: one task ranks it.
    """
    out, total = rows, sum(parts.values())
    whole = Window.partitionBy(*within)
    all_rows = F.sum(size).over(whole)
    upto = 0
    for part, number in parts.items():
        upto += number
        here = F.floor(F.lit(upto) * F.least(F.lit(total), all_rows) / total)
        out = out.withColumn("_here", here).withColumn("_exact", F.col("_here").cast("double") * F.col(size) / all_rows).withColumn("_floor", F.floor("_exact"))
        out = out.withColumn("_left", F.col("_here") - F.sum("_floor").over(whole))
        out = out.withColumn("_place", F.row_number().over(whole.orderBy(F.desc(F.round(F.col("_exact") - F.col("_floor"), 9)), *strata)))
        out = out.withColumn(f"upto_{part}", F.col("_floor") + F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)).drop("_here", "_exact", "_floor", "_left", "_place")
    return out


def dealt(rows: DataFrame, strata: list[str], draw: Column, key: str, parts: dict[str, int], within: tuple[str, ...] = (), most_share: float | None = None) -> DataFrame:
    """(key, strata, part): rows dealt to parts of given sizes, each stratum in proportion to its size; rows over the sizes are in no part.

    within: the parts have their sizes for each value of these columns, which are among the strata.
    most_share: no stratum counts for more than this share of the parts together.
    """
    placed = ranked(rows.select(key, *strata), strata, draw, key)
    sizes = placed.groupBy(*strata).agg(F.max("population").alias("population"))
    if most_share is not None:
        sizes = sizes.withColumn("population", F.least("population", F.floor(F.lit(most_share * sum(parts.values())))))
    quotas = largest_remainder(sizes, strata, parts, within=within)
    renamed = quotas.select(*(F.col(s).alias(f"_q{k}") for k, s in enumerate(strata)), *(f"upto_{p}" for p in parts))
    on = F.lit(True)
    for k, s in enumerate(strata):
        on &= F.col(s).eqNullSafe(F.col(f"_q{k}"))
    part = F.coalesce(*(F.when(F.col("rank") <= F.col(f"upto_{p}"), p) for p in parts))
    return placed.join(renamed, on).withColumn("part", part).where("part is not null").select(key, *strata, "part")
