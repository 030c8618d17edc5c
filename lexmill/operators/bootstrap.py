"""Bootstrap by hash: a draw depends on seed, replicate, cell and place alone, never on the partitioning.

A cell of n units has places 1 to n and as many draws of each replicate, so the unit at a place makes the
draws of that number.  They go to the unit they hit in one shuffle, where it stands before them: no join, so
neither driver nor task ever holds all draws, or all of a cell.  Estimates are sums, combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import uniform
from .ranks import ranked


def draws(units: DataFrame, cells: list[str], key: str, seed: int, replicates: int) -> DataFrame:
    """The columns of `units` with b (the replicate) and times (how often the unit is drawn in it); units not drawn have no row.

    Of each cell as many units are drawn as it has, with repetition.
    """
    placed = ranked(units, cells, uniform(seed, F.col(key)), key).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    n, itself = F.col("population"), F.col("_b") == 0
    pick = F.least(F.floor(uniform(seed, F.col("_b"), *map(F.col, cells), F.col("rank")) * n) + 1, n)
    at = ["_at", *(f"_c{k}" for k in range(len(cells)))]  # places first: they sort faster than cells
    rows = placed.select(F.when(itself, F.col("rank")).otherwise(pick).alias("_at"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(cells)), "_b", F.when(itself, F.struct(*units.columns)).alias("_unit"))
    met = rows.withColumn("_unit", F.first("_unit").over(Window.partitionBy(*at).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
    times = met.where("_b > 0").groupBy(*at, "_b").agg(F.first("_unit").alias("_unit"), F.count(F.lit(1)).alias("times"))
    return times.select("_unit.*", F.col("_b").alias("b"), "times")


def means(units: DataFrame, cells: list[str], key: str, value: Column, seed: int, replicates: int, weight: Column | None = None) -> DataFrame:
    """(b, estimate): the weighted mean of `value` over the units drawn in each replicate."""
    w = F.lit(1.0) if weight is None else weight
    rows = draws(units.withColumn("_value", value.cast("double")).withColumn("_weight", w.cast("double")), cells, key, seed, replicates)
    w = F.col("_weight") * F.col("times")
    return rows.groupBy("b").agg((F.sum(w * F.col("_value")) / F.sum(w)).alias("estimate"))


def ratios(units: DataFrame, cluster: str, top: str, bottom: str, seed: int, replicates: int) -> DataFrame:
    """(b, estimate): sum of `top` over sum of `bottom`, over whole clusters drawn with repetition."""
    clusters = units.groupBy(cluster).agg(F.sum(top).alias("_top"), F.sum(bottom).alias("_bottom")).withColumn("_all", F.lit(1))
    rows = draws(clusters, ["_all"], cluster, seed, replicates)
    return rows.groupBy("b").agg((F.sum(F.col("times") * F.col("_top")) / F.sum(F.col("times") * F.col("_bottom"))).alias("estimate"))


def crossed(values: DataFrame, factors: list[str], value: str, seed: int, replicates: int) -> DataFrame:
    """(b, estimate): the mean of `value` where the levels of every factor are drawn for themselves, with repetition.

    values: a row per combination of levels (paired differences, say).  The k-th factor is drawn with seed + k.
    """
    rows, weight = values, F.lit(1)
    for k, f in enumerate(factors):
        levels = values.select(f).distinct().withColumn("_all", F.lit(1))
        picked = draws(levels, ["_all"], f, seed + k, replicates).select(f, "b", F.col("times").alias(f"_t{k}"))
        rows = rows.join(picked, [f] if not k else [f, "b"])
        weight = weight * F.col(f"_t{k}")
    return rows.groupBy("b").agg((F.sum(weight * F.col(value)) / F.sum(weight)).alias("estimate"))


def interval(estimates: DataFrame, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """One row: centre (mean), low and high (exact percentiles) and replicates."""
    return estimates.agg(F.avg("estimate").alias("centre"), F.percentile("estimate", low).alias("low"), F.percentile("estimate", high).alias("high"), F.count(F.lit(1)).alias("replicates"))
