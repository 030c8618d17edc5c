"""Profiles of tables: columns, counts of a candidate frame, and shares against quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What is counted of a candidate frame beside its rows and works, as columns of booleans.
FLAGS = ("with_text", "any_code", "explicit_primary", "one_class", "cleared")


def columns(rows: DataFrame) -> DataFrame:
    """(name, type, known, missing): a row per column, counted in one pass."""
    names = rows.columns
    counted = rows.agg(F.count(F.lit(1)).alias("_n"), *(F.count(F.col(f"`{c}`")).alias(f"_k{k}") for k, c in enumerate(names)))
    each = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(f"_k{k}").alias("known"), (F.col("_n") - F.col(f"_k{k}")).alias("missing")) for k, (c, t) in enumerate(rows.dtypes)))
    return counted.select(F.explode(each).alias("x")).select("x.*")


def candidates(frame: DataFrame, *keys: str, work: str = "work_id") -> DataFrame:
    """(keys, level, found, works, FLAGS): counts by all keys, then with one less from the right each time, down to the whole.

    level is the number of keys that were left out; those keys are null.  A null flag counts as false.
    """
    flags = [F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in FLAGS]
    left_out = sum((F.grouping(k) for k in keys[1:]), F.grouping(keys[0])).cast("long")
    return frame.rollup(*keys).agg(left_out.alias("level"), F.count(F.lit(1)).alias("found"), F.count_distinct(work).alias("works"), *flags)


def quotas(rows: DataFrame, key: str, least: float | None = None, most: float | None = None, groups: int = 0, within: tuple[str, ...] = ()) -> DataFrame:
    """(within, key, n, share, verdict): shares of each key, and whether they are above, below, ok, or of too few keys."""
    per = rows.groupBy(*within, key).agg(F.count(F.lit(1)).alias("n"))
    whole = per.groupBy(*within).agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_keys"))
    joined = per.join(whole, list(within)) if within else per.crossJoin(F.broadcast(whole))
    share = F.col("n").cast("double") / F.col("_all")
    verdict = F.when(F.col("_keys") < groups, "too few")
    verdict = verdict if most is None else verdict.when(share > most, "above")
    verdict = verdict if least is None else verdict.when(share < least, "below")
    return joined.select(*within, key, "n", share.alias("share"), verdict.otherwise("ok").alias("verdict"))
