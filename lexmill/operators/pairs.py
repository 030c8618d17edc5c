"""Pairs of rows that belong together: spans that overlap, marked rows with controls, sources left out in turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import uniform


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Length of the common part of [a, b) and [c, d) over that of both together; 0 without a common part."""
    return F.greatest(F.lit(0.0), F.try_divide(F.least(b, d) - F.greatest(a, c), F.greatest(b, d) - F.least(a, c)))


def match_spans(found: DataFrame, gold: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc, i, start, j, iou): spans of both sides that are each other's best, with an overlap of `least` of their union.

    found and gold: doc, i (or j), start, end.  Equal rows are one span.  Of equal overlaps the smaller number counts, then the earlier start.
    Spans meet within a document only, so a task holds the pairs of one document at a time.
    """
    f = found.select("doc", "i", "start", "end").distinct()
    g = gold.select("doc", "j", F.col("start").alias("c"), F.col("end").alias("d")).distinct()
    pairs = f.join(g, "doc").where((F.col("start") < F.col("d")) & (F.col("c") < F.col("end"))).withColumn("iou", overlap(F.col("start"), F.col("end"), F.col("c"), F.col("d"))).where(F.col("iou") >= least)
    mine = F.row_number().over(Window.partitionBy("doc", "i", "start").orderBy(F.desc("iou"), "j", "c"))
    theirs = F.row_number().over(Window.partitionBy("doc", "j", "c").orderBy(F.desc("iou"), "i", "start"))
    return pairs.withColumn("_m", mine).withColumn("_t", theirs).where("_m = 1 and _t = 1").select("doc", "i", "start", "j", "iou")


def matched(rows: DataFrame, marked: Column, buckets: list[str], key: str) -> DataFrame:
    """(marked, control, buckets): the n-th marked row of each bucket with its n-th other row, both in the order of `key`; the longer side's rest has no pair."""
    placed = rows.withColumn("_marked", marked).withColumn("_k", F.row_number().over(Window.partitionBy("_marked", *buckets).orderBy(key)))
    per = placed.groupBy(*buckets, "_k").agg(F.max(F.when(F.col("_marked"), F.col(key))).alias("marked"), F.max(F.when(~F.col("_marked"), F.col(key))).alias("control"))
    return per.where("marked is not null and control is not null").select("marked", "control", *buckets)


def leave_out(rows: DataFrame, source: str, label: str, works: int = 50, classes: int = 3, per_class: int = 10) -> DataFrame:
    """(held_out, label, test, train): sizes by class for every source that may be left out in turn; counts are joined, never rows.

    A source qualifies with `works` rows and `classes` classes of `per_class` rows at least.
    """
    counts = rows.groupBy(F.col(source).alias("held_out"), label).agg(F.count(F.lit(1)).alias("n"))
    fit = counts.groupBy("held_out").agg(F.sum("n").alias("all"), F.count_if(F.col("n") >= per_class).alias("classes")).where(f"all >= {works} and classes >= {classes}").select("held_out")
    whole = counts.groupBy(label).agg(F.sum("n").alias("total"))
    grid = fit.crossJoin(F.broadcast(whole))  # sources times classes
    test = F.coalesce("n", F.lit(0))
    return grid.join(counts, ["held_out", label], "left").select("held_out", label, test.cast("long").alias("test"), (F.col("total") - test).cast("long").alias("train"))


def masks(texts: DataFrame, key: str, words: Column, sets: int = 5, share: float = 0.15, seed: int = 23) -> DataFrame:
    """(key, mask_set, place): for each text and set the places of the masked words, drawn by hash; a text is handled by itself."""
    n = F.size(words)
    places = texts.select(key, n.alias("n"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(sets).cast("long"))).alias("mask_set"))
    each = F.transform(F.sequence(F.lit(1), F.col("n")), lambda p: F.struct(uniform(seed, F.col("mask_set"), F.col(key), p).alias("u"), p.cast("long").alias("place")))
    chosen = F.slice(F.array_sort(each), F.lit(1), F.ceil(F.lit(share) * F.col("n")).cast("int"))
    return places.where("n > 0").select(key, "mask_set", F.explode(chosen).alias("x")).select(key, "mask_set", "x.place")


def discovery(rows: DataFrame, work: Column, path: str) -> DataFrame:
    """(work, paths, found_in): one row per work, with all the ways it was found, sorted."""
    return rows.select(work.alias("work"), path).distinct().groupBy("work").agg(F.count(F.lit(1)).alias("paths"), F.array_join(F.sort_array(F.collect_list(path)), ",").alias("found_in"))


def zipped(rows: DataFrame, group: str, side: str, order: str, first: str, second: str) -> DataFrame:
    """(group, i, first, second): the i-th row (by `order`, from 1) of one side of a group with the i-th of the other; the longer side's rest is left out.

    Rows are numbered and meet by their number, so a large group is no array.
    """
    placed = rows.where(F.col(side).isin(first, second)).withColumn("i", F.row_number().over(Window.partitionBy(group, side).orderBy(order)).cast("long"))
    of = lambda s: F.max(F.when(F.col(side) == s, F.col(order)))
    return placed.groupBy(group, "i").agg(of(first).alias("first"), of(second).alias("second")).where("first is not null and second is not null")
