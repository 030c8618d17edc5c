"""Agreement of labels, scores of classes and association of two columns, all from one table of cells.

A table of cells (a, b, n) has a row for every pair of values, also for pairs that never
occur; it is as large as the classes are many, so everything after it is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What an annotator may answer.
OUTCOMES = ("C1", "C2", "C3", "C4", "C5", "OTHER", "AMBIGUOUS", "INSUFFICIENT")


def cells(pairs: DataFrame, a: str, b: str, values: tuple | None = None, weight: Column | None = None) -> DataFrame:
    """(a, b, n): count, or sum of `weight`, of every pair of values; rows with a null in either column don't count.

    values: all values of both columns; without it, those of each column that occur.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight.cast("double"))
    seen = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(n.alias("n"))
    if values is None:
        rows, cols = seen.select("a").distinct(), seen.select("b").distinct()
    else:
        domain = pairs.sparkSession.createDataFrame([(v,) for v in values], "v " + pairs.schema[a].dataType.simpleString())
        rows, cols = domain.withColumnRenamed("v", "a"), domain.withColumnRenamed("v", "b")
    return rows.crossJoin(cols).join(seen, ["a", "b"], "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"))  # classes times classes


def paired_answers(labels: DataFrame, item: str = "annotation_item_id", decision: str = "annotator_decision", order: str = "label_record_id") -> DataFrame:
    """(item, first, second): the answers of items that have exactly two."""
    per = labels.groupBy(item).agg(F.array_sort(F.collect_list(F.struct(order, decision))).alias("x")).where("size(x) = 2")
    return per.select(item, F.col("x")[0][decision].alias("first"), F.col("x")[1][decision].alias("second"))


def kappa(table: DataFrame) -> DataFrame:
    """One row: observed, expected and kappa (null where the expected agreement is 1)."""
    n = F.col("n").cast("double")
    total = table.agg(F.sum(n).alias("t"), F.sum(F.when(F.col("a") == F.col("b"), n).otherwise(0.0)).alias("same"))
    rows, cols = table.groupBy("a").agg(F.sum(n).alias("ra")), table.groupBy("b").agg(F.sum(n).alias("rb"))
    chance = rows.join(cols, F.col("a") == F.col("b")).agg(F.sum(F.col("ra") * F.col("rb")).alias("x"))
    both = total.crossJoin(chance).select(F.try_divide(F.col("same"), F.col("t")).alias("observed"), F.try_divide(F.col("x"), F.col("t") * F.col("t")).alias("expected"))
    return both.withColumn("kappa", F.try_divide(F.col("observed") - F.col("expected"), F.nullif(1 - F.col("expected"), F.lit(0.0))))


def class_scores(table: DataFrame, classes: tuple | None = None) -> DataFrame:
    """(c, tp, fp, fn, precision, recall, f1) of each class; `a` is the truth, `b` the guess.  Guesses outside `classes` count against the truth."""
    side = F.array(F.struct(F.col("a").alias("c"), F.lit("a").alias("side")), F.struct(F.col("b").alias("c"), F.lit("b").alias("side")))
    rows = table.select("a", "b", "n", F.explode(side).alias("s")).select("a", "b", "n", "s.*")
    hit, n = F.col("a") == F.col("b"), F.col("n").cast("double")
    total = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0.0))
    per = rows.groupBy("c").agg(total(hit & (F.col("side") == "a")).alias("tp"), total(~hit & (F.col("side") == "b")).alias("fp"), total(~hit & (F.col("side") == "a")).alias("fn"))
    if classes is not None:
        per = per.where(F.col("c").isin(*classes))
    zero = lambda x, y: F.coalesce(F.try_divide(x, F.nullif(y, F.lit(0.0))), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return per.select("c", "tp", "fp", "fn", zero(tp, tp + fp).alias("precision"), F.try_divide(tp, F.nullif(tp + fn, F.lit(0.0))).alias("recall"), zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def f1_summary(scores: DataFrame) -> DataFrame:
    """One row: macro_f1, micro_f1 (the share of hits), weighted_f1 and balanced_accuracy."""
    support = F.col("tp") + F.col("fn")
    return scores.agg(F.avg("f1").alias("macro_f1"), F.try_divide(F.sum("tp"), F.sum(support)).alias("micro_f1"), F.try_divide(F.sum(F.col("f1") * support), F.sum(support)).alias("weighted_f1"), F.avg("recall").alias("balanced_accuracy"))


def association(table: DataFrame) -> DataFrame:
    """One row: cramers_v and mutual information in nats."""
    o = F.col("n").cast("double")
    over = lambda *keys: F.sum(o).over(Window.partitionBy(*keys))
    rows = table.select("a", "b", o.alias("o"), over("a").alias("ra"), over("b").alias("rb"), over().alias("t"))
    e = F.col("ra") * F.col("rb") / F.col("t")
    chi = F.sum((F.col("o") - e) * (F.col("o") - e) / e)
    nats = F.sum(F.when(F.col("o") > 0, F.col("o") / F.col("t") * F.log(F.col("o") * F.col("t") / (F.col("ra") * F.col("rb")))).otherwise(0.0))
    size = F.max("t") * (F.least(F.count_distinct("a"), F.count_distinct("b")) - 1)
    return rows.agg(F.sqrt(F.try_divide(chi, size)).alias("cramers_v"), nats.alias("mutual_information"))


def as_map(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One row with a map of a small table."""
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias(name))


def one_row(*frames: DataFrame) -> DataFrame:
    """The columns of several tables of one row each, side by side: a report."""
    return reduce(lambda x, y: x.crossJoin(F.broadcast(y)), frames)
