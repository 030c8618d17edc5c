"""Connected components of small label graphs (journals and classes) by minimum labels and pointer jumping."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where all runs on one machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="lexmill-")


def label_components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, from edges (a, b).

    Every round is a join and a grouped minimum; each result is checkpointed, so a lost executor
    costs one round.
    """
    spark = edges.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")).checkpoint()
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "m").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("over"))
        new = step.join(jump, "label", "left").select("node", F.coalesce("over", "label").alias("label")).checkpoint()
        if new.exceptAll(labels).isEmpty():
            return new
        labels = new
