"""Append-only ingest of raw files (an extension: the batch rules, run as a stream).

A file that comes again with equal bytes adds a retrieval, not an artifact.
The set of known artifacts is the target table itself, so state doesn't grow in
the stream; each micro-batch is anti-joined with what the batches before it wrote, so
that a batch which runs again writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ARTIFACT = "artifact_id string, path string, length long"


def save_to(target: str) -> Callable[[DataFrame, int], None]:
    """Writes one micro-batch (artifact_id, path, length); the same batch again replaces its own rows only."""

    def save(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        retrievals = batch.select("artifact_id", "path")
        retrievals.write.mode("overwrite").parquet(f"{target}/retrievals/batch={number}")
        fresh = batch.groupBy("artifact_id").agg(F.min("path").alias("path"), F.min("length").alias("length"))
        known = session.createDataFrame([], ARTIFACT)
        if number:
            known = session.read.schema(f"{ARTIFACT}, batch long").option("basePath", f"{target}/artifacts").parquet(f"{target}/artifacts").where(F.col("batch") < number)
        fresh.join(known.select("artifact_id"), "artifact_id", "left_anti").write.mode("overwrite").parquet(f"{target}/artifacts/batch={number}")

    return save


def ingest(spark: SparkSession, landing: str, target: str, checkpoint: str) -> StreamingQuery:
    """Writes new artifacts to target/artifacts and every file to target/retrievals, once for all files there."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(landing)
    rows = files.select(F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("artifact_id"), "path", "length")
    return rows.writeStream.foreachBatch(save_to(target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
