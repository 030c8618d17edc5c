"""Steps that apply an operator's decisions to the table `documents`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import decontaminate, minhash, mixing, quality, secrets
from .common import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Tables of keys, and what goes with them, are sent to all executors up to this size.
MAX_SENT_BYTES = 40 << 20
ROW_BYTES, SPAN_BYTES = 130, 100


def _sendable(df: DataFrame, spans: str | None = None) -> DataFrame:
    """`df`, materialised; marked for broadcast if its measured size allows it: a key a row, and the entries of the array `spans`."""
    kept = cut(df)
    entries = F.coalesce(F.sum(F.size(spans)), F.lit(0)) if spans else F.lit(0)
    size = kept.agg((F.count(F.lit(1)) * ROW_BYTES + entries * SPAN_BYTES).alias("bytes")).first()["bytes"]
    return F.broadcast(kept) if size <= MAX_SENT_BYTES else kept


def _key(*columns: str) -> Column:
    """One value for each combination of `columns`; null is a value of its own."""
    return F.sha2(F.concat_ws("\x00", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns)), 256)


def without_low_quality(docs: DataFrame) -> DataFrame:
    """Documents that the quality rules keep, unchanged.

    Texts are counted once; the verdicts go back by a hash of text, language and source, on
    which alone they depend.  Null and empty texts are rejected, as they have no words;
    null languages and sources are groups of their own; equal rows share a verdict; very long texts
    are counted whole; an empty table stays empty; further columns go.
    """
    data = docs.select(*COLUMNS)
    counts = cut(quality.counted(data.select(_key("text", "lang", "source").alias("_key"), "lang", "source", F.col("text").cast("string").alias("text"))).drop("text"))
    lost = quality.judge(counts).where("not kept").select("_key").distinct()
    return data.withColumn("_key", _key("text", "lang", "source")).join(_sendable(lost), "_key", "left_anti").select(*COLUMNS)


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each group; rows without a doc_id stay.

    Rows that share a doc_id are one document: of those with equal texts one stays (with the
    least lang, source and n_chars), different texts all stay.  Null and blank texts are no
    duplicates; very long texts are compared whole; an empty table stays empty; further columns go.
    """
    data = docs.select(*COLUMNS)
    verdict = cut(minhash.near_duplicates(data, words=5, percent=80))
    lost = verdict.where("doc_id is not null and not kept").select("doc_id").distinct()
    out = data.join(_sendable(lost), "doc_id", "left_anti")
    if verdict.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return out
    named = out.where("doc_id is not null").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("r")).select("doc_id", "text", "r.*")
    return named.select(*COLUMNS).unionByName(out.where("doc_id is null").select(*COLUMNS))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item, unchanged.

    Null and empty texts hold none; rows without a doc_id stay; rows that share a doc_id go or
    stay together; very long texts are searched whole; empty tables lose nothing; further columns go.
    """
    data = docs.select(*COLUMNS)
    lost = decontaminate.leaks(data, benchmark).select("doc_id").distinct()
    return data.join(_sendable(lost), "doc_id", "left_anti")


def without_secrets(docs: DataFrame) -> DataFrame:
    """All documents, every found span replaced by a mask and n_chars set anew.

    Spans that overlap get one mask.  Texts without a span, null and empty ones are unchanged;
    equal texts share their spans; very long texts are searched whole; an empty table stays empty; further columns go.
    """
    data = docs.select(*COLUMNS).withColumn("_key", F.sha2("text", 256))
    spans = secrets.scan(data, keep=("_key",)).where("size(found) > 0").groupBy("_key").agg(F.first("found").alias("_found"))
    joined = data.join(_sendable(spans, "_found"), "_key", "left")
    text = F.when(F.col("_found").isNull(), F.col("text")).otherwise(secrets.masked(F.col("text"), F.col("_found")))
    n_chars = F.when(F.col("_found").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return joined.withColumn("text", text).withColumn("n_chars", n_chars).select(*COLUMNS)


def in_target_mixture(docs: DataFrame) -> DataFrame:
    """All documents with their place in the mixture: every row once, whatever its text; see `mixing.mix`."""
    return mixing.mix(docs.select(*COLUMNS))
