"""Toxicity by a character n-gram linear classifier with naive Bayes scaling.

Features are the distinct character n-grams (sizes SIZES, over bytes of ASCII
lower-cased words with a mark at both ends) of the distinct words of a text,
hashed into 2**BITS slots.  Every slot is scaled by its naive Bayes log-count
ratio, counted over all training rows.  A logistic regression on the scaled
features is then fitted on at most MAX_FIT_ROWS rows, drawn by hash; that bound is the only
sample taken.  Scores are probabilities.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Pack, arrow_rows, count_of, cut, mix64, sliced, texts_of, word_spans

BITS = 17
SIZES = (3, 5)
SMOOTHING = 1.0
MAX_FIT_ROWS = 6000
#: Labels of so many documents at most are sent to all executors (20 bytes each).
MAX_SENT_LABELS = 500_000
#: Slots in fewer training rows, or with a ratio nearer to 0, get no weight.
LEAST_ROWS, LEAST_RATIO = 8, 1.0
STEPS, RATE, PENALTY = 200, 0.05, 1e-3
THRESHOLD = 0.3


def features(texts: list[bytes], wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """Sorted distinct slots of each text, or only those that `wanted` marks."""
    pack = Pack([t.lower() for t in texts])
    start, end, doc = word_spans(pack)
    slots, owners = [], []
    if len(start):
        words = mix64(pack.hash(start, end) + mix64(doc.astype(np.uint64)))
        _, first = np.unique(words, return_index=True)
        start, end, doc = start[first], end[first], doc[first]
        for size in SIZES:
            grams = mix64(pack.hash_fixed(size) + np.uint64(size)) >> np.uint64(64 - BITS)
            # a word is read with the white space on both sides of it
            lo = np.maximum(start - 1, 0)
            count = np.maximum(np.minimum(end + 1, len(pack.bytes)) - lo - size + 1, 0)
            total = int(count.sum())
            if total:
                place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
                slot, owner = grams[place], np.repeat(doc, count)
                if wanted is not None:
                    hit = wanted[slot]
                    slot, owner = slot[hit], owner[hit]
                slots.append(slot)
                owners.append(owner)
    if not slots:
        return [np.zeros(0, np.int64) for _ in texts]
    key = np.unique((np.concatenate(owners).astype(np.int64) << BITS) | np.concatenate(slots).astype(np.int64))
    at = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.int64) << BITS)
    return [key[at[k] : at[k + 1]] & ((1 << BITS) - 1) for k in range(len(texts))]


def _counted(batches):
    """(slot, positive, negative): rows of either label that hold the slot, of one partition."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for part in sliced(batch):
            labels = part.column(part.schema.get_field_index("toxic")).to_pylist()
            for label, f in zip(labels, features(texts_of(part)), strict=True):
                counts[label, f] += 1
                rows[label] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1)), pa.array(np.append(counts[1, used], rows[1])), pa.array(np.append(counts[0, used], rows[0]))], names=["slot", "positive", "negative"]
    )


def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    f = [x.astype(np.int32).tobytes() for x in features(texts_of(batch))]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(f, pa.binary())], names=["toxic", "slots"])


def drawn(rows: DataFrame, most: int) -> DataFrame:
    """The `most` distinct rows (doc_id, text, toxic) with the least hash of all three: a draw that no label or order sways."""
    marked = rows.select("doc_id", "text", "toxic", F.xxhash64("doc_id", "text", "toxic").alias("mark"))
    last = marked.select("mark").distinct().orderBy("mark").limit(most).agg(F.max("mark").alias("m")).first()["m"]
    return marked.where(F.col("mark") <= F.lit(last)).dropDuplicates(["mark"]).drop("mark")


def fit(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Weights by slot and bias, from (doc_id, text, toxic) rows."""
    counts = rows.select("text", "toxic").mapInArrow(_counted, "slot long, positive long, negative long").groupBy("slot").agg(F.sum("positive").alias("p"), F.sum("negative").alias("n"))
    table = counts.toPandas()  # 2**BITS + 1 rows at most
    p, n = np.full(1 << BITS, SMOOTHING), np.full(1 << BITS, SMOOTHING)
    total = {0: 0, 1: 0}
    for slot, a, b in table.itertuples(index=False):
        if slot < 0:
            total = {1: int(a), 0: int(b)}
        else:
            p[slot] += a
            n[slot] += b
    if not total[0] or not total[1]:  # one label only: a constant score
        share = (total[1] + 0.5) / (total[0] + total[1] + 1.0)
        return np.zeros(1 << BITS), float(np.log(share / (1 - share)))
    ratio = np.log(p / (total[1] + 2 * SMOOTHING)) - np.log(n / (total[0] + 2 * SMOOTHING))
    ratio[(p + n < LEAST_ROWS + 2 * SMOOTHING) | (np.abs(ratio) < LEAST_RATIO)] = 0
    got = drawn(rows, MAX_FIT_ROWS).select("toxic", "text").mapInArrow(arrow_rows(_features), "toxic int, slots binary").toPandas()
    got = got.sort_values(["toxic", "slots"], ignore_index=True)
    y = got["toxic"].to_numpy(np.float64)
    each = [np.frombuffer(b, np.int32) for b in got["slots"]]
    sizes = np.array([len(x) for x in each])
    row = np.repeat(np.arange(len(each)), sizes)
    col = np.concatenate(each)
    row, col = row[ratio[col] != 0], col[ratio[col] != 0]
    used, col = np.unique(col, return_inverse=True)
    scale = ratio[used][col]
    # rows are scaled to unit norm for the fit's conditioning; the norm is undone by a common factor
    norm = float(np.sqrt(np.maximum(np.bincount(row, scale**2, len(each)), 1e-9).mean()))
    scale = scale / norm
    w, bias = np.zeros(len(used)), float(np.log(total[1] / total[0]))
    mean_w, var_w, mean_b, var_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = np.bincount(row, scale * w[col], len(each)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.bincount(col, scale * error[row], len(used)) + PENALTY * w
        slope = error.sum()
        mean_w = 0.9 * mean_w + 0.1 * grad
        var_w = 0.999 * var_w + 0.001 * grad**2
        mean_b, var_b = 0.9 * mean_b + 0.1 * slope, 0.999 * var_b + 0.001 * slope**2
        rate = RATE * (1 - step / (STEPS + 1))
        a, b = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (mean_w / a) / (np.sqrt(var_w / b) + 1e-8)
        bias -= rate * (mean_b / a) / (np.sqrt(var_b / b) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = ratio[used] * w / norm
    return weights, float(bias)


def _score(batch: pa.RecordBatch, weights, bias: float) -> pa.RecordBatch:
    w = weights.value if hasattr(weights, "value") else weights
    f = features(texts_of(batch), w != 0)
    sizes = np.array([len(x) for x in f])
    z = np.bincount(np.repeat(np.arange(len(f)), sizes), w[np.concatenate(f)], len(f)) + bias if sizes.sum() else np.full(len(f), bias)
    score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    keep = [batch.column(k) for k in range(batch.num_columns - 1)]
    return pa.RecordBatch.from_arrays([*keep, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])


def held_out(doc_id) -> F.Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per input row of `docs`.

    docs: doc_id, text; labels: doc_id, toxic (0 or 1; other values and nulls are
    ignored); further columns are ignored.  Null text counts as empty and gets the
    score of a text without features.  A null doc_id is not held out and never
    labelled.  Without labels, or with one label only, all scores are equal.  A
    doc_id labelled twice counts once for each label; rows that share a doc_id share its label and are
    scored each by its own text.  Texts of any length are read whole.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    data = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    marks = cut(marks)
    if count_of(marks) <= MAX_SENT_LABELS:
        marks = F.broadcast(marks)
    weights, bias = fit(data.where("not held_out").join(marks, "doc_id").select("doc_id", "text", "toxic"))
    sent = spark.sparkContext.broadcast(weights.astype(np.float32).astype(np.float64))
    return data.mapInArrow(arrow_rows(partial(_score, weights=sent, bias=bias)), "doc_id long, held_out boolean, score double, predicted int")
