"""Quality rules with thresholds that adapt to each language and source.

Counts are taken from whole texts in one pass.  Every ratio, and every denominator,
is sketched per (lang, source): a histogram over values cut to their BITS leading
binary digits, so with a relative error below 2**(1 - BITS).  Such sketches are
merged by adding counts, exactly and in any order.  A group of fewer than LEAST
documents takes the sketch of its language, or that of all documents.

A fence lies SPREAD spreads beyond the outer quartile.  The spread is the distance from the
median to that quartile, and at least what one more unit (a symbol, a line, a
repeated 3-word window, a letter) weighs in the group's median document, so that a
group whose quartiles coincide has a scale of its own, too.  No threshold is a
fixed number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, Pack, arrow_rows, count_of, cut, mix64, rolled, texts_of, word_spans

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: Leading binary digits of a value that a sketch keeps.
BITS = 8
#: Ratios are whole numbers of this part of one.
SCALE = 1 << 20
#: Documents that a sketch must hold to be used for its group.
LEAST = 30
#: Distance of a fence from the quartile, in spreads.
SPREAD = 6
#: Fences of so many groups at most are sent to all executors (100 bytes each).
MAX_SENT_GROUPS = 20_000
#: ratio: (numerator, denominator, what a unit adds to the numerator)
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars", 1),
    "repeat_ratio": ("n_repeat_words", "n_words", 6),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 1),
    "word_length": ("word_chars", "n_words", 1),
}
#: Ratios that are fenced from below, too.
BOTH_SIDES = ("word_length",)
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _sums(flags: np.ndarray, pack: Pack) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[pack.ends] - total[pack.starts]


def count_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The six counts of each UTF-8 text."""
    pack = Pack(texts, b"\n")
    raw = pack.bytes
    start, end, doc = word_spans(pack)
    n = len(texts)
    n_words = np.bincount(doc, minlength=n)
    first_bytes = ((raw & 0xC0) != 0x80) & ~SPACE[raw]
    # words in 3-word windows that occur twice or more in their text
    words = mix64(pack.hash(start, end))
    grams = rolled(words, 3)
    inside = doc[: len(grams)] == doc[2:] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    keys = mix64(grams[at] + mix64(doc[at].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(ranked), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hits = at[order[twice]]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[hits + k] = True
    n_repeat = np.bincount(doc[covered], minlength=n)
    # lines with a word, equal to an earlier line of the text
    stop = np.flatnonzero(raw == 0x0A)
    begin = np.concatenate(([0], stop[:-1] + 1))
    of = np.searchsorted(pack.ends, begin, side="left")
    worded = np.zeros(len(stop) + 1, np.int64)
    worded[1:] = np.cumsum(np.bincount(np.searchsorted(stop, start, side="left"), minlength=len(stop)) > 0)
    has = np.diff(worded) > 0
    line = mix64(mix64(pack.hash(begin, stop)[has] ^ (stop - begin)[has].astype(np.uint64)) + mix64(of[has].astype(np.uint64)))
    line_doc = of[has]
    _, first = np.unique(line, return_index=True)
    lines = np.bincount(line_doc, minlength=n)
    distinct = np.bincount(line_doc[first], minlength=n)
    return {
        "n_words": n_words,
        "word_chars": _sums(first_bytes, pack),
        "n_symbols": _sums(_SYMBOL[raw], pack),
        "n_dup_lines": lines - distinct,
        "n_repeat_words": n_repeat,
        "n_lines": lines,
    }


def _ratio(name: str) -> Column:
    top, bottom, _ = RATIOS[name]
    return F.expr(f"coalesce(({top} * {SCALE}) div nullif({bottom}, 0), 0)")


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def rounded(c: str) -> str:
    """SQL: a whole number cut to its BITS leading binary digits."""
    return f"shiftleft(shiftright({c}, greatest(length(bin({c})) - {BITS}, 0)), greatest(length(bin({c})) - {BITS}, 0))"


def sketches(rated: DataFrame) -> DataFrame:
    """(lang, source, metric, value, n): the histogram of every ratio and denominator of each group."""
    metrics = [*(f"_{r}" for r in RATIOS), *sorted({d for _, d, _ in RATIOS.values()})]
    each = F.array(*(F.struct(F.lit(m).alias("metric"), F.expr(rounded(m)).alias("value")) for m in metrics))
    return rated.select("lang", "source", F.explode(each).alias("m")).groupBy("lang", "source", "m.metric", "m.value").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """The sum of the sketches that agree on `keys`."""
    return sketch.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Per keys: n, and q1, q2, q3 of every metric as columns `metric_q1` and so on.  A sketch is some thousand rows at most."""
    by = Window.partitionBy(*keys, "metric")
    ranked = sketch.withColumn("upto", F.sum("n").over(by.orderBy("value"))).withColumn("total", F.sum("n").over(by))
    metrics = [*(f"_{r}" for r in RATIOS), *sorted({d for _, d, _ in RATIOS.values()})]
    picks = [F.min(F.when((F.col("metric") == m) & (4 * F.col("upto") >= k * F.col("total")), F.col("value"))).alias(f"{m}_q{k}") for m in metrics for k in (1, 2, 3)]
    return ranked.groupBy(*keys).agg(F.max("total").alias("n"), *picks)


def _limits(side: str) -> list[Column]:
    out = []
    for r, (_, bottom, unit) in RATIOS.items():
        step = f"coalesce({unit * SCALE} div nullif({side}.{bottom}_q2, 0), 0)"
        out.append(F.expr(f"{side}._{r}_q3 + {SPREAD} * greatest({side}._{r}_q3 - {side}._{r}_q2, {step})").alias(f"_max_{r}"))
        if r in BOTH_SIDES:
            out.append(F.expr(f"{side}._{r}_q1 - {SPREAD} * greatest({side}._{r}_q2 - {side}._{r}_q1, {step})").alias(f"_min_{r}"))
    return out


def fences(rated: DataFrame) -> DataFrame:
    """One row per (lang, source): the upper fence of every ratio, and the lower ones of BOTH_SIDES."""
    fine = cut(sketches(rated))
    names = [f"{x}_{r}" for r in RATIOS for x in ("_max", "_min") if x == "_max" or r in BOTH_SIDES]
    g = quartiles(fine, "lang", "source").alias("g").select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("n").alias("_n"), F.struct(*_limits("g")).alias("_own"))
    by_lang = quartiles(merged(fine, "lang"), "lang").alias("l").select(F.col("lang").alias("_of"), F.col("n").alias("_n_lang"), F.struct(*_limits("l")).alias("_wide"))
    whole = quartiles(merged(fine)).alias("a").select(F.struct(*_limits("a")).alias("_all"))
    joined = g.join(by_lang, F.col("_lang").eqNullSafe(F.col("_of"))).crossJoin(F.broadcast(whole))  # one row
    pick = F.when(F.col("_n") >= LEAST, F.col("_own")).when(F.col("_n_lang") >= LEAST, F.col("_wide")).otherwise(F.col("_all"))
    return joined.select("_lang", "_source", pick.alias("f")).select("_lang", "_source", *(F.col(f"f.{n}").alias(n) for n in names))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and kept, one row per input row.

    docs: doc_id, text, lang, source; further columns are ignored.  Null text
    counts as empty: no words, base_failed.  A null language or source is a
    group of its own.  Documents that fail the base rule take no part in the
    sketches.  Texts of any length are counted whole.  A value on the fence is kept.  Equal rows get
    equal results.  An empty table gives no rows.
    """
    return judge(cut(counted(docs.select("doc_id", "lang", "source", F.col("text").cast("string").alias("text"))).drop("text")))


def judge(data: DataFrame) -> DataFrame:
    """`data` (from `counted`) with base_failed and kept: false beyond a fence of the row's group."""
    rated = data.withColumn("base_failed", base_failed()).withColumns({f"_{r}": _ratio(r) for r in RATIOS})
    limits = cut(fences(rated.where("not base_failed")))
    if count_of(limits) <= MAX_SENT_GROUPS:
        limits = F.broadcast(limits)
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    inside = F.expr(" and ".join([*(f"_{r} <= _max_{r}" for r in RATIOS), *(f"_{r} >= _min_{r}" for r in BOTH_SIDES)]))
    joined = rated.join(limits, on, "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    return joined.select(*data.columns, "base_failed", "kept")


def counted(docs: DataFrame) -> DataFrame:
    """All columns of `docs` (text among them) with the counts beside them."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(arrow_rows(_count), f"{schema}, {COUNTS}")


def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts = count_texts(texts_of(batch))
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, pa.int64()) for v in counts.values())], names=[*batch.schema.names, *counts])
