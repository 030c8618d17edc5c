"""Near-duplicate groups by circulant MinHash, banding and exact verification.

Signature: shingle hashes are put in a universe of 2**32 values by a first
permutation; a second one, shifted circularly by k, gives coordinate k for all
k < COORDINATES.  Both permutations are invertible mixers, so none is stored.
Bands of ROWS coordinates make buckets.  Documents with equal shingle sets are
one class, and only its smallest doc_id takes part in the search.

Search: every document is first compared with the smallest doc_id that any of its
buckets starts with.  Links are confirmed on full shingle sets and joined into
components.  Buckets whose members then lie in one component need no more work.
The other buckets are joined into clusters, in which a document stands once.  A
cluster is split into blocks of BLOCK documents, and pairs of blocks are dealt to the
tasks twice.  First with signatures only (160 bytes a document): a task names the members that agree
enough with one of another component.  Then these members alone come with their full sets; a
task compares them and unites components as it goes, so it
returns a link for each union instead of all pairs.

With 32 bands of 5 a link at similarity 0.8 shares no bucket with probability
3e-6; at 0.8 fewer than `min_agree` of 160 coordinates agree with probability 4e-7.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, count_of, cut, mix64, runs, shingle_sets, texts_of
from .graph import components

BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: Columns of the shift table handled at once, to stay in cache.
WIDTH = 512
#: Documents of a cluster that a task compares with as many others.
BLOCK = 1024


def min_agree(percent: int) -> int:
    """Coordinates that agree in all but 4e-7 of the pairs at the threshold: five deviations below the mean."""
    s = percent / 100
    return max(1, int(COORDINATES * s - 5 * (COORDINATES * s * (1 - s)) ** 0.5))


def _permute32(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(COORDINATES, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """COORDINATES minima of one non-empty set of 64-bit shingle hashes."""
    first = _permute32((mix64(shingles ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32))
    low = np.full(COORDINATES, np.uint32(0xFFFFFFFF))
    for at in range(0, len(first), WIDTH):
        np.minimum(low, _permute32(first[None, at : at + WIDTH] - _SHIFTS).min(axis=1), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band; the band's number is part of it."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    for col in sig.reshape(BANDS, ROWS).T:
        h = mix64(h ^ col.astype(np.uint64)) + np.uint64(0x8EBC6AF09C88C6E3)
    return h.view(np.int64)


def _sign(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    sets = shingle_sets(texts_of(batch), words)
    signatures = [signature(s) if len(s) else None for s in sets]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
            pa.array([None if s is None else band_keys(s) for s in signatures], pa.list_(pa.int64())),
            pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in signatures], pa.binary()),
        ],
        names=["doc_id", "n_shingles", "set_key", "bands", "low"],
    )


def _confirm(batches, words: int, percent: int):
    """Pairs (a, b, text_a, text_b) whose sets are similar enough."""
    last, kept = None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            left, right = texts_of(part, "text_a"), texts_of(part, "text_b")
            todo = []
            for t in left:
                if t != last and (not todo or t != todo[-1]):
                    todo.append(t)
                last = t
            made = dict(zip(todo, shingle_sets(todo, words), strict=True)) if todo else {}
            if kept is not None:
                made.setdefault(kept[0], kept[1])
            others = shingle_sets(right, words)
            ok = []
            for t, y in zip(left, others, strict=True):
                x = made[t]
                both = len(x) + len(y)
                merged = np.concatenate((x, y))
                merged.sort()
                shared = int(np.count_nonzero(merged[1:] == merged[:-1]))
                ok.append(shared > 0 and 100 * shared >= percent * (both - shared))
            kept = (left[-1], made[left[-1]])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(ok))


def _bytes(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _likely(batches, least: int):
    """Pairs (a, b, low_a, low_b) whose signatures agree in `least` coordinates."""
    for batch in batches:
        if batch.num_rows:
            ok = (_bytes(batch.column(2)) == _bytes(batch.column(3))).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))


def _sets(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    at = batch.schema.get_field_index("text")
    sets = pa.array([s.tobytes() for s in shingle_sets(texts_of(batch), words)], pa.binary())
    return batch.set_column(at, pa.field("text", pa.binary()), sets)


def _meet(batches, least: int, percent: int):
    """Rows of runs of (key, side, first, second, doc_id, root, n, low) whose signature agrees with one of another component; without low."""
    for run in runs(batches, "key"):
        roots = run.column("root").to_pylist()
        if len(set(roots)) < 2:
            continue
        owner, side = np.unique(roots, return_inverse=True)[1], run.column("side").to_numpy()
        apart = run.column("first")[0].as_py() != run.column("second")[0].as_py()
        low, sizes = _bytes(run.column("low")), run.column("n").to_numpy()
        met = np.zeros(len(roots), bool)
        for k in range(len(roots) - 1):
            rest = slice(k + 1, len(roots))
            fits = (owner[rest] != owner[k]) & (100 * np.minimum(sizes[rest], sizes[k]) >= percent * np.maximum(sizes[rest], sizes[k]))
            if apart:
                fits &= side[rest] != side[k]
            maybe = np.flatnonzero(fits) + k + 1
            maybe = maybe[(low[maybe] == low[k]).sum(axis=1) >= least]
            met[maybe] = True
            met[k] |= len(maybe) > 0
        if met.any():
            yield from run.drop_columns(["n", "low"]).filter(pa.array(met)).to_batches()


def _across(batches, least: int, percent: int):
    """Links between components, from runs of (key, side, first, second, doc_id, root, low, shingles).

    Only links that unite two components of those known so far are returned.
    """
    for run in runs(batches, "key"):
        roots = run.column("root").to_pylist()
        if len(set(roots)) < 2:
            continue
        over = {r: r for r in roots}

        def top(r, over=over):
            while over[r] != r:
                over[r] = over[over[r]]
                r = over[r]
            return r

        ids, side = run.column("doc_id").to_pylist(), run.column("side").to_numpy()
        apart = run.column("first")[0].as_py() != run.column("second")[0].as_py()
        low = _bytes(run.column("low"))
        sets = [np.frombuffer(s, np.uint64) for s in run.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        owner = np.unique(roots, return_inverse=True)[1]
        links = []
        for k in range(len(ids) - 1):
            rest = slice(k + 1, len(ids))
            fits = (owner[rest] != owner[k]) & (100 * np.minimum(sizes[rest], sizes[k]) >= percent * np.maximum(sizes[rest], sizes[k]))
            if apart:
                fits &= side[rest] != side[k]
            maybe = np.flatnonzero(fits) + k + 1
            maybe = maybe[(low[maybe] == low[k]).sum(axis=1) >= least]
            if not len(maybe):
                continue
            values = np.concatenate([sets[m] for m in maybe])
            place = np.minimum(np.searchsorted(sets[k], values), sizes[k] - 1)
            ends = np.concatenate(([0], np.cumsum(sizes[maybe])))
            hits = np.concatenate(([0], np.cumsum(sets[k][place] == values)))
            shared = hits[ends[1:]] - hits[ends[:-1]]
            for m in maybe[100 * shared >= percent * (sizes[maybe] + sizes[k] - shared)]:
                x, y = top(roots[k]), top(roots[m])
                if x != y:
                    over[max(x, y)] = min(x, y)
                    links.append((min(ids[k], ids[m]), max(ids[k], ids[m])))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])


def _linked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that an exact comparison of full shingle sets confirms."""
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    full = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(partial(_confirm, words=words, percent=percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    docs: doc_id, text; further columns are ignored.  Two documents are linked
    if their sets of distinct `words`-word shingles overlap by `percent` of
    their union at least; component_id is the smallest doc_id reachable.

    Null or blank text: an empty set, linked with nothing.  Null doc_id: the row
    takes no part, component_id is null and kept is false.  Rows that share a
    doc_id are one document, which is linked if any of its texts is; n_shingles is that of each row's own text.
    Repeated rows get equal results; very long texts are compared whole.  An
    empty table gives no rows.  A link whose texts agree in too few coordinates or share no bucket
    is not found; see above for how seldom that is.
    """
    least = min_agree(percent)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut(source.mapInArrow(arrow_rows(partial(_sign, words=words)), "doc_id long, n_shingles long, set_key binary, bands array<long>, low binary"))
    live = signed.where("doc_id is not null and n_shingles > 0")
    chosen = live.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "low")).alias("r")).select("set_key", "r.*")
    chosen = cut(chosen)
    shared_ids = cut(live.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    alone = shared_ids.isEmpty()
    lows = chosen.select("doc_id", "low", F.col("n_shingles").alias("n"))
    entries = chosen.select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    entries = cut(entries.join(buckets.select("bucket", F.col("first.doc_id").alias("lead"), F.col("first.n").alias("lead_n")), "bucket"))
    texts = source.where("doc_id is not null and text is not null")
    own = None
    if not alone:  # a doc_id with several texts: each text once, and links from the doc_id to all its classes
        texts = texts.dropDuplicates(["doc_id", "text"])
        classes = chosen.select("set_key", F.col("doc_id").alias("a"))
        own = cut(live.join(shared_ids.select("doc_id"), "doc_id", "left_semi").join(classes, "set_key").select("a", F.col("doc_id").alias("b")).where("a <> b").distinct())
    near = F.expr(f"100 * least(n, lead_n) >= {percent} * greatest(n, lead_n)")
    pairs = entries.where("doc_id > lead").where(near).groupBy("doc_id").agg(F.min("lead").alias("a")).withColumnRenamed("doc_id", "b")
    pairs = pairs.join(lows.select(F.col("doc_id").alias("b"), F.col("low").alias("low_b")), "b").join(lows.select(F.col("doc_id").alias("a"), F.col("low").alias("low_a")), "a")
    tried = cut(pairs.select("a", "b", "low_a", "low_b").mapInArrow(partial(_likely, least=least), "a long, b long"))
    links = cut(_linked(tried.distinct(), texts, words, percent))
    if own is not None:
        links = links.unionByName(own)
    roots = components(links)
    owned = entries.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    split = owned.groupBy("bucket").agg(F.min("doc_id").alias("lead"), F.min("root").alias("low_root"), F.max("root").alias("high_root")).where("low_root <> high_root")
    owned = owned.join(split.select("bucket", "lead"), "bucket").groupBy("doc_id", "root", "lead").agg(F.count(F.lit(1)).alias("shared"))
    owned = cut(owned.select("doc_id", "root", "lead"))
    across = cut(_cluster_links(owned, lows, texts, words, percent, least, block))
    if count_of(across):
        roots = components(links.union(across))
    return _labelled(signed, chosen, roots)


def _cluster_links(owned: DataFrame, lows: DataFrame, texts: DataFrame, words: int, percent: int, least: int, block: int) -> DataFrame:
    """(a, b): links across components within the clusters that (doc_id, root, lead) span."""
    grouped = components(owned.select(F.col("doc_id").alias("a"), F.col("lead").alias("b")))
    members = owned.select("doc_id", "root").distinct().join(grouped.withColumnsRenamed({"node": "doc_id", "root": "cluster"}), "doc_id", "left").withColumn("cluster", F.coalesce("cluster", "doc_id"))
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    sided = members.join(sizes, "cluster").withColumn("side", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))
    dealt = sided.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("doc_id", "root", "cluster", "side", F.least("side", "other").alias("first"), F.greatest("side", "other").alias("second"))
    dealt = dealt.withColumn("key", F.xxhash64("cluster", "first", "second"))
    places = "key long, side int, first int, second int, doc_id long, root long"
    names = ("key", "side", "first", "second", "doc_id", "root")
    signed = dealt.join(lows, "doc_id").select(*names, "n", "low").repartition("key").sortWithinPartitions("key", "doc_id")
    met = cut(signed.mapInArrow(partial(_meet, least=least, percent=percent), places).distinct())
    full = met.join(lows.drop("n"), "doc_id").join(texts, "doc_id").select(*names, "low", "text")
    sets = full.mapInArrow(arrow_rows(partial(_sets, words=words)), f"{places}, low binary, text binary")
    rows = sets.withColumnRenamed("text", "shingles").repartition("key").sortWithinPartitions("key", "doc_id")
    return rows.mapInArrow(partial(_across, least=least, percent=percent), "a long, b long")


def _labelled(signed: DataFrame, chosen: DataFrame, roots: DataFrame) -> DataFrame:
    classes = chosen.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("set_key", F.coalesce("root", "doc_id").alias("component"))
    rows = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_key")).alias("set_key"))
    out = rows.join(classes, "set_key", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
