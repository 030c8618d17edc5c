"""Removal of repeated byte strings by suffix arrays.

A byte goes if it is covered by a WIDTH-byte window that also starts in a document with a
smaller doc_id.  Equal windows must meet in one task without moving all
windows there:

1. The anchor of a window is its leftmost least GRAM-byte string by hash; equal
   windows have equal anchors.  Windows in a row with one anchor make a run, and
   all its bytes a segment: at most REACH bytes on either side of the anchor.
2. Only anchors that occur in two documents matter.  Chunks of documents send the
   hashes of their anchors, packed, and get the shared ones back.
3. Segments of shared anchors go to the task of their anchor, one copy per
   chunk with its smallest and largest doc_id.
4. There the segments of one anchor, the anchor itself replaced by one symbol, lose the bytes on
   either side that no other segment has, and what is left is joined
   and suffix-sorted (`suffix_array`).  Equal windows are neighbours in the
   array and get their smallest doc_id.
5. The chunks get those back and cut their texts.

An anchor that more than HOT_CHUNKS chunks hold doesn't meet in one task: its windows are dealt by the
SIDE bytes before it where the window has as many, else by the bytes after it, which equal windows
share, too.

Equal texts are met before: all but the one with the smallest doc_id are
covered whole.  Nothing is capped: a string that very many documents hold stands
once per chunk, and a chunk is some megabytes of text.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PACK_BYTES, Pack, count_of, cut, mix64, shuffle_parts

WIDTH = 50
GRAM = 32
#: Windows that hold a given GRAM-byte string, and so the length of a window with its anchor as one symbol.
SPAN = WIDTH - GRAM + 1
CHUNK_BYTES = 2 << 20
#: Longer texts are read in overlapping pieces.
PIECE = 4 << 20
_POS_BITS = 23
#: Text for which one task keeps the anchors.
PART_BYTES = 16 << 20
#: Chunks that may hold an anchor before it is split, and the bytes beside it that it is split by.
HOT_CHUNKS, SIDE = 16, 9
#: Repeated texts of so many at most are sent to all executors by hash (100 bytes each).
MAX_SENT_FIRSTS = 300_000
#: Bytes that never occur in UTF-8 stand for the anchor and for the end of a segment.
ANCHOR, END = b"\xff", b"\xfe"


# ------------------------------------------------------------------ suffix array


def lyndon_groups(s: bytes) -> tuple[list[int], list[int], list[list[int]]]:
    """Group of each suffix, its previous smaller suffix, and the groups in descending order.

    Suffixes start out grouped by their first byte.  The highest group not yet
    processed is taken; the previous smaller suffix of each member is found by
    following pointers over processed suffixes; and those found move to new groups just
    above their own, more members of the group meaning higher.  In the end a
    group holds the suffixes with one longest Lyndon prefix.
    """
    n = len(s)
    members: list[list[int]] = []
    up: list[int] = []
    down: list[int] = []
    by_byte: dict[int, list[int]] = {}
    for i, c in enumerate(s):
        if c in by_byte:
            by_byte[c].append(i)
        else:
            by_byte[c] = [i]
    group = [0] * n
    for g, c in enumerate(sorted(by_byte)):
        members.append(by_byte[c])
        up.append(g + 1)
        down.append(g - 1)
        for i in by_byte[c]:
            group[i] = g
    previous = list(range(-1, n - 1))
    done = bytearray(n)
    order: list[list[int]] = []
    g = len(members) - 1
    up[g] = -1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        if own:
            order.append(own)
            for i in own:
                done[i] = 1
            if len(own) == 1:
                i = own[0]
                p = previous[i]
                while p >= 0 and done[p]:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    old = group[p]
                    if down[g] != old or len(members[old]) > 1:
                        new = len(members)
                        members.append([p])
                        above = up[old]
                        up.append(above)
                        down.append(old)
                        up[old] = new
                        down[above] = new
                        group[p] = new
            else:
                found: dict[int, int] = {}
                own.sort()
                for i in own:
                    p = previous[i]
                    while p >= 0 and done[p]:
                        p = previous[p]
                    previous[i] = p
                    if p >= 0:
                        found[p] = found.get(p, 0) + 1
                moves: dict[tuple[int, int], list[int]] = {}
                for p, times in found.items():
                    key = (-times, group[p])
                    if key in moves:
                        moves[key].append(p)
                    else:
                        moves[key] = [p]
                for (_, old), who in sorted(moves.items()) if len(moves) > 1 else moves.items():
                    new = len(members)
                    members.append(who)
                    above = up[old]
                    up.append(above)
                    down.append(old)
                    up[old] = new
                    down[above] = new
                    for p in who:
                        group[p] = new
        g = down[g]
    return group, previous, order


def suffix_array(s: bytes) -> list[int]:
    """Start positions of all suffixes in ascending order, by linear grouping.

    After grouping, the array is filled from the left: from each suffix placed
    (and first from the empty one) the chain of previous smaller suffixes is
    walked, and each unplaced one takes the next place in its group.
    """
    n = len(s)
    group, previous, order = lyndon_groups(s)
    place: dict[int, int] = {}
    at = n
    for own in order:
        at -= len(own)
        place[group[own[0]]] = at
    out = [-1] * n
    free = bytearray(b"\x01") * n
    j = n - 1
    while j >= 0 and free[j]:
        g = group[j]
        k = place[g]
        out[k] = j
        place[g] = k + 1
        free[j] = 0
        j = previous[j]
    for i in out:  # grows ahead of the loop
        j = i - 1
        while j >= 0 and free[j]:
            g = group[j]
            k = place[g]
            out[k] = j
            place[g] = k + 1
            free[j] = 0
            j = previous[j]
    return out


def _shared_prefix(parts: list[bytes]) -> list[int]:
    """For every string the length of the longest prefix that it has in common with another one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best = [0] * len(parts)
    a = order[0]
    for b in order[1:]:
        n = 0
        if parts[a] == parts[b]:
            n = len(parts[a])
        else:
            for p, q in zip(parts[a], parts[b]):  # noqa: B905  one may be longer
                if p != q:
                    break
                n += 1
        best[a], best[b] = max(best[a], n), max(best[b], n)
        a = b
    return best


def owners(segments: list[bytes], least: list[int]) -> list[list[int]]:
    """For every window of each distinct segment, the smallest doc_id among equal windows.

    segments: with the anchor as one symbol; least: their smallest doc_id.  A window that reaches beyond
    the bytes which another segment has, too, is its segment's own.
    """
    low = [[owner] * (len(seg) - SPAN + 1) for seg, owner in zip(segments, least, strict=True)]
    if len(segments) == 1:
        return low
    anchor = [seg.index(ANCHOR) for seg in segments]
    left = _shared_prefix([seg[:a][::-1] for seg, a in zip(segments, anchor, strict=True)])
    right = _shared_prefix([seg[a + 1 :] for seg, a in zip(segments, anchor, strict=True)])
    cores: dict[bytes, list[tuple[int, int]]] = {}
    for k, (seg, a, before, after) in enumerate(zip(segments, anchor, left, right, strict=True)):
        if before + after + 1 >= SPAN:
            cores.setdefault(seg[a - before : a + 1 + after], []).append((k, a - before))
    names = list(cores)
    for core, row in zip(names, _sorted_owners(names, [min(least[k] for k, _ in cores[c]) for c in names]), strict=True):
        for k, at in cores[core]:
            low[k][at : at + len(row)] = row
    return low


def _sorted_owners(segments: list[bytes], least: list[int]) -> list[list[int]]:
    """`owners` by the suffix array of all segments."""
    if len(segments) < 2:
        return [[owner] * (len(seg) - SPAN + 1) for seg, owner in zip(segments, least, strict=True)]
    s = END.join(segments) + END
    first, owner = [], [-1] * len(s)
    at = 0
    for k, seg in enumerate(segments):
        first.append(at)
        for i in range(at, at + len(seg) - SPAN + 1):
            owner[i] = k
        at += len(seg) + 1
    low = [0] * len(s)
    held: list[int] = []
    last, best = b"", 0
    for i in suffix_array(s):
        k = owner[i]
        if k < 0:
            continue
        w = s[i : i + SPAN]
        if w != last:
            for x in held:
                low[x] = best
            held, last, best = [i], w, least[k]
        else:
            held.append(i)
            best = min(best, least[k])
    for x in held:
        low[x] = best
    return [low[a : a + len(seg) - SPAN + 1] for a, seg in zip(first, segments, strict=True)]


# ------------------------------------------------------------------ anchors


def _slide_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < width:
        v = np.minimum(v[: size - width], v[width - size :])
    return v


class Runs:
    """Runs of windows with one anchor in a pack of texts: key, text number, first window, number of windows, anchor position."""

    def __init__(self, texts: list[bytes]):
        self.pack = pack = Pack(texts, b"\x00")
        grams = mix64(pack.hash_fixed(GRAM))
        n = len(pack.bytes)
        empty = np.zeros(0, np.int64)
        self.key, self.doc, self.start, self.count, self.anchor = np.zeros(0, np.uint64), empty, empty, empty, empty
        if n < WIDTH:
            return
        mask = np.uint64((1 << _POS_BITS) - 1)
        marked = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        at = (_slide_min(marked, SPAN) & mask).astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), pack.sizes + 1)[: len(at)]
        valid = np.arange(WIDTH, len(at) + WIDTH) <= np.repeat(pack.ends, pack.sizes + 1)[: len(at)]
        change = np.ones(len(at), bool)
        change[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
        heads = np.flatnonzero(change)
        sizes = np.diff(np.append(heads, len(at)))
        good = valid[heads]
        self.start, self.count = heads[good], sizes[good]
        self.anchor = at[self.start]
        self.doc = doc[self.start]
        self.key = grams[self.anchor]


def _pieces(ids: list[int], texts: list[bytes]):
    """Packs of (index of the text, offset, piece)."""
    pack, size = [], 0
    for k, t in enumerate(texts):
        for offset in range(0, max(1, len(t) - WIDTH + 1), PIECE):
            piece = t[offset : offset + PIECE + WIDTH - 1]
            if size and size + len(piece) > PACK_BYTES:
                yield pack
                pack, size = [], 0
            pack.append((k, offset, piece))
            size += len(piece) + 1
    if pack:
        yield pack


def _chunk(left: pa.Table, right: pa.Table) -> tuple[list[int], list[bytes]]:
    """doc_ids and texts of a chunk that stand for their class, in order, each once."""
    if not left.num_rows or not right.num_rows:  # an empty side comes without columns
        return [], []
    rep = {(i, s) for i, s in zip(right.column("rep").to_pylist(), right.column("sha").to_pylist(), strict=True) if i is not None}
    many = {i for i, _ in rep}
    rows = {(i, t) for i, t in zip(left.column("doc_id").to_pylist(), left.column("text").cast(pa.large_binary()).to_pylist(), strict=True) if i in many}
    rows = sorted(r for r in rows if len(r[1]) >= WIDTH and (r[0], hashlib.sha256(r[1]).hexdigest()) in rep)
    return [r[0] for r in rows], [r[1] for r in rows]


def _send_keys(key, left: pa.Table, right: pa.Table, parts: int) -> pa.Table:
    """(part, chunk, keys): the anchors of a chunk by part; the lowest bit says that two documents hold it."""
    ids, texts = _chunk(left, right)
    keys, docs = [], []
    for pack in _pieces(ids, texts):
        r = Runs([p[2] for p in pack])
        keys.append(r.key)
        docs.append(np.array([ids[p[0]] for p in pack], np.int64)[r.doc])
    if not keys:
        return pa.table(dict(part=pa.array([], pa.int32()), chunk=pa.array([], pa.int64()), keys=pa.array([], pa.binary())))
    k, d = np.concatenate(keys) & ~np.uint64(1), np.concatenate(docs)
    order = np.argsort(k, kind="stable")
    k, d = k[order], d[order]
    heads = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    several = np.minimum.reduceat(d, heads) != np.maximum.reduceat(d, heads)
    sent = k[heads] | several.astype(np.uint64)
    part = (sent >> np.uint64(40)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    full = [p for p in range(parts) if edges[p + 1] > edges[p]]
    blobs = [sent[order[edges[p] : edges[p + 1]]].tobytes() for p in full]
    return pa.table(dict(part=pa.array(full, pa.int32()), chunk=pa.array([key[0].as_py()] * len(full), pa.int64()), keys=pa.array(blobs, pa.binary())))


def _reply_keys(key, table, hot_chunks):  # Spark reads the kind of function from hints, and takes none of a partial one
    """(chunk, keys): for each chunk its anchors that are shared; the lowest bit says that many chunks hold it."""
    chunks = table.column("chunk").to_pylist()
    each = [np.frombuffer(b, np.uint64) for b in table.column("keys").to_pylist()]
    sent = np.concatenate(each)
    plain = sent & ~np.uint64(1)
    several = (sent & np.uint64(1)).astype(bool)
    order = np.argsort(plain)
    ranked = plain[order]
    again = np.concatenate(([False], ranked[1:] == ranked[:-1], [False]))
    head = np.flatnonzero(~again[:-1])
    in_two = np.logical_or.reduceat(several[order] | again[1:], head)
    holders = np.diff(np.append(head, len(plain)))
    shared, told = np.empty(len(plain), bool), np.empty(len(plain), np.uint64)
    shared[order] = np.repeat(in_two, holders)
    told[order] = ranked | np.repeat(holders > hot_chunks, holders).astype(np.uint64)
    ends = np.cumsum([len(e) for e in each])
    out = [told[hi - len(e) : hi][shared[hi - len(e) : hi]].tobytes() for e, hi in zip(each, ends, strict=True)]
    full = [k for k, b in enumerate(out) if b]
    return pa.table(dict(chunk=pa.array([chunks[k] for k in full], pa.int64()), keys=pa.array([out[k] for k in full], pa.binary())))


def _split(r: Runs, hit: np.ndarray, key: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Key, text, first window, anchor position and number of windows of the runs `hit`; those of hot anchors are cut in two."""
    doc, start, anchor, count = r.doc[hit], r.start[hit], r.anchor[hit], r.count[hit]
    if not hot.any():
        return key, doc, start, anchor, count
    cold = ~hot
    # windows with SIDE bytes before the anchor, and the others, which have WIDTH - GRAM - SIDE + 1 after it
    early = hot & (start <= anchor - SIDE)
    late = hot & (start + count > anchor - SIDE + 1)
    a, b = anchor[early], anchor[late]
    ends = np.minimum(start[early] + count[early], a - SIDE + 1)
    begins = np.maximum(start[late], b - SIDE + 1)
    before = mix64(r.pack.hash(a - SIDE, a + GRAM) ^ np.uint64(0x5851F42D4C957F2D))
    after = mix64(r.pack.hash(b, b + WIDTH - SIDE + 1) ^ np.uint64(0x14057B7EF767814F))
    return (
        np.concatenate((key[cold], before, after)),
        np.concatenate((doc[cold], doc[early], doc[late])),
        np.concatenate((start[cold], start[early], begins)),
        np.concatenate((anchor[cold], a, b)),
        np.concatenate((count[cold], ends - start[early], start[late] + count[late] - begins)),
    )


def _shared_runs(left: pa.Table, right: pa.Table):
    """Texts of a chunk, its distinct shared segments, and where they stand."""
    ids, texts = _chunk(left, right)
    blobs = [b for b in right.column("keys").to_pylist() if b] if texts else []
    wanted = np.sort(np.frombuffer(b"".join(blobs), np.uint64))
    hot = (wanted & np.uint64(1)).astype(bool)
    wanted = wanted & ~np.uint64(1)
    known: dict[tuple[int, bytes], int] = {}
    where: list[tuple[int, int, int]] = []  # segment, text, first window
    if len(wanted):
        for pack in _pieces(ids, texts):
            r = Runs([p[2] for p in pack])
            plain = r.key & ~np.uint64(1)
            place = np.minimum(np.searchsorted(wanted, plain), len(wanted) - 1)
            hit = np.flatnonzero(wanted[place] == plain)
            key, doc, start, anchor, count = _split(r, hit, plain[hit], hot[place[hit]])
            raw = r.pack.raw
            first = np.array([p[1] for p in pack])[doc] + start - r.pack.starts[doc]
            number_of = np.array([p[0] for p in pack])[doc]
            for k, s, a, e, text, at in zip(*(x.tolist() for x in (key, start, anchor, start + count + WIDTH - 1, number_of, first)), strict=True):
                number = known.setdefault((k, raw[s:a] + ANCHOR + raw[a + GRAM : e]), len(known))
                where.append((number, text, at))
    return ids, texts, known, where


def _send_segments(key, left: pa.Table, right: pa.Table, parts: int) -> pa.Table:
    """(part, chunk, rows): segments with number, smallest and largest doc_id."""
    ids, _, known, where = _shared_runs(left, right)
    number_of, text_of = np.array([w[0] for w in where], np.int64), np.array([w[1] for w in where], np.int64)
    low, high = np.full(len(known), np.iinfo(np.int64).max), np.full(len(known), np.iinfo(np.int64).min)
    holder = np.array(ids, np.int64)[text_of] if where else text_of
    np.minimum.at(low, number_of, holder)
    np.maximum.at(high, number_of, holder)
    low, high = low.tolist(), high.tolist()
    by_part: dict[int, list[tuple]] = {}
    for (anchor, segment), number in known.items():
        by_part.setdefault((anchor >> 40) % parts, []).append((anchor, number, low[number], high[number], segment))
    names = sorted(by_part)
    return pa.table(
        dict(
            part=pa.array(names, pa.int32()),
            chunk=pa.array([key[0].as_py()] * len(names), pa.int64()),
            anchors=pa.array([np.array([r[0] for r in by_part[p]], np.uint64).tobytes() for p in names], pa.binary()),
            numbers=pa.array([np.array([r[1:4] for r in by_part[p]], np.int64).tobytes() for p in names], pa.binary()),
            segments=pa.array([END.join(r[4] for r in by_part[p]) for p in names], pa.binary()),
        )
    )


def _find_owners(table: pa.Table) -> pa.Table:
    """(chunk, owners): for each chunk (segment, from, to, doc_id), windows that a smaller doc_id than its largest holds."""
    chunks = table.column("chunk").to_pylist()
    segments: list[bytes] = []
    anchors, numbers, sizes = [], [], []
    for a, n, joined in zip(*(table.column(c).to_pylist() for c in ("anchors", "numbers", "segments")), strict=True):
        anchors.append(np.frombuffer(a, np.uint64))
        numbers.append(np.frombuffer(n, np.int64).reshape(-1, 3))
        sizes.append(len(anchors[-1]))
        segments += joined.split(END)
    keys = np.concatenate(anchors)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    edges = np.concatenate((np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))), [len(keys)])).tolist()
    number, low, high = (c.tolist() for c in np.concatenate(numbers).T)
    row_of = np.repeat(np.arange(len(sizes)), sizes).tolist()
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in chunks]
    order = order.tolist()
    for start, end in zip(edges, edges[1:]):  # noqa: B905
        own = order[start:end]
        one = segments[own[0]]
        if all(segments[i] == one for i in own):
            least = min(low[i] for i in own)
            for i in own:
                if least < high[i]:
                    out[row_of[i]].append((number[i], 0, len(one) - SPAN + 1, least))
            continue
        distinct: dict[bytes, int] = {}
        for i in own:
            distinct[segments[i]] = min(low[i], distinct.get(segments[i], low[i]))
        names = sorted(distinct)
        found = dict(zip(names, owners(names, [distinct[s] for s in names]), strict=True))
        for i in own:
            row, top, at = found[segments[i]], high[i], 0
            while at < len(row):
                to = at + 1
                while to < len(row) and row[to] == row[at]:
                    to += 1
                if row[at] < top:
                    out[row_of[i]].append((number[i], at, to, row[at]))
                at = to
    per: dict[int, list[tuple[int, int, int, int]]] = {}
    for chunk, found_here in zip(chunks, out, strict=True):
        if found_here:
            per.setdefault(chunk, []).extend(found_here)
    return pa.table(dict(chunk=pa.array(list(per), pa.int64()), owners=pa.array([np.array(v, np.int64).tobytes() for v in per.values()], pa.binary())))


def _cut_texts(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """(doc_id, sha, n_removed, n_spans, kept_sha256) of the texts that stand for their class."""
    ids, texts, known, where = _shared_runs(left, right)
    owned: dict[int, list[tuple[int, int, int]]] = {}
    for blob in right.column("owners").to_pylist() if texts else ():
        for number, a, b, owner in np.frombuffer(blob, np.int64).reshape(-1, 4).tolist() if blob else ():
            owned.setdefault(number, []).append((a, b, owner))
    covered: list[list[tuple[int, int]]] = [[] for _ in texts]
    for number, text, start in where:
        for a, b, owner in owned.get(number, ()):
            if owner < ids[text]:
                covered[text].append((start + a, start + b - 1 + WIDTH))
    rows = []
    for doc, text, spans in zip(ids, texts, covered, strict=True):
        merged: list[list[int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        kept = hashlib.sha256()
        at = 0
        for a, b in merged:
            kept.update(text[at:a])
            at = b
        kept.update(text[at:])
        rows.append((doc, hashlib.sha256(text).hexdigest(), sum(b - a for a, b in merged), len(merged), kept.hexdigest()))
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "sha", "n_removed", "n_spans", "kept_sha256"])


# ------------------------------------------------------------------ operator


def dedup(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, hot_chunks: int = HOT_CHUNKS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per input row.

    docs: doc_id, text; further columns are ignored.  Every byte of the UTF-8
    text goes that a WIDTH-byte string covers which also starts in a document
    with a smaller doc_id, all judged on the input.  Null text counts as empty.
    A null doc_id takes no part: nothing is removed from or because of it.
    Rows that share a doc_id don't remove each other's bytes.  Very long texts are read whole, in overlapping pieces.
    Texts of fewer bytes than WIDTH lose nothing.  An empty table gives no rows.  chunk_bytes and hot_chunks change the dealing, not the rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashed = source.select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes"))
    # only texts that several rows hold are joined: sent where they are few, else split where one has very many rows
    firsts = cut(hashed.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first"))
    if count_of(firsts) <= MAX_SENT_FIRSTS:
        firsts = F.broadcast(firsts)
    info = cut(hashed.join(firsts, "sha", "left").withColumn("first", F.coalesce("first", "doc_id")))
    total = info.where(f"n_bytes >= {WIDTH} and doc_id = first").agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    chunks, parts = int(total // chunk_bytes) + 1, max(shuffle_parts(spark), int(total // PART_BYTES) + 1)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    texts = source.where(f"doc_id is not null and octet_length(text) >= {WIDTH}").select(chunk, "doc_id", "text").groupBy("chunk")
    none = F.lit(None).cast("binary")
    flags = info.where(f"n_bytes >= {WIDTH} and doc_id = first").select(chunk, F.col("doc_id").alias("rep"), "sha", none.alias("keys"), none.alias("owners"))

    def told(rows: DataFrame):
        return rows.groupBy("chunk")

    sent = texts.cogroup(told(flags)).applyInArrow(partial(_send_keys, parts=parts), "part int, chunk long, keys binary")
    replies = cut(sent.groupBy("part").applyInArrow(partial(_reply_keys, hot_chunks=hot_chunks), "chunk long, keys binary"))
    control = flags.unionByName(replies.select("chunk", F.lit(None).cast("long").alias("rep"), F.lit(None).cast("string").alias("sha"), "keys", none.alias("owners")))
    segments = texts.cogroup(told(control)).applyInArrow(partial(_send_segments, parts=parts), "part int, chunk long, anchors binary, numbers binary, segments binary")
    found = cut(segments.groupBy("part").applyInArrow(_find_owners, "chunk long, owners binary"))
    control = control.unionByName(found.select("chunk", F.lit(None).cast("long").alias("rep"), F.lit(None).cast("string").alias("sha"), none.alias("keys"), "owners"))
    done = texts.cogroup(told(control)).applyInArrow(_cut_texts, "doc_id long, sha string, n_removed long, n_spans long, kept_sha256 string")
    # the row that stands for a class may be repeated: every input row gets the verdict
    done = info.where(f"n_bytes >= {WIDTH} and doc_id = first").select("doc_id", "sha", "n_bytes").join(done, ["doc_id", "sha"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    whole = info.where(f"n_bytes < {WIDTH} or doc_id is null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"))
    copies = info.where(f"n_bytes >= {WIDTH} and doc_id <> first").select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    return done.unionByName(whole).unionByName(copies)
