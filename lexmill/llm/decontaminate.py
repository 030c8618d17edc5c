"""Benchmark decontamination by template canonicalisation.

Tokens lose outer punctuation and case; numbers, names (capitalised words that
don't open a sentence, and aren't all in capitals) and units after a number become typed placeholders.  A run of
names or of numbers is one token, so that a full name can stand for a first name.
Windows of WINDOW template tokens are hashed and joined with those of the
benchmark.  A window with few literal tokens has two hashes: that of its raw tokens,
so that a run of numbers matches the same numbers, and that of the template of the
shortest longer window with MIN_LITERALS literal tokens.  An item shorter than WINDOW
is one window, matched by its raw tokens and, with the same share of literal tokens,
by its template.  In each run of overlapping
windows on a diagonal (document position minus item position) the slots must be
consistent: one benchmark value stands for one document value, and the other way round.  Of an inconsistent
run only the windows with equal raw tokens count.  Diagonals at most WINDOW apart
are added up, so inserted, lost and changed words split nothing: if the windows
that count cover enough of the item's tokens, it is a leak, re-parameterised if any
slot differs.  Items of 2 * WINDOW - 1 or 2 * WINDOW tokens have windows one token
shorter, so that one changed word in their middle leaves windows on both sides.

The benchmark's hashes go to the tasks only while they are fewer than
MAX_SENT_WINDOWS; beyond that all windows of the documents are joined by shuffle.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_TABLE, Pack, arrow_rows, cut, mix64, powers, rolled, texts_of, word_spans

WINDOW = 8
MIN_LITERALS = 4
#: A leak covers more than this share of an item's tokens, or so many windows in all.
MIN_SHARE, MIN_RUN = 0.5, 6
#: The benchmark's hashes (8 bytes each), and its windows with their slots, go to all tasks up to these sizes.
MAX_SENT_WINDOWS, MAX_SENT_BYTES = 2_000_000, 64 << 20
#: Units of measurement, lower case.
UNITS = (
    "mm cm m km in ft yd mi g kg mg lb oz ton tons t l ml s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years meter meters metre metres kilometer kilometers gram grams "
    "kilogram kilograms liter liters litre litres mile miles foot feet inch inches pound pounds dollar dollars "
    "euro euros cent cents percent degree degrees km/h mph kmh hz khz mhz ghz w kw v kv a j kj cal kcal pa kpa bar"
).split()

_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"'()*,-./:;<=>?[\\]^_`{|}~")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:\"")] = True
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x1B873593CC9E2D51, 0x38B34AE5A1E38B93, 0x2127599BF4325C37))


def _two_bytes() -> tuple[np.ndarray, np.ndarray]:
    """For every code point of two UTF-8 bytes: the code point in lower case, and whether it is a capital."""
    low, capital = np.arange(0x800), np.zeros(0x800, bool)
    for c in range(0x80, 0x800):
        small = chr(c).lower()
        if chr(c).isupper() and len(small) == 1 and 0x80 <= ord(small) < 0x800:
            low[c], capital[c] = ord(small), True
    return low, capital


_LOW, _CAPITAL = _two_bytes()


def _folded(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with letters of one or two bytes (Latin, Greek, Cyrillic) in lower case, and where a capital letter begins."""
    low = raw.copy()
    capital = (raw >= 0x41) & (raw <= 0x5A)
    low[capital] += 32
    lead = np.flatnonzero((raw[:-1] >= 0xC2) & (raw[:-1] <= 0xDF) & ((raw[1:] & 0xC0) == 0x80))
    code = ((raw[lead].astype(np.int64) & 0x1F) << 6) | (raw[lead + 1] & 0x3F)
    small = _LOW[code]
    low[lead], low[lead + 1] = 0xC0 | (small >> 6), 0x80 | (small & 0x3F)
    capital[lead[_CAPITAL[code]]] = True
    return low, capital


class Template:
    """Template tokens of many texts: hash, kind, byte span and text of each."""

    def __init__(self, texts: list[bytes]):
        pack = Pack(texts)
        low, capital = _folded(pack.bytes)
        self.pack = pack
        begin, end, doc = word_spans(pack)
        plain = ~_PUNCT[pack.bytes]
        n = len(plain)
        index = np.where(plain, np.arange(n), n)
        following = np.minimum.accumulate(index[::-1])[::-1]
        leading = np.maximum.accumulate(np.where(plain, np.arange(n), -1))
        s, e = following[begin], leading[end - 1] + 1
        real = s < e
        real &= (s >= begin) & (s < end)
        stop = _STOPS[pack.bytes[end - 1]]
        opens = np.ones(len(begin), bool)
        opens[1:] = stop[:-1] | (doc[1:] != doc[:-1])
        gap = np.zeros(len(begin), bool)  # a new line opens a sentence, too
        lines = np.concatenate(([0], np.cumsum(pack.bytes == 0x0A)))
        gap[1:] = lines[begin[1:]] != lines[end[:-1]]
        opens |= gap
        s, e, doc, opens = s[real], e[real], doc[real], opens[real]
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_TABLE[low] * powers(n + 1)[0][:n], out=prefix[1:])
        raw_hash = mix64((prefix[e] - prefix[s]) * pack.inverse[s]) if len(s) else np.zeros(0, np.uint64)
        number = self._numbers(s, e)
        # a word in capitals is no name, as a text may be set in them; one letter is an initial beside a name
        second = s + np.where(pack.bytes[s] >= 0xC0, 2, 1)
        name = capital[s] & ~opens & (second < e) & ~capital[np.minimum(second, n - 1)]
        beside = np.zeros(len(s) + 2, bool)
        beside[2:] |= name
        beside[:-2] |= name
        name |= capital[s] & ~opens & (second >= e) & beside[1:-1]
        unit = np.zeros(len(s), bool)
        unit[1:] = number[:-1] & (doc[1:] == doc[:-1]) & np.isin(raw_hash[1:], unit_hashes())
        kind = np.where(number, 1, np.where(unit, 2, np.where(name, 3, 0)))
        # the tokens of a run of numbers or names are one: head is its first
        goes_on = np.zeros(len(s), bool)
        goes_on[1:] = (kind[1:] == kind[:-1]) & (kind[1:] % 2 == 1) & (doc[1:] == doc[:-1])
        head = np.flatnonzero(~goes_on)
        last = np.append(head[1:], len(s)) - 1
        if len(head) < len(s):
            power, inverse = powers(len(s) + 1)
            prefix = np.zeros(len(s) + 1, np.uint64)
            np.cumsum(raw_hash * power[: len(s)], out=prefix[1:])
            joined = mix64((prefix[last + 1] - prefix[head]) * inverse[head])
            raw_hash = np.where(last > head, joined, raw_hash[head])
        kind, doc = kind[head], doc[head]
        self.start, self.end, self.doc = s[head], e[last] if len(s) else e, doc
        self.slot = kind > 0
        self.token, self.raw_hash = np.where(kind == 0, raw_hash, np.array([0, NUMBER, UNIT, NAME], np.uint64)[kind]), raw_hash
        self.literal = np.concatenate(([0], np.cumsum(~self.slot)))
        self.counts = np.bincount(doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))[:-1]

    def _numbers(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Tokens that begin with a digit, after a currency sign or not."""
        if not len(s):
            return np.zeros(0, bool)
        raw = np.concatenate((self.pack.bytes, np.zeros(4, np.uint8)))
        skip = np.where(raw[s] == 0x24, 1, 0)  # $
        skip[(raw[s] == 0xC2) & ((raw[s + 1] == 0xA3) | (raw[s + 1] == 0xA5))] = 2  # pound, yen
        skip[(raw[s] == 0xE2) & (raw[s + 1] == 0x82) & (raw[s + 2] == 0xAC)] = 3  # euro
        skip[(skip > 0) & ((raw[s + skip] == 0x2E) | (raw[s + skip] == 0x2D))] += 1  # $.50, $-3
        return _DIGIT[raw[s + skip]] & (s + skip < e)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token, number of tokens and key of the windows of `size` tokens, slot-dense ones also longer."""
        w = max(0, len(self.start) - size + 1)
        if not w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        literals = self.literal[size : size + w] - self.literal[:w]
        at = np.flatnonzero(self.doc[:w] == self.doc[size - 1 :])
        enough = WINDOW * literals[at] >= MIN_LITERALS * size
        plain = at[enough]
        raw = at if size < WINDOW - 1 else at[~enough]  # a short item has no other window that could match
        found = [(plain, np.full(len(plain), size), rolled(self.token, size)[plain]), (raw, np.full(len(raw), size), rolled(self.raw_hash, size)[raw] ^ np.uint64(1))]
        dense = at[~enough]
        if size >= WINDOW - 1 and len(dense):
            end = np.searchsorted(self.literal, self.literal[dense] + MIN_LITERALS)
            last = self.first[self.doc[dense]] + self.counts[self.doc[dense]]
            dense, end = dense[end <= last], end[end <= last]
            power, inverse = powers(len(self.token) + 1)
            prefix = np.zeros(len(self.token) + 1, np.uint64)
            np.cumsum(self.token * power[:-1], out=prefix[1:])
            found.append((dense, end - dense, mix64((prefix[end] - prefix[dense]) * inverse[dense]) ^ np.uint64(2)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def slots(self, at: int, size: int) -> list[str]:
        return [" ".join(self.pack.raw[self.start[k] : self.end[k]].decode("utf-8", "replace").lower().split()) if self.slot[k] else "" for k in range(at, at + size)]


def sizes_of(n: np.ndarray) -> np.ndarray:
    """Window size of items of n tokens."""
    return np.where((n == 2 * WINDOW - 1) | (n == 2 * WINDOW), WINDOW - 1, np.minimum(n, WINDOW))


_units: list[np.ndarray] = []


def unit_hashes() -> np.ndarray:
    if not _units:
        pack = Pack([u.encode() for u in UNITS])
        _units.append(mix64(pack.hash(pack.starts, pack.ends)))
    return _units[0]


def _windows(batch: pa.RecordBatch, wanted, sizes: tuple[int, ...] | None) -> pa.RecordBatch:
    """(id, key, pos, size, base, n, slots) of each window of `sizes`, or only of those whose key is wanted (sorted).

    Without `sizes` each text has windows of its own base size.  n is the number of tokens of the text.
    """
    wanted = wanted.value if hasattr(wanted, "value") else wanted
    t = Template(texts_of(batch))
    own = sizes_of(t.counts)
    found = []
    for base in sizes or np.unique(own[t.counts > 0]).tolist():
        at, size, keys = t.windows(base)
        if sizes is None:
            mine = own[t.doc[at]] == base
            at, size, keys = at[mine], size[mine], keys[mine]
        if wanted is not None:
            pick = np.flatnonzero(_bitmap(wanted)[keys >> np.uint64(44)])
            if len(wanted):
                k = np.minimum(np.searchsorted(wanted, keys[pick]), len(wanted) - 1)
                pick = pick[wanted[k] == keys[pick]]
            at, size, keys = at[pick], size[pick], keys[pick]
        found.append((at, size, keys, np.full(len(at), base)))
    none = np.zeros(0, np.int64)
    at, size, keys, base = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none.view(np.uint64), none)
    rows = t.doc[at]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(rows)),
            pa.array(keys.view(np.int64)),
            pa.array(at - t.first[rows], pa.int64()),
            pa.array(size, pa.int64()),
            pa.array(base, pa.int64()),
            pa.array(t.counts[rows], pa.int64()),
            pa.array([t.slots(k, n) for k, n in zip(at, size, strict=True)], pa.list_(pa.string())),
        ],
        names=["id", "key", "pos", "size", "base", "n", "slots"],
    )


_maps: list[tuple[np.ndarray, np.ndarray]] = []


def _bitmap(wanted: np.ndarray) -> np.ndarray:
    if not _maps or _maps[0][0] is not wanted:  # a worker outlives its query, so an id() may come again
        bits = np.zeros(1 << 20, bool)
        bits[wanted >> np.uint64(44)] = True
        _maps[:] = [(wanted, bits)]
    return _maps[0][1]


def windows(texts: DataFrame, wanted=None, sizes: tuple[int, ...] | None = None) -> DataFrame:
    """texts: id, text; wanted: a broadcast of sorted keys."""
    return texts.mapInArrow(arrow_rows(partial(_windows, wanted=wanted, sizes=sizes)), "id long, key long, pos long, size long, base long, n long, slots array<string>")


def _counting(hits: dict[tuple[int, int], tuple[list[str], list[str]]]) -> list[tuple[int, int, bool]]:
    """(first token, end, differs) of the windows of one diagonal that count; hits: slots of both, by item position and size."""
    out, run, end = [], [], -1
    for at in [*sorted(hits), None]:
        if run and (at is None or at[0] >= end):
            each = [{p for p in zip(i, d, strict=True) if p[0] and p[1]} for _, _, i, d in run]  # with equal raw tokens, one side's name may open a sentence on the other
            differs = [any(i != d for i, d in pairs) for pairs in each]
            pairs = set().union(*each)
            consistent = len(pairs) == len({i for i, _ in pairs}) == len({d for _, d in pairs})
            out += [(a, b, other) for (a, b, _, _), other in zip(run, differs, strict=True) if consistent or not other]
            run = []
        if at is not None:
            run.append((at[0], sum(at), *hits[at]))
            end = max(end, sum(at))
    return out


def _judge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The leak of one item in one document, if it is one."""
    n = table.column("n")[0].as_py()
    diagonals: dict[int, dict[tuple[int, int], tuple[list[str], list[str]]]] = {}
    for pos, diagonal, size, *hit in zip(*(table.column(c).to_pylist() for c in ("item_pos", "diagonal", "size", "item_slots", "slots")), strict=True):
        held = diagonals.setdefault(diagonal, {})
        held[pos, size] = min(held.get((pos, size), tuple(hit)), tuple(hit))
    groups: list[list[tuple[int, int, bool]]] = []
    last = None
    for diagonal in sorted(diagonals):
        good = _counting(diagonals[diagonal])
        if not good:
            continue
        if last is None or diagonal - last > WINDOW:
            groups.append([])
        groups[-1] += good
        last = diagonal
    leaked = []
    for group in groups:
        n_windows = len({a for a, _, _ in group})
        share = len({k for a, b, _ in group for k in range(a, b)}) / n
        if share > MIN_SHARE or n_windows >= MIN_RUN:
            leaked.append((n_windows, share, any(differs for _, _, differs in group)))
    rows = [(key[0].as_py(), key[1].as_py(), max(x[0] for x in leaked), max(x[1] for x in leaked), min(x[2] for x in leaked))] if leaked else []
    types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["doc_id", "item_id", "n_windows", "share", "reparameterised"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, share, reparameterised), a row per leaked item of a document."""
    items = cut(windows(benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))).where("id is not null").withColumnsRenamed({"id": "item_id", "pos": "item_pos", "slots": "item_slots"}))
    bases = tuple(sorted(r["base"] for r in items.select("base").distinct().collect())) or (WINDOW,)
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(F.concat_ws("", "item_slots")) + 16 * F.size("item_slots") + 60), F.lit(0)).alias("bytes")).first()
    wanted = None
    if size["n"] <= MAX_SENT_WINDOWS:
        keys = np.fromiter((r["key"] for r in items.select("key").distinct().toLocalIterator()), np.int64)
        wanted = docs.sparkSession.sparkContext.broadcast(np.sort(keys.view(np.uint64)))
    found = windows(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")), wanted, bases).where("id is not null").select(F.col("id").alias("doc_id"), "key", "pos", "size", "slots")
    side = items.select("item_id", "key", "item_pos", "size", "n", "item_slots")
    hits = found.join(F.broadcast(side) if size["bytes"] <= MAX_SENT_BYTES else side, ["key", "size"])
    hits = hits.select("doc_id", "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("diagonal"), "size", "n", "item_slots", "slots")
    return hits.groupBy("doc_id", "item_id").applyInArrow(_judge, "doc_id long, item_id long, n_windows long, share double, reparameterised boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per input row: doc_id, contaminated, n_items, item_ids, reparameterised.

    docs: doc_id, text; benchmark: item_id, text; further columns are ignored.
    Null texts and texts without a token match nothing; an item of fewer than WINDOW
    tokens, even of one, matches wherever it stands whole; a null doc_id or item_id never matches.  Rows that share a doc_id are one document.
    Very long texts are searched whole.  Repeated items count once per item_id; equal items of
    different item_id are all leaked; of several hits at one place that with the least slots counts.  Empty tables give no leak.
    """
    per_doc = leaks(docs, benchmark).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("reparameterised").alias("reparameterised"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(per_doc, "doc_id", "left")
    return out.select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    )
