"""Chat threads by quotation linking.

The text of a message is cut into lines by quote depth (leading `>` marks, blanks
between them allowed).  Lines of depth 0 are the author's own; every run of
quoted lines of one depth is a passage.  Passages and their paragraphs, lines
and sentences are cut into tiles of MIN_WORDS words, which are hashed and joined with
the word windows of the own texts of the same conversation; a message holds a
passage if all its tiles lie there in a row, however the lines are wrapped.  A passage of
fewer words must equal a whole text, paragraph, line or sentence.  The original
is the earliest message that holds it.  A message replies to the original of its shallowest linked passage.

Reply order is that of a walk around each tree of replies: every linked message is
entered and left, each step names the next one, and pointer doubling over the
steps adds up what lies behind.  That gives place, depth and root in a number of rounds that grows with the
logarithm of a tree's size, and no row holds a path.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, cut

#: Lines shorter than this many words are no evidence on their own.
MIN_WORDS = 4
#: The tiles of the quotes go to the tasks while they are at most so many (60 bytes each).
MAX_SENT_TILES = 1_000_000
#: Replies to one message are ordered in groups of so many turns.
SIBLINGS = 1024
_PARAGRAPH, _SENTENCE = re.compile(r"\n[ \t]*\n"), re.compile(r"(?<=[.!?])\s+")
_QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
_SAID = re.compile(r"^[^\n]{0,200}\b(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$", re.I)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The author's own text, and the quoted passages with their depth."""
    own: list[str] = []
    quotes: list[tuple[int, str]] = []
    held: list[str] = []
    depth = 0
    for line in text.split("\n"):
        m = _QUOTE.match(line)
        level = m.group(1).count(">") if m else 0
        if level != depth and held:
            quotes.append((depth, "\n".join(held)))
            held = []
        if level:
            if not depth:  # the line that names the author goes with the quote
                while own and not own[-1].strip():
                    own.pop()
                if own and _SAID.match(own[-1]):
                    own.pop()
            held.append(m.group(2))
        else:
            own.append(line)
        depth = level
    if held:
        quotes.append((depth, "\n".join(held)))
    if not quotes:
        return text, quotes
    return "\n".join(own).strip(), quotes


def units(text: str) -> list[tuple[str, ...]]:
    """Words of a whole text and of its paragraphs, lines and sentences, each once."""
    parts = [text, *_PARAGRAPH.split(text), *text.split("\n"), *_SENTENCE.split(text)]
    return [u for u in dict.fromkeys(tuple(p.lower().split()) for p in parts) if u]


def tiles(words: tuple[str, ...]) -> list[tuple[int, int]]:
    """Place and hash of tiles that cover all words."""
    last = max(0, len(words) - MIN_WORDS)
    return [(k, _hash(" ".join(words[k : k + MIN_WORDS]))) for k in [*range(0, last, MIN_WORDS), last]]


def windows(text: str) -> list[tuple[int, int]]:
    """Place and hash of all windows of a text, and of its units that are shorter (place 0)."""
    words = text.lower().split()
    out = [(k, _hash(" ".join(words[k : k + MIN_WORDS]))) for k in range(len(words) - MIN_WORDS + 1)]
    return out + [(0, _hash(" ".join(u))) for u in units(text) if len(u) < MIN_WORDS]


def _asked(quotes: list[tuple[int, str]]) -> list[dict]:
    out = []
    for depth, quote in quotes:
        for k, unit in enumerate(units(quote)):
            if not k or len(unit) >= MIN_WORDS:
                each = tiles(unit)
                out += [{"depth": depth, "whole": k == 0, "unit": _hash(" ".join(unit)), "need": len(each), "at": at, "hash": h} for at, h in each]
    return out


def _parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
    at = batch.schema.get_field_index("text")
    got = [parse(t or "") for t in batch.column(at).to_pylist()]
    kind = pa.list_(pa.struct([("depth", pa.int32()), ("whole", pa.bool_()), ("unit", pa.int64()), ("need", pa.int64()), ("at", pa.int64()), ("hash", pa.int64())]))
    keep = [c for k, c in enumerate(batch.columns) if k != at]
    names = [n for k, n in enumerate(batch.schema.names) if k != at]
    cols = [pa.array([o for o, _ in got], pa.string()), pa.array([len(q) for _, q in got], pa.int64()), pa.array([_asked(q) for _, q in got], kind)]
    return pa.RecordBatch.from_arrays([*keep, *cols], names=[*names, "text", "n_quotes", "quoted"])


def _held(batch: pa.RecordBatch, wanted) -> pa.RecordBatch:
    """(conv_id, origin, place, hash) of the windows of each text, or only of those in the broadcast `wanted`."""
    wanted = wanted.value if wanted is not None else None
    rows = [(k, place, h) for k, t in enumerate(batch.column(2).to_pylist()) for place, h in windows(t or "") if wanted is None or h in wanted]
    take = pa.array([r[0] for r in rows], pa.int64())
    return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["conv_id", "origin", "place", "hash"])


def _walk(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root, place, depth) of every message of a tree of replies.

    parents: conv_id, turn, reply_to (an earlier turn), once each.  place counts from 0 at the root, a
    reply after its original and before the next one.
    """
    nodes = parents.select("conv_id", "turn", "reply_to")
    roots = parents.select("conv_id", F.col("reply_to").alias("turn")).distinct().join(nodes.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")
    # the next reply to the same original: within a group of turns, else the first of the next group
    kin = nodes.withColumn("group", F.floor(F.col("turn") / SIBLINGS))
    inner = Window.partitionBy("conv_id", "reply_to", "group").orderBy("turn")
    outer = Window.partitionBy("conv_id", "reply_to").orderBy("group")
    groups = kin.groupBy("conv_id", "reply_to", "group").agg(F.min("turn").alias("least")).withColumn("after", F.lead("least").over(outer)).drop("least")
    kin = kin.withColumn("next", F.lead("turn").over(inner)).join(groups, ["conv_id", "reply_to", "group"])
    kin = cut(kin.select("conv_id", "turn", "reply_to", F.coalesce("next", "after").alias("next")))
    first = nodes.groupBy("conv_id", F.col("reply_to").alias("turn")).agg(F.min("turn").alias("child"))
    every = kin.unionByName(roots.withColumn("reply_to", F.lit(None)).withColumn("next", F.lit(None)).select("conv_id", "turn", *(F.col(c).cast(nodes.schema["turn"].dataType) for c in ("reply_to", "next"))))
    every = cut(every.join(first, ["conv_id", "turn"], "left"))
    step = lambda turn, leave: F.when(turn.isNotNull(), F.struct(turn.alias("turn"), F.lit(leave).alias("leave")))
    enter = every.select("conv_id", F.struct("turn", F.lit(False).alias("leave")).alias("at"), F.coalesce(step(F.col("child"), False), step(F.col("turn"), True)).alias("to"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("level"))
    leave = every.select("conv_id", F.struct("turn", F.lit(True).alias("leave")).alias("at"), F.coalesce(step(F.col("next"), False), step(F.col("reply_to"), True)).alias("to"), F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("level"))
    # n and level sum up the steps from `at` to just before `to`; the step out of a root has no next one
    steps = cut(enter.unionByName(leave).withColumn("end", F.when(F.col("to").isNull(), F.col("at.turn"))))
    while not steps.where("to is not null").isEmpty():
        on = steps.select("conv_id", F.col("at").alias("to"), F.col("to").alias("_to"), F.col("n").alias("_n"), F.col("level").alias("_level"), F.col("end").alias("_end"))
        moved = steps.where("to is not null").join(on, ["conv_id", "to"])
        moved = moved.select("conv_id", "at", F.col("_to").alias("to"), (F.col("n") + F.col("_n")).alias("n"), (F.col("level") + F.col("_level")).alias("level"), F.col("_end").alias("end"))
        steps = cut(moved.unionByName(steps.where("to is null").select(*moved.columns)))
    entered = steps.where("not at.leave").select("conv_id", "at.turn", F.col("end").alias("root"), "n", "level")
    whole = entered.where("turn = root").select("conv_id", "root", F.col("n").alias("size"))
    return entered.join(whole, ["conv_id", "root"]).select("conv_id", "turn", "root", (F.col("size") - F.col("n")).alias("place"), (-F.col("level")).alias("depth"))


def _escaped(c) -> F.Column:
    """`c` with the opening of a mark set off, so that no text can end its message."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def threads(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n_quotes, reply_to, depth, thread, place, formatted: one row per input row.

    messages: conv_id, turn (a whole number), role, text; further columns are ignored.  text is the
    author's own part; reply_to the turn it answers, null for none; depth the
    replies above it; thread the turn of the message that no message above it replies from; sorted by thread and
    place a conversation is in reply order (a reply after
    its original and before the next one); formatted is the message in chat
    markup, where `<|` within a text or role is written `<\\|`.  Null text counts as empty; a null conv_id or turn is never linked.  Rows
    that share conv_id and turn are one place in the order: a quote of any of them links to that turn,
    and the shallowest link of any of them counts for all.  Of equally shallow passages one found whole goes before
    one found in part, then the later original.  Very long texts are read whole.  A quote whose original is not
    in the conversation, or not before the message, links nothing.  An empty
    table gives no rows.
    """
    data = messages.select("conv_id", "turn", "role", F.col("text").cast("string").alias("text"))
    types = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in ("conv_id", "turn", "role"))
    rows = cut(data.mapInArrow(arrow_rows(_parsed), f"{schema}, text string, n_quotes long, quoted array<struct<depth:int,whole:boolean,unit:long,need:long,at:long,hash:long>>"))
    asking = rows.where("n_quotes > 0").select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*").distinct()
    hashes = [r["hash"] for r in asking.select("hash").distinct().limit(MAX_SENT_TILES + 1).toLocalIterator()]
    wanted = messages.sparkSession.sparkContext.broadcast(frozenset(hashes)) if len(hashes) <= MAX_SENT_TILES else None
    # of equal own texts only the earliest can be the original, and equal passages have the same one
    talks = rows.join(asking.select("conv_id").distinct(), "conv_id", "left_semi").groupBy("conv_id", "text").agg(F.min("turn").alias("turn")).select("conv_id", "turn", "text")
    held = talks.mapInArrow(arrow_rows(partial(_held, wanted=wanted)), f"conv_id {types['conv_id']}, origin {types['turn']}, place long, hash long").distinct()
    found = asking.select("conv_id", "unit", "need", "at", "hash").distinct().join(held, ["conv_id", "hash"])
    holders = found.groupBy("conv_id", "unit", "need", "origin", (F.col("place") - F.col("at")).alias("shift")).agg(F.count_distinct("at").alias("n")).where("n = need")
    originals = holders.groupBy("conv_id", "unit").agg(F.min("origin").alias("origin"))
    links = asking.select("conv_id", "turn", "depth", "whole", "unit").distinct().join(originals, ["conv_id", "unit"]).where("origin < turn")
    best = F.min(F.struct("depth", (~F.col("whole")).alias("part"), (-F.col("origin")).alias("late"))).alias("b")
    parents = cut(links.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", (-F.col("b.late")).alias("reply_to")))
    placed = parents.join(_walk(parents), ["conv_id", "turn"], "right")
    out = rows.join(placed, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "n_quotes",
        "reply_to",
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("root", "turn").alias("thread"),
        F.coalesce("place", F.lit(0)).cast("long").alias("place"),
        F.concat(F.lit("<|"), _escaped(F.col("role")), F.lit("|>\n"), _escaped(F.col("text")), F.lit("<|end|>\n")).alias("formatted"),
    )
