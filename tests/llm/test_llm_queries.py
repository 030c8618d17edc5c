"""Queries over whole tables against SQL, and against plain versions where SQL can't say it."""

import html
import random
import re
from collections import Counter
from fractions import Fraction
from math import pi

import pytest
from oracle import check

from lexmill.llm import queries as Q
from lexmill.llm.decontaminate import decontaminate
from lexmill.llm.extract import main_text
from lexmill.llm.mixing import exact_parts, mix, schedule_blocks
from lexmill.llm.suffix import SPAN, owners, suffix_array
from lexmill.llm.toxicity import toxicity

SF, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_same_rows_as_sql(spark, name):
    check(spark, Q.QUERIES[name], Q.ORACLES[name], SF)


def article(page):
    start, end = page.find("<article>") + 9, page.find("</article>")
    inner = re.sub(r"<(?:br|b)>|</b>", " ", page[start : end if end >= 0 else None])
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_html_is_the_article(spark):
    pages = spark.read.parquet(f"{SF1}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in Q.op2_html_extract(spark, SF1).collect()}
    assert all(got[r["page_id"]] == article(r["html"]) for r in pages.collect())


def test_html_is_the_article_without_its_mark(spark):
    """With the article's tag renamed, stop words, lengths and links alone find the same text on every page."""
    for r in spark.read.parquet(f"{SF1}/pages.parquet").collect():
        assert main_text(re.sub(r"<(/?)article", r"<\1div", r["html"])) == article(r["html"])


def test_suffix_array_and_owners():
    draw = random.Random(5)
    for _ in range(500):
        s = bytes(draw.choice(b"ab\xff") for _ in range(draw.randint(1, 50)))
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    segments = list({bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 3))) + b"c" * (SPAN - 3) + b"\xff" + bytes(draw.choice(b"ab") for _ in range(4)) for _ in range(30)})
    least = [draw.randint(1, 99) for _ in segments]
    for seg, row in zip(segments, owners(segments, least), strict=True):
        for i, low in enumerate(row):
            assert low == min(d for other, d in zip(segments, least, strict=True) if seg[i : i + SPAN] in other)


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/labels.parquet")
    out = toxicity(docs, labels).toPandas()
    assert len(out) == docs.count() and out["score"].between(0, 1).all() and ((out["score"] >= 0.3) == (out["predicted"] == 1)).all()
    held = out[out["held_out"]].merge(labels.toPandas(), on="doc_id")
    hit = held[held["predicted"] == 1]
    assert hit["toxic"].mean() > 0.9 and (held[held["toxic"] == 1]["predicted"]).mean() > 0.45
    # the labels of held-out rows are not learnt
    flipped = labels.withColumn("toxic", (1 - labels["toxic"])).where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2")
    kept = labels.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2")
    again = toxicity(docs, kept.unionByName(flipped.select(*kept.columns))).toPandas()
    both = out.merge(again, on="doc_id")
    assert (both["score_x"] - both["score_y"]).abs().max() < 1e-6


def test_schedule_deviates_by_less_than_a_block():
    for weights in ({"a": 5, "b": 3, "c": 1}, {"x": 1}, {k: 1 / (k + 1) for k in range(40)}, {"a": 997, None: 1}, {"a": Fraction(1, 3), "b": Fraction(2, 3)}, {"a": 1.0, "b": 0.0002, "c": 2**0.5, "d": pi / 9}):
        parts = exact_parts(weights)
        total = sum(parts.values())
        assert all(Fraction(weights[s]) / sum(map(Fraction, weights.values())) == Fraction(p, total) for s, p in parts.items())
        n = 100_000
        slots = schedule_blocks(parts, {s: n * p // total + 2 for s, p in parts.items()})
        owner = {slot: s for s, each in slots.items() for slot in each}
        seen = dict.fromkeys(parts, 0)
        for slot in range(n):
            s = owner[slot]
            assert seen[s] * total // parts[s] <= slot < -(-(seen[s] + 1) * total // parts[s])
            seen[s] += 1
            if slot < 3000 or slot > n - 3000:
                assert all(abs(seen[k] * total - (slot + 1) * p) < total for k, p in parts.items())


def test_mixture_holds_the_weights(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet").select("doc_id", "source", "n_chars")
    rows = mix(docs, {"src0": 0.5, "src1": 0.25, "src2": 0.25}, block_rows=4).orderBy("mix_position").collect()
    assert len(rows) == docs.count() == len({r["mix_position"] for r in rows})
    sizes = Counter(r["source"] for r in rows)
    for s, n in sizes.items():
        assert sorted(r["mix_rank"] for r in rows if r["source"] == s) == list(range(n))
    target = {s: {"src0": 0.5}.get(s, 0.25) for s in sizes}
    total, seen = sum(target.values()), Counter()
    by_slot = {}
    for r in rows:
        by_slot.setdefault(r["mix_slot"], []).append(r["source"])
    for slot in range(max(r["mix_slot"] for r in rows if r["on_target"]) + 1):
        here = by_slot[slot]
        assert len(here) == 4 and len(set(here)) == 1
        seen[here[0]] += 1
        assert all(abs(seen[s] - (slot + 1) * p / total) < 1 for s, p in target.items())


def test_leaks_whole_and_with_other_values(spark):
    docs, bench = spark.read.parquet(f"{SF1}/documents.parquet"), spark.read.parquet(f"{SF1}/benchmark.parquet")
    items = [r["text"] for r in bench.collect()]
    expect = {r["doc_id"] for r in docs.collect() if any(t.lower() in r["text"].lower() for t in items)}  # three hold an item in capitals
    assert {r["doc_id"] for r in decontaminate(docs, bench).where("contaminated").collect()} == expect
    item = "A train leaves with 12 wagons and 30 people, then meets Anna after 12 km and stops there for 30 minutes today."
    other = item.replace("12", "17").replace("30", "44").replace("Anna", "Boris").replace("km", "miles")
    uneven = item.replace("12 wagons", "17 wagons").replace("30", "44")
    rows = [(1, "Before. " + item + " After."), (2, other), (3, uneven), (4, "nothing of the kind is to be found in this longer text at all, really"), (5, None)]
    got = {r["doc_id"]: r for r in decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert (got[1]["contaminated"], got[1]["reparameterised"]) == (True, False)
    assert (got[2]["contaminated"], got[2]["reparameterised"]) == (True, True)
    assert not got[3]["contaminated"] and not got[4]["contaminated"] and not got[5]["contaminated"]


def test_every_message_has_a_place(spark):
    rows = Q.op9_chat_threads(spark, SF1).collect()
    assert len(rows) == spark.read.parquet(f"{SF1}/conversations.parquet").count()
    assert all(r["reply_to"] is None or r["reply_to"] < r["turn"] for r in rows)
