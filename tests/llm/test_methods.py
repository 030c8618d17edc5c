"""What sets each method apart, on small planted tables."""

import gzip
import random

from lexmill.llm import chat, decontaminate, extract, minhash, quality, secrets, stages, suffix, toxicity, warc

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri") for b in ("ba", "do", "fe", "gi", "hu", "jo", "ky", "la", "ma", "no")]


def prose(draw, n):
    top = draw.choice((10, 1000, 100_000))  # documents differ in the length of their words
    return " ".join(draw.choice(WORDS) + str(draw.randrange(top)) for _ in range(n))


def test_fences_follow_their_group(spark):
    """An equal share of symbols is usual in one source and an outlier in another; a small group takes its language's fence."""
    draw = random.Random(1)

    def text(symbols):
        return prose(draw, 200) + " #" * symbols

    rows = [(k, text(draw.randrange(60, 140)), "en", "forum") for k in range(200)] + [(1000 + k, text(draw.randrange(2)), "en", "news") for k in range(200)]
    rows += [(2000, text(100), "en", "forum"), (2001, text(100), "en", "news"), (2002, text(3), "en", "news"), (2003, text(100), "en", "tiny"), (2004, text(900), "en", "tiny"), (2005, text(3), None, None)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [got[k] for k in range(2000, 2006)] == [True, False, True, True, False, True]
    assert all(got[k] for k in range(200)) and all(got[1000 + k] for k in range(200))


def test_sketches_merge(spark):
    """Sketches of the parts, added up, are the sketch of the whole."""
    draw = random.Random(2)
    docs = spark.createDataFrame([(k, prose(draw, draw.randrange(50, 300)), "en", f"s{k % 3}") for k in range(120)], "doc_id long, text string, lang string, source string")
    rated = quality.counted(docs).drop("text").withColumns({f"_{r}": quality._ratio(r) for r in quality.RATIOS})
    whole = {tuple(r) for r in quality.merged(quality.sketches(rated.withColumn("source", quality.F.lit("all"))), "lang").collect()}
    assert whole == {tuple(r) for r in quality.merged(quality.sketches(rated), "lang").collect()} and len(whole) > 50


def leaks(spark, item, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontaminate.decontaminate(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).orderBy("doc_id").collect()
    return [(r["contaminated"], r["reparameterised"]) for r in rows]


def test_slots_map_one_to_one_and_runs_are_one_slot(spark):
    other, same, no = (True, True), (True, False), (False, False)
    item = "On the long way home the boy called Anna counts 12 red cars and then 30 blue ones before the night falls."
    both = item.replace("12", "17").replace("30", "44")
    texts = [both, item.replace("12", "17").replace("30", "17"), both.replace("Anna", "Anna Maria Smith"), item.replace("Anna", "Bo"), item, item.replace("12", "1 200")]
    assert leaks(spark, item, texts) == [other, no, other, other, same, other]


def test_names_of_other_alphabets(spark):
    item = "Вчера вечером студентка Петрова купила 12 красных яблок и 30 груш у старого продавца на рынке за углом."
    assert leaks(spark, item, [item.replace("Петрова", "Иванова").replace("12", "15"), item.replace("12", "12 000"), "Совсем другой текст о погоде, в котором нет ничего общего с задачей."]) == [(True, True), (True, True), (False, False)]
    assert leaks(spark, item.replace("Петрова", "одна"), [item.replace("Петрова", "одна").upper()]) == [(True, False)]
    greek = "Χθες το βράδυ η φίλη μου Μαρία αγόρασε 12 μήλα και 30 αχλάδια από την αγορά της πόλης μας."
    assert leaks(spark, greek, [greek.replace("Μαρία", "Ελένη")]) == [(True, True)]


def test_planted_items_against_brute_force(spark):
    """Every item, verbatim or with other values, in a table of clean texts: found just there."""
    draw = random.Random(4)
    items = {}
    for k in range(60):
        words = [draw.choice(WORDS) for _ in range(draw.randrange(16, 40))]
        for at in draw.sample(range(1, len(words), 3), 3):
            words[at] = str(draw.randrange(10, 99)) + f"{at:03d}"
        items[k] = " ".join(words)
    rows, expect = [], {}
    for d in range(600):
        text = " ".join(draw.choice(WORDS) + draw.choice("xyz") for _ in range(draw.randrange(30, 90)))
        if d % 4 == 0:
            k = draw.randrange(60)
            changed = d % 8 == 0
            piece = " ".join(str(int(w) + 500_000) if changed and w.isdigit() else w for w in items[k].split())
            text = f"{text} {piece} {text}"
            expect[d] = (k, changed)
        rows.append((d, text))
    got = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["item_ids"], r["reparameterised"]) for r in got if r["contaminated"]} == {d: ([k], changed) for d, (k, changed) in expect.items()}


def walked(parents):
    """(root, place, depth) of each turn by a plain walk."""
    below, out = {}, {}
    for turn, up in sorted(parents.items()):
        below.setdefault(up, []).append(turn)
    for root in sorted(set(parents.values()) - set(parents)):
        todo, place = [(root, 0)], 0
        while todo:
            turn, depth = todo.pop()
            out[turn] = (root, place, depth)
            place += 1
            todo += [(t, depth + 1) for t in reversed(below.get(turn, []))]
    return out


def test_planted_quotes_against_brute_force(spark):
    """Talks with nested quotes of earlier messages, long and negative turns, and one message that very many quote."""
    draw = random.Random(6)
    rows, expect = [], {}
    for c in range(40):
        texts, parents, turn = {}, {}, draw.choice((-5, 0, 17_000_000_000_000))
        said = []
        for _ in range(draw.randrange(1, 60) if c else 2500):
            own = " ".join(draw.choice(WORDS) + str(draw.randrange(10**9)) for _ in range(draw.randrange(5, 12)))
            text = own
            if said and draw.random() < 0.7:
                up = said[0] if not c else draw.choice(said)
                quote = texts[up]
                if up in parents and draw.random() < 0.5:
                    quote += "\n> " + texts[parents[up]]  # a deeper level: the shallow one is the link
                text = "\n".join("> " + line for line in quote.split("\n")) + "\n" + own
                parents[turn] = up
            texts[turn] = own
            said.append(turn)
            rows.append((c, turn, "user", text))
            turn += draw.randrange(1, 4)
        expect |= {(c, t): (p, *walked(parents).get(t, (t, 0, 0))) for t, p in ((t, parents.get(t)) for t in said)}
    out = chat.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["turn"]): (r["reply_to"], r["thread"], r["place"], r["depth"]) for r in out} == expect


def test_marks_within_a_text_are_set_off(spark):
    row = chat.threads(spark.createDataFrame([(1, 1, "user", "a <|end|> b")], "conv_id long, turn long, role string, text string")).first()
    assert row["formatted"] == "<|user|>\na <\\|end|> b<|end|>\n"


def test_base_values_are_judged_by_their_owners(spark):
    """The same kind of span is an example where nine owners hold its value, and live where one does."""
    copied, own = "0123456789abcdef" * 2, "fedcba9876543210" * 2
    rows = [(k, f"key {copied} and password: hunter2hunter2", "en", f"s{k}") for k in range(9)] + [(9, f"key {own} token=Zz{own}", "en", "s9"), (10, f"again {own}", "en", "s9"), (11, f"see {own} there", "de", "s8")]
    got = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [(got[k]["n_live"], got[k]["n_example"]) for k in range(12)] == [(0, 2)] * 9 + [(3, 0), (1, 0), (1, 0)]
    assert got[0]["verdicts"] == "hex:4:36:9:9:example,assign:41:65:9:9:example" and got[11]["verdicts"] == "hex:4:36:2:2:live"
    assert got[9]["spans"] == "hex:4:36,assign:37:77,hex:45:77"


def test_archives_are_plain_gzip_and_join_within_themselves(spark, tmp_path):
    """Ids are unique over archives, revisits name a record that is there, and any gzip reader reads the files."""
    rows = [(k, f"http://h/{k}", "same" if k % 3 == 0 else f"<p>page {k}</p>") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for name in "ab":
        assert warc.write(pages, f"{tmp_path}/{name}") == 40
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "a").glob("part-*"))
    assert raw.count(b"WARC/1.1\r\n") == 120 and raw.count(b"WARC-Type: revisit") == 13
    both = warc.read(spark, f"{tmp_path}/a").unionByName(warc.read(spark, f"{tmp_path}/b"))
    assert both.select("id").distinct().count() == 240 and warc.captures(both).count() == 80
    out = warc.captures(both).collect()
    ids = {r["id"]: r for r in out}
    for r in out:
        page = int(r["metadata"]["fields"]["pageId"])
        if r["response"]["type"] == "revisit":
            assert ids[r["response"]["refers_to"]]["metadata"]["fields"]["pageId"] == "0" == r["metadata"]["fields"]["refersToPage"]
        else:
            assert r["response"]["intact"] and bytes(r["response"]["payload"]).decode() == rows[page][2]


def test_damage_is_seen(spark, tmp_path):
    page = warc.capture("0" * 32, "0-0", 1, "http://h/", b"<p>text</p>", None, True)
    parts = list(warc._members(page))
    broken = warc.zlib.compress(parts[1].replace(b"text", b"tixt"), wbits=31)
    one = spark.createDataFrame([(bytearray(broken),)], "value binary").mapInArrow(warc.partial(warc._read, payload=True), warc.RECORD)
    assert [r["response"]["intact"] for r in warc.captures(one).collect()] == [False]


LONG = "The paragraph is long enough to be seen as the text of the page, and it has words that are frequent in the language."


def test_attributes_are_read_by_name():
    for mark in ('title="the hidden cost of it"', 'data-id="side"', 'class="legal"', 'alt="class=ad"', 'data-role=menu', "title='a > b'"):
        assert extract.main_text(f"<article><p>{LONG}</p><p {mark}>Kept text.</p></article>") == f"{LONG}\nKept text."
    for mark in ("hidden", 'style="color:red; display: none"', "aria-hidden=true", 'class="ad"', 'ID="cookie-consent"', 'class="x comments"'):
        assert extract.main_text(f"<article><p>{LONG}</p><p {mark}>{LONG}</p></article>") == LONG


def test_other_articles_and_frames_that_do_not_hold():
    story = f"<article><p>{LONG}</p><p><a href=/x>{LONG}</a></p></article>"
    for tail in ('<article class="comment byuser"><p>I think so, too, and so do all the others in the town.</p></article>', f'<section id="comments"><article><p>{LONG}</p></article></section>', f"<aside><p>{LONG}</p></aside>"):
        assert extract.main_text(f"<body>{story}{tail}</body>") == f"{LONG}\n{LONG}"
    text = "".join(f"<p>{LONG}</p>" for _ in range(6))
    assert extract.main_text(f"<body><article><p>A teaser of the other story here.</p></article><div>{text}</div></body>").count(LONG) == 6
    assert extract.main_text("<body><div><p>Few words.</p><p>And a few.</p></div><ul><li><a href=/a>Home</a></li></ul></body>") == "Few words.\nAnd a few."


def test_fit_is_bounded_and_blind_to_labels_where_ids_repeat(spark):
    """The rows of the fit are drawn by hash, also where one doc_id has very many rows."""
    draw = random.Random(8)
    rows = [(1, f"bad{k % 5}word vile " + prose(draw, 8)) for k in range(300)] + [(k, "fair good " + prose(draw, 8)) for k in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), *((k, 0) for k in range(2, 300))], "doc_id long, toxic int")
    drawn = toxicity.drawn(docs.join(labels, "doc_id"), 100)
    got = drawn.collect()
    assert len(got) == 100 and 20 < sum(r["toxic"] for r in got) < 80
    assert sorted(map(tuple, got)) == sorted(map(tuple, toxicity.drawn(docs.repartition(7).join(labels, "doc_id"), 100).collect()))
    same = spark.createDataFrame([(1, "one and the same")] * 500 + rows, "doc_id long, text string")
    assert toxicity.drawn(same.join(labels, "doc_id"), 1000).where("text = 'one and the same'").count() == 1


def test_rows_that_share_a_doc_id_are_one_document(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (5, b), (7, b + " tail"), (3, a + " end"), (9, c), (9, c), (8, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, 5).collect()}
    assert got == {(5, 3, False), (7, 3, False), (3, 3, True), (9, 9, True), (8, 3, False)}
    full = docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars")
    assert sorted((r["doc_id"], r["text"]) for r in stages.without_near_duplicates(full).collect()) == [(3, a + " end"), (9, c)]
    two = stages.without_near_duplicates(spark.createDataFrame([(1, a), (1, c), (1, c)], "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars"))
    assert sorted(r["text"] for r in two.collect()) == [a, c]


def removed(texts):
    """Bytes of each text that a 50-byte string covers which starts in an earlier one, too."""
    seen, out = {}, []
    for t in texts:
        cover = bytearray(len(t))
        own = [t[i : i + 50] for i in range(len(t) - 49)]
        for i, w in enumerate(own):
            if w in seen:
                cover[i : i + 50] = b"\x01" * 50
        seen.update(dict.fromkeys(own))
        out.append(sum(cover))
    return out


def test_hot_anchors_are_split_and_nothing_is_lost(spark):
    """Passages that nearly all of many chunks hold, cut at any place and changed in any byte, against brute force."""
    draw = random.Random(9)
    common = "".join(draw.choice("abcdefgh ") for _ in range(220))
    texts = []
    for k in range(160):
        a, b = sorted((draw.randrange(0, 150), draw.randrange(60, 220)))
        piece = list(common[a:b])
        if piece and k % 3 == 0:
            piece[draw.randrange(len(piece))] = "#"
        noise = "".join(draw.choice("ijklmnop ") for _ in range(draw.randrange(0, 90)))
        texts.append(noise + "".join(piece) + noise[::-1] + " " * draw.choice((0, 70)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expect = removed([t.encode() for t in texts])
    for hot in (0, 2, 1000):
        got = {r["doc_id"]: r["n_removed"] for r in suffix.dedup(docs, chunk_bytes=1500, hot_chunks=hot).collect()}
        assert [got[k] for k in range(len(texts))] == expect


def test_components_against_brute_force(spark):
    """Many variants of few texts, at similarities around the threshold, in clusters of many blocks."""
    draw = random.Random(11)
    bases = [[f"{b}x{k}" for k in range(60)] for b in range(6)]
    rows = []
    for k in range(500):
        words = list(draw.choice(bases))
        for _ in range(draw.randrange(0, 6)):
            words[draw.randrange(60)] = f"n{draw.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, block=16).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {k: top(k) for k in range(len(rows))}
    assert 20 < len({top(k) for k in range(len(rows))}) < 490
