from pyspark.sql import functions as F

from lexmill.operators.graph import label_components
from lexmill.operators.rules import ARTIFACTS, RIGHTS, unexpected_keys, violations
from lexmill.sources import records as R
from lexmill.streaming.ingest import ingest

FEED = """<rss><channel><item><title>T &amp;amp; U</title><link> http://h/1 </link><description>&lt;p&gt;A body that is long enough to stay here&lt;/p&gt;</description>
<category>one</category><category>two</category></item>
<item><title>No link</title><description>x</description></item>
<item><title>Title for a short one</title><link>http://h/2</link><description>short</description></item></channel></rss>"""


def test_feed(spark):
    rows = R.parse_feed(spark.createDataFrame([("f", FEED)], "feed string, xml string"), "name").orderBy("url").collect()
    assert [(r["url"], r["title"], r["text"], r["section"]) for r in rows] == [
        ("http://h/1", "T & U", "A body that is long enough to stay here", "one"),
        ("http://h/2", "Title for a short one", "Title for a short one", None),
    ]
    assert R.parse_feed(spark.createDataFrame([("f", FEED)], "feed string, xml string"), "name", 1).count() == 1


def test_jsonl_round_trip_and_append(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("s", "u1", "t" * 30), ("s", "u2", "x")], "source string, url string, text string")
    kept = docs.where(R.sink_ok(F.col("text"), F.lit(None).cast("boolean")))
    R.append_jsonl(kept, path)
    R.append_jsonl(kept, path)
    back = R.read_jsonl(spark, path)
    assert back.count() == 2 and back.select("url").distinct().count() == 1
    assert [r["url"] for r in R.append_new(docs, back).collect()] == ["u2"]


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF" + b"x" * 997)
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    rows = {r["path"][-5:]: r for r in R.binary_files(spark, str(tmp_path)).collect()}
    assert rows["a.pdf"]["is_kind"] and rows["a.pdf"]["is_cached"] and not rows["b.pdf"]["is_kind"] and not rows["b.pdf"]["is_cached"]
    assert R.checksum_manifest(R.binary_files(spark, str(tmp_path))).count() == 2


def test_fetch_retries(spark):
    def fetch(url):
        if url == "bad":
            raise OSError("down")
        return url.encode()

    rows = {r["url"]: r for r in R.fetch_all(spark.createDataFrame([("ok",), ("bad",)], "url string"), fetch, delay=0).collect()}
    assert bytes(rows["ok"]["content"]) == b"ok" and rows["bad"]["error"] == "down"


def test_best_text_truth_table(spark):
    good, bad = "я" * 200, "x" * 300
    rows = [(1, good, None), (2, bad, good), (3, bad, "x" * 500), (4, bad, "x" * 499), (5, None, None)]
    out = R.best_text(spark.createDataFrame(rows, "id int, raw string, ocr string")).orderBy("id").collect()
    assert [(r["method"], r["readable"]) for r in out] == [("pdf", True), ("pdf_ocr_layout", True), ("pdf_ocr_layout", False), ("pdf_unreadable", False), ("pdf_unreadable", False)]
    texts = spark.createDataFrame([("a" * 499, "pdf", True, "h"), ("a" * 500, "pdf", True, "h"), (None, "pdf", True, "h")], "pdf_text string, method string, readable boolean, html_text string")
    assert [r["text_source"] for r in R.article_text(texts).collect()] == ["html", "pdf", "html"]
    assert R.article_text(texts, "pdf").count() == 1  # shorter than the least


def test_rules(spark):
    rights = spark.createDataFrame([("r", "acquisition", "conditional", "unknown", None, None)], "id string, operation string, status string, basis_type string, acquisition_method string, acquisition_scope string")
    rights = rights.withColumn("derivative_scope", F.array().cast("array<string>")).withColumn("rights_conditions", F.array().cast("array<string>"))
    assert sorted(r["rule_id"] for r in violations(rights, "id", RIGHTS).collect()) == ["C11", "C13", "C9"]
    artifacts = spark.createDataFrame([("k", "retrieved", "sha256:b", "a", "p", 1, "h")], "id string, acquisition_status string, artifact_id string, sha256 string, path string, bytes long, h2_input_sha256 string")
    lists, texts = ("retrievals", "rights_record_ids"), ("extraction_status", "qa_status", "error_code", "error_detail", "label_leakage_audit_version", "label_leakage_audit_status")
    artifacts = artifacts.withColumns({c: F.array().cast("array<string>") for c in lists} | {c: F.lit(None).cast("string") for c in texts} | {"processing_status": F.lit("pending"), "content_role": F.lit("full_text")})
    assert [r["rule_id"] for r in violations(artifacts, "id", ARTIFACTS).collect()] == ["V8"]
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":1,"b":2}',), ('{"a":1,"b":2,"c":3}',), ("{",)], "value string")
    assert unexpected_keys(lines, ("a", "b")).count() == 3


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (3, 9)], "a long, b long")
    assert {r["node"]: r["label"] for r in label_components(edges).collect()} == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7}


def test_ingest_counts_equal_bytes_once(spark, tmp_path):
    land = tmp_path / "in"
    land.mkdir()
    (land / "a").write_bytes(b"1")
    (land / "b").write_bytes(b"1")
    where = (str(land), str(tmp_path / "out"), str(tmp_path / "state"))
    ingest(spark, *where).awaitTermination()
    (land / "c").write_bytes(b"1")
    (land / "d").write_bytes(b"2")
    ingest(spark, *where).awaitTermination()
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{where[1]}/artifacts").count() == 2
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{where[1]}/retrievals").count() == 4


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    from lexmill.streaming.ingest import ARTIFACT, save_to

    save = save_to(str(tmp_path))
    first = spark.createDataFrame([("sha256:a", "f1", 1), ("sha256:a", "f2", 1)], ARTIFACT)
    second = spark.createDataFrame([("sha256:a", "f3", 1), ("sha256:b", "f4", 2)], ARTIFACT)
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        save(batch, number)
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted((r["artifact_id"], r["path"]) for r in read("artifacts").collect()) == [("sha256:a", "f1"), ("sha256:b", "f4")]
    assert read("retrievals").count() == 4


def test_hosts_are_fetched_one_after_another(spark):
    def fetch(url):
        import os
        import time

        if "gone" in url:
            error = OSError("gone")
            error.code = 404
            raise error
        return f"{os.getpid()} {time.time()}".encode()

    urls = spark.createDataFrame([(f"https://h{k % 2}/{k}",) for k in range(6)] + [("https://h0/gone",), (None,)], "url string")
    rows = R.fetch_all(urls.where("url is not null"), fetch, delay=5, pause=0.05).collect()
    for host in ("h0", "h1"):
        seen = sorted((bytes(r["content"]).decode().split() for r in rows if host in r["url"] and r["content"]), key=lambda x: float(x[1]))
        assert len({p for p, _ in seen}) == 1 and all(float(b[1]) - float(a[1]) >= 0.05 for a, b in zip(seen, seen[1:]))
    assert [r["error"] for r in rows if "gone" in r["url"]] == ["gone"]


ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title>One</title><link rel="self" href="http://no/"/><link href="http://h/1"/><published>p</published><updated>u</updated>
<category term="x"/><content type="html">&lt;p&gt;The content of the entry, long enough to be kept.&lt;/p&gt;</content><summary>s</summary></entry><entry><title>Two</title></entry></feed>"""


def test_atom_default_and_broken_feeds(spark):
    rows = [("n", "https://host/f", ATOM, None), ("m", "https://m/", "<rss><channel>", None), ("o", "https://o/", None, "HTTP 500"), ("p", "https://p/", "<rss><channel></channel></rss>", None)]
    feeds = spark.createDataFrame(rows, "name string, feed string, xml string, error string")
    got = R.parse_feed(feeds.where("name = 'n'").select("feed", "xml")).collect()
    assert [(r["source"], r["url"], r["title"], r["text"], r["published"], r["categories"]) for r in got] == [("host:rss", "http://h/1", "One", "The content of the entry, long enough to be kept.", "p", ["x"])]
    every = R.default_feeds(feeds).collect()
    assert sorted((r["source"], r["title"], r["skipped"]) for r in every) == [("m", "feed_error", True), ("n:rss", "One", False), ("o", "feed_error", True)]


def test_pages_in_columns_are_read_in_order(spark):
    import numpy as np

    from lexmill.sources import pdf

    gray = np.full((825, 300), 255, np.uint8)
    gray[40:, 20:280] = 0
    gray[405:, 120:180] = 255
    read = lambda g: f"{g.shape[0]}x{g.shape[1]}"
    first, second = pdf.read_page(gray, 792.0, 0, read), pdf.read_page(gray, 792.0, 1, read)
    assert len(first.split("\n\n")) == 3 and first.split("\n\n")[0].endswith("x300") and len(second.split("\n\n")) == 2
    assert pdf.read_page(np.full((825, 300), 255, np.uint8), 792.0, 0, read) == "825x300"


def test_command_line(spark, tmp_path, capsys):
    from lexmill.cli import main

    line = "Достаточно длинная строка статьи, которая идёт первой на странице и не кончается"
    pages = {
        "https://j/ru/articles/": '<a href="/ru/articles/1999/9/">9</a>',
        "https://j/ru/articles/1999/9/": '<a href="/ru/articles/1999/9/a/">Название статьи</a><a href="/ru/articles/1999/9/b/">x</a>',
        "https://j/ru/articles/1999/9/a/": f'<div class="main"><p>{line}</p><p>{line}</p>© Успехи</div>',
        "https://j/ru/articles/1999/9/b/": "<p>404</p>",
    }
    get = lambda url: pages[url].encode("cp1251")
    out = str(tmp_path / "out")
    assert main(["journal", "-o", out, "--delay", "0", "--base", "https://j"], spark, get) == {"saved": 1, "rejected": 1}
    row = R.read_jsonl(spark, out).first()
    assert (row["title"], row["text"]) == ("Название статьи", f"{line}\n{line}")
    feeds = {"https://f/": FEED, "https://g/": "<rss"}
    assert main(["rss", "-o", str(tmp_path / "rss"), "--delay", "0", "--feed", "https://f/", "--feed", "https://g/"], spark, lambda url: feeds[url].encode()) == {"saved": 1, "feeds with errors": 1}
    (tmp_path / "works.jsonl").write_text('{"work_id": "w"}\n\nnot json\n')
    assert main(["check", "works", str(tmp_path / "works.jsonl")], spark) == {"lines": 2, "rules broken": 2}


def test_only_answers_with_status_200_count(spark):
    rows = spark.createDataFrame([(200, ["a"]), (404, ["b"]), (None, ["c"])], "status int, items array<string>")
    assert [r["items"] for r in R.answered(rows, "items").collect()] == [["a"], None, None]


def test_sidecars_and_tables_that_are_there_stay(spark, tmp_path):
    docs = spark.createDataFrame([("f1", "pdf", "text\nof it")], "stem string, method string, text string")
    R.save_sidecars(docs, str(tmp_path / "s"))
    written = [p.read_text() for p in (tmp_path / "s").glob("name=f1_pdf.txt/part-*")]
    assert written == ["# extracted via pdf\n# source pdf: f1.pdf\n# chars: 10\n# layout: top=1 col (title/PACS/DOI), bottom=left col then right col\n\ntext\nof it\n"]
    R.write_once(docs, str(tmp_path / "t"))
    try:
        R.write_once(docs, str(tmp_path / "t"))
    except Exception as e:  # noqa: BLE001
        assert "exists" in str(e).lower()
    else:
        raise AssertionError("the table was written twice")
