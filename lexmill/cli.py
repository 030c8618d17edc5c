"""Command line: collect documents from a journal or feeds, rebuild texts from files, check registries.

`python -m lexmill.cli journal --max-issues 2 -o corpus.jsonl`; every command ends with a line of counts.
Output is a folder of JSON lines, which may not be there yet unless --append is given.
"""

from __future__ import annotations

import argparse
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import registries
from .sources import crawl, pdf, records

#: The feeds read by default.
FEEDS = {"quantum-electronics.ru": "https://quantum-electronics.ru/feed/", "ufn.ru": "https://ufn.ru/ru/articles/rss.xml"}
TIMEOUT = 45


def fetch(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:  # noqa: S310
        return answer.read()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexmill")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, **more) -> argparse.ArgumentParser:
        p = sub.add_parser(name, **more)
        p.add_argument("-o", "--output", default="corpus.jsonl")
        p.add_argument("--append", action="store_true", help="add to the output instead of making it anew")
        p.add_argument("--delay", type=float, default=1.0, help="seconds between requests to one host")
        return p

    p = command("journal", help="crawl the journal's archive")
    p.add_argument("--max-issues", type=int)
    p.add_argument("--max-articles", type=int, default=0, help="per issue; 0: all")
    p.add_argument("--max-docs", type=int)
    p.add_argument("--rss", action="store_true", help="the journal's own feed, too")
    p.add_argument("--rss-limit", type=int, default=20)
    p.add_argument("--text-source", choices=("html", "pdf", "pdf+html"), default="html")
    p.add_argument("--min-pdf-chars", type=int, default=records.MIN_PDF_CHARS)
    p.add_argument("--base", default=crawl.BASE)
    p = command("rss", help="read feeds")
    p.add_argument("--feed", action="append", help="address; may be given more than once")
    p.add_argument("--limit", type=int, default=20)
    p = command("rebuild", help="take texts anew from PDF files")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("--pdf-dir", required=True)
    p.add_argument("-n", "--limit", type=int, help="documents that could be read")
    p = sub.add_parser("check", help="check the lines of a registry")
    p.add_argument("registry", choices=sorted(registries.REGISTRIES))
    p.add_argument("path")
    return top


def _save(docs: DataFrame, args: argparse.Namespace, filtered: bool) -> int:
    docs = docs.cache()
    if filtered:
        docs = docs.where(records.sink_ok(F.col("text"), F.col("skipped") if "skipped" in docs.columns else F.lit(False)))
    if args.append:
        records.append_jsonl(docs, args.output)
    else:
        records.write_once(docs, args.output, "json")
    return docs.count()


def journal(spark: SparkSession, args: argparse.Namespace, get: Callable[[str], bytes], extract: pdf.Extract | None = None) -> dict[str, int]:
    """Crawls listing, issues and articles one after another, each as one distributed fetch."""

    def pages(paths: DataFrame, charset: str = "cp1251") -> DataFrame:
        return records.fetch_text(paths, get, args.base, charset, pause=args.delay).cache()

    archive = pages(spark.createDataFrame([("/ru/articles/",)], "path string"))
    listed = crawl.resolve.issue_paths(archive, args.max_issues)
    issues = pages(listed).withColumnRenamed("path", "issue_path")
    found = crawl.resolve.article_paths(issues.where("html is not null"))
    articles = pages(found.select("path").distinct())
    texts = None
    if extract and args.text_source != "html":
        main = crawl.main_block(F.col("html"))
        links = articles.select(crawl.pdf_link(main, F.col("path"), args.base).alias("url")).where("url is not null")
        files = records.fetch_all(links, get, pause=args.delay).where("content is not null").select(F.col("url").alias("path"), "content")
        texts = pdf.combined(files.cache(), extract).withColumnRenamed("path", "pdf_url")
    docs, rejects = crawl.crawl(archive, issues, articles, texts, args.max_issues, args.max_articles, args.max_docs, mode=args.text_source, min_chars=args.min_pdf_chars, base=args.base)
    counts = {"saved": _save(docs.drop("path"), args, False), "rejected": rejects.count()}
    if args.rss:
        feed = records.fetch_text(spark.createDataFrame([("/ru/articles/rss.xml",)], "path string"), get, args.base, None, pause=args.delay).select(F.col("path").alias("feed"), F.col("html").alias("xml"))
        args.append = True
        counts["from the feed"] = _save(records.journal_rss(feed, crawl.SOURCE, args.rss_limit), args, True)
    return counts


def rss(spark: SparkSession, args: argparse.Namespace, get: Callable[[str], bytes]) -> dict[str, int]:
    named = [(f, f) for f in args.feed] if args.feed else list(FEEDS.items())
    feeds = spark.createDataFrame(named, "name string, feed string")
    if args.feed:
        feeds = feeds.withColumn("name", records.T.host(F.col("feed")))
    got = records.fetch_all(feeds.select(F.col("feed").alias("url")), get, pause=args.delay)
    rows = feeds.join(got, feeds["feed"] == got["url"]).select("name", "feed", records.T.decode_text("content", F.lit("utf-8")).alias("xml"), "error").cache()
    items = records.default_feeds(rows, args.limit).cache()
    return {"saved": _save(items, args, True), "feeds with errors": items.where("skipped").count()}


def rebuild(spark: SparkSession, args: argparse.Namespace, extract: pdf.Extract | None) -> dict[str, int]:
    if extract is None:
        raise SystemExit("rebuild needs a reader of PDF text layers; see lexmill.sources.pdf")
    docs = records.read_jsonl(spark, args.input).withColumn("line", F.monotonically_increasing_id()).withColumn("pdf_file", F.try_variant_get("extra", "$.pdf_file", "string"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(args.pdf_dir).select("path", "content")
    texts = pdf.combined(files, extract).cache()
    done, outcomes = pdf.rebuild(docs.drop("extra", "_corrupt"), texts, args.limit)
    counts = {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    return {"saved": _save(done.drop("line"), args, False)} | counts


def check(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    lines = registries.read(spark, args.path)
    broken = registries.check(lines, args.registry).cache()
    broken.orderBy("record_key", "rule_id").show(50, truncate=False)
    return {"lines": lines.count(), "rules broken": broken.count()}


def main(argv: list[str] | None = None, spark: SparkSession | None = None, get: Callable[[str], bytes] = fetch, extract: pdf.Extract | None = None) -> dict[str, int]:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lexmill").getOrCreate()
    counts = {"journal": lambda: journal(spark, args, get, extract), "rss": lambda: rss(spark, args, get), "rebuild": lambda: rebuild(spark, args, extract), "check": lambda: check(spark, args)}[args.command]()
    print(", ".join(f"{k}: {v}" for k, v in counts.items()))
    return counts


if __name__ == "__main__":
    main()
