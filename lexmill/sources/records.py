"""Document records: JSON lines, feeds, binary files, sidecars, manifests.

Live fetching is a plug-in: a fetcher is any callable url -> bytes.  The
retry and delay rules are applied around it, on the executors.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

DOCUMENT = (
    "source string, url string, title string, text string, authors array<string>, published string, section string, pdf_url string, language string, extra variant"
)
ITEM = "title string, link string, pubDate string, date string, `content:encoded` string, encoded string, description string, summary string, category array<string>"
ENTRY = "title string, link array<struct<_href: string, _rel: string, _VALUE: string>>, updated string, published string, summary string, content string, category array<struct<_term: string, _VALUE: string>>"
MIN_SINK_CHARS, MIN_ARTICLE_CHARS, MIN_CACHED_BYTES, MIN_PDF_CHARS, MIN_JOURNAL_CHARS = 30, 80, 1000, 500, 40


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines file under a fixed schema; blank lines are skipped, bad ones kept in `_corrupt`."""
    return spark.read.schema(f"{DOCUMENT}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def sink_ok(text: Column, skipped: Column) -> Column:
    return ~F.coalesce(skipped, F.lit(False)) & (F.length(T.strip(F.coalesce(text, F.lit("")))) >= MIN_SINK_CHARS)


def append_jsonl(docs: DataFrame, path: str, filtered: bool = False) -> None:
    """Appends records as JSON lines; `filtered`: only those that pass `sink_ok`."""
    if filtered:
        skipped = F.col("skipped") if "skipped" in docs.columns else F.lit(False)
        docs = docs.where(sink_ok(F.col("text"), skipped))
    docs.write.mode("append").json(path)


def write_once(docs: DataFrame, path: str, kind: str = "parquet", **options) -> None:
    """Writes a table that may not be there yet: raw data is never overwritten.  kind: parquet, json, csv or text."""
    docs.write.mode("errorifexists").format(kind).options(**({"header": "true"} if kind == "csv" else {}), **options).save(path)


def append_new(docs: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose url isn't in `existing` yet (a plain append keeps them all)."""
    return docs.join(existing.select("url").distinct(), "url", "left_anti")


def _schema(fields: str) -> str:
    return ", ".join(x.strip().replace(" ", ": ", 1) for x in _top_level(fields))


def _top_level(fields: str) -> list[str]:
    parts, depth, held = [], 0, ""
    for c in fields:
        depth += {"<": 1, ">": -1}.get(c, 0)
        if c == "," and not depth:
            parts.append(held)
            held = ""
        else:
            held += c
    return [*parts, held]


def feed_items(feeds: DataFrame) -> DataFrame:
    """(feed, pos, title, link, published, body, categories) of feeds (feed, xml): RSS items wherever they stand, else Atom entries.

    No row for a feed that isn't XML.
    """
    root = F.from_xml("xml", f"channel struct<item: array<struct<{_schema(ITEM)}>>>, item array<struct<{_schema(ITEM)}>>, entry array<struct<{_schema(ENTRY)}>>")
    known = feeds.select("feed", root.alias("r"))
    rss = known.where("r.channel.item is not null or r.item is not null").select("feed", F.posexplode(F.coalesce("r.channel.item", "r.item")).alias("pos", "i"))
    atom = known.where("r.channel.item is null and r.item is null").select("feed", F.posexplode("r.entry").alias("pos", "i"))
    first = lambda *names: F.coalesce(*(F.nullif(F.col(f"i.{c}"), F.lit("")) for c in names), F.lit(""))
    tidy = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), T.strip), lambda x: x != "")
    items = rss.select("feed", "pos", T.strip(F.coalesce("i.title", F.lit(""))).alias("title"), T.strip(F.coalesce("i.link", F.lit(""))).alias("link"), F.coalesce(T.strip(F.col("i.pubDate")), T.strip(F.col("i.date"))).alias("published"), first("`content:encoded`", "encoded", "description", "summary").alias("body"), tidy(F.col("i.category")).alias("categories"))
    links = F.filter("i.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    url = F.coalesce(F.try_element_at(F.transform(links, lambda x: F.coalesce(x["_href"], x["_VALUE"])), F.lit(1)), F.lit(""))
    marks = F.transform("i.category", lambda x: F.coalesce(x["_term"], x["_VALUE"], F.lit("")))
    entries = atom.select("feed", "pos", T.strip(F.coalesce("i.title", F.lit(""))).alias("title"), T.strip(url).alias("link"), F.coalesce(T.strip(F.col("i.published")), T.strip(F.col("i.updated"))).alias("published"), first("content", "summary").alias("body"), tidy(marks).alias("categories"))
    return items.unionByName(entries)


def _capped(rows: DataFrame, limit: int | None) -> DataFrame:
    if limit is None:
        return rows
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy("feed").orderBy("pos"))).where(F.col("_k") <= limit).drop("_k")


def parse_feed(feeds: DataFrame, name: str | None = None, limit: int | None = 30) -> DataFrame:
    """Items of RSS and Atom documents (feed string, xml string) as records, `limit` kept per feed (None: all).

    The source is `name`, or the feed's host.  Bodies are unescaped before and after markup removal; items without link are
    dropped; a text under 30 characters gives way to the title.
    """
    text = T.normalize_whitespace(T.html_to_text(T.unescape("body"), unescape=T.unescape))
    source = F.lit(name) if name is not None else T.host(F.col("feed"))
    out = feed_items(feeds).where("link <> ''").withColumn("plain", text)
    out = out.select(
        "feed",
        "pos",
        F.concat(source, F.lit(":rss")).alias("source"),
        F.col("link").alias("url"),
        T.strip(T.unescape("title")).alias("title"),
        F.when((F.length("plain") < 30) & (F.col("title") != ""), F.col("title")).otherwise(F.col("plain")).alias("text"),
        "published",
        F.try_element_at("categories", F.lit(1)).alias("section"),
        "categories",
    )
    return _capped(out, limit).drop("pos")


def default_feeds(feeds: DataFrame, limit: int | None = 15) -> DataFrame:
    """Items of several feeds (name, feed, xml, error), with a placeholder row for each that couldn't be fetched or read.

    A placeholder has the title `feed_error`, no text, the error, and skipped = true, so that the sink leaves it out.
    """
    blank = {"error": F.lit(None).cast("string"), "skipped": F.lit(False)}
    good = feeds.where("error is null")
    items = parse_feed(good.select("feed", "xml"), None, limit).join(good.select("feed", "name"), "feed").withColumn("source", F.concat("name", F.lit(":rss"))).withColumns(blank)
    broken = feeds.where(F.col("error").isNotNull() | ~F.coalesce(_well_formed(F.col("xml")), F.lit(False)))
    holes = broken.select("feed", F.col("name").alias("source"), F.col("feed").alias("url"), F.lit("feed_error").alias("title"), F.lit("").alias("text"), F.coalesce("error", F.lit("no feed")).alias("error"), F.lit(True).alias("skipped"))
    return items.drop("name").unionByName(holes, allowMissingColumns=True)


def _well_formed(xml: Column) -> Column:
    """Whether a string is XML that can be read."""
    read = F.from_xml(xml, "_corrupt_record string, channel string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return F.length(T.strip(xml)).cast("boolean") & read["_corrupt_record"].isNull()


def journal_rss(feeds: DataFrame, source: str, limit: int | None = 50) -> DataFrame:
    """Items of the journal's own feed that have a link and 40 characters of text at least."""
    text = T.normalize_whitespace(T.html_to_text(T.unescape("body"), unescape=T.unescape))
    rows = feed_items(feeds).withColumn("text", text).where((F.col("link") != "") & (F.length("text") >= MIN_JOURNAL_CHARS))
    return _capped(rows, limit).select("feed", F.lit(f"{source}:rss").alias("source"), F.col("link").alias("url"), "title", "text", "published", F.lit("rss_description").alias("format"))


def binary_files(spark: SparkSession, path: str, magic: bytes = b"%PDF") -> DataFrame:
    """path, length, artifact_id, is_kind, is_cached of each file: content address, magic bytes, least size."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        "path",
        "length",
        F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("artifact_id"),
        (F.substring("content", 1, len(magic)) == F.lit(bytearray(magic))).alias("is_kind"),
        (F.col("length") > MIN_CACHED_BYTES).alias("is_cached"),
    )


def checksum_manifest(files: DataFrame) -> DataFrame:
    return files.select(F.concat(F.substring_index("artifact_id", ":", -1), F.lit("  "), F.col("path")).alias("line")).orderBy("line")


def sidecars(docs: DataFrame) -> DataFrame:
    """(name, text): one text per file and method with a four-line head, from (stem, method, text)."""
    head = [F.concat(F.lit("# extracted via "), "method"), F.concat(F.lit("# source pdf: "), "stem", F.lit(".pdf")), F.concat(F.lit("# chars: "), F.length("text").cast("string")), F.lit("# layout: top=1 col (title/PACS/DOI), bottom=left col then right col")]
    return docs.select(F.concat("stem", F.lit("_"), "method", F.lit(".txt")).alias("name"), F.concat(F.concat_ws("\n", *head), F.lit("\n\n"), "text").alias("text"))


def save_sidecars(docs: DataFrame, path: str) -> None:
    """Writes each sidecar text to a folder of its own, `name=...`; texts that are there already stay."""
    sidecars(docs).write.mode("append").partitionBy("name").option("lineSep", "\n").text(path)


def fetch_all(urls: DataFrame, fetch: Callable[[str], bytes], retries: int = 3, delay: float = 1.0, pause: float = 0.0) -> DataFrame:
    """(url, content, error): every url fetched with linear back-off between tries.

    The urls of a host are fetched one after another, `pause` seconds apart, by one task: that is what
    a site asks of a crawler, however many tasks there are.  Only errors of the connection are tried again,
    and of those not an answer that says the page isn't there (`code` below 500).
    """

    def run(batches):
        last = None
        for pdf in batches:
            rows = []
            for url, host in zip(pdf["url"], pdf["host"], strict=True):
                content, error = None, None
                if pause and host == last:
                    time.sleep(pause)
                last = host
                for attempt in range(retries):
                    try:
                        content, error = fetch(url), None
                        break
                    except (OSError, TimeoutError) as e:
                        error = str(e)
                        if getattr(e, "code", 500) < 500:
                            break
                        if attempt + 1 < retries:
                            time.sleep(delay * (attempt + 1))
                rows.append((url, content, error))
            yield pd.DataFrame(rows, columns=["url", "content", "error"])

    by_host = urls.select("url", T.host(F.col("url")).alias("host")).distinct().repartition("host").sortWithinPartitions("host", "url")
    return by_host.mapInPandas(run, "url string, content binary, error string")


def fetch_text(urls: DataFrame, fetch: Callable[[str], bytes], base: str, charset: str | None = None, **options) -> DataFrame:
    """(path, html, error): pages by paths relative to `base`, decoded; bytes that don't fit the charset are replaced."""
    asked = urls.select("path", T.resolve_url(F.col("path"), base).alias("url"))
    got = fetch_all(asked.select("url"), fetch, **options)
    return asked.join(got, "url", "left").select("path", T.decode_text("content", F.lit(charset)).alias("html"), "error")


def answered(pages: DataFrame, column: str) -> DataFrame:
    """`column` null where the answer's status isn't 200."""
    return pages.withColumn(column, F.when(F.col("status") == 200, F.col(column)))


def best_text(docs: DataFrame, low: str = "\\u0400", high: str = "\\u04FF") -> DataFrame:
    """Adds method, readable and text, chosen from `raw` and `ocr`."""
    raw, ocr = F.coalesce("raw", F.lit("")), F.coalesce("ocr", F.lit(""))
    raw_ok, ocr_ok = T.is_readable(raw, low, high), T.is_readable(ocr, low, high)
    method = F.when(raw_ok, "pdf").when(ocr_ok | (F.length(ocr) >= 500), "pdf_ocr_layout").otherwise("pdf_unreadable")
    return docs.withColumn("method", method).withColumn("readable", raw_ok | ocr_ok).withColumn("text", F.when(F.col("method") == "pdf_ocr_layout", ocr).otherwise(raw))


def article_text(docs: DataFrame, mode: str = "pdf+html", min_chars: int = MIN_PDF_CHARS) -> DataFrame:
    """Adds text, text_source and pdf_unreadable from `pdf_text`, `method`, `readable` and `html_text`; drops what the mode can't serve.

    A PDF serves if it is readable and has `min_chars` characters.  Mode html takes the page, pdf only a PDF that serves, pdf+html the page where none does.
    """
    served = F.coalesce("readable", F.lit(False)) & F.coalesce(F.length("pdf_text") >= min_chars, F.lit(False))
    poor = F.col("method").isNotNull() & ~served
    if mode == "html":
        return docs.withColumns({"text": F.col("html_text"), "text_source": F.lit("html"), "pdf_unreadable": F.lit(False)})
    if mode == "pdf":
        return docs.where(served).withColumns({"text": F.col("pdf_text"), "text_source": F.col("method"), "pdf_unreadable": F.lit(False)})
    return docs.withColumns({"text": F.when(served, F.col("pdf_text")).otherwise(F.col("html_text")), "text_source": F.when(served, F.col("method")).otherwise("html"), "pdf_unreadable": poor})
