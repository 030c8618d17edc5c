"""The archive crawl: issue listings, article pages, and the documents they give.

Pages come as rows (path, html); how they were fetched is `records.fetch_all`'s matter.
What can't be read isn't dropped in silence: it goes to a table of rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import resolve
from .records import MIN_ARTICLE_CHARS, MIN_PDF_CHARS, article_text

SOURCE, BASE = "ufn.ru", "https://ufn.ru"
#: Where the text of an article page begins, and the note that ends it.
MAIN, END_NOTE = '(?is)class="main"[^>]*(?:id="print")?[^>]*>(.*)', "© Успехи"


def main_block(html: Column) -> Column:
    """The text part of an article page; null if there is none."""
    found = F.regexp_extract(html, MAIN, 1)
    return F.when(html.rlike(MAIN), F.substring_index(found, END_NOTE, 1))


def pdf_link(main: Column, path: Column, base: str = BASE, parity: bool = True) -> Column:
    """The first link to a PDF file, else the address that follows from the path (null with `parity`, a known defect)."""
    found = F.nullif(F.regexp_extract(main, '(?i)href="([^"]+\\.pdf[^"]*)"', 1), F.lit(""))
    return F.coalesce(T.resolve_url(found, base), T.article_pdf_url(path, parity))


def year_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, "/articles/([0-9]{4})/", 1), F.lit(""))


def issue_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, "^(/ru/articles/[0-9]{4}/[0-9]+/)", 1), F.lit(""))


def parse_articles(pages: DataFrame, base: str = BASE, parity: bool = True) -> DataFrame:
    """pages (path, html, and title_hint if there) as rows with main, url, pdf_url, title, authors, section, year, issue_path, html_text and reject_reason.

    A hint that isn't empty is the title.  reject_reason is null for a page with a main block.
    """
    main = main_block(F.col("html"))
    rows = pages.withColumn("main", main)
    plain = T.drop_nav_prefix(T.normalize_whitespace(T.html_to_text(F.col("main"), unescape=T.unescape)))
    rows = rows.withColumn("html_text", plain)
    hint = F.nullif(F.col("title_hint"), F.lit("")) if "title_hint" in pages.columns else F.lit(None).cast("string")
    return rows.select(
        "path",
        "main",
        T.resolve_url(F.col("path"), base).alias("url"),
        pdf_link(F.col("main"), F.col("path"), base, parity).alias("pdf_url"),
        F.coalesce(hint, T.extract_title(F.col("html_text"), F.col("main"))).alias("title"),
        T.extract_authors(F.col("main")).alias("authors"),
        T.extract_section(F.col("main")).alias("section"),
        year_of(F.col("path")).alias("year"),
        issue_of(F.col("path")).alias("issue_path"),
        "html_text",
        F.when(F.col("html").isNull(), "not fetched").when(F.col("main").isNull(), "no main block").alias("reject_reason"),
    )


def articles(pages: DataFrame, pdf_texts: DataFrame | None = None, mode: str = "pdf+html", min_chars: int = MIN_PDF_CHARS, source: str = SOURCE, base: str = BASE, parity: bool = True) -> tuple[DataFrame, DataFrame]:
    """Documents of article pages, and the rejects (path, reason).

    pdf_texts: pdf_url, pdf_text, method, readable, error (from `pdf.combined`); without it every PDF counts as not read.
    mode: html, pdf or pdf+html, as in `records.article_text`.
    """
    rows = parse_articles(pages, base, parity)
    good = rows.where("reject_reason is null")
    if pdf_texts is None:
        blank = {"pdf_text": "string", "method": "string", "readable": "boolean", "error": "string"}
        good = good.withColumns({c: F.lit(None).cast(t) for c, t in blank.items()})
    else:
        good = good.join(pdf_texts.select("pdf_url", "pdf_text", "method", "readable", "error"), "pdf_url", "left")
    chosen = article_text(good, mode, min_chars)
    extra = F.struct("issue_path", "year", F.when(F.col("pdf_url").isNotNull(), T.file_name(F.col("pdf_url"))).alias("pdf_file"), F.col("method").alias("pdf_extract_method"), F.col("error").alias("pdf_error"), "pdf_unreadable", "text_source")
    docs = chosen.where(F.length("text") >= MIN_ARTICLE_CHARS).select("path", F.lit(source).alias("source"), "url", "title", "text", "authors", "section", "pdf_url", F.lit("ru").alias("language"), extra.alias("extra"))
    kept = docs.select("path")
    short = good.join(kept, "path", "left_anti").select("path", F.when(F.length("html_text") < MIN_ARTICLE_CHARS, "too short").otherwise("no usable text").alias("reason"))
    return docs, rows.where("reject_reason is not null").select("path", F.col("reject_reason").alias("reason")).unionByName(short)


def crawl(archive: DataFrame, issues: DataFrame, pages: DataFrame, pdf_texts: DataFrame | None = None, max_issues: int | None = None, max_articles: int = 0, max_docs: int | None = None, numeric: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """Documents and rejects of a whole crawl, from the pages that it visits.

    archive: html of listing pages; issues: issue_path, html; pages: path, html.  Issues go newest first
    (in string order without `numeric`), articles of an issue by path, and their number is cut to max_articles before
    they are read (0: all).  max_docs counts documents that are long enough (0: none, None: all).
    """
    listed = resolve.issue_paths(archive, max_issues, numeric)
    found = resolve.article_paths(issues.join(listed.withColumnRenamed("path", "issue_path"), "issue_path", "left_semi"))
    if max_articles:
        found = found.withColumn("_k", F.row_number().over(Window.partitionBy("issue_path").orderBy("path"))).where(F.col("_k") <= max_articles).drop("_k")
    visited = found.withColumnRenamed("title", "title_hint").join(pages, "path", "left")
    docs, rejects = articles(visited.select("path", "title_hint", "html").distinct(), pdf_texts, **options)
    if max_docs is not None:
        docs = docs.orderBy(F.desc("extra.issue_path"), "path").limit(max_docs)
    return docs, rejects


def nested_titles(pages: DataFrame, article_class: str = "articles", rubric_class: str = "rubric") -> DataFrame:
    """(path, rubric, position, title): article links of listing pages whose paragraphs carry classes, under the rubric before them.

    The n-th paragraph of articles belongs to the n-th rubric; the longer list's rest is left out.
    """
    part = lambda c: F.regexp_extract_all("html", F.lit(f'(?is)<p[^>]*class="{c}"[^>]*>(.*?)</p>'), F.lit(1))
    both = pages.select("path", part(rubric_class).alias("r"), part(article_class).alias("a"))
    zipped = both.select("path", F.posexplode(F.slice(F.arrays_zip("r", "a"), 1, F.least(F.size("r"), F.size("a")))).alias("n", "z"))
    titles = F.regexp_extract_all(F.col("z.a"), F.lit("(?is)<a[^>]*>(.*?)</a>"), F.lit(1))
    out = zipped.select("path", "n", T.strip(T.html_to_text(F.col("z.r"))).alias("rubric"), F.posexplode(titles).alias("position", "title"))
    return out.select("path", "rubric", "position", T.remove_soft(T.strip(T.html_to_text(F.col("title")))).alias("title"))
