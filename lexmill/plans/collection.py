"""Queries that run the sources and text functions on pages, feeds and files derived from the supplied tables.

The SQL says what must come out of them; it knows nothing of the markup that goes in.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout as L
from ..operators.graph import shared_folder
from ..sources import crawl as W
from ..sources import pdf as P
from ..sources import records as S
from .queries import query, table

# ------------------------------------------------------------------ feeds


def feeds_of(docs):
    """Feeds of up to 20 items: RSS from sources with an even number, Atom from the others; every eleventh item has no link."""
    body = F.expr("if(doc_id % 7 = 0, 'short', concat('<p>Body of work <b>', doc_id, '</b> in ', lang, '</p><p>and a second line &amp;amp; an end</p>'))")
    escaped = F.replace(F.replace(F.replace(body, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    link = "if(doc_id % 11 = 0, '', concat('https://h/', doc_id))"
    rss = F.concat(
        F.expr(f"concat('<item><title> Work &amp;amp; ', doc_id, '</title>', if({link} = '', '', concat('<link> ', {link}, ' </link>')), '<pubDate>day ', doc_id, '</pubDate><category> ', lang, ' </category><category>two</category>')"),
        F.when(F.expr("doc_id % 5 = 0"), F.concat(F.lit("<content:encoded>"), escaped, F.lit("</content:encoded><description>other</description>"))).otherwise(F.concat(F.lit("<description>"), escaped, F.lit("</description>"))),
        F.lit("</item>"),
    )
    atom = F.concat(
        F.expr(f"concat('<entry><title>Work &amp;amp; ', doc_id, '</title>', if({link} = '', '', concat('<link rel=\"self\" href=\"https://no/\"/><link href=\"', {link}, '\"/>')), '<updated>day ', doc_id, '</updated><category term=\"', lang, '\"/><category term=\"two\"/><summary type=\"html\">')"),
        escaped,
        F.lit("</summary></entry>"),
    )
    even = F.expr("cast(substr(source, 4) as int) % 2 = 0")
    rows = docs.select("doc_id", F.expr("concat('https://', source, '.org/feed/', doc_id div 20)").alias("feed"), "source", even.alias("rss"), F.when(even, rss).otherwise(atom).alias("item"))
    grouped = rows.groupBy("feed", "source", "rss").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda x: x["item"]), "").alias("items"))
    whole = F.when(F.col("rss"), F.concat(F.lit('<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>t</title>'), "items", F.lit("</channel></rss>"))).otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'), "items", F.lit("</feed>")))
    return grouped.select("feed", "source", whole.alias("xml"))


_ITEM_SQL = """doc_id, source || '.org' AS host, 'https://h/' || doc_id AS url, 'Work & ' || doc_id AS title, lang AS section, 'day ' || doc_id AS published,
    CASE WHEN doc_id % 7 = 0 THEN 'Work &amp; ' || doc_id ELSE 'Body of work ' || doc_id || ' in ' || lang || chr(10) || 'and a second line & an end' END AS text, row_number() OVER (PARTITION BY source, doc_id // 20 ORDER BY doc_id) AS k
    FROM documents WHERE doc_id % 11 <> 0"""


@query(f"SELECT host || ':rss' AS source, url, title, text, published, section, section || '|two' AS categories FROM (SELECT {_ITEM_SQL}) WHERE k <= 15")
def feed_items(spark, sf_dir):
    """Items of RSS and Atom feeds as records, 15 of each feed."""
    out = S.parse_feed(feeds_of(table(spark, sf_dir, "documents")), None, 15)
    return out.select("source", "url", "title", "text", "published", "section", F.array_join("categories", "|").alias("categories"))


@query(f"""SELECT source, url, title, false AS skipped FROM (SELECT *, 'n-' || substr(host, 1, length(host) - 4) || ':rss' AS source FROM (SELECT {_ITEM_SQL}) WHERE k <= 15 AND substr(host, 4, length(host) - 7)::INT % 5 NOT IN (3, 4))
    UNION ALL SELECT DISTINCT 'n-' || source, 'https://' || source || '.org/feed/' || (doc_id // 20), 'feed_error', true FROM documents WHERE substr(source, 4)::INT % 5 IN (3, 4)""")
def feed_union(spark, sf_dir):
    """Items of all feeds; one that couldn't be fetched, or isn't XML, gives a placeholder that the sink leaves out."""
    number = F.expr("cast(substr(source, 4) as int) % 5")
    feeds = feeds_of(table(spark, sf_dir, "documents")).select("feed", F.concat(F.lit("n-"), "source").alias("name"), F.when(number == 3, None).when(number == 4, F.lit("<rss><channel>")).otherwise(F.col("xml")).alias("xml"), F.when(number == 3, "HTTP 500").alias("error"))
    return S.default_feeds(feeds, 15).select("source", "url", "title", "skipped")


@query("""SELECT 'journal:rss' AS source, 'https://h/' || doc_id AS url, 'Work &amp; ' || doc_id AS title, 'Body of work ' || doc_id || ' in ' || lang || chr(10) || 'and a second line & an end' AS text FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 7 <> 0""")
def journal_rss(spark, sf_dir):
    """Items of the journal's feed with a link and enough text; titles stay escaped."""
    return S.journal_rss(feeds_of(table(spark, sf_dir, "documents")), "journal", None).select("source", "url", "title", "text")


# ------------------------------------------------------------------ crawl

_PATH = "concat('/ru/articles/', 1000 + doc_id div 312, '/', 1 + (doc_id div 26) % 12, '/', char(97 + doc_id % 26), '/')"
_ISSUE = "concat('/ru/articles/', 1000 + doc_id div 312, '/', 1 + (doc_id div 26) % 12, '/')"
_TEXT = "concat('Достаточно длинная строка статьи номер ', doc_id, ' на языке ', lang)"
_PATH_SQL = "'/ru/articles/' || (1000 + doc_id // 312) || '/' || (1 + (doc_id // 26) % 12) || '/' || chr((97 + doc_id % 26)::INT) || '/'"
_TEXT_SQL = "'Достаточно длинная строка статьи номер ' || doc_id || ' на языке ' || lang"


def archive_of(docs):
    """Listing pages, issue pages and article pages of a journal whose articles are the documents, and the texts of its PDF files."""
    archive = docs.selectExpr(f"{_ISSUE} as i", "doc_id div 312 as y").distinct().groupBy("y").agg(F.array_join(F.collect_set(F.concat(F.lit('<a href="'), "i", F.lit('">x</a>'))), " ").alias("html"))
    links = docs.select(F.expr(_ISSUE).alias("issue_path"), F.expr(f"concat('<a href=\"', {_PATH}, '\">PDF</a><a class=x href=\"', {_PATH}, '\">', if(doc_id % 4 = 0, '', concat('Заголовок\n  статьи &amp; ', doc_id)), '</a><a href=\"/ru/other/a/\">no</a>')").alias("a"))
    issues = links.groupBy("issue_path").agg(F.array_join(F.collect_list("a"), "").alias("html"))
    lines = F.expr(f"if(doc_id % 9 = 0, 'Коротко', concat({_TEXT}, '</p><p>', {_TEXT}, '<br/>Ещё &mdash; &#1077;щё'))")
    main = F.concat(
        F.lit('<div class="main" id="print"><p>выпуски</p><p>1999</p><div><b>Иван А. Б. Петров</b></div><div><i>ОБЗОРЫ АКТУАЛЬНЫХ ПРОБЛЕМ</i></div>'),
        F.expr(f"if(doc_id % 3 = 0, concat('<div><a href=\"/files/', doc_id, '.pdf\">f</a></div>'), '')"),
        F.lit("<p>"),
        lines,
        F.lit("</p>© Успехи физических наук <p>Подвал страницы, который не входит в текст статьи</p></div>"),
    )
    html = F.when(F.expr("doc_id % 13 = 0"), F.lit("<html><p>404</p></html>")).otherwise(F.concat(F.lit("<html><p>Меню сайта</p>"), main, F.lit("</html>")))
    pages = docs.where("doc_id % 17 <> 0").select(F.expr(_PATH).alias("path"), html.alias("html"))
    files = docs.where("doc_id % 3 = 0").selectExpr("concat('https://ufn.ru/files/', doc_id, '.pdf') as pdf_url", "repeat('ж ', if(doc_id % 6 = 0, 300, 200)) as pdf_text", "'pdf' as method", "true as readable", "cast(null as string) as error")
    return archive, issues, pages, files


_VISITED = f"(SELECT *, {_PATH_SQL} AS path FROM documents WHERE doc_id % 26 < 20)"


@query(f"""SELECT 'https://ufn.ru' || path AS url, CASE WHEN doc_id % 4 = 0 THEN 'PDF' ELSE 'Заголовок статьи & ' || doc_id END AS title, CASE WHEN doc_id % 6 = 0 THEN 'pdf' ELSE 'html' END AS text_source, doc_id % 6 = 3 AS pdf_unreadable, (1000 + doc_id // 312)::VARCHAR AS year,
    CASE WHEN doc_id % 3 = 0 THEN 'https://ufn.ru/files/' || doc_id || '.pdf' END AS pdf_url, 'ОБЗОРЫ АКТУАЛЬНЫХ ПРОБЛЕМ' AS section, 'Иван А. Б. Петров' AS authors,
    CASE WHEN doc_id % 6 = 0 THEN repeat('ж ', 300) ELSE {_TEXT_SQL} || chr(10) || {_TEXT_SQL} || chr(10) || 'Ещё — ещё' END AS text
FROM {_VISITED} WHERE doc_id % 13 <> 0 AND doc_id % 17 <> 0 AND (doc_id % 9 <> 0 OR doc_id % 6 = 0)""")
def crawl_documents(spark, sf_dir):
    """A crawl of the whole archive, 20 articles an issue: listing, issue and article pages to documents."""
    docs, _ = W.crawl(*archive_of(table(spark, sf_dir, "documents")), max_articles=20)
    return docs.select("url", "title", "extra.text_source", "extra.pdf_unreadable", "extra.year", "pdf_url", "section", F.array_join("authors", ", ").alias("authors"), "text")


@query(f"""SELECT path, CASE WHEN doc_id % 17 = 0 THEN 'not fetched' WHEN doc_id % 13 = 0 THEN 'no main block' ELSE 'too short' END AS reason FROM {_VISITED} WHERE doc_id % 13 = 0 OR doc_id % 17 = 0 OR (doc_id % 9 = 0 AND doc_id % 6 <> 0)""")
def crawl_rejects(spark, sf_dir):
    """What the crawl couldn't read, with the reason."""
    return W.crawl(*archive_of(table(spark, sf_dir, "documents")), max_articles=20)[1]


@query("""SELECT 'l' || doc_id AS path, 'Rubric ' || r AS rubric, p::INT AS position, 'Title ' || doc_id || '-' || r || '-' || p AS title FROM documents, (SELECT unnest([1, 2]) AS r), (SELECT unnest([0, 1, 2]) AS p)""")
def rubric_titles(spark, sf_dir):
    """Titles under the rubric before them, by the classes of their paragraphs; a third rubric without articles is left out."""
    part = lambda r: ", ".join([f"'<p class=\"rubric\">Rubric {r}</p>'"] + ([] if r == 3 else [f"'<p class=\"articles\">'", *(f"'<a href=x>Title  ', doc_id, '-{r}-{p}­</a>'" for p in range(3)), "'</p>'"]))
    pages = table(spark, sf_dir, "documents").selectExpr("concat('l', doc_id) as path", f"concat({', '.join(part(r) for r in (1, 2, 3))}) as html")
    return W.nested_titles(pages)


# ------------------------------------------------------------------ files

_MARK = b"%OCR:"


def _layer(content: bytes) -> list[str]:
    return content[4:].split(_MARK)[0].decode().split("\f")


def _render(content: bytes):
    return [(np.frombuffer(page, np.uint8).reshape(1, -1), 800.0) for page in content.split(_MARK)[1].split(b"\f")]


def _recognise(gray: np.ndarray) -> str:
    return gray.tobytes().decode()


def files_of(docs):
    """Files whose text layer, and what OCR reads, follow from doc_id; every fifth is no PDF, every seventh is broken."""
    layer = F.expr("case doc_id % 5 when 0 then concat(repeat('ж', 150), '\f 12 \n', repeat('я', 150)) else repeat('x', 1100) end")
    ocr = F.expr("case doc_id % 5 when 1 then concat(repeat('д', 120), '\f', repeat('л', 120)) when 2 then repeat('y', 500) else repeat('z', 499) end")
    good = F.concat(F.lit("%PDF"), layer, F.lit(_MARK.decode()), ocr, F.repeat(F.lit(" "), F.lit(1000)))
    content = F.when(F.expr("doc_id % 5 = 4"), F.lit("<html>")).when(F.expr("doc_id % 7 = 0"), F.unhex(F.concat(F.hex(F.lit("%PDF")), F.repeat(F.lit("ff"), F.lit(2000))))).otherwise(F.encode(good, "UTF-8"))
    return docs.select(F.expr("concat('/files/', doc_id, '.pdf')").alias("path"), content.alias("content"))


_FILE_SQL = """SELECT doc_id, '/files/' || doc_id || '.pdf' AS path,
    CASE WHEN doc_id % 5 = 4 THEN NULL WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 = 0 THEN repeat('ж', 150) || chr(10) || repeat('я', 150) WHEN doc_id % 5 = 1 THEN repeat('д', 120) || chr(10) || chr(10) || repeat('л', 120) WHEN doc_id % 5 = 2 THEN repeat('y', 500) ELSE repeat('x', 1100) END AS pdf_text,
    CASE WHEN doc_id % 5 = 4 OR doc_id % 7 = 0 THEN 'pdf_unreadable' WHEN doc_id % 5 = 0 THEN 'pdf' WHEN doc_id % 5 IN (1, 2) THEN 'pdf_ocr_layout' ELSE 'pdf_unreadable' END AS method,
    doc_id % 5 IN (0, 1) AND doc_id % 7 <> 0 AS readable, CASE WHEN doc_id % 5 = 4 THEN 'no PDF' WHEN doc_id % 7 = 0 THEN 'UnicodeDecodeError' END AS error FROM documents"""


@query(f"SELECT path, pdf_text, method, readable, error FROM ({_FILE_SQL})")
def pdf_texts(spark, sf_dir):
    """The best text of each file: its layer, or OCR; what isn't a PDF, or can't be read, with the error."""
    out = P.combined(files_of(table(spark, sf_dir, "documents")), _layer, (_render, _recognise))
    return out.withColumn("error", F.element_at(F.split("error", ":"), 1))


@query(f"""SELECT doc_id AS line, CASE WHEN doc_id % 8 = 7 THEN 'no file name' WHEN doc_id % 8 = 6 THEN 'missing file' WHEN readable THEN 'ok' ELSE 'not readable' END AS outcome FROM ({_FILE_SQL})""")
def file_join_rebuild(spark, sf_dir):
    """Documents joined with their files by name, and what became of each."""
    return P.rebuild(*_rebuild_input(spark, sf_dir))[1].select("line", "outcome")


@query(f"""SELECT doc_id AS line, method AS text_source, length(pdf_text) AS n_chars FROM ({_FILE_SQL}) WHERE readable AND doc_id % 8 < 6 ORDER BY doc_id LIMIT 40""")
def rebuild_limit(spark, sf_dir):
    """The first 40 documents that could be read: the limit counts successes."""
    return P.rebuild(*_rebuild_input(spark, sf_dir), limit=40)[0].select("line", "text_source", F.length("text").cast("long").alias("n_chars"))


@query(f"""SELECT count(*) FILTER (readable AND doc_id % 8 < 6) AS ok, count(*) FILTER (NOT (readable AND doc_id % 8 < 6)) AS skipped, count(*) AS seen FROM ({_FILE_SQL})""")
def rebuild_counters(spark, sf_dir):
    """How many documents could be read anew, and how many were skipped."""
    outcomes = P.rebuild(*_rebuild_input(spark, sf_dir))[1]
    ok = F.col("outcome") == "ok"
    return outcomes.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("skipped"), F.count(F.lit(1)).alias("seen"))


def _rebuild_input(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.selectExpr("doc_id as line", "concat('u', doc_id) as url", "if(doc_id % 8 = 5, concat('https://h/', doc_id, '.pdf'), null) as pdf_url", "case doc_id % 8 when 7 then '' when 6 then 'none.pdf' when 5 then null else concat(doc_id, '.pdf') end as pdf_file", "'' as text")
    return rows, P.combined(files_of(docs), _layer, (_render, _recognise))


@query("""SELECT 'f' || doc_id || '_pdf.txt' AS name, sha256('# extracted via pdf' || chr(10) || '# source pdf: f' || doc_id || '.pdf' || chr(10) || '# chars: ' || length(coalesce(text, '')) || chr(10) || '# layout: top=1 col (title/PACS/DOI), bottom=left col then right col' || chr(10) || chr(10) || coalesce(text, '')) AS digest FROM documents""")
def sidecar_files(spark, sf_dir):
    """The text files beside the PDF files, with their head."""
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("f"), "doc_id").alias("stem"), F.lit("pdf").alias("method"), F.coalesce("text", F.lit("")).alias("text"))
    return S.sidecars(rows).select("name", F.sha2("text", 256).alias("digest"))


def scratch(spark) -> str:
    """A new folder where all executors can write."""
    return f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"


_KEPT = "doc_id % 10 <> 0 AND length(regexp_replace(coalesce(text, ''), '^[\\s\\x1c-\\x1f\\x85\\p{Z}]+|[\\s\\x1c-\\x1f\\x85\\p{Z}]+\\z', '', 'g')) >= 30"


@query(f"""SELECT source, count(*) FILTER ({_KEPT}) AS saved, count(*) FILTER (NOT ({_KEPT})) AS skipped, count(*) AS seen, coalesce(sum(length(text)) FILTER ({_KEPT}), 0)::BIGINT AS chars FROM documents GROUP BY source""")
def sink_filter(spark, sf_dir):
    """Records written as JSON lines by the filtering sink, and read again; every tenth is marked as skipped."""
    docs = table(spark, sf_dir, "documents").select("source", F.concat(F.lit("u"), "doc_id").alias("url"), "text", F.expr("doc_id % 10 = 0").alias("skipped"))
    path = scratch(spark)
    S.append_jsonl(docs, path, filtered=True)
    saved = S.read_jsonl(spark, path).groupBy("source").agg(F.count(F.lit(1)).alias("saved"), F.sum(F.length("text")).alias("chars"))
    seen = docs.groupBy("source").agg(F.count(F.lit(1)).alias("seen"))
    return seen.join(saved, "source", "left").select("source", F.coalesce("saved", F.lit(0)).alias("saved"), (F.col("seen") - F.coalesce("saved", F.lit(0))).alias("skipped"), "seen", F.coalesce("chars", F.lit(0)).alias("chars"))


@query("SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source")
def csv_round_trip(spark, sf_dir):
    """A profile written as CSV and read again."""
    path = scratch(spark)
    S.write_once(table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")), path, "csv")
    return spark.read.schema("source string, n long, chars long").option("header", True).csv(path)


_RAW_OK, _OCR_OK = "doc_id % 300 >= 200", "doc_id % 3 <> 0 AND doc_id % 2 = 0 AND doc_id % 700 >= 200"
_METHOD = f"CASE WHEN {_RAW_OK} THEN 'pdf' WHEN ({_OCR_OK}) OR (doc_id % 3 <> 0 AND doc_id % 700 >= 500) THEN 'pdf_ocr_layout' ELSE 'pdf_unreadable' END"


@query(f"""WITH t AS (SELECT doc_id, {_METHOD} AS method, ({_RAW_OK}) OR ({_OCR_OK}) AS readable, CASE {_METHOD} WHEN 'pdf_ocr_layout' THEN doc_id % 700 ELSE doc_id % 300 END AS n FROM documents)
SELECT doc_id, mode, CASE WHEN mode <> 'html' AND readable AND n >= 250 THEN method ELSE 'html' END AS text_source, CASE WHEN mode <> 'html' AND readable AND n >= 250 THEN n ELSE 4 END AS n_chars, mode = 'pdf+html' AND NOT (readable AND n >= 250) AS pdf_unreadable
FROM t, (SELECT unnest(['html', 'pdf', 'pdf+html']) AS mode) WHERE mode <> 'pdf' OR (readable AND n >= 250)""")
def best_text_choice(spark, sf_dir):
    """The best of layer, OCR and page for every document, in each mode; a PDF serves from 250 characters on."""
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "repeat('ж', cast(doc_id % 300 as int)) as raw", "if(doc_id % 3 = 0, null, repeat(if(doc_id % 2 = 0, 'д', 'x'), cast(doc_id % 700 as int))) as ocr", "'page' as html_text")
    best = S.best_text(rows).withColumnRenamed("text", "pdf_text")
    each = [S.article_text(best, mode, 250).select("doc_id", F.lit(mode).alias("mode"), "text_source", F.length("text").cast("long").alias("n_chars"), "pdf_unreadable") for mode in ("html", "pdf", "pdf+html")]
    return each[0].unionByName(each[1]).unionByName(each[2])


# ------------------------------------------------------------------ layout


def _raster(start: int) -> np.ndarray:
    gray = np.full((825, 300), 255, np.uint8)
    gray[40:, 20:280] = 0
    gray[start:, 120:180] = 255
    return gray


@query("""SELECT n_nationkey AS page, round((165 + 12 * (5 + n_nationkey % 20)) * 792.0 / 825 + 10, 6) AS split_y, CASE WHEN n_nationkey % 2 = 0 THEN 'head|left|right' ELSE 'head|right' END AS text, 137.0::DOUBLE AS left_end, 151.0::DOUBLE AS right_start, 792 - round((165 + 12 * (5 + n_nationkey % 20)) * 792.0 / 825 + 10, 6) >= 20 AS readable FROM nation""")
def page_layout(spark, sf_dir):
    """Where pages go over into two columns, from rasters; their clips, and the text put together."""
    n = table(spark, sf_dir, "nation").select("n_nationkey")

    def drawn(batches):
        for pdf in batches:
            pdf["gray"] = [_raster(165 + 12 * (5 + k % 20)).tobytes() for k in pdf["n_nationkey"]]
            yield pdf

    pages = n.mapInPandas(drawn, "n_nationkey int, gray binary").select("n_nationkey", F.lit(300).alias("w"), F.lit(825).alias("h"), "gray", F.lit(792.0).alias("height"), F.lit(0).alias("page"))
    split = pages.select("n_nationkey", "height", F.round(L.split_y("w", "h", "gray", "height", "page"), 6).alias("split_y"))
    clips = L.column_clips(F.lit(288.0), F.col("height"), F.col("split_y"))
    part = split.withColumn("c", clips).withColumn("cut", L.intersection(F.col("c")[0], F.struct(F.lit(0.0).alias("x0"), F.col("split_y").alias("y0"), F.lit(288.0).alias("x1"), F.col("height").alias("y1"))))
    text = F.replace(L.assembled(F.lit("head"), F.expr("if(n_nationkey % 2 = 0, 'left', ' ')"), F.lit("right")), F.lit("\n\n"), F.lit("|"))
    return part.select(F.col("n_nationkey").alias("page"), "split_y", text.alias("text"), F.col("c")[0]["x1"].alias("left_end"), F.col("c")[1]["x0"].alias("right_start"), F.col("cut").isNotNull().alias("readable"))


# ------------------------------------------------------------------ text functions


@query("""SELECT doc_id, 'Привет ' || doc_id || '�' AS old, 'né ' || doc_id AS plain FROM documents""")
def charset_decode(spark, sf_dir):
    """Bytes in a charset, and in UTF-8, as text; one that doesn't fit is replaced."""
    docs = table(spark, sf_dir, "documents")
    digits = F.hex(F.concat(F.lit(" "), F.col("doc_id").cast("string")))
    old = F.unhex(F.concat(F.lit("CFF0E8E2E5F2"), digits, F.lit("98")))  # 0x98 is no character of this charset
    return docs.select("doc_id", T.decode_text(old, F.lit("cp1251")).alias("old"), T.decode_text(F.unhex(F.concat(F.lit("6EC3A9"), digits)), F.lit(None).cast("string")).alias("plain"))


@query("""SELECT doc_id, chr((1040 + doc_id % 32)::INT) || chr((97 + doc_id % 26)::INT) || '&#x; & < «' || chr(128512) || '» &#' || doc_id || chr(10) || '�' AS text FROM documents""")
def numeric_entities(spark, sf_dir):
    """Named and numeric entities of a page, by expressions alone."""
    page = F.expr("concat('&#', 1040 + doc_id % 32, ';&#x', hex(97 + doc_id % 26), ';&#x; &amp; &lt; &laquo;&#x1F600;&raquo; &amp;#', doc_id, '<br>&#xD800;')")
    return table(spark, sf_dir, "documents").select("doc_id", T.html_to_text(page).alias("text"))


@query("""SELECT doc_id, '10.3367/ufnr.' || doc_id AS doi, CASE WHEN doc_id % 4 = 0 THEN 'C1' WHEN doc_id % 4 = 1 THEN 'C5' END AS class, 'https://ufn.ru/ufn' || lpad(((1990 + doc_id % 30) % 100)::VARCHAR, 2, '0') || '/ufn' || lpad(((1990 + doc_id % 30) % 100)::VARCHAR, 2, '0') || '_' || (1 + doc_id % 12) || '/Russian/r' || lpad(((1990 + doc_id % 30) % 100)::VARCHAR, 2, '0') || (1 + doc_id % 12) || 'c.pdf' AS pdf,
    NULL::VARCHAR AS pdf_by_parity, (1990 + doc_id % 30) || '_' || (1 + doc_id % 12) || '_c.pdf' AS name, (1990 + doc_id % 30)::VARCHAR AS year, '/ru/articles/' || (1990 + doc_id % 30) || '/' || (1 + doc_id % 12) || '/' AS issue, 'https://ufn.ru/ru/articles/' || (1990 + doc_id % 30) || '/' || (1 + doc_id % 12) || '/c/' AS url, 'early' AS period FROM documents""".replace("'early' AS period", "CASE WHEN 1990 + doc_id % 30 < 2000 THEN NULL WHEN 1990 + doc_id % 30 <= 2012 THEN '2000-2012' ELSE '2013-2025' END AS period"))
def identifiers(spark, sf_dir):
    """DOI, class of a code, addresses of an article's page and file, its issue, year and period."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "cast(1990 + doc_id % 30 as int) as y", "cast(1 + doc_id % 12 as int) as v")
    path = F.concat(F.lit("/ru/articles/"), "y", F.lit("/"), "v", F.lit("/c/"))
    y, v, c = F.col("y"), F.col("v"), F.lit("c")
    doi = F.expr("concat(element_at(array(' https://doi.org/', 'doi: ', 'http://dx.doi.org/', ''), cast(1 + doc_id % 4 as int)), '10.3367/UFNr.', doc_id, if(doc_id % 2 = 0, '?x=1', ''))")
    code = F.expr("element_at(array('29.05.03', '29.33', '29.01', '30.05'), cast(1 + doc_id % 4 as int))")
    return docs.select("doc_id", T.normalize_doi(doi).alias("doi"), T.grnti_class(code).alias("class"), T.from_template("pdf", y, v, c).alias("pdf"), T.article_pdf_url(path, parity=True).alias("pdf_by_parity"), T.from_template("name", y, v, c).alias("name"), W.year_of(path).alias("year"), W.issue_of(path).alias("issue"), T.from_template("article", y, v, c).alias("url"), T.period(y).alias("period"))


@query("""SELECT doc_id, 'сверх' || 'проводник и лазер' || chr(10) || 'вторая строка ' || doc_id || chr(10) || chr(10) || 'конец' AS normalized, 'до [FORMULA] между [FORMULA] после ' || doc_id AS masked,
    'Лазер 532 нм' || chr(10) || 'слова автора ' || doc_id AS scrubbed, doc_id % 2 = 0 AS leaked FROM documents""")
def text_repairs(spark, sf_dir):
    """Line breaks and hyphens made one, formulas masked by their spans, label leaks removed and looked for."""
    docs = table(spark, sf_dir, "documents")
    raw = F.expr("concat('сверх-\\r\\nпроводник  и\\tла\\u00adзер \\r вторая строка ', doc_id, '\\n\\n\\n\\nконец ')")
    formula = F.expr("concat('до E=mc2 между x+y после ', doc_id)")
    spans = F.array(*(F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in ((15, 18), (3, 8), (4, 6), (9, 9))))
    leak = F.expr("concat('Рубрика: Физика\\nЛазер 532 нм УДК 535.3, 621.37\\nГлавная > Физика > Оптика\\nслова автора ', doc_id, ' ГРНТИ: 29.31.15')")
    return docs.select("doc_id", T.normalize_text(raw).alias("normalized"), T.mask_spans(formula, spans).alias("masked"), T.scrub_labels(leak).alias("scrubbed"), T.leaks_label(F.expr("if(doc_id % 2 = 0, 'код 29.05.03 тут', 'просто текст 29.5')")).alias("leaked"))


@query("""SELECT doc_id, length(text)::BIGINT AS characters, len(list_filter(regexp_split_to_array(text, '[\\s\\x1c-\\x1f\\x85\\p{Z}]+'), lambda w: w <> ''))::BIGINT AS words FROM documents""")
def length_metrics(spark, sf_dir):
    """Characters and words of every text."""
    return table(spark, sf_dir, "documents").select("doc_id", T.length_metrics(F.col("text")).alias("m")).select("doc_id", "m.characters", "m.words")


@query("""SELECT lang, round(exp(avg(ln(n_chars + 2.0) - ln(n_chars + 1.0))) - 1, 9) AS ratio, count(*) AS works FROM documents GROUP BY lang""")
def perplexity_ratio(spark, sf_dir):
    """Two models paired by work: the relative change of perplexity."""
    docs = table(spark, sf_dir, "documents")
    losses = docs.select("doc_id", "lang", F.explode(F.array(F.struct(F.lit("M1").alias("model"), F.log(F.col("n_chars") + 2.0).alias("loss")), F.struct(F.lit("B1").alias("model"), F.log(F.col("n_chars") + 1.0).alias("loss")))).alias("x")).select("doc_id", "lang", "x.*")
    pairs = T.paired(losses, "doc_id", "model", "loss", "M1", "B1", "lang")
    return pairs.groupBy("lang").agg(F.round(T.perplexity_ratio(F.avg("delta")), 9).alias("ratio"), F.count(F.lit(1)).alias("works"))


@query("""SELECT doc_id, '0' || (doc_id % 9) || '.10||42.' || (10 + doc_id % 80) AS codes, 'theory||optics ' || lang AS names, '10.1/a' || doc_id || '||10.1/b' AS dois FROM documents""")
def code_collect(spark, sf_dir):
    """Codes and their names from the links of a page, and its DOI names, each once and sorted."""
    page = F.expr("concat('<a title=\"Optics ', upper(lang), '\" href=x> 42.', 10 + doc_id % 80, ' </a><a href=y title=\"THEORY\">0', doc_id % 9, '.10</a><a title=\"THEORY\">0', doc_id % 9, '.10</a><a title=\"none\">text</a> https://doi.org/10.1/B doi 10.1/a', doc_id, ' ')")
    codes = T.code_links(page)
    dois = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(page, F.lit("(10[.][0-9]+/[^ <]+)"), F.lit(1)), T.normalize_doi)))
    join = lambda c, f: F.array_join(F.transform(c, lambda x: x[f]), "||")
    return table(spark, sf_dir, "documents").select("doc_id", join(codes, "code").alias("codes"), join(codes, "name").alias("names"), F.array_join(dois, "||").alias("dois"))
