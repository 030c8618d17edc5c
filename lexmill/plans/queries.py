"""Queries over the supplied tables, with the SQL that must give the same rows.

The tables stand in for the registries of the data model ("proxy"): a passing
check shows that the operator is right, not that real registries are.  Most
queries are one declarative statement that both engines read; `$draw`, `$sha` and the
like name the few functions that differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.pairs import zipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _dialect(sql: str, spark: bool) -> str:
    """Writes the few functions that differ: $draw(a, b), $sha(x), $each(list), $range(a, b)."""
    def call(name: str, spark_form: str, duck_form: str, s: str) -> str:
        while (at := s.find(f"${name}(")) >= 0:
            depth, k = 1, at + len(name) + 2
            while depth:
                depth += {"(": 1, ")": -1}.get(s[k], 0)
                k += 1
            inner = s[at + len(name) + 2 : k - 1]
            s = s[:at] + (spark_form if spark else duck_form).replace("@", inner) + s[k:]
        return s

    sql = call("draw", "(cast(conv(substr(sha2(concat_ws('|', @), 256), 1, 13), 16, 10) as bigint) / 4503599627370496.0D)", "(('0x' || substr(sha256(concat_ws('|', @)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)", sql)
    sql = call("sha", "sha2(@, 256)", "sha256(@)", sql)
    sql = call("each", "explode(@)", "unnest(@)", sql)
    sql = call("range", "sequence(@)", "generate_series(@)", sql)
    return sql


def both(name: str, sql: str) -> None:
    used = [t for t in TABLES if f"{{{t}}}" in sql]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(_dialect(sql, True), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})

    run.__name__ = name
    QUERIES[name] = run
    duck = _dialect(sql, False)
    for t in used:
        duck = duck.replace(f"{{{t}}}", t)
    ORACLES[name] = duck


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ text from pages


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+|[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+\\z', '', 'g')"


def _html_sql(x: str) -> str:
    for p, by in T.MARKUP:
        x = f"regexp_replace({x}, {_q(p)}, {_q(by)}, 'g')"
    for e, c in T.ENTITIES:
        x = f"replace({x}, {_q(e)}, {_q(c)})"
    for p, by in T.BLANKS:
        x = f"regexp_replace({x}, {_q(p)}, {_q(by)}, 'g')"
    return f"array_to_string(list_filter(list_transform(string_split({x}, chr(10)), lambda l: {_strip_sql('l')}), lambda l: l <> ''), chr(10))"


_MAIN = "(?s)<article[^>]*>(.*)"
_MAIN_SQL = f"string_split(regexp_extract(html, {_q(_MAIN)}, 1), '</article>')[1]"


def _main(c):
    return F.substring_index(F.regexp_extract(c, _MAIN, 1), "</article>", 1)


@query(f"SELECT page_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars FROM (SELECT page_id, {_html_sql(_MAIN_SQL)} AS t FROM pages)")
def html_text(spark, sf_dir):
    out = table(spark, sf_dir, "pages").select("page_id", T.html_to_text(_main(F.col("html"))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


_NAV_START = f"length(l) > 25 AND lower({_strip_sql('l')}) NOT IN ({', '.join(map(_q, T.MENU))}) AND NOT regexp_matches(l, '^[0-9]{{4}}\\z') AND NOT regexp_matches(lower({_strip_sql('l')}), '^(?:{T.MONTHS})') AND NOT regexp_matches(l, '^[\\s/←→0-9]+\\z')"


@query(f"""WITH t AS (SELECT page_id, {_html_sql('html')} AS t, html FROM pages),
k AS (SELECT *, list_filter(string_split(t, chr(10)), lambda l: NOT regexp_matches(l, '@|mail[0-9]|Ud%|-->|\\$')) AS k FROM t),
p AS (SELECT *, list_position(list_transform(k, lambda l: {_NAV_START}), true) AS p FROM k),
b AS (SELECT page_id, html, CASE WHEN p > 0 THEN array_to_string(k[p:], chr(10)) ELSE t END AS body FROM p)
SELECT page_id, coalesce(substr(list_filter(string_split(body, chr(10)), lambda l: lower(l) NOT IN ({", ".join(map(_q, T.TITLE_SKIP))}) AND NOT regexp_matches(l, '^[0-9]{{4}}\\z') AND length(l) >= 12
    AND NOT regexp_matches(lower(l), '^(?:{T.MONTHS})'))[1], 1, 500), {_q(T.UNTITLED)}) AS title, CAST(length(body) AS BIGINT) AS n_chars FROM b""")
def nav_drop_title(spark, sf_dir):
    body = table(spark, sf_dir, "pages").select("page_id", "html", T.drop_nav_prefix(T.html_to_text(F.col("html"))).alias("body"))
    both_of = T.let(F.struct("body", "html"), lambda x: F.struct(T.extract_title(x["body"], x["html"]).alias("title"), F.length(x["body"]).cast("long").alias("n_chars")))
    return body.select("page_id", both_of.alias("x")).select("page_id", "x.title", "x.n_chars")


@query("SELECT page_id, path, row_number() OVER (PARTITION BY page_id ORDER BY path DESC) AS rank FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href=\"(/[^\"]*)\"', 1)) AS path FROM pages)")
def link_extract(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1))).alias("path")).distinct()
    return links.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("path"))).cast("long"))


@query("""SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
    CASE WHEN lower(n) LIKE '%.pdf' THEN n ELSE n || '.pdf' END AS file_name, string_split(url, '/')[-2] AS section
FROM (SELECT *, list_extract(string_split(regexp_replace(url, '/+\\z', ''), '/'), -1) AS n FROM pages)""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", T.host(u).alias("host"), T.file_name(u).alias("file_name"), F.element_at(F.split(u, "/"), -2).alias("section"))


@query(f"""SELECT doc_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars FROM (SELECT doc_id, regexp_replace({_strip_sql("array_to_string(list_filter(string_split(text, chr(10)), lambda l: NOT regexp_matches(" + _strip_sql("l") + ", '^[0-9]{1,4}\\z')), chr(10))")}, '\\n{{3,}}', chr(10) || chr(10), 'g') AS t FROM documents)""")
def page_line_clean(spark, sf_dir):
    out = table(spark, sf_dir, "documents").select("doc_id", T.clean_page_lines(F.col("text")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


_RATIO_SQL = "coalesce(CAST(len(regexp_extract_all(array_to_string(regexp_extract_all(text, '\\p{L}'), ''), '[À-ÿ]')) AS DOUBLE) / nullif(len(regexp_extract_all(text, '\\p{L}')), 0), 0)"


@query(f"SELECT doc_id, round(r, 6) AS ratio, length({_strip_sql('text')}) >= 200 AND r >= 0.12 AS readable FROM (SELECT doc_id, text, {_RATIO_SQL} AS r FROM documents)")
def readable_script(spark, sf_dir):
    """Share of a script, and whether a text is readable by it."""
    c, low, high = F.col("text"), "\\u00C0", "\\u00FF"
    both_of = T.let(T.script_ratio(c, low, high), lambda r: F.struct(F.round(r, 6).alias("ratio"), T.is_readable(c, low, high, ratio=r).alias("readable")))
    return table(spark, sf_dir, "documents").select("doc_id", both_of.alias("x")).select("doc_id", "x.*")


both("issue_caps", """
WITH r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM {documents}),
s AS (SELECT source, doc_id, row_number() OVER (ORDER BY source DESC, doc_id) AS n FROM r WHERE k <= 5 AND n_chars >= 80)
SELECT source, doc_id, CAST(n AS BIGINT) AS place FROM s WHERE n <= 60""")

both("lexical_vs_numeric_order", """
SELECT source, CAST(row_number() OVER (ORDER BY source DESC) AS BIGINT) AS lexical, CAST(row_number() OVER (ORDER BY CAST(substr(source, 4) AS INT) DESC) AS BIGINT) AS by_number
FROM (SELECT DISTINCT source FROM {documents})""")

both("title_last_wins", """
WITH l AS (SELECT conv_id, role, max(turn) AS turn FROM {conversations} GROUP BY conv_id, role)
SELECT c.conv_id, c.role, min(c.text) AS text FROM {conversations} c JOIN l ON l.conv_id = c.conv_id AND l.role = c.role AND l.turn = c.turn GROUP BY c.conv_id, c.role""")

both("year_volume_grid", """
SELECT CAST(y AS BIGINT) AS year, CAST(v AS BIGINT) AS volume, count(o.o_orderkey) AS orders FROM (SELECT $each($range(1992, 1998)) AS y) CROSS JOIN (SELECT $each($range(1, 12)) AS v)
LEFT JOIN {orders} o ON year(o.o_orderdate) = y AND month(o.o_orderdate) = v GROUP BY y, v""")

both("content_address", """
SELECT artifact, count(*) AS retrievals, min(doc_id) AS first FROM (SELECT concat('sha256:', $sha(text)) AS artifact, doc_id FROM {documents}) GROUP BY artifact""")

both("bool_mean_profile", """
SELECT avg(CAST(toxic AS DOUBLE)) AS toxic_share, avg(CAST(quality AS DOUBLE)) AS quality_share, count(toxic) AS toxic_known, count(quality) AS quality_known, count(DISTINCT doc_id) AS docs FROM {labels}""")

both("url_distinct", "SELECT count(*) AS n_rows, count(DISTINCT url) AS n_urls FROM {pages}")


@query("""WITH z AS (SELECT conv_id, list(turn ORDER BY turn) FILTER (role = 'user') AS u, list(turn ORDER BY turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(i AS BIGINT) AS i, u[i] AS question, a[i] AS answer FROM (SELECT *, unnest(range(1, least(len(u), len(a)) + 1)) AS i FROM z WHERE u IS NOT NULL AND a IS NOT NULL)""")
def zip_truncate(spark, sf_dir):
    """The i-th question of a conversation with its i-th answer."""
    out = zipped(table(spark, sf_dir, "conversations"), "conv_id", "role", "turn", "user", "assistant")
    return out.select("conv_id", "i", F.col("first").alias("question"), F.col("second").alias("answer"))


both("run_detect", """
WITH s AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS prior_id FROM {events})
SELECT user_id, min(prior_id) AS run_start FROM s WHERE value >= 50 AND before >= 50 GROUP BY user_id""")

# ------------------------------------------------------------------ splits, samples, leakage

# ------------------------------------------------------------------ agreement and association

_CELLS = "WITH d AS (SELECT a.v AS a, b.v AS b FROM (SELECT 0 AS v UNION ALL SELECT 1) a CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) b), c AS (SELECT d.a, d.b, count(l.doc_id) AS n FROM d LEFT JOIN {labels} l ON l.quality = d.a AND l.toxic = d.b GROUP BY d.a, d.b)"
both("confusion", f"{_CELLS} SELECT a AS quality, b AS toxic, n FROM c")
_KAPPA = """, t AS (SELECT sum(n) AS n, sum(CASE WHEN a = b THEN n ELSE 0 END) AS same FROM c), r AS (SELECT a, sum(n) AS n FROM c GROUP BY a), k AS (SELECT b, sum(n) AS n FROM c GROUP BY b),
e AS (SELECT sum(CAST(r.n AS DOUBLE) * k.n) AS x FROM r JOIN k ON r.a = k.b)
SELECT round(CAST(same AS DOUBLE) / t.n, 6) AS observed, round(x / (CAST(t.n AS DOUBLE) * t.n), 6) AS expected,
    round((CAST(same AS DOUBLE) / t.n - x / (CAST(t.n AS DOUBLE) * t.n)) / nullif(1 - x / (CAST(t.n AS DOUBLE) * t.n), 0), 6) AS kappa FROM t CROSS JOIN e"""
both("cohen_kappa", _CELLS + _KAPPA)
both("weighted_kappa", """
WITH s AS (SELECT l.quality AS a, l.toxic AS b, CAST(p.n AS DOUBLE) / 20 AS w FROM {labels} l JOIN {documents} d ON d.doc_id = l.doc_id JOIN (SELECT lang, count(*) AS n FROM {documents} GROUP BY lang) p ON p.lang = d.lang),
c AS (SELECT a, b, sum(w) AS n FROM s GROUP BY a, b)""" + _KAPPA)
both("macro_f1", _CELLS + """, k AS (SELECT v.v, coalesce(sum(CASE WHEN a = v.v AND b = v.v THEN n END), 0) AS tp, coalesce(sum(CASE WHEN a <> v.v AND b = v.v THEN n END), 0) AS fp, coalesce(sum(CASE WHEN a = v.v AND b <> v.v THEN n END), 0) AS fn
    FROM c CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) v GROUP BY v.v)
SELECT round(avg(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)), 6) AS macro_f1, round(sum(CAST(tp AS DOUBLE)) / CAST(sum(tp + fn) AS DOUBLE), 6) AS micro_f1, round(avg(CAST(tp AS DOUBLE) / nullif(tp + fn, 0)), 6) AS balanced_accuracy,
    round(sum(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn)) / CAST(sum(tp + fn) AS DOUBLE), 6) AS weighted_f1 FROM k""")
_FLAGS = """WITH g AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM {lineitem} GROUP BY l_returnflag, l_linestatus),
c AS (SELECT x.a, y.b, coalesce(g.n, 0) AS n FROM (SELECT DISTINCT a FROM g) x CROSS JOIN (SELECT DISTINCT b FROM g) y LEFT JOIN g ON g.a = x.a AND g.b = y.b),
m AS (SELECT *, CAST(n AS DOUBLE) AS o, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) AS ra, CAST(sum(n) OVER (PARTITION BY b) AS DOUBLE) AS rb, CAST(sum(n) OVER () AS DOUBLE) AS t FROM c)"""
both("cramers_v", _FLAGS + " SELECT round(sqrt(sum((o - ra * rb / t) * (o - ra * rb / t) / (ra * rb / t)) / (max(t) * (least(count(DISTINCT a), count(DISTINCT b)) - 1))), 6) AS v FROM m")
both("mutual_information", _FLAGS + " SELECT round(sum(CASE WHEN o > 0 THEN o / t * ln(o * t / (ra * rb)) ELSE 0 END), 6) AS nats FROM m")
both("coverage_rates", "SELECT source, count(*) AS works, round(avg(CASE WHEN n_chars >= 200 THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS long_share, round(avg(CASE WHEN lang = 'en' THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS en_share, count(DISTINCT lang) AS langs FROM {documents} GROUP BY source")
both("two_level_mean", "SELECT lang, round(avg(m), 6) AS mean FROM (SELECT lang, source, avg(CAST(n_chars AS DOUBLE)) AS m FROM {documents} GROUP BY lang, source) GROUP BY lang")
both("cer", "SELECT item_id, CAST(levenshtein(text, replace(text, 'th', 't')) AS BIGINT) AS edits, round(CAST(levenshtein(text, replace(text, 'th', 't')) AS DOUBLE) / length(text), 6) AS cer FROM {benchmark}")


both("referential_integrity", """
SELECT 'labels.doc_id' AS relation, count(*) AS violations FROM {labels} l WHERE NOT EXISTS (SELECT 1 FROM {documents} d WHERE d.doc_id = l.doc_id)
UNION ALL SELECT 'orders.o_custkey', count(*) FROM {orders} o WHERE NOT EXISTS (SELECT 1 FROM {customer} c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM {lineitem} l WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_orderkey = l.l_orderkey)""")

both("formula_overlap", """
SELECT a.l_orderkey AS doc, a.l_linenumber AS i, b.l_linenumber AS j, CAST(least(a.l_linenumber, b.l_linenumber) AS BIGINT) AS inner_lo FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
AND a.l_quantity < b.l_quantity + 5 AND b.l_quantity < a.l_quantity + 5""")

@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS s, l_partkey % 7 AS p FROM lineitem),
r AS (SELECT s, s AS m FROM e UNION SELECT e2.s, r.m FROM r JOIN e e1 ON e1.s = r.s JOIN e e2 ON e2.p = e1.p),
c AS (SELECT s, min(m) AS m FROM r GROUP BY s)
SELECT count(DISTINCT m) AS components, count(*) AS journals, (SELECT min(n) FROM (SELECT count(DISTINCT s) AS n FROM e GROUP BY p)) AS min_class_degree FROM c""")
def graph_connectivity(spark, sf_dir):
    from ..operators.graph import label_components

    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 7).alias("p")).distinct()
    edges = e.select(F.col("s").alias("a"), (-1 - F.col("p")).alias("b"))
    labels = label_components(edges).where("node >= 0")
    degree = e.groupBy("p").agg(F.count_distinct("s").alias("n")).agg(F.min("n").alias("min_class_degree"))
    return labels.agg(F.count_distinct("label").alias("components"), F.count(F.lit(1)).alias("journals")).crossJoin(degree)


def operated(name: str):
    """Registers a query that runs the library's operators; the SQL given before by `both` stays its oracle."""

    def add(f):
        QUERIES[name] = f
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to text per host: main block, text, menu prefix, title, length filter."""
    p = table(spark, sf_dir, "pages").select(T.host(F.col("url")).alias("host"), T.drop_nav_prefix(T.html_to_text(_main(F.col("html")))).alias("text"))
    return p.where(F.length("text") >= 80).groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("text")).alias("n_chars"))


@query(f"""SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, count(*) AS pages FROM (SELECT url, {_html_sql(_MAIN_SQL)} AS t FROM pages) WHERE length(t) >= 80 GROUP BY 1""")
def page_hosts(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(T.host(F.col("url")).alias("host"), T.html_to_text(_main(F.col("html"))).alias("t"))
    return p.where(F.length("t") >= 80).groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
