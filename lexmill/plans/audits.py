"""More queries of the registry: chunks, masks, folds, matched pairs, span agreement, volumes, power.

As in `queries`, the tables stand in for registries ("proxy").
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .queries import ORACLES, both, query, table

CHUNK, OVERLAP = 128, 32
STEP = CHUNK - OVERLAP


@query(f"""WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
c AS (SELECT doc_id, w, unnest(generate_series(0, greatest(CAST(ceil((len(w) - {OVERLAP}) / {STEP}.0) AS BIGINT), 1) - 1)) AS chunk FROM w),
t AS (SELECT doc_id, chunk, w[chunk * {STEP} + 1 : chunk * {STEP} + {CHUNK}] AS p FROM c)
SELECT doc_id, CAST(chunk AS BIGINT) AS chunk, CAST(len(p) AS BIGINT) AS n_words, sha256(array_to_string(p, ' ')) AS digest FROM t""")
def chunk_overlap(spark, sf_dir):
    """Chunks of 128 words that share 32 with the next; the last one always holds words of its own."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("w")).where("w is not null")
    last = F.greatest(F.ceil((F.size("w") - OVERLAP) / F.lit(float(STEP))), F.lit(1)) - 1
    cut = words.select("doc_id", "w", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("chunk"))
    part = cut.select("doc_id", "chunk", F.slice("w", (F.col("chunk") * STEP + 1).cast("int"), CHUNK).alias("p"))
    return part.select("doc_id", "chunk", F.size("p").cast("long").alias("n_words"), F.sha2(F.array_join("p", " "), 256).alias("digest"))


both("mask_sets", """
WITH t AS (SELECT item_id, $each($range(1, length(text) - length(replace(text, ' ', '')) + 1)) AS place, length(text) - length(replace(text, ' ', '')) + 1 AS n FROM {benchmark}),
r AS (SELECT item_id, s, place, n, row_number() OVER (PARTITION BY item_id, s ORDER BY $draw('23', s, item_id, place), place) AS k FROM t CROSS JOIN (SELECT $each($range(1, 5)) AS s))
SELECT item_id, CAST(s AS BIGINT) AS mask_set, CAST(place AS BIGINT) AS place FROM r WHERE k <= CAST(ceil(0.15 * n) AS BIGINT)""")

both("period_bucket", """
SELECT CASE WHEN year(o_orderdate) <= 1994 THEN 'early' ELSE 'late' END AS period, o_orderpriority AS stratum, count(*) AS n FROM {orders}
GROUP BY CASE WHEN year(o_orderdate) <= 1994 THEN 'early' ELSE 'late' END, o_orderpriority""")

both("source_lists", """
SELECT lang, count(*) AS sources, listagg(source, ',') WITHIN GROUP (ORDER BY source) AS ids, count(*) >= 2 AS enough FROM (SELECT DISTINCT lang, source FROM {documents}) GROUP BY lang""")
ORACLES["source_lists"] = "SELECT lang, count(*) AS sources, string_agg(source, ',' ORDER BY source) AS ids, count(*) >= 2 AS enough FROM (SELECT DISTINCT lang, source FROM documents) GROUP BY lang"

both("discovery_paths", """
SELECT work, count(*) AS paths, listagg(source, ',') WITHIN GROUP (ORDER BY source) AS found_in FROM (SELECT DISTINCT $sha(text) AS work, source FROM {documents}) GROUP BY work""")
ORACLES["discovery_paths"] = "SELECT work, count(*) AS paths, string_agg(source, ',' ORDER BY source) AS found_in FROM (SELECT DISTINCT sha256(text) AS work, source FROM documents) GROUP BY work"

both("leave_one_source_out", """
WITH c AS (SELECT lang, source, count(*) AS n FROM {documents} GROUP BY lang, source),
e AS (SELECT lang FROM c GROUP BY lang HAVING sum(n) >= 50 AND count(CASE WHEN n >= 10 THEN 1 END) >= 3),
t AS (SELECT source, sum(n) AS n FROM c GROUP BY source)
SELECT e.lang AS held_out, t.source, CAST(coalesce(c.n, 0) AS BIGINT) AS test, CAST(t.n - coalesce(c.n, 0) AS BIGINT) AS train
FROM e CROSS JOIN t LEFT JOIN c ON c.lang = e.lang AND c.source = t.source""")

both("matched_pairs", """
WITH d AS (SELECT l.doc_id, l.toxic, d.lang, d.source, CAST(floor(d.n_chars / 500.0D) AS BIGINT) AS size FROM {labels} l JOIN {documents} d ON d.doc_id = l.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY toxic, lang, source, size ORDER BY doc_id) AS k FROM d)
SELECT a.doc_id AS marked, b.doc_id AS control, a.lang, a.source, a.size FROM r a JOIN r b ON a.toxic = 1 AND b.toxic = 0 AND a.lang = b.lang AND a.source = b.source AND a.size = b.size AND a.k = b.k""")
ORACLES["matched_pairs"] = ORACLES["matched_pairs"].replace("500.0D", "500.0::DOUBLE")

# Spans [quantity, quantity + 10) against [10 * line, 10 * line + 10): a match is the best of both sides with IoU >= 0.5.
# Line numbers repeat within an order, so a span is known by its number and its start.
both("span_match", """
WITH s AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS i, CAST(l_quantity AS DOUBLE) AS a, CAST(l_quantity AS DOUBLE) + 10 AS b FROM {lineitem}),
g AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS j, CAST(10 * l_linenumber AS DOUBLE) AS a, CAST(10 * l_linenumber AS DOUBLE) + 10 AS b FROM {lineitem}),
p AS (SELECT s.doc, s.i, s.a, g.j, (least(s.b, g.b) - greatest(s.a, g.a)) / (greatest(s.b, g.b) - least(s.a, g.a)) AS iou FROM s JOIN g ON g.doc = s.doc AND s.a < g.b AND g.a < s.b),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, i, a ORDER BY iou DESC, j) AS ki, row_number() OVER (PARTITION BY doc, j ORDER BY iou DESC, i, a) AS kj FROM p WHERE iou >= 0.5)
SELECT doc, CAST(i AS BIGINT) AS i, a AS start, CAST(j AS BIGINT) AS j, round(iou, 6) AS iou FROM r WHERE ki = 1 AND kj = 1""")

both("power_simulation", """
WITH d AS (SELECT e, r, i, $draw('31', r, i, 'a') - $draw('31', r, i, 'b') + e / 20.0 AS x FROM (SELECT $each($range(0, 4)) AS e) CROSS JOIN (SELECT $each($range(1, 100)) AS r) CROSS JOIN (SELECT $each($range(1, 40)) AS i)),
m AS (SELECT e, r, avg(CAST(x AS DOUBLE)) AS mean, stddev_samp(CAST(x AS DOUBLE)) AS sd FROM d GROUP BY e, r)
SELECT CAST(e AS BIGINT) AS effect, count(*) AS replicates, round(avg(CASE WHEN mean - 1.645 * sd / sqrt(40.0) > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS power FROM m GROUP BY e""")

both("duplicate_keys", """
SELECT 'documents' AS registry, count(*) AS violations FROM (SELECT doc_id FROM {documents} GROUP BY doc_id HAVING count(*) > 1)
UNION ALL SELECT 'pages', count(*) FROM (SELECT page_id FROM {pages} GROUP BY page_id HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', count(*) FROM (SELECT l_orderkey, l_linenumber FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
