"""Queries on samples, splits, resampling, retrieval and reports, through the library's operators.

The SQL repeats the draw by hash, and says the rest as plain windows over whole strata.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import agreement as A
from ..operators import bootstrap as B
from ..operators import sampling as M
from ..operators import pairs as X
from ..operators import profile as P
from ..operators import resolve as R
from ..operators import source_only as O
from .relations import labels_of
from .queries import operated, query, table


def _u(*parts: str) -> str:
    return f"(('0x' || substr(sha256(concat_ws('|', {', '.join(parts)})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def _dealt_sql(source: str, strata: list[str], seed: str, key: str, parts: dict[str, int], within: list[str] = (), most: int | None = None) -> str:
    """SQL for the deal of `ranks.dealt`: (key, strata, part)."""
    s, total, upto = ", ".join(strata), sum(parts.values()), 0
    over = f"PARTITION BY {', '.join(within)}" if within else ""
    size = f"least(max(n), {most})" if most is not None else "max(n)"
    here, exact, cols = [], [], []
    for p, number in parts.items():
        upto += number
        here.append(f"floor({upto} * least({total}, sum(n) OVER ({over})) / {total}.0::DOUBLE)::BIGINT AS h_{p}")
        exact.append(f"h_{p}::DOUBLE * n / total AS x_{p}")
        cols.append(f"floor(x_{p}) + CASE WHEN row_number() OVER ({over} ORDER BY round(x_{p} - floor(x_{p}), 9) DESC, {s}) <= h_{p} - sum(floor(x_{p})) OVER ({over}) THEN 1 ELSE 0 END AS upto_{p}")
    part = " ".join(f"WHEN rank <= upto_{p} THEN '{p}'" for p in parts)
    return f"""(WITH placed AS (SELECT {key}, {s}, row_number() OVER (PARTITION BY {s} ORDER BY {_u(f"'{seed}'", key)}, {key}) AS rank, count(*) OVER (PARTITION BY {s}) AS n FROM {source}),
    sizes AS (SELECT {s}, {size} AS n FROM placed GROUP BY {s}), here AS (SELECT *, {", ".join(here)}, sum(n) OVER ({over}) AS total FROM sizes),
    quotas AS (SELECT {s}, {", ".join(cols)} FROM (SELECT *, {", ".join(exact)} FROM here))
    SELECT {key}, {s}, CASE {part} END AS part FROM placed JOIN quotas USING ({s}) WHERE CASE {part} END IS NOT NULL)"""


# ------------------------------------------------------------------ splits and samples

_SPLIT_SQL = _dealt_sql("(SELECT doc_id AS work_id, lang, source, text FROM documents)", ["lang", "source"], "17", "work_id", M.MLM_PARTS)


def _split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs, M.mlm_split(docs.select(F.col("doc_id").alias("work_id"), "lang", "source"), ["lang", "source"], 17)


@query(f"SELECT work_id AS doc_id, part AS split FROM {_SPLIT_SQL}")
def split_assign(spark, sf_dir):
    """1600, 200 and 200 works, or as many in proportion, each language and source by largest remainder."""
    return _split(spark, sf_dir)[1].select(F.col("work_id").alias("doc_id"), F.col("part").alias("split"))


@query(f"WITH s AS (SELECT DISTINCT part, sha256(text) AS h FROM {_SPLIT_SQL} JOIN documents ON doc_id = work_id) SELECT a.part AS left_split, b.part AS right_split, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.part < b.part GROUP BY a.part, b.part")
def split_overlap_matrix(spark, sf_dir):
    """Texts that two parts of the split share: a grouped set of parts per hash, no self join."""
    docs, split = _split(spark, sf_dir)
    held = docs.join(split.select(F.col("work_id").alias("doc_id"), "part"), "doc_id").groupBy(F.sha2("text", 256).alias("h")).agg(F.sort_array(F.collect_set("part")).alias("p"))
    left = held.where("size(p) > 1 and h is not null").select("p", F.explode("p").alias("left_split"))
    return left.select("left_split", F.explode(F.filter("p", lambda x: x > F.col("left_split"))).alias("right_split")).groupBy("left_split", "right_split").agg(F.count(F.lit(1)).alias("shared"))


@query(f"SELECT part AS split, count(*) AS works, CAST(sum(length(text)) AS BIGINT) AS chars, round(CAST(sum(length(text)) AS DOUBLE) / sum(sum(length(text))) OVER (), 6) AS share FROM {_SPLIT_SQL} JOIN documents ON doc_id = work_id GROUP BY part")
def split_volume(spark, sf_dir):
    """Works and characters of each part."""
    docs, split = _split(spark, sf_dir)
    per = docs.select("doc_id", F.length("text").alias("n")).join(split.select(F.col("work_id").alias("doc_id"), F.col("part").alias("split")), "doc_id").groupBy("split").agg(F.count(F.lit(1)).alias("works"), F.sum("n").cast("long").alias("chars"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("chars").alias("whole")))).select("split", "works", "chars", F.round(F.col("chars").cast("double") / F.col("whole"), 6).alias("share"))


@query(f"""SELECT doc_id, lang, population, CAST(least(20, population) AS DOUBLE) / population AS inclusion_probability FROM (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_u("'5'", "doc_id")}, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS population FROM documents) WHERE k <= 20""")
def stratified_sample(spark, sf_dir):
    """20 works of each language, by hashed rank."""
    out = R.stratified(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 20, 5)
    return out.select("doc_id", "lang", F.col("stratum_population_size").alias("population"), "inclusion_probability")


_FRAME_SQL = "SELECT doc_id AS work_id, CASE WHEN doc_id % 8 < 5 THEN 'C' || (1 + doc_id % 8) ELSE 'HARD' END || '/' || CASE WHEN doc_id % 2 = 0 THEN 'early' ELSE 'late' END AS stratum_id FROM documents"


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY stratum_id ORDER BY {_u("'7'", "work_id")}, work_id) AS k, count(*) OVER (PARTITION BY stratum_id) AS n, CASE WHEN stratum_id LIKE 'HARD%' THEN 25 ELSE 15 END AS size FROM ({_FRAME_SQL})),
c AS (SELECT work_id, row_number() OVER (ORDER BY {_u("'8'", "work_id")}, work_id) AS k, count(*) OVER () AS rest FROM r WHERE k > size)
SELECT r.work_id, stratum_id, n AS stratum_population_size, CASE WHEN r.k <= size THEN 'audit' WHEN c.k <= 30 THEN 'calibration' ELSE 'not_selected' END AS selection_role,
    CASE WHEN r.k > size AND c.k <= 30 THEN least(30, rest)::DOUBLE / rest ELSE least(size, n)::DOUBLE / n END AS inclusion_probability FROM r LEFT JOIN c USING (work_id)""")
def audit_sample(spark, sf_dir):
    """The audit sample: 15 works of each class and period, 25 hard ones of each period, and 30 others for calibration."""
    frame = table(spark, sf_dir, "documents").selectExpr("doc_id as work_id", "case when doc_id % 8 < 5 then concat('C', 1 + doc_id % 8) when doc_id % 8 = 5 then 'BOUNDARY' else 'OTHER' end as candidate_class_id", "if(doc_id % 2 = 0, 'early', 'late') as period")
    return M.audit_sample(frame, 7)


_CLASSED = "(SELECT doc_id AS work_id, 'C' || (1 + doc_id % 5) AS h2_class_id, source AS source_id FROM documents)"
_CLASS_SPLIT_SQL = _dealt_sql(_CLASSED, ["h2_class_id", "source_id"], "19", "work_id", M.CLASS_PARTS, ["h2_class_id"], 180)


def _classed(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("doc_id as work_id", "concat('C', 1 + doc_id % 5) as h2_class_id", "source as source_id")


@query(f"SELECT work_id, h2_class_id, source_id, part FROM {_CLASS_SPLIT_SQL}")
def class_split(spark, sf_dir):
    """210, 30 and 60 works of each class, or as many in proportion, with at most 60% from one source."""
    return M.class_split(_classed(spark, sf_dir), 19)


@query(f"""WITH p AS (SELECT h2_class_id, part, source_id, count(*) AS n FROM {_CLASS_SPLIT_SQL} GROUP BY ALL), w AS (SELECT h2_class_id, part, sum(n) AS n, count(*) AS sources, max(n) AS most FROM p GROUP BY ALL)
SELECT h2_class_id, part, 'too few works' AS reason FROM w WHERE n < CASE part WHEN 'train' THEN 210 WHEN 'validation' THEN 30 ELSE 60 END UNION ALL SELECT h2_class_id, part, 'too few sources' FROM w WHERE sources < 2 UNION ALL SELECT h2_class_id, part, 'too much of one source' FROM w WHERE most > ceil(0.6 * n)""")
def class_split_faults(spark, sf_dir):
    """Parts of the split by class that break a rule."""
    return M.split_faults(M.class_split(_classed(spark, sf_dir), 19))


_PILOT_SQL = _dealt_sql(f"(SELECT work_id, lang AS source_group_id FROM {_SPLIT_SQL} WHERE part = 'train')", ["source_group_id"], "23", "work_id", {"pilot": M.PILOT_WORKS})


@query(f"SELECT count(*) AS works, count(DISTINCT source_group_id) AS groups, sum(n_chars)::BIGINT AS subtokens, count(*) = 400 AND count(DISTINCT source_group_id) >= 3 AND sum(n_chars) BETWEEN 4000000 AND 6000000 AS ok, sum(work_id)::BIGINT AS ids FROM {_PILOT_SQL} JOIN documents ON doc_id = work_id")
def pilot_subset(spark, sf_dir):
    """400 works of the training part, groups in proportion, and whether they meet the pilot's rules (characters stand in for subtokens)."""
    docs, split = _split(spark, sf_dir)
    chosen = M.pilot(split.where("part = 'train'").select("work_id", F.col("lang").alias("source_group_id")), 23).join(docs.select(F.col("doc_id").alias("work_id"), F.col("n_chars").alias("subtokens")), "work_id")
    return M.pilot_verdict(chosen).crossJoin(chosen.agg(F.sum("work_id").alias("ids")))


_RULES_SQL = {
    1: ("genre and years", "not an article"), 2: ("genre and years", ""), 3: ("title and abstract", "no title or abstract"), 4: ("stable address", ""), 5: ("explicit primary code", ""), 6: ("one class", "several classes"),
    7: ("unique and permitted", "duplicate"), 8: ("unique and permitted", "not permitted"), 9: ("no label in the input", ""), 10: ("one class", "section only"), 11: ("one class", "general branch"), 12: ("one class", "other branch"), 13: ("genre and years", "not Russian"),
}


@query("SELECT doc_id, doc_id % 14 = 0 AS included, CASE doc_id % 14 " + " ".join(f"WHEN {k} THEN '{v[0]}'" for k, v in _RULES_SQL.items()) + " ELSE '' END AS failed, CASE doc_id % 14 " + " ".join(f"WHEN {k} THEN '{v[1]}'" for k, v in _RULES_SQL.items()) + " ELSE '' END AS reasons FROM documents")
def inclusion_rules(spark, sf_dir):
    """The rules of inclusion and the reasons of exclusion, each broken by some works."""
    return M.included(_works(spark, sf_dir)).select("doc_id", "included", F.array_join("failed_rules", "|").alias("failed"), F.array_join("exclusion_reasons", "|").alias("reasons"))


@query("SELECT reason, count(*) AS n FROM documents JOIN (VALUES " + ", ".join(f"({k}, '{v[1]}')" for k, v in _RULES_SQL.items() if v[1]) + ") t(k, reason) ON doc_id % 14 = k GROUP BY reason")
def exclusion_reasons(spark, sf_dir):
    """Works by the reason they are left out for; a work may have several."""
    return M.included(_works(spark, sf_dir)).select(F.explode("exclusion_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _works(spark, sf_dir):
    """Works that break one rule each, by doc_id modulo 14."""
    s = "doc_id % 14"
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"if({s} = 13, 'en', 'ru') as language", f"if({s} = 1, 'other', 'review_article') as genre", f"if({s} = 2, 1999, 2010) as year", "'t' as title", f"if({s} = 3, ' ', 'a') as abstract", f"if({s} = 4, null, 'https://h/') as canonical_url",
        f"{s} <> 5 as is_primary_explicit", f"case {s} when 10 then '29' when 11 then '29.03.01' when 12 then '29.37' else '29.05.01' end as code", "'e' as evidence_sha256",
        f"case when {s} = 6 then array('C1', 'C2') when {s} in (10, 11, 12) then array() else array('C1', 'C1') end as classes", f"if({s} = 7, 'w', null) as duplicate_of_work_id", f"if({s} = 8, null, true) as permitted", f"{s} = 9 as leaks",
    )


@query("SELECT doc_id, CAST(ntile(10) OVER (ORDER BY n_chars, doc_id) AS BIGINT) AS decile FROM documents")
def length_decile(spark, sf_dir):
    """Tenths of the whole table by length: parts cut at sketched quantiles, ranked by counted offsets."""
    return M.length_decile(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id").select("doc_id", "decile")


@query(f"""SELECT doc_id, rep, CAST((k - 1) % 5 AS BIGINT) AS fold FROM (SELECT doc_id, rep, row_number() OVER (PARTITION BY rep, quality ORDER BY {_u("'29'", "rep", "doc_id")}, doc_id) AS k FROM (SELECT DISTINCT doc_id, quality FROM labels), (SELECT unnest(range(1, 11)) AS rep))""")
def stratified_folds(spark, sf_dir):
    """Five stratified folds, ten times."""
    return M.folds(table(spark, sf_dir, "labels").select("doc_id", "quality").distinct(), "doc_id", "quality", 29).select("doc_id", "rep", "fold")


@query()
def source_only(spark, sf_dir):
    """How well source, period and length alone tell the class: macro-F1 of each repeat, by cross-validation."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id as work_id", "source as journal_id", "if(doc_id % 2 = 0, 'early', 'late') as period", "n_chars")
    rows = M.length_decile(docs, "n_chars", "work_id").join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work_id"), F.concat(F.lit("C"), F.col("quality") + 1).alias("h2_class_id")).distinct(), "work_id")
    return O.scores(rows, 29)


# ------------------------------------------------------------------ resampling

_UNITS = "SELECT l.doc_id, l.toxic, d.lang, d.source, 1.0 + l.doc_id % 3 AS w FROM labels l JOIN documents d ON d.doc_id = l.doc_id"


def _draws_sql(units: str, cells: list[str], key: str, seed: str, replicates: int) -> str:
    """(columns of units, b, times), as `bootstrap.draws`."""
    c = ", ".join(cells)
    by = f"PARTITION BY {c} " if cells else ""
    cs = f"{c}, " if cells else ""
    group = f"GROUP BY {c}" if cells else ""
    using = f"{c}, " if cells else ""
    hashed = f"{c}, " if cells else "1, "
    return f"""(WITH placed AS (SELECT *, row_number() OVER ({by}ORDER BY {_u(f"'{seed}'", key)}, {key}) AS pick, count(*) OVER ({by}) AS n FROM ({units})),
    slots AS (SELECT {cs}n, unnest(range(1, n + 1)) AS i FROM (SELECT {cs}max(n) AS n FROM placed {group})),
    times AS (SELECT {cs}b, pick, count(*) AS times FROM (SELECT {cs}b, least(floor({_u(f"'{seed}'", "b", hashed + "i")} * n)::BIGINT + 1, n) AS pick FROM slots, (SELECT unnest(range(1, {replicates + 1})) AS b)) GROUP BY ALL)
    SELECT placed.*, b, times FROM placed JOIN times USING ({using}pick))"""


_MEANS = f"SELECT b, sum(w * times * toxic) / sum(w * times) AS m FROM {_draws_sql(_UNITS, ['lang', 'source'], 'doc_id', '11', 50)} GROUP BY b"


def _estimates(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").hint("merge")  # else the driver sends all of it while its files are small
    units = labels.join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id").selectExpr("doc_id", "toxic", "lang", "source", "1.0D + doc_id % 3 as w")
    return B.means(units, ["lang", "source"], "doc_id", F.col("toxic"), 11, 50, F.col("w"))


@query(f"SELECT round(avg(m), 6) AS centre, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high, count(*) AS replicates FROM ({_MEANS})")
def bootstrap_ci(spark, sf_dir):
    """A 95% interval of a weighted mean: works drawn within cells of language and source."""
    out = B.interval(_estimates(spark, sf_dir))
    return out.select(*(F.round(c, 6).alias(c) for c in ("centre", "low", "high")), "replicates")


@query(f"SELECT round(quantile_cont(m, 0.05), 6) AS lower95, round(quantile_cont(m, 0.95), 6) AS upper95 FROM ({_MEANS})")
def bootstrap_bounds(spark, sf_dir):
    """One-sided bounds of the same mean."""
    out = B.interval(_estimates(spark, sf_dir), 0.05, 0.95)
    return out.select(F.round("low", 6).alias("lower95"), F.round("high", 6).alias("upper95"))


def _crossed_sql(factors: dict[str, str], value: str, seed: int, replicates: int) -> str:
    joins = " ".join(f"JOIN {_draws_sql(sql, [], name, str(seed + k), replicates)} f{k} ON f{k}.{name} = v.{name}" + (f" AND f{k}.b = f0.b" if k else "") for k, (name, sql) in enumerate(factors.items()))
    weight = " * ".join(f"f{k}.times" for k in range(len(factors)))
    return f"SELECT f0.b, sum({weight} * v.value) / sum({weight}) AS m FROM ({value}) v {joins} GROUP BY f0.b"


_PAIRS = "SELECT work, dapt, (work % 97 - 48) / 1000.0::DOUBLE + dapt / 100.0::DOUBLE AS value FROM (SELECT DISTINCT doc_id AS work FROM labels), (SELECT unnest([1, 2, 3]) AS dapt)"
_TRIPLES = "SELECT work, dapt, tune, (work % 97 - 48) / 1000.0::DOUBLE + dapt / 100.0::DOUBLE - tune / 200.0::DOUBLE AS value FROM (SELECT DISTINCT doc_id AS work FROM labels), (SELECT unnest([1, 2, 3]) AS dapt), (SELECT unnest([1, 2, 3, 4, 5]) AS tune)"
_LEVELS = {"dapt": "SELECT unnest([1, 2, 3]) AS dapt", "tune": "SELECT unnest([1, 2, 3, 4, 5]) AS tune", "work": "SELECT DISTINCT doc_id AS work FROM labels"}


@query(f"SELECT round(avg(exp(m) - 1), 6) AS centre, round(quantile_cont(exp(m) - 1, 0.025), 6) AS low, round(quantile_cont(exp(m) - 1, 0.975), 6) AS high FROM ({_crossed_sql({k: _LEVELS[k] for k in ('dapt', 'work')}, _PAIRS, 37, 40)})")
def bootstrap_crossed(spark, sf_dir):
    """Seeds and works drawn for themselves: the interval of the relative change of perplexity."""
    works = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work")).distinct()
    values = works.select("work", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("dapt")).selectExpr("*", "(work % 97 - 48) / 1000.0D + dapt / 100.0D as value")
    out = B.interval(B.crossed(values, ["dapt", "work"], "value", 37, 40).withColumn("estimate", T.perplexity_ratio(F.col("estimate"))))
    return out.select(*(F.round(c, 6).alias(c) for c in ("centre", "low", "high")))


@query(f"SELECT round(avg(m), 6) AS centre, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM ({_crossed_sql({k: _LEVELS[k] for k in ('dapt', 'tune', 'work')}, _TRIPLES, 41, 30)})")
def bootstrap_three_factors(spark, sf_dir):
    """Two kinds of seeds and the works drawn for themselves."""
    works = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work")).distinct()
    grid = works.select("work", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("dapt")).select("*", F.explode(F.array(*map(F.lit, (1, 2, 3, 4, 5)))).alias("tune"))
    values = grid.selectExpr("*", "(work % 97 - 48) / 1000.0D + dapt / 100.0D - tune / 200.0D as value")
    out = B.interval(B.crossed(values, ["dapt", "tune", "work"], "value", 41, 30))
    return out.select(*(F.round(c, 6).alias(c) for c in ("centre", "low", "high")))


_PAGES = "SELECT item_id % 25 AS page, levenshtein(text, replace(text, 'th', 't'))::BIGINT AS edits, length(text)::BIGINT AS chars FROM benchmark"


@query(f"""SELECT round(quantile_cont(m, 0.95), 6) AS cer_upper, quantile_cont(m, 0.95) <= 0.03 AS ok FROM (SELECT b, sum(times * edits) / sum(times * chars) AS m FROM {_draws_sql(f"SELECT page, sum(edits)::BIGINT AS edits, sum(chars)::BIGINT AS chars FROM ({_PAGES}) GROUP BY page", [], "page", "43", 40)} GROUP BY b)""")
def ocr_gate(spark, sf_dir):
    """The upper bound of the character error rate over whole pages, against its gate."""
    units = table(spark, sf_dir, "benchmark").selectExpr("item_id % 25 as page", "cast(levenshtein(text, replace(text, 'th', 't')) as bigint) as edits", "cast(length(text) as bigint) as n")
    out = B.interval(B.ratios(units, "page", "edits", "n", 43, 40), 0.05, 0.95)
    return out.select(F.round("high", 6).alias("cer_upper"), (F.col("high") <= 0.03).alias("ok"))


# ------------------------------------------------------------------ errors, retrieval, profiles

_WORDS = "string_split_regex(trim({}), '[ \\t\\n\\x0B\\f\\r]+')"


@query(f"""WITH w AS (SELECT item_id, {_WORDS.format("text")} AS a, {_WORDS.format("replace(text, ' th', ' t')")} AS b FROM benchmark),
k AS (SELECT *, list_sort(list_distinct(list_concat(a, b))) AS k FROM w),
c AS (SELECT item_id, len(a) AS n, array_to_string(list_transform(a, lambda x: chr((32 + list_position(k, x))::INT)), '') AS a, array_to_string(list_transform(b, lambda x: chr((32 + list_position(k, x))::INT)), '') AS b FROM k)
SELECT item_id, levenshtein(a, b)::BIGINT AS edits, round(levenshtein(a, b) / n::DOUBLE, 6) AS wer FROM c""")
def wer(spark, sf_dir):
    """Edit distance in words over the number of words; the SQL writes every word as one character."""
    b = table(spark, sf_dir, "benchmark").withColumn("seen", F.regexp_replace("text", " th", " t"))
    return b.select("item_id", T.word_edits(F.col("seen"), F.col("text")).alias("edits"), F.size(F.split(F.trim("text"), "\\s+")).alias("n")).select("item_id", "edits", F.round(F.try_divide(F.col("edits").cast("double"), F.col("n")), 6).alias("wer"))


#: Queries that go to the tasks at a time (300 bytes each).
QUERY_BLOCK = 20_000


def retrieval(spark, sf_dir):
    """(q, k): the place of each query's first hit among all other rows by dot product, ties by id; k is null without a hit.

    The query set is the ids divisible by 50.  Queries go to the tasks in blocks; no pair is shuffled: one pass finds the best hit, a second one counts
    what comes before it.
    """
    e = table(spark, sf_dir, "embeddings")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("x"), F.col("label").alias("y"))
    n = queries.count()
    dot = F.round(F.aggregate(F.zip_with("x", "embedding", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v), 9)
    place = F.struct(dot.alias("score"), (-F.col("vec_id")).alias("late"))
    out = []
    blocks = n // QUERY_BLOCK + 1
    for k in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == k)
        best = e.join(F.broadcast(block), (F.col("vec_id") != F.col("q")) & (F.col("label") == F.col("y"))).groupBy("q").agg(F.max(place).alias("best"))
        asked = block.join(best, "q")
        ahead = e.join(F.broadcast(asked), F.col("vec_id") != F.col("q")).groupBy("q").agg((F.count_if(place > F.col("best")) + 1).alias("k"))
        out.append(block.select("q").join(ahead, "q", "left"))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("""WITH s AS (SELECT a.vec_id AS q, b.vec_id AS c, round(list_sum(list_transform(range(1, 65), lambda i: CAST(a.embedding[i] AS DOUBLE) * b.embedding[i])), 9) AS score, a.label = b.label AS hit
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) AS k FROM s), f AS (SELECT q, min(k) FILTER (hit) AS k FROM r GROUP BY q)
SELECT round(avg(coalesce(1.0 / k, 0)), 6) AS mrr, round(avg(CASE WHEN k <= 10 THEN 1.0 ELSE 0.0 END), 6) AS accuracy_10 FROM f""")
def mrr_at_k(spark, sf_dir):
    """Mean reciprocal rank and accuracy at 10 of whole vectors, for a stated query set against all rows."""
    found = retrieval(spark, sf_dir)
    return found.agg(F.round(F.avg(F.coalesce(F.try_divide(F.lit(1.0), F.col("k")), F.lit(0.0))), 6).alias("mrr"), F.round(F.avg(F.when(F.col("k") <= 10, 1.0).otherwise(0.0)), 6).alias("accuracy_10"))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS l FROM embeddings), m AS (SELECT *, list_max(l) AS m FROM e),
s AS (SELECT *, list_transform(l, lambda x: exp(x - m)) AS g FROM m)
SELECT vec_id, CAST(list_position(l, m) AS BIGINT) AS label, round(1.0 / list_sum(g), 6) AS p FROM s""")
def softmax_argmax(spark, sf_dir):
    """The likeliest label of each row of logits, and its probability."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("l"))
    return e.select("vec_id", F.array_position("l", F.array_max("l")).cast("long").alias("label"), F.round(F.array_max(T.softmax(F.col("l"))), 6).alias("p"))


@query("""SELECT event_type, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS k, count(DISTINCT props->>'$.k') AS different, string_agg(DISTINCT json_keys(props)[1], ',') AS keys FROM events GROUP BY event_type""")
def json_extra(spark, sf_dir):
    """Events by the fields of their JSON column."""
    e = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long").alias("p"), F.json_object_keys("props").alias("keys"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("k"), F.count_distinct("p.k").alias("different"), F.array_join(F.array_distinct(F.flatten(F.collect_set("keys"))), ",").alias("keys"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def exact_dedup(spark, sf_dir):
    """The first document of each text: a grouped minimum, combined before the shuffle."""
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min(F.struct("doc_id", "source")).alias("r")).select("r.*")


@query("""SELECT n.doc_id, n.source FROM documents n WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = n.doc_id) AND NOT EXISTS (SELECT 1 FROM documents o JOIN labels l ON l.doc_id = o.doc_id WHERE o.text = n.text)""")
def append_dedup(spark, sf_dir):
    """Documents that are new by id and by text; texts are joined by hash, grouped first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    known = docs.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return docs.join(known.select("doc_id"), "doc_id", "left_anti").join(known.select("h").distinct(), "h", "left_anti").select("doc_id", "source")


_duck8 = "list_transform(generate_series(1, greatest(len(string_split(lower(text), ' ')) - 7, 1)), lambda i: array_to_string(string_split(lower(text), ' ')[i:i + 7], ' '))"
#: Hashes of the benchmark's windows are sent to all tasks up to this many (16 bytes each).
MAX_SENT_GRAMS = 2_000_000


@query(f"SELECT DISTINCT d.doc_id, b.item_id FROM (SELECT doc_id, unnest(s) AS s FROM (SELECT doc_id, {_duck8} AS s FROM documents)) d JOIN (SELECT item_id, unnest(s) AS s FROM (SELECT item_id, {_duck8} AS s FROM benchmark)) b ON b.s = d.s")
def shingle_contamination(spark, sf_dir):
    """Documents that share an 8-word window with an item; windows that no item has go before any shuffle."""

    def grams(name, key):
        words = table(spark, sf_dir, name).select(key, F.split(F.lower("text"), " ").alias("w"))
        at = F.sequence(F.lit(1), F.greatest(F.size("w") - 7, F.lit(1)))
        return words.select(key, F.explode(F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice("w", i, 8), " ")))).alias("s"))

    items = grams("benchmark", "item_id").distinct()
    if items.count() <= MAX_SENT_GRAMS:
        items = F.broadcast(items)
    return grams("documents", "doc_id").join(items, "s").select("doc_id", "item_id").distinct()


@query("""SELECT lang, count(*) AS works, round(quantile_cont(n_chars, 0.5), 6) AS median_chars, round(quantile_cont(n_chars, 0.95), 6) AS p95_chars, round(1 - count(DISTINCT sha256(text)) / count(*)::DOUBLE, 6) AS duplicate_share,
    round(avg(CASE WHEN regexp_matches(text, '[=<>|]') THEN 1.0 ELSE 0.0 END), 6) AS formula_share, round(avg(len(regexp_extract_all(coalesce(text, ''), '[^\\p{L}\\p{N}\\p{P}\\p{Z}\\s]')) / greatest(length(coalesce(text, '')), 1)::DOUBLE), 6) AS noise FROM documents GROUP BY lang""")
def eda_profile(spark, sf_dir):
    """Lengths, duplicates, formulas and odd characters by language."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    odd = F.regexp_count(text, F.lit("[^\\p{L}\\p{N}\\p{P}\\p{Z}\\s]")) / F.greatest(F.length(text), F.lit(1)).cast("double")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("works"),
        F.round(F.percentile("n_chars", 0.5), 6).alias("median_chars"),
        F.round(F.percentile("n_chars", 0.95), 6).alias("p95_chars"),
        F.round(1 - F.count_distinct(F.sha2("text", 256)) / F.count(F.lit(1)).cast("double"), 6).alias("duplicate_share"),
        F.round(F.avg(F.when(F.col("text").rlike("[=<>|]"), 1.0).otherwise(0.0)), 6).alias("formula_share"),
        F.round(F.avg(odd), 6).alias("noise"),
    )


# ------------------------------------------------------------------ agreement


def _rounded(rows, *names):
    return rows.select(*(F.round(n, 6).alias(n) for n in names))


def _answers(spark, sf_dir):
    return A.cells(table(spark, sf_dir, "labels"), "quality", "toxic", (0, 1))


@operated("confusion")
def confusion(spark, sf_dir):
    """All cells of two labels, empty ones, too."""
    return _answers(spark, sf_dir).select(F.col("a").alias("quality"), F.col("b").alias("toxic"), "n")


@operated("cohen_kappa")
def cohen_kappa(spark, sf_dir):
    """Agreement of two labels beyond chance."""
    return _rounded(A.kappa(_answers(spark, sf_dir)), "observed", "expected", "kappa")


@operated("weighted_kappa")
def weighted_kappa(spark, sf_dir):
    """The same with weights: how many documents of its language a labelled one stands for."""
    docs = table(spark, sf_dir, "documents")
    sizes = docs.groupBy("lang").agg((F.count(F.lit(1)).cast("double") / 20).alias("w"))
    rows = table(spark, sf_dir, "labels").join(docs.select("doc_id", "lang"), "doc_id").join(F.broadcast(sizes), "lang")
    return _rounded(A.kappa(A.cells(rows, "quality", "toxic", None, F.col("w"))), "observed", "expected", "kappa")


@operated("macro_f1")
def macro_f1(spark, sf_dir):
    """F1 over classes: unweighted, weighted, over all rows; and balanced accuracy."""
    return _rounded(A.f1_summary(A.class_scores(_answers(spark, sf_dir))), "macro_f1", "micro_f1", "weighted_f1", "balanced_accuracy")


def _flags(spark, sf_dir):
    return A.association(A.cells(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"), "l_returnflag", "l_linestatus"))


@operated("cramers_v")
def cramers_v(spark, sf_dir):
    """Association of two columns."""
    return _flags(spark, sf_dir).select(F.round("cramers_v", 6).alias("v"))


@operated("mutual_information")
def mutual_information(spark, sf_dir):
    """Information that two columns share, in nats."""
    return _flags(spark, sf_dir).select(F.round("mutual_information", 6).alias("nats"))


@query("""WITH d AS (SELECT *, doc_id % 40 AS s FROM documents), p AS (SELECT 'C1' AS a, CASE s WHEN 11 THEN 'C2' WHEN 30 THEN 'C3' ELSE 'C1' END AS b FROM d WHERE s NOT IN (9, 10)),
m AS (SELECT count(*)::DOUBLE AS t, count(*) FILTER (a = b)::DOUBLE AS same FROM p), f AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (s IN (11, 30))::DOUBLE AS bad FROM d WHERE s NOT IN (9, 10)),
l AS (SELECT string_agg(lang || '=' || n, ',' ORDER BY lang) AS x FROM (SELECT lang, count(DISTINCT source) AS n FROM documents GROUP BY lang))
SELECT 'a1' AS audit_id, m.t::BIGINT AS double_annotated_n, (SELECT count(*) FROM d WHERE s IN (12, 30)) AS adjudicated_n, round(same / t, 6) AS observed_agreement, CASE WHEN same < t THEN 0.0::DOUBLE END AS cohen_kappa,
    (SELECT count(*) FROM d WHERE s = 11) AS unresolved_n, round((SELECT avg(CASE WHEN n_chars >= 200 THEN 1.0 ELSE 0.0 END) FROM d), 6) AS title_abstract_rate, l.x AS distinct_sources, (SELECT count(DISTINCT lang || source) FROM d) AS cells FROM m, l""")
def audit_report(spark, sf_dir):
    """One row of figures, put together from the operators for answers, agreement, consensus and coverage."""
    docs = table(spark, sf_dir, "documents")
    labels = labels_of(docs)
    pairs = A.paired_answers(labels.where("record_type = 'annotation'"))
    agreed = _rounded(A.kappa(A.cells(pairs, "first", "second", A.OUTCOMES)), "observed", "kappa").withColumnsRenamed({"observed": "observed_agreement", "kappa": "cohen_kappa"})
    sources = docs.groupBy("lang").agg(F.count_distinct("source").alias("n"))
    return A.one_row(
        docs.agg(F.lit("a1").alias("audit_id"), F.round(F.avg(F.when(F.col("n_chars") >= 200, 1.0).otherwise(0.0)), 6).alias("title_abstract_rate"), F.count_distinct(F.concat("lang", "source")).alias("cells")),
        pairs.agg(F.count(F.lit(1)).alias("double_annotated_n")),
        labels.agg(F.count_if(F.col("record_type") == "annotation_adjudication").alias("adjudicated_n")),
        R.consensus(labels).agg(F.count_if(F.col("decision").isNull()).alias("unresolved_n")),
        agreed,
        A.as_map(sources, "lang", "n", "m").select(F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("distinct_sources")),
    )


_FLAGGED = "n_chars >= 200 AS with_text, doc_id % 2 = 0 AS any_code, doc_id % 4 = 0 AS explicit_primary, doc_id % 8 = 0 AS one_class, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id % 5 = 0 END AS cleared"


@query(f"""SELECT lang, source, class, (grouping(lang) + grouping(source) + grouping(class))::BIGINT AS level, count(*) AS found, count(DISTINCT work) AS works, {", ".join(f"count(*) FILTER ({f}) AS {f}" for f in P.FLAGS)}
    FROM (SELECT lang, source, 'C' || (doc_id % 5) AS class, sha256(text) AS work, {_FLAGGED} FROM documents) GROUP BY ROLLUP (lang, source, class)""")
def candidate_counts(spark, sf_dir):
    """The counts of a candidate frame by query, journal and class, with their sums."""
    frame = table(spark, sf_dir, "documents").selectExpr("lang", "source", "concat('C', doc_id % 5) as class", "sha2(text, 256) as work_id", *(x.strip() for x in _FLAGGED.split(", ")))
    return P.candidates(frame, "lang", "source", "class")


@query("SELECT lang, n, round(share, 6) AS share, CASE WHEN share > 0.4 THEN 'above' WHEN share < 0.1 THEN 'below' ELSE 'ok' END AS verdict FROM (SELECT lang, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM documents GROUP BY lang)")
def quota_violations(spark, sf_dir):
    """Shares of groups against their least and greatest."""
    return P.quotas(table(spark, sf_dir, "documents"), "lang", 0.1, 0.4, 4).withColumn("share", F.round("share", 6))


@query("""SELECT 'C' || (doc_id % 5) AS class, source, count(*) AS n, CASE WHEN count(DISTINCT source) OVER (PARTITION BY doc_id % 5) < 2 THEN 'too few' WHEN count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY doc_id % 5) > 0.1 THEN 'above' ELSE 'ok' END AS verdict FROM documents GROUP BY doc_id % 5, source""")
def source_quotas(spark, sf_dir):
    """Shares of sources within each class."""
    rows = table(spark, sf_dir, "documents").selectExpr("concat('C', doc_id % 5) as class", "source")
    return P.quotas(rows, "source", None, 0.1, 2, ("class",)).select("class", "source", "n", "verdict")


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS known, count(*) - count({c}) AS missing FROM documents" for c in ("doc_id", "text", "lang", "source", "n_chars")))
def frame_profile(spark, sf_dir):
    """Known and missing values of every column."""
    return P.columns(table(spark, sf_dir, "documents")).select("name", "known", "missing")


# ------------------------------------------------------------------ pairs


@operated("span_match")
def span_match(spark, sf_dir):
    """Spans of two annotations that match one to one."""
    rows = table(spark, sf_dir, "lineitem")
    found = rows.selectExpr("l_orderkey as doc", "l_linenumber as i", "cast(l_quantity as double) as start", "cast(l_quantity as double) + 10 as end")
    gold = rows.selectExpr("l_orderkey as doc", "l_linenumber as j", "cast(10 * l_linenumber as double) as start", "cast(10 * l_linenumber as double) + 10 as end")
    return X.match_spans(found, gold).select("doc", F.col("i").cast("long").alias("i"), "start", F.col("j").cast("long").alias("j"), F.round("iou", 6).alias("iou"))


@operated("matched_pairs")
def matched_pairs(spark, sf_dir):
    """Marked documents with controls of the same language, source and size."""
    rows = table(spark, sf_dir, "labels").select("doc_id", "toxic").join(table(spark, sf_dir, "documents").selectExpr("doc_id", "lang", "source", "cast(floor(n_chars / 500.0D) as bigint) as size"), "doc_id")
    return X.matched(rows, F.col("toxic") == 1, ["lang", "source", "size"], "doc_id")


@operated("leave_one_source_out")
def leave_one_source_out(spark, sf_dir):
    """Every language that is large enough, left out in turn; sources stand in for classes."""
    return X.leave_out(table(spark, sf_dir, "documents"), "lang", "source")


@operated("mask_sets")
def mask_sets(spark, sf_dir):
    """Five sets of masked words of every item."""
    words = F.split("text", " ", -1)
    return X.masks(table(spark, sf_dir, "benchmark"), "item_id", words)


@operated("discovery_paths")
def discovery_paths(spark, sf_dir):
    """The sources in which each text was found."""
    return X.discovery(table(spark, sf_dir, "documents"), F.sha2("text", 256), "source")
