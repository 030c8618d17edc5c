"""Queries that run the checks and relations across registries, on registries derived from the supplied tables.

Every document is a work; what is wrong with it follows from doc_id modulo 40, so that
the SQL can name the offenders without repeating a check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import checks as C
from ..operators import resolve as R
from .queries import operated, query, table

#: Offenders of each check: the remainder of doc_id, and the key.
SEEDED = (
    ("V1", 1, "concat('f', doc_id)"), ("V2", 2, "concat('w', doc_id)"), ("V3", 3, "concat('w', doc_id)"), ("V5", 4, "concat('item-10.1/', doc_id)"), ("V10", 5, "concat('w', doc_id)"), ("V11", 6, "concat('z', doc_id)"),
    ("V11", 7, "concat('z', doc_id)"), ("V12", 8, "concat('i', doc_id)"), ("V13", 9, "concat('i', doc_id)"), ("V13", 10, "concat('i', doc_id)"), ("V14", 9, "concat('i', doc_id)"), ("V14", 10, "concat('i', doc_id)"), ("V14", 11, "concat('i', doc_id)"), ("V14", 12, "concat('i', doc_id)"),
    ("V9", 13, "concat('w', doc_id)"), ("V20", 14, "concat('w', doc_id)"), ("V19", 15, "concat('l', doc_id, '-1')"), ("J9", 16, "concat('w', doc_id)"), ("V16", 17, "concat('p', doc_id)"), ("V17", 18, "concat('p', doc_id)"), ("V17", 19, "concat('p', doc_id)"), ("V18", 20, "concat('p', doc_id)"),
    ("V7", 21, "concat('q', doc_id)"), ("V7", 22, "concat('q', doc_id)"), ("V7", 23, "concat('q', doc_id)"), ("V6", 24, "concat('a', doc_id)"), ("V3b", 25, "concat('w', doc_id)"), ("J18", 26, "concat('f', doc_id)"), ("V4", 27, "concat('w', doc_id)"), ("V4", 27, "concat('w', doc_id, '-2')"), ("D8", 28, "concat('w', doc_id)"),
)


def frame_of(docs):
    """Frame rows: one per document, two where the same work comes twice."""
    twice = docs.select("doc_id", "lang", F.expr("doc_id % 40").alias("s"), F.explode(F.expr("sequence(1, if(doc_id % 40 in (1, 2, 3, 5), 2, 1))")).alias("copy"))
    return twice.selectExpr(
        "doc_id", "s", "copy",
        "if(s = 1 or copy = 1, concat('f', doc_id), concat('f', doc_id, '-2')) as frame_record_id",
        "if(s = 1 and copy = 2, concat('w', doc_id, '-2'), concat('w', doc_id)) as work_id",
        "if(s in (3, 5) and copy = 2, 'a2', 'a1') as audit_id", "'c' as candidate_frame_id", "'v1' as audit_frame_version",
        "if(s = 3 and copy = 2, 'other', concat('z', doc_id)) as stratum_id",
        "if(s = 4, concat('item-10.1/', doc_id), concat('i', doc_id)) as annotation_item_id", "concat('10.1/', doc_id) as doi",
        "if(s = 5 and copy = 2, 'calibration', 'audit') as selection_role", "true as selected",
        "if(s = 3, null, cast(if(s in (1, 2, 5), 2, 1) + if(s = 6, 1, 0) as bigint)) as stratum_population_size", "if(s = 7, 0.5D, 1.0D) as inclusion_probability",
        "array(named_struct('query_id', concat('q', doc_id), 'query_version', if(s = 26, '2', '1'))) as query_refs",
    )


def labels_of(docs, changed=False):
    """Answers, rulings, assignments and conflict packages of every document."""
    rows = docs.select("doc_id", F.expr("doc_id % 40").alias("s"))
    answers = rows.select("*", F.explode(F.expr("sequence(1, case when s = 9 then 1 when s = 10 then 3 else 2 end)")).alias("n")).selectExpr(
        "concat('l', doc_id, '-', n) as label_record_id", "'annotation' as record_type", "concat('i', doc_id) as annotation_item_id", "concat('w', doc_id) as work_id",
        f"case when s = 11 and n = 2 then 'C2' when s = 30 and n = 2 then 'C3' when s = 15 and {str(changed).lower()} and n = 1 then 'C1' else 'C1' end as annotator_decision",
        f"if(s = 15 and n = 1 and {str(changed).lower()}, 'changed', 'why') as decision_rationale", "cast(null as string) as adjudicated_decision", "if(s = 8 and n = 2, 'h2', 'h1') as input_sha256",
        "cast(null as string) as code", "cast(null as string) as origin", "cast(null as array<string>) as source_label_record_ids", "cast(null as string) as grnti_conflict_outcome", "cast(null as string) as h2_class_id",
    )
    blank = {"annotation_item_id": "string", "annotator_decision": "string", "decision_rationale": "string", "adjudicated_decision": "string", "input_sha256": "string", "code": "string", "origin": "string", "source_label_record_ids": "array<string>", "grnti_conflict_outcome": "string", "h2_class_id": "string"}

    def more(which, **cols):
        return which.selectExpr(*(f"{cols[c]} as {c}" if c in cols else f"cast(null as {t}) as {c}" for c, t in ({"label_record_id": "string", "record_type": "string", "work_id": "string"} | blank).items()))

    work = "concat('w', doc_id)"
    rulings = more(rows.where("s in (12, 30)"), label_record_id="concat('j', doc_id)", record_type="'annotation_adjudication'", work_id=work, annotation_item_id="concat('i', doc_id)", adjudicated_decision="'C3'")
    codes = [more(rows, label_record_id=f"concat('g', doc_id, '-{n}')", record_type="'grnti_assignment'", work_id=work, code=code, origin=f"if(s = 18, 's', 's{n}')") for n, code in ((1, "'29.05.01'"), (2, "if(s = 20, '29.05.02', '29.15.02')"))]
    ids = "case when s = 17 then array(concat('l', doc_id, '-1'), concat('g', doc_id, '-1'), concat('g', doc_id, '-2')) when s = 19 then array(concat('l', doc_id, '-1'), concat('l', doc_id, '-2'), concat('g', doc_id, '-1'), concat('g', doc_id, '-2'), 'nothing') else array(concat('l', doc_id, '-1'), concat('l', doc_id, '-2'), concat('g', doc_id, '-1'), concat('g', doc_id, '-2')) end"
    package = more(rows.where("s in (17, 18, 19, 20, 31)"), label_record_id="concat('p', doc_id)", record_type="'grnti_conflict_resolution'", work_id=work, source_label_record_ids=ids, grnti_conflict_outcome="'catalog_confirmed'", h2_class_id="'C2'")
    out = reduce(lambda a, b: a.unionByName(b), (answers, rulings, *codes, package))
    return out.withColumn("grnti_assignment", F.when(F.col("code").isNotNull(), F.struct("code", F.col("origin").alias("assignment_source_id"))))


_OFFENDERS = " UNION ALL ".join(f"SELECT '{c}' AS check_id, {k.replace('concat(', 'concat(')} AS offender FROM documents WHERE doc_id % 40 = {s}" for c, s, k in SEEDED)


@query(_OFFENDERS)
def registry_checks(spark, sf_dir):
    """The offenders of all checks across registries."""
    docs = table(spark, sf_dir, "documents")
    s = F.expr("doc_id % 40")
    frame, labels = frame_of(docs), labels_of(docs)
    answers = labels.where("record_type = 'annotation'")
    items = docs.select(F.concat(F.lit("i"), "doc_id").alias("annotation_item_id"))
    works = docs.selectExpr("explode(if(doc_id % 40 = 27, array(concat('w', doc_id), concat('w', doc_id, '-2')), array(concat('w', doc_id)))) as work_id", "concat('10.1/', doc_id) as doi", "cast(array() as array<string>) as work_aliases", "cast(null as string) as duplicate_of_work_id")
    stored = docs.selectExpr("concat('w', doc_id) as work_id", "if(doc_id % 40 = 13, 'other', 'h') as input_sha256", "if(doc_id % 40 = 16, 'nothing', concat('w', doc_id)) as parent_id")
    forms = docs.selectExpr("concat('w', doc_id) as work_id", "'h' as input_sha256")
    splits = docs.selectExpr("concat('w', doc_id) as work_id", "explode(if(doc_id % 40 in (14, 28), array('classification/test', 'mlm/train'), array('classification/train', 'mlm/train'))) as s").selectExpr("work_id", "split(s, '/')[0] as task", "split(s, '/')[1] as split")
    viewed = frame.where("s = 14").select("work_id")
    queries = docs.selectExpr(
        "concat('q', doc_id) as query_id", "'1' as query_version", "source as source_id", "'api' as query_type", "cast(if(doc_id % 40 = 23, 9, 1) as bigint) as result_count",
        "concat('r', if(doc_id % 40 = 21, 'x', ''), doc_id) as rights_record_id",
    )
    for_queries = docs.selectExpr(
        "concat('r', doc_id) as rights_record_id", "'acquisition' as operation", "'allowed' as status", "'source' as scope_type", "source as scope_id", "if(doc_id % 40 = 22, 'crawler', 'api') as acquisition_method", "'single' as acquisition_scope",
    )
    artifacts = docs.selectExpr("concat('a', doc_id) as artifact")
    effective = docs.select(F.concat(F.lit("a"), "doc_id").alias("artifact"), F.explode(F.expr("array('acquisition', 'storage', 'evaluation')")).alias("operation"), s.alias("s")).selectExpr("artifact", "operation", "if(s = 24 and operation = 'storage', 'prohibited', 'conditional') as status")
    hits = docs.selectExpr("concat('w', doc_id) as work_id", "explode(if(doc_id % 40 = 25, array(concat('q', doc_id), 'elsewhere'), array(concat('q', doc_id)))) as query_id", "if(doc_id % 40 = 26, '2', '1') as query_version")
    # a package without one consensus breaks V16, one without two sources or with a missing id V17
    broken = C.broken_conflicts(labels)
    of = {
        "V1": C.duplicated(frame, "frame_record_id"),
        "V2": C.duplicated(frame, "audit_id", "candidate_frame_id", "audit_frame_version", "work_id").select("work_id"),
        "V3": C.several_values(frame.where("s <> 5"), "work_id", "stratum_id"),
        "V3b": C.unlisted_paths(frame, hits).select("work_id"),
        "V4": C.several_versions(works),
        "V5": C.telling_ids(frame, "annotation_item_id", "doi"),
        "V6": C.without_right(artifacts, effective, "acquisition", "storage", "evaluation").select("artifact"),
        "V7": C.unfit_query_rights(queries, for_queries).select("query_id"),
        "V9": C.differing(stored, forms, "work_id", "input_sha256"),
        "V10": C.shared(frame.where("selection_role = 'audit'"), frame.where("selection_role = 'calibration'"), "work_id"),
        "V11": C.wrong_probability(frame.where("s <> 3"), "stratum_id"),
        "V12": C.several_values(answers, "annotation_item_id", "input_sha256"),
        "V13": C.wrong_count(items, answers, "annotation_item_id").select("annotation_item_id"),
        "V14": R.consensus(labels).where("invalid").select("annotation_item_id"),
        "V16": broken.where("cast(substr(package, 2) as bigint) % 40 = 17"),
        "V17": broken.where("cast(substr(package, 2) as bigint) % 40 <> 17"),
        "V18": C.wrong_confirmed_class(labels),
        "V19": C.overwritten(answers.select("label_record_id", "annotator_decision", "decision_rationale"), labels_of(docs, changed=True).select("label_record_id", "annotator_decision", "decision_rationale"), "label_record_id"),
        "V20": viewed.join(splits.where("split <> 'train'"), "work_id", "left_semi"),
        "D8": R.split_violations(splits).where("cast(substr(work_id, 2) as bigint) % 40 = 28").select("work_id"),
        "J9": R.missing(stored, "parent_id", forms, "work_id").select("work_id"),
        "J18": C.unknown_queries(frame, queries).select("frame_record_id"),
    }
    return reduce(lambda a, b: a.unionByName(b), (df.select(F.lit(name).alias("check_id"), F.col(df.columns[0]).alias("offender")) for name, df in of.items()))


@query("""SELECT 'i' || doc_id AS item, CASE WHEN doc_id % 40 = 11 THEN NULL WHEN doc_id % 40 = 30 THEN 'C3' ELSE 'C1' END AS decision, doc_id % 40 IN (11, 30) AS disagreement, doc_id % 40 IN (9, 10, 11, 12) AS invalid FROM documents""")
def consensus_label(spark, sf_dir):
    """Equal answers of two annotators, or else the one ruling."""
    out = R.consensus(labels_of(table(spark, sf_dir, "documents")))
    return out.select(F.col("annotation_item_id").alias("item"), "decision", "disagreement", "invalid")


@query("""SELECT truth, count(*) AS works, count(*) FILTER (decision IS DISTINCT FROM truth) AS conflicts, round(count(*) FILTER (decision IS DISTINCT FROM truth) / count(*)::DOUBLE, 6) AS rate FROM (
    SELECT CASE WHEN doc_id % 40 = 11 THEN NULL WHEN doc_id % 40 = 30 THEN 'C3' ELSE 'C1' END AS decision, 'C' || (1 + doc_id % 2) AS truth FROM documents WHERE doc_id % 3 <> 0) GROUP BY truth""")
def conflict_rate(spark, sf_dir):
    """Consensus against the verified class: every other decision, and none, is a conflict."""
    docs = table(spark, sf_dir, "documents")
    decisions = R.consensus(labels_of(docs)).withColumn("work_id", F.regexp_replace("annotation_item_id", "^i", "w"))
    codes = docs.selectExpr("concat('w', doc_id) as work_id", "concat('C', 1 + doc_id % 2) as h2_class_id", "if(doc_id % 3 = 0, 'pending', 'verified') as label_verification_status", "true as is_primary_explicit")
    return R.conflicts(decisions, codes).groupBy("truth").agg(F.count(F.lit(1)).alias("works"), F.count_if("conflict").alias("conflicts"), F.round(F.avg(F.col("conflict").cast("double")), 6).alias("rate"))


_RIGHTS_SQL = """CASE WHEN doc_id % 5 = 0 AND doc_id % 10 <> 0 THEN 'artifact' WHEN doc_id % 3 = 0 THEN 'work' WHEN substr(source, 4)::INT % 2 = 0 THEN 'journal' WHEN lang IN ('en', 'fr') THEN 'source' ELSE 'source_group' END"""


def rights_of(docs):
    """Rights of every width: all groups, some languages, journals, works and artifacts; some expired, some superseded."""
    rows = [
        docs.selectExpr("'source_group' as scope_type", "'g' as scope_id", "'allowed' as status", "'g' as id").distinct(),
        docs.where("lang in ('en', 'fr')").selectExpr("'source' as scope_type", "lang as scope_id", "'conditional' as status", "concat('s-', lang) as id").distinct(),
        docs.where("cast(substr(source, 4) as int) % 2 = 0").selectExpr("'journal' as scope_type", "source as scope_id", "explode(array('allowed', 'permission_required')) as status").selectExpr("*", "concat('j-', scope_id, '-', status) as id").distinct(),
        docs.where("doc_id % 3 = 0").selectExpr("'work' as scope_type", "concat('w', doc_id) as scope_id", "'prohibited' as status", "concat('w-', doc_id) as id"),
        docs.where("doc_id % 5 = 0").selectExpr("'artifact' as scope_type", "concat('a', doc_id) as scope_id", "'allowed' as status", "concat('a-', doc_id) as id"),
        docs.where("doc_id % 7 = 0").selectExpr("'artifact' as scope_type", "concat('a', doc_id) as scope_id", "'prohibited' as status", "concat('old-', doc_id) as id"),
    ]
    out = reduce(lambda a, b: a.unionByName(b), rows)
    replaced = docs.where("doc_id % 7 = 0").selectExpr("'work' as scope_type", "'nowhere' as scope_id", "'allowed' as status", "concat('new-', doc_id) as id")
    out = out.withColumn("supersedes_rights_record_id", F.lit(None).cast("string")).unionByName(replaced.withColumn("supersedes_rights_record_id", F.regexp_replace("id", "^new", "old")))
    expires = F.when((F.col("scope_type") == "artifact") & F.col("id").startswith("a-") & (F.regexp_extract("id", "([0-9]+)$", 1).try_cast("long") % 10 == 0), "2020-01-01")
    return out.select(F.col("id").alias("rights_record_id"), "scope_type", "scope_id", F.lit("ml_training").alias("operation"), "status", F.lit("2024-01-01").alias("created_at"), expires.alias("rights_expires_at"), "supersedes_rights_record_id")


def scopes_of(docs):
    return docs.selectExpr("concat('a', doc_id) as artifact", "'g' as source_group", "lang as source", "source as journal", "concat('w', doc_id) as work")


@query(f"""SELECT 'a' || doc_id AS artifact, scope_type, CASE scope_type WHEN 'artifact' THEN 'allowed' WHEN 'work' THEN 'prohibited' WHEN 'journal' THEN 'permission_required' WHEN 'source' THEN 'conditional' ELSE 'allowed' END AS status
    FROM (SELECT *, {_RIGHTS_SQL} AS scope_type FROM documents)""")
def rights_resolve(spark, sf_dir):
    """The right that holds for each artifact: the narrowest scope, a restriction first, neither expired nor superseded."""
    docs = table(spark, sf_dir, "documents")
    return R.effective_rights(scopes_of(docs), rights_of(docs), "2024-06-01").select("artifact", "scope_type", "status")


@query(f"""SELECT 'a' || doc_id AS artifact FROM (SELECT *, {_RIGHTS_SQL} AS scope_type FROM documents) WHERE scope_type IN ('artifact', 'source_group') OR (scope_type = 'source' AND lang = 'en')""")
def training_admission(spark, sf_dir):
    """Artifacts that may be trained on: allowed, or conditional with the conditions fulfilled (here those of one language)."""
    docs = table(spark, sf_dir, "documents")
    fulfilled = spark.createDataFrame([("s-en",)], "rights_record_id string")
    return R.admitted(R.effective_rights(scopes_of(docs), rights_of(docs), "2024-06-01"), fulfilled)


@query("""SELECT 'a' || doc_id AS artifact, r AS rights_record_id, CASE r WHEN 'x' THEN 'storage' WHEN 'y' THEN 'evaluation' END AS operation FROM (SELECT doc_id, unnest(CASE WHEN doc_id % 2 = 0 THEN ['x', 'y'] ELSE ['x', 'z'] END) AS r FROM documents)""")
def linked_rights(spark, sf_dir):
    """Artifacts joined with rights through their id list; an id without a row stays visible."""
    artifacts = table(spark, sf_dir, "documents").selectExpr("concat('a', doc_id) as artifact", "if(doc_id % 2 = 0, array('x', 'y', 'x'), array('x', 'z')) as rights_record_ids")
    rights = spark.createDataFrame([("x", "storage", "allowed"), ("y", "evaluation", "allowed")], "rights_record_id string, operation string, status string")
    return R.linked_rights(artifacts, rights).select("artifact", "rights_record_id", "operation")


@query("""SELECT 'f' || doc_id || CASE WHEN c = 2 THEN '-2' ELSE '' END AS frame_record_id, 'l' || doc_id || '-' || n AS label_record_id FROM (SELECT doc_id, unnest(CASE WHEN doc_id % 40 = 2 THEN [1, 2] ELSE [1] END) AS c FROM documents WHERE doc_id % 40 <> 4), (SELECT unnest([1, 2, 3]) AS n)
    WHERE n <= CASE doc_id % 40 WHEN 9 THEN 1 WHEN 10 THEN 3 ELSE 2 END""")
def labelled_frame(spark, sf_dir):
    """Frame rows with their answers by the five columns they share."""
    docs = table(spark, sf_dir, "documents")
    answers = labels_of(docs).where("record_type = 'annotation'").selectExpr("label_record_id", "annotation_item_id", "work_id", "'a1' as audit_id", "'c' as candidate_frame_id", "'v1' as audit_frame_version")
    return R.labelled_frame(frame_of(docs), answers).select("frame_record_id", "label_record_id")


@query("""SELECT 'w' || doc_id AS work_id, CASE WHEN doc_id % 10 IN (2, 3, 4) THEN min('w' || doc_id) FILTER (doc_id % 10 IN (2, 3, 4)) OVER (PARTITION BY doc_id // 10) ELSE 'w' || doc_id END AS canonical FROM documents""")
def canonical_works(spark, sf_dir):
    """Works that share aliases, directly or over others, are one."""
    works = table(spark, sf_dir, "documents").selectExpr("concat('w', doc_id) as work_id", "case when doc_id % 10 in (2, 3) then array(concat('alias', doc_id div 10)) else array() end as work_aliases", "if(doc_id % 10 = 4, concat('w', doc_id - 1), null) as duplicate_of_work_id")
    return R.canonical_works(works)


@query("""SELECT lang AS scope_id, 'conditional' AS acquisition, CASE WHEN lang = 'de' THEN 'permission_required' ELSE 'allowed' END AS storage, CASE WHEN lang = 'de' THEN NULL ELSE 'unknown' END AS redistribution FROM documents GROUP BY lang""")
def rights_matrix(spark, sf_dir):
    """Status of each operation by source; of several rows the strictest."""
    langs = table(spark, sf_dir, "documents").select("lang").distinct()
    rows = langs.selectExpr("lang as scope_id", "explode(array('acquisition/allowed', 'acquisition/conditional', if(lang = 'de', 'storage/permission_required', 'storage/allowed'), 'storage/allowed', if(lang = 'de', 'evaluation/allowed', 'redistribution/unknown'))) as r")
    return C.rights_matrix(rows.selectExpr("scope_id", "split(r, '/')[0] as operation", "split(r, '/')[1] as status")).select("scope_id", "acquisition", "storage", "redistribution")


@query("""WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source) SELECT count(*) FILTER (ok) AS usable_groups, coalesce(sum(n) FILTER (ok), 0)::BIGINT AS usable_works, count(*) FILTER (ok) >= 4 AND coalesce(sum(n) FILTER (ok), 0) >= 2000 AS admitted
    FROM (SELECT n, substr(source, 4)::INT % 3 <> 0 AS ok FROM n)""")
def source_admission(spark, sf_dir):
    """Whether enough groups and works may be used for all four operations."""
    docs = table(spark, sf_dir, "documents")
    sizes = docs.groupBy(F.col("source").alias("scope_id")).agg(F.count(F.lit(1)).alias("works"))
    rows = sizes.selectExpr("scope_id", "explode(array('acquisition', 'storage', 'evaluation', 'ml_training')) as operation").selectExpr("*", "if(cast(substr(scope_id, 4) as int) % 3 = 0 and operation = 'storage', 'prohibited', 'conditional') as status")
    return C.source_admission(C.rights_matrix(rows), sizes)



@query("""SELECT doc_id, CASE WHEN doc_id % 10 < 5 THEN 'reject' WHEN doc_id % 3 = 0 OR doc_id % 7 = 0 THEN 'revise' ELSE 'pass' END AS decision FROM documents""")
def final_gate(spark, sf_dir):
    """The nine criteria of admission, on figures that follow from doc_id."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "0.75D + doc_id % 10 / 100.0D as kappa")
    metrics = docs.selectExpr("doc_id", "kappa", "kappa - 0.04 as kappa_low", "kappa + 0.04 as kappa_high", "0.95 as expert_f1", "0.9 as expert_f1_low", "0.1 as conflict_high", "300 as least_class_works", "2 as least_class_sources", "0 as unverified", "0 as unresolved", "doc_id % 3 <> 0 as connected", "2 as least_degree", "0.4 as source_f1", "if(doc_id % 7 = 0, 0.6, 0.5) as source_f1_high")
    return C.final_gate(metrics).select("doc_id", "decision")


@query("""SELECT 'w' || doc_id AS work, CASE doc_id % 6 WHEN 1 THEN 'eligible' WHEN 2 THEN 'quarantined' ELSE 'rejected' END AS before, CASE doc_id % 6 WHEN 2 THEN 'eligible' ELSE 'pending' END AS after FROM documents WHERE doc_id % 6 IN (1, 2, 3)""")
def status_transitions(spark, sf_dir):
    """Changes of eligibility that aren't allowed, from the history of every work."""
    docs = table(spark, sf_dir, "documents")
    paths = "case doc_id % 6 when 0 then array('pending', 'eligible') when 1 then array('pending', 'eligible', 'pending') when 2 then array('pending', 'quarantined', 'eligible') when 3 then array('rejected', 'pending', 'eligible') else array('pending', 'pending', 'rejected') end"
    history = docs.selectExpr("concat('w', doc_id) as work", f"posexplode({paths}) as (at, eligibility_status)")
    return C.broken_transitions(history, "work", "eligibility_status", "at").select("work", "before", "after")


@query("""SELECT 'item' || doc_id AS annotation_item_id, sha256(nfc_normalize(lang || ' ' || source) || chr(10) || chr(10) || CASE WHEN doc_id % 4 = 0 THEN '' ELSE nfc_normalize(coalesce(text, '')) END || chr(10)) AS input_sha256 FROM documents""")
def blinded_forms(spark, sf_dir):
    """Blinded rows with the hash of what the model reads: title and abstract in NFC; nothing that tells the source is shown."""
    docs = table(spark, sf_dir, "documents")
    works = docs.selectExpr("concat('w', doc_id) as work_id", "concat(lang, ' ', source) as title", "if(doc_id % 4 = 0, null, coalesce(text, '')) as abstract", "source as journal_title")
    ids = docs.selectExpr("concat('w', doc_id) as work_id", "concat('item', doc_id) as annotation_item_id")
    forms = R.blinded(works, ids)
    return forms.select("annotation_item_id", T.h2_input_sha256(F.col("blinded_title"), F.col("blinded_abstract")).alias("input_sha256"))


@operated("referential_integrity")
def referential_integrity(spark, sf_dir):
    """Rows whose key isn't there, by relation."""
    of = lambda name: table(spark, sf_dir, name)
    relations = (("labels.doc_id", "labels", "doc_id", "documents", "doc_id"), ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"), ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"))
    each = [R.missing(of(child).select(key), key, of(parent), parent_key).agg(F.lit(name).alias("relation"), F.count(F.lit(1)).alias("violations")) for name, child, key, parent, parent_key in relations]
    return reduce(lambda a, b: a.unionByName(b), each)


@operated("duplicate_keys")
def duplicate_keys(spark, sf_dir):
    """Keys that occur more than once, by table."""
    each = [C.duplicated(table(spark, sf_dir, name).select(*keys), *keys).agg(F.lit(name).alias("registry"), F.count(F.lit(1)).alias("violations")) for name, keys in (("documents", ["doc_id"]), ("pages", ["page_id"]), ("lineitem", ["l_orderkey", "l_linenumber"]))]
    return reduce(lambda a, b: a.unionByName(b), each)


@operated("issue_caps")
def issue_caps(spark, sf_dir):
    """Five articles of each issue, sixty in all, in the order of the crawl; sources stand in for issues."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("issue_path"), F.lpad(F.col("doc_id").cast("string"), 19, "0").alias("path"), "text", "doc_id")
    chosen = R.capped(docs, 5, 60)
    place = F.row_number().over(Window.orderBy(F.desc("issue_path"), "path"))  # 60 rows
    return chosen.select(F.col("issue_path").alias("source"), "doc_id", place.cast("long").alias("place"))
