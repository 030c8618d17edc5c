"""Relations across registries: rights, labels, splits, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, unescape, uniform
from .ranks import ranked

#: Scopes of rights, from the widest to the narrowest.
SCOPES = ("source_group", "source", "journal", "work", "artifact")
#: Columns a blinded form must never show.
HIDDEN = ("work_id", "doi", "edn", "source_id", "journal_id", "journal_title", "publisher_section", "pacs_codes_raw", "udc_codes_raw", "canonical_url")


def effective_rights(scopes: DataFrame, rights: DataFrame, today: str) -> DataFrame:
    """The right that holds for each (artifact, operation): the narrowest scope; of one scope a restriction first, then the newest.

    scopes: artifact, source_group, source, journal, work (one row per artifact).
    Superseded and expired rights don't count.
    """
    old = rights.where("supersedes_rights_record_id is not null").select(F.col("supersedes_rights_record_id").alias("rights_record_id"))
    live = rights.join(old, "rights_record_id", "left_anti").where(F.col("rights_expires_at").isNull() | (F.col("rights_expires_at") >= today))
    named = F.array(*(F.struct(F.lit(s).alias("scope_type"), F.col(s).alias("scope_id"), F.lit(k).alias("width")) for k, s in enumerate(SCOPES)))
    ladder = scopes.select("artifact", F.explode(named).alias("s")).select("artifact", "s.*").where("scope_id is not null")
    strict = F.when(F.col("status").isin("prohibited", "permission_required"), 0).otherwise(1)
    best = Window.partitionBy("artifact", "operation").orderBy(F.desc("width"), strict, F.desc("created_at"), "rights_record_id")
    found = ladder.join(live, ["scope_type", "scope_id"]).withColumn("_k", F.row_number().over(best)).where("_k = 1")
    return found.select("artifact", "operation", "scope_type", "status", "rights_record_id")


def consensus(labels: DataFrame) -> DataFrame:
    """(annotation_item_id, decision, disagreement): equal answers, or else the single adjudication.

    A grouped maximum and minimum per item replace a self join.
    """
    answer = F.when(F.col("record_type") == "annotation", F.col("annotator_decision"))
    ruled = F.when((F.col("record_type") == "annotation_adjudication"), F.col("adjudicated_decision"))
    per = labels.groupBy("annotation_item_id").agg(F.count(answer).alias("answers"), F.min(answer).alias("low"), F.max(answer).alias("high"), F.max(ruled).alias("ruled"), F.count(ruled).alias("rulings"))
    differ = F.col("low") != F.col("high")
    return per.where("answers > 0").select(
        "annotation_item_id",
        F.when(~differ, F.col("low")).when(F.col("rulings") == 1, F.col("ruled")).alias("decision"),
        differ.alias("disagreement"),
        ((F.col("answers") != 2) | (differ != (F.col("rulings") == 1))).alias("invalid"),
    )


def conflicts(decisions: DataFrame, codes: DataFrame) -> DataFrame:
    """(work_id, truth, decision, conflict): consensus against the verified class; other decisions stay, as conflicts.

    decisions: work_id, decision; codes: work_id, h2_class_id, label_verification_status, is_primary_explicit.
    """
    verified = codes.where("label_verification_status = 'verified' and is_primary_explicit and h2_class_id is not null").select("work_id", F.col("h2_class_id").alias("truth"))
    return decisions.select("work_id", "decision").join(verified, "work_id").withColumn("conflict", ~F.col("truth").eqNullSafe(F.col("decision")))


#: The five columns by which frame rows and labels belong together.
ITEM = ("audit_id", "candidate_frame_id", "audit_frame_version", "annotation_item_id", "work_id")


def labelled_frame(frame: DataFrame, labels: DataFrame) -> DataFrame:
    """Frame rows with their labels, joined on ITEM; a null item id joins nothing."""
    return frame.join(labels, list(ITEM))


def linked_rights(artifacts: DataFrame, rights: DataFrame) -> DataFrame:
    """(artifact, rights_record_id, operation, status): the rights that an artifact's list names; status null for an id that isn't there."""
    named = artifacts.select("artifact", F.explode("rights_record_ids").alias("rights_record_id")).distinct()
    return named.join(rights.select("rights_record_id", "operation", "status"), "rights_record_id", "left").select("artifact", "rights_record_id", "operation", "status")


def admitted(effective: DataFrame, fulfilled: DataFrame, operation: str = "ml_training") -> DataFrame:
    """Artifacts whose right for `operation` is allowed, or conditional with its conditions fulfilled (rights_record_id in `fulfilled`)."""
    rows = effective.where(F.col("operation") == operation)
    done = rows.where("status = 'conditional'").join(fulfilled.select("rights_record_id").distinct(), "rights_record_id", "left_semi")
    return rows.where("status = 'allowed'").select("artifact").unionByName(done.select("artifact"))


def canonical_works(works: DataFrame) -> DataFrame:
    """(work_id, canonical): works that share an alias or are marked as duplicates are one, known by the least work_id."""
    from .graph import label_components

    names = F.array_compact(F.concat(F.coalesce("work_aliases", F.array().cast("array<string>")), F.array("duplicate_of_work_id")))
    edges = works.select(F.col("work_id").alias("a"), F.explode(names).alias("b"))
    ids = works.select("work_id").distinct()
    groups = label_components(edges)
    least = groups.join(ids, groups["node"] == ids["work_id"]).groupBy("label").agg(F.min("work_id").alias("canonical"))
    known = groups.join(least, "label").select(F.col("node").alias("work_id"), "canonical")
    return ids.join(known, "work_id", "left").select("work_id", F.coalesce("canonical", "work_id").alias("canonical"))


def blinded(works: DataFrame, item_ids: DataFrame) -> DataFrame:
    """annotation_item_id, title, abstract and nothing that tells where a work is from."""
    out = works.join(item_ids, "work_id").select("annotation_item_id", F.col("title").alias("blinded_title"), F.col("abstract").alias("blinded_abstract"))
    assert not set(out.columns) & set(HIDDEN)
    return out


def split_violations(assignments: DataFrame) -> DataFrame:
    """(work_id, splits) of works in more than one split, but for training data of both tasks."""
    pairs = assignments.select("work_id", F.concat_ws("/", "task", "split").alias("s")).distinct()
    wide = pairs.groupBy("work_id").agg(F.sort_array(F.collect_set("s")).alias("splits")).where("size(splits) > 1")
    return wide.where("splits <> array('classification/train', 'mlm/train')")


def missing(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of `child` whose non-null key isn't in `parent`."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def stratified(frame: DataFrame, strata: list[str], key: str, size: int, seed: int) -> DataFrame:
    """`size` rows of each stratum by hashed rank, with population and inclusion probability."""
    rows = ranked(frame, strata, uniform(seed, F.col(key)), key).withColumnRenamed("population", "stratum_population_size")
    share = F.least(F.lit(size), F.col("stratum_population_size")).cast("double") / F.col("stratum_population_size")
    return rows.where(F.col("rank") <= size).drop("rank").withColumn("inclusion_probability", share)


def issue_paths(pages: DataFrame, limit: int | None = None, numeric: bool = False) -> DataFrame:
    """Distinct issue paths of archive pages, newest first; without `numeric` in string order (so 9 before 10); limit 0 means all."""
    found = pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="(/ru/articles/[0-9]{4}/[0-9]+/?)"'), F.lit(1))).alias("path")).distinct()
    part = lambda k: F.regexp_extract("path", "/articles/([0-9]{4})/([0-9]+)", k).cast("int")
    ordered = found.orderBy(F.desc(part(1)), F.desc(part(2)), "path") if numeric else found.orderBy(F.desc("path"))
    return ordered.limit(limit) if limit else ordered


def article_paths(pages: DataFrame) -> DataFrame:
    """(issue_path, path, title): article links of issue pages; of several link texts the last one that isn't empty."""
    link = '<a[^>]*href="([^"]*/[a-z]/?)"[^>]*>([^<]*)</a>'
    found = pages.select("issue_path", F.posexplode(F.arrays_zip(F.regexp_extract_all("html", F.lit(link), F.lit(1)).alias("path"), F.regexp_extract_all("html", F.lit(link), F.lit(2)).alias("title"))).alias("pos", "x"))
    own = found.where(F.col("x.path").startswith(F.col("issue_path"))).select("issue_path", F.col("x.path").alias("path"), "pos", F.regexp_replace("x.title", "\\s+", " ").alias("title"))
    own = own.withColumn("title", F.nullif(strip(unescape("title")), F.lit("")))
    return own.groupBy("issue_path", "path").agg(F.max_by("title", F.when(F.col("title").isNotNull(), F.col("pos"))).alias("title"))


def capped(articles: DataFrame, per_issue: int = 0, most: int | None = None) -> DataFrame:
    """Articles in crawl order under both caps: 0 per issue means all, 0 in all means none."""
    rows = articles
    if per_issue:
        rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy("issue_path").orderBy("path"))).where(F.col("_k") <= per_issue).drop("_k")
    rows = rows.where(F.length("text") >= 80)
    return rows if most is None else rows.orderBy(F.desc("issue_path"), "path").limit(most)
