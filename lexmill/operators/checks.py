"""Checks across registries that no row rule can make.  Each returns the offending keys; no rows means it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import grnti_class


def duplicated(rows: DataFrame, *keys: str) -> DataFrame:
    """Key combinations that occur more than once, with their count `_n`."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def several_values(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """Keys whose rows don't agree on `values`; nulls compare as a value."""
    return rows.select(key, *values).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)


def telling_ids(rows: DataFrame, key: str, *hidden: str) -> DataFrame:
    """Ids that contain, in either case, a non-empty value they should hide."""
    named = [(F.length(c) > 0) & F.contains(F.lower(key), F.lower(c)) for c in hidden]
    return rows.where(F.greatest(*(F.coalesce(n, F.lit(False)) for n in named), F.lit(False))).select(key)


def shared(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of both sides, which should be disjoint."""
    return a.select(key).intersect(b.select(key))


def wrong_count(items: DataFrame, answers: DataFrame, key: str, n: int = 2) -> DataFrame:
    """Items that don't have exactly `n` rows in `answers`."""
    counts = answers.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return items.select(key).distinct().join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") != n)


def differing(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of both sides whose values differ; null differs from any other value."""
    other = b.select(key, F.col(value).alias("_other"))
    return a.select(key, value).join(other, key).where(~F.col(value).eqNullSafe(F.col("_other"))).select(key).distinct()


def overwritten(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of `old` whose row is gone or changed in `new`, which may only add rows."""
    return old.exceptAll(new.select(old.columns)).select(key).distinct()


def wrong_probability(frame: DataFrame, *strata: str) -> DataFrame:
    """Strata whose stored size or inclusion probability isn't that of their rows.

    Columns: stratum_population_size, inclusion_probability, selected (boolean).
    """
    per = frame.groupBy(*strata).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("selected").alias("drawn"),
        F.min("stratum_population_size").alias("low"),
        F.max("stratum_population_size").alias("high"),
        F.min("inclusion_probability").alias("p_low"),
        F.max("inclusion_probability").alias("p_high"),
        F.count_if(F.col("stratum_population_size").isNull() | F.col("inclusion_probability").isNull()).alias("unset"),
    )
    share = F.col("drawn") / F.col("n")
    good = (F.col("unset") == 0) & (F.col("low") == F.col("n")) & (F.col("high") == F.col("n")) & (F.abs(F.col("p_low") - share) < 1e-9) & (F.abs(F.col("p_high") - share) < 1e-9)
    return per.where(~F.coalesce(good, F.lit(False))).select(*strata)


def broken_conflicts(labels: DataFrame) -> DataFrame:
    """Conflict resolutions without exactly one consensus label and two assignments of distinct sources, or naming a missing row.

    The consensus is one adjudication, or two annotations that agree.  Ids are joined as rows, so no list grows beyond a package.
    """
    package = labels.where("record_type = 'grnti_conflict_resolution'").select(F.col("label_record_id").alias("package"), F.explode_outer(F.array_distinct("source_label_record_ids")).alias("label_record_id"))
    parts = labels.select("label_record_id", "record_type", "annotator_decision", F.col("grnti_assignment.assignment_source_id").alias("origin"))
    is_answer = F.col("record_type") == "annotation"
    per = package.join(parts, "label_record_id", "left").groupBy("package").agg(
        F.count_if(F.col("record_type").isNull()).alias("absent"),
        F.count_if(F.col("record_type") == "annotation_adjudication").alias("rulings"),
        F.count_if(is_answer).alias("answers"),
        F.count_distinct(F.when(is_answer, F.col("annotator_decision"))).alias("decisions"),
        F.count_distinct(F.when(F.col("record_type") == "grnti_assignment", F.col("origin"))).alias("origins"),
    )
    return per.where("not (absent = 0 and origins >= 2 and ((rulings = 1 and answers = 0) or (rulings = 0 and answers = 2 and decisions = 1)))").select("package")


def unlisted_paths(frame: DataFrame, hits: DataFrame) -> DataFrame:
    """Ways a work was found (work_id, query_id, query_version) that its frame row doesn't list in query_refs."""
    listed = frame.select("work_id", F.explode("query_refs").alias("q")).select("work_id", "q.query_id", "q.query_version")
    return hits.select("work_id", "query_id", "query_version").distinct().join(listed, ["work_id", "query_id", "query_version"], "left_anti")


def unknown_queries(frame: DataFrame, queries: DataFrame) -> DataFrame:
    """(frame_record_id, query_id, query_version) that no query row has."""
    named = frame.select("frame_record_id", F.explode("query_refs").alias("q")).select("frame_record_id", "q.query_id", "q.query_version")
    return named.join(queries.select("query_id", "query_version").distinct(), ["query_id", "query_version"], "left_anti").select("frame_record_id", "query_id", "query_version")


def several_versions(works: DataFrame) -> DataFrame:
    """work_ids that share an identifier (their own, a DOI or an alias) with another one that isn't marked as its duplicate."""
    live = works.where("duplicate_of_work_id is null")
    names = F.array_distinct(F.concat(F.array("work_id"), F.coalesce("work_aliases", F.array().cast("array<string>")), F.array_compact(F.array("doi"))))
    held = live.select("work_id", F.explode(names).alias("name")).distinct()
    several = held.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return held.join(several, "name", "left_semi").select("work_id").distinct()


def without_right(artifacts: DataFrame, effective: DataFrame, *operations: str) -> DataFrame:
    """(artifact, operation) that no allowed or conditional right covers; effective: from `resolve.effective_rights`."""
    wanted = artifacts.select("artifact", F.explode(F.array(*map(F.lit, operations))).alias("operation"))
    return wanted.join(effective.where("status in ('allowed', 'conditional')"), ["artifact", "operation"], "left_anti")


#: Ways of acquisition that suit each type of query (our choice, as the rule only says "compatible").
SUITS = {"site_search": ("crawler", "manual_download", "other"), "catalog_export": ("platform_export", "other"), "manual_index": ("manual_download", "other"), "api": ("api", "other"), "other": ("manual_download", "api", "crawler", "platform_export", "other")}


def unfit_query_rights(queries: DataFrame, rights: DataFrame) -> DataFrame:
    """(query_id, query_version) whose rights row is missing or doesn't cover it.

    It must allow acquisition for the query's source, by a method that suits the type; more than one result needs a scope beyond a single item.
    """
    cols = ("rights_record_id", "operation", "status", "scope_type", "scope_id", "acquisition_method", "acquisition_scope")
    suits = F.create_map(*(x for k, v in SUITS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    joined = queries.join(rights.select(*cols), "rights_record_id", "left")
    fit = (
        (F.col("operation") == "acquisition")
        & F.col("status").isin("allowed", "conditional")
        & ((F.col("scope_type") != "source") | (F.col("scope_id") == F.col("source_id")))
        & F.array_contains(suits[F.col("query_type")], F.col("acquisition_method"))
        & ((F.col("result_count") <= 1) | F.col("acquisition_scope").isin("sample", "bulk"))
    )
    return joined.where(~F.coalesce(fit, F.lit(False))).select("query_id", "query_version")


def wrong_confirmed_class(labels: DataFrame) -> DataFrame:
    """Conflict packages that confirm the catalogue, but with a class that none of their assignments has."""
    package = labels.where("record_type = 'grnti_conflict_resolution' and grnti_conflict_outcome = 'catalog_confirmed'").select(F.col("label_record_id").alias("package"), F.col("h2_class_id").alias("confirmed"), F.explode_outer("source_label_record_ids").alias("label_record_id"))
    codes = labels.where("record_type = 'grnti_assignment'").select("label_record_id", grnti_class(F.col("grnti_assignment.code")).alias("by_code"))
    per = package.join(codes, "label_record_id", "left").groupBy("package").agg(F.max(F.coalesce(F.col("by_code") == F.col("confirmed"), F.lit(False))).alias("same"))
    return per.where("not same").select("package")


#: The changes of state that each field allows.
TRANSITIONS = {
    "eligibility_status": ("pending>eligible", "pending>rejected", "pending>quarantined"),
    "acquisition_status": ("discovered>rights_blocked", "discovered>ready", "ready>retrieved", "ready>failed"),
    "extraction_status": ("not_started>running", "running>succeeded", "running>failed"),
    "qa_status": ("not_evaluated>passed", "not_evaluated>quarantined", "not_evaluated>failed"),
    "processing_status": ("not_started>processed", "processed>eligible", "processed>rejected"),
}


def broken_transitions(history: DataFrame, key: str, field: str, at: str, allowed: tuple[str, ...] | None = None) -> DataFrame:
    """(key, before, after): changes of `field`, in the order of `at`, that aren't allowed; staying the same always is.

    A way out of quarantine needs a new derived object, so it isn't a change of the same one.
    """
    steps = history.select(key, F.lag(field).over(Window.partitionBy(key).orderBy(at, field)).alias("before"), F.col(field).alias("after"))
    good = F.concat_ws(">", "before", "after").isin(*(allowed or TRANSITIONS[field]))
    return steps.where(F.col("before").isNotNull() & (F.col("before") != F.col("after")) & ~good)


def final_gate(metrics: DataFrame) -> DataFrame:
    """`metrics` (a row per audit) with its nine criteria g1 to g9 and decision: pass, revise or reject.

    Only criteria on the mixture with sources (g8, g9) failing, or an interval of kappa that is too wide (g3), means revise; a missing figure fails.
    Columns: kappa, kappa_low, kappa_high, expert_f1, expert_f1_low, conflict_high, least_class_works, least_class_sources, unverified, unresolved, connected, least_degree, source_f1, source_f1_high.
    """
    tests = {
        "g1": "kappa >= 0.80",
        "g2": "kappa_low >= 0.70",
        "g3": "(kappa_high - kappa_low) / 2 <= 0.10",
        "g4": "expert_f1 >= 0.90 and expert_f1_low >= 0.85 and conflict_high <= 0.15",
        "g5": "least_class_works >= 300 and least_class_sources >= 2",
        "g6": "unverified = 0",
        "g7": "unresolved = 0",
        "g8": "connected and least_degree >= 2",
        "g9": "source_f1 < 0.50 and source_f1_high < 0.55",
    }
    out = metrics.withColumns({k: F.coalesce(F.expr(t), F.lit(False)) for k, t in tests.items()})
    verdict = F.when(F.expr(" and ".join(tests)), "pass").when(F.expr("g1 and g2 and g4 and g5 and g6 and g7"), "revise").otherwise("reject")
    return out.withColumn("decision", verdict)


#: Operations that the corpus needs.
NEEDED = ("acquisition", "storage", "evaluation", "ml_training")


def rights_matrix(rights: DataFrame) -> DataFrame:
    """A row per scope_id and a column per operation: its status, the strictest where several rows speak; null for none."""
    operations = ("acquisition", "storage", "evaluation", "ml_training", "redistribution", "derivatives_release", "checkpoint_release")
    order = F.create_map(*(x for k, s in enumerate(("prohibited", "permission_required", "unknown", "conditional", "allowed")) for x in (F.lit(s), F.lit(k))))
    return rights.groupBy("scope_id").pivot("operation", list(operations)).agg(F.min_by("status", order[F.col("status")]))


def source_admission(matrix: DataFrame, sizes: DataFrame, works: int = 2000, groups: int = 4) -> DataFrame:
    """One row: usable_groups, usable_works and admitted, from `rights_matrix` and (scope_id, works)."""
    open_ = F.expr(" and ".join(f"coalesce({o} in ('allowed', 'conditional'), false)" for o in NEEDED))
    return matrix.where(open_).join(sizes, "scope_id").agg(F.count(F.lit(1)).alias("usable_groups"), F.coalesce(F.sum("works"), F.lit(0)).alias("usable_works")).withColumn("admitted", F.expr(f"usable_groups >= {groups} and usable_works >= {works}"))
