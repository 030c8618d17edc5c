"""Samples and splits by rule: the audit sample, the splits by quota, the pilot, and inclusion with its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import uniform
from .ranks import by_value, dealt, ntile, ranked

#: The classes, and the sizes of samples and splits.
CLASSES = ("C1", "C2", "C3", "C4", "C5")
PER_CELL, HARD_PER_PERIOD, CALIBRATION = 15, 25, 30
MLM_PARTS = {"train": 1600, "validation": 200, "test": 200}
CLASS_PARTS = {"train": 210, "validation": 30, "test": 60}
MOST_SHARE, LEAST_SOURCES = 0.6, 2
PILOT_WORKS, PILOT_GROUPS, PILOT_SUBTOKENS = 400, 3, 5_000_000
GENRES = ("research_article", "review_article", "short_communication")


def audit_sample(frame: DataFrame, seed: int, per_cell: int = PER_CELL, hard: int = HARD_PER_PERIOD, calibration: int = CALIBRATION) -> DataFrame:
    """(work_id, stratum_id, stratum_population_size, selection_role, inclusion_probability) of every row of a frame.

    frame: work_id, candidate_class_id, period.  Of each class and period `per_cell` works are audited, of each period `hard` of all other
    classes; of the rest `calibration` works are drawn over all strata, with the share of the rest as probability.
    Roles: audit, calibration, not_selected (probability of the audit).
    """
    named = F.concat_ws("/", F.when(F.col("candidate_class_id").isin(*CLASSES), F.col("candidate_class_id")).otherwise("HARD"), "period")
    rows = ranked(frame.select("work_id", named.alias("stratum_id")), ["stratum_id"], uniform(seed, F.col("work_id")), "work_id")
    size = F.when(F.col("stratum_id").startswith("HARD/"), hard).otherwise(per_cell)
    rows = rows.withColumn("audited", F.col("rank") <= size).withColumn("p", F.least(size, F.col("population")).cast("double") / F.col("population"))
    rest = rows.where("not audited")
    drawn = rest.select("work_id", uniform(seed + 1, F.col("work_id")).alias("u")).orderBy("u", "work_id").limit(calibration).select("work_id", F.lit(True).alias("calibrated"))
    count = rest.agg(F.count(F.lit(1)).alias("n_rest"))
    out = rows.join(F.broadcast(drawn), "work_id", "left").crossJoin(F.broadcast(count))  # `calibration` rows, and one
    role = F.when(F.col("audited"), "audit").when(F.col("calibrated"), "calibration").otherwise("not_selected")
    share = F.when(role == "calibration", F.least(F.lit(calibration), F.col("n_rest")).cast("double") / F.col("n_rest")).otherwise(F.col("p"))
    return out.select("work_id", "stratum_id", F.col("population").alias("stratum_population_size"), role.alias("selection_role"), share.alias("inclusion_probability"))


def mlm_split(works: DataFrame, strata: list[str], seed: int, parts: dict[str, int] | None = None) -> DataFrame:
    """(work_id, strata, part): works dealt to train, validation and test, each stratum in proportion; rows must be one per work."""
    return dealt(works, strata, uniform(seed, F.col("work_id")), "work_id", parts or MLM_PARTS)


def class_split(works: DataFrame, seed: int, parts: dict[str, int] | None = None, most_share: float = MOST_SHARE) -> DataFrame:
    """(work_id, h2_class_id, source_id, part): for every class parts of fixed sizes, no source with more than `most_share` of them."""
    return dealt(works, ["h2_class_id", "source_id"], uniform(seed, F.col("work_id")), "work_id", parts or CLASS_PARTS, ("h2_class_id",), most_share)


def split_faults(split: DataFrame, parts: dict[str, int] | None = None, most_share: float = MOST_SHARE) -> DataFrame:
    """(h2_class_id, part, reason): parts of a class split that are too small, or hold too few sources or too much of one."""
    per = split.groupBy("h2_class_id", "part", "source_id").agg(F.count(F.lit(1)).alias("n"))
    whole = per.groupBy("h2_class_id", "part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sources"), F.max("n").alias("most"))
    wanted = F.create_map(*(x for k, v in (parts or CLASS_PARTS).items() for x in (F.lit(k), F.lit(v))))
    reasons = F.array(F.when(F.col("n") < wanted[F.col("part")], "too few works"), F.when(F.col("sources") < LEAST_SOURCES, "too few sources"), F.when(F.col("most") > F.ceil(most_share * F.col("n")), "too much of one source"))
    return whole.select("h2_class_id", "part", F.explode(F.array_compact(reasons)).alias("reason"))


def pilot(train: DataFrame, seed: int, works: int = PILOT_WORKS) -> DataFrame:
    """Works of the training part for a pilot, each group in proportion: (work_id, source_group_id, part)."""
    return dealt(train, ["source_group_id"], uniform(seed, F.col("work_id")), "work_id", {"pilot": works})


def pilot_verdict(chosen: DataFrame, works: int = PILOT_WORKS) -> DataFrame:
    """One row: works, groups, subtokens and ok, for the chosen works with their subtokens."""
    ok = f"works = {works} and groups >= {PILOT_GROUPS} and subtokens between {0.8 * PILOT_SUBTOKENS} and {1.2 * PILOT_SUBTOKENS}"
    return chosen.agg(F.count(F.lit(1)).alias("works"), F.count_distinct("source_group_id").alias("groups"), F.coalesce(F.sum("subtokens"), F.lit(0)).alias("subtokens")).withColumn("ok", F.expr(ok))


def _named(tests: dict[str, str]) -> Column:
    return F.array_compact(F.array(*(F.when(~F.coalesce(F.expr(t), F.lit(False)), F.lit(name)) for name, t in tests.items())))


#: Rules that a work of the classification set meets.
INCLUSION = {
    "genre and years": f"language = 'ru' and genre in {GENRES} and year between 2000 and 2025",
    "title and abstract": "length(trim(title)) > 0 and length(trim(abstract)) > 0",
    "stable address": "length(canonical_url) > 0",
    "explicit primary code": "is_primary_explicit and length(code) > 0 and length(evidence_sha256) > 0",
    "one class": "size(array_distinct(classes)) = 1",
    "unique and permitted": "duplicate_of_work_id is null and permitted",
    "no label in the input": "not leaks",
}
#: Reasons to leave a work out, as conditions that say so.
EXCLUSION = {
    "section only": "code in ('29', '29.00')",
    "general branch": "code rlike r'^29[.](01|03)'",
    "other branch": "code rlike r'^29[.][0-9]{2}' and code not rlike r'^29[.](00|01|03|05|15|19|27|33)'",
    "several classes": "size(array_distinct(classes)) > 1",
    "no title or abstract": "length(coalesce(trim(title), '')) = 0 or length(coalesce(trim(abstract), '')) = 0",
    "not Russian": "language <> 'ru'",
    "not an article": "genre = 'other'",
    "duplicate": "duplicate_of_work_id is not null",
    "not permitted": "not coalesce(permitted, false)",
}


def included(works: DataFrame) -> DataFrame:
    """`works` with failed_rules, exclusion_reasons and included: no rule failed; rows are never dropped.

    Columns: language, genre, year, title, abstract, canonical_url, is_primary_explicit, code, evidence_sha256, classes, duplicate_of_work_id, permitted, leaks.
    A rule whose columns are null is failed; a reason whose columns are null isn't given.
    """
    reasons = F.array_compact(F.array(*(F.when(F.coalesce(F.expr(t), F.lit(False)), F.lit(name)) for name, t in EXCLUSION.items())))
    return works.withColumn("failed_rules", _named(INCLUSION)).withColumn("exclusion_reasons", reasons).withColumn("included", F.size("failed_rules") == 0)


def folds(rows: DataFrame, key: str, label: str, seed: int, n: int = 5, repeats: int = 10) -> DataFrame:
    """(key, label, rep, fold): stratified folds, dealt in turn by hashed rank within each label, anew for each repeat."""
    each = rows.select(key, label, F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("rep"))
    placed = ranked(each, ["rep", label], uniform(seed, F.col("rep"), F.col(key)), key)
    return placed.select(key, label, F.col("rep").cast("long").alias("rep"), ((F.col("rank") - 1) % n).cast("long").alias("fold"))


def length_decile(rows: DataFrame, length: str, key: str) -> DataFrame:
    """`rows` with decile: tenths of the whole table by length, then key."""
    placed = by_value(rows, length, key)
    return placed.withColumn("decile", ntile(F.col("rank"), F.col("population"), 10)).drop("rank", "population")
