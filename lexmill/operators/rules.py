"""Row rules of closed registries, compiled from declarations to boolean columns.

A rule is (id, SQL condition that a good row meets).  Three-valued logic is
closed: a condition that is null counts as broken.  All rules are read in one
pass over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str]

#: Rules of the rights registry on optional fields and their conditions.
RIGHTS: tuple[Rule, ...] = (
    ("C9", "operation <> 'acquisition' or (acquisition_method is not null and acquisition_scope is not null)"),
    ("C10", "operation <> 'derivatives_release' or size(coalesce(derivative_scope, array())) > 0"),
    ("C11", "status <> 'conditional' or size(coalesce(rights_conditions, array())) > 0"),
    ("C12", "basis_type <> 'lawful_access_research_assumption' or (status = 'conditional' and operation in ('acquisition', 'storage', 'evaluation', 'ml_training') and size(coalesce(rights_conditions, array())) > 0)"),
    ("C13", "basis_type <> 'unknown' or status in ('unknown', 'permission_required')"),
    ("C14", "operation not in ('redistribution', 'derivatives_release', 'checkpoint_release') or status not in ('allowed', 'conditional') or basis_type in ('explicit_license', 'written_permission', 'contract', 'statutory_exception')"),
)
ARTIFACTS: tuple[Rule, ...] = (
    ("C6", "if(acquisition_status = 'retrieved', artifact_id is not null and sha256 is not null, artifact_id is null and sha256 is null and path is null and bytes is null and h2_input_sha256 is null)"),
    ("C7", "processing_status <> 'eligible' or (size(retrievals) > 0 and size(rights_record_ids) > 0 and artifact_id rlike '^sha256:[0-9a-f]{64}' and length(artifact_id) = 71 and length(sha256) = 64 and length(path) > 0 and bytes >= 0 and acquisition_status = 'retrieved' and extraction_status = 'succeeded' and qa_status = 'passed' and error_code is null and error_detail is null)"),
    ("C8", "content_role <> 'title_abstract' or processing_status <> 'eligible' or (length(h2_input_sha256) = 64 and length(label_leakage_audit_version) > 0 and label_leakage_audit_status = 'passed')"),
    ("V8", "artifact_id is null or artifact_id = concat('sha256:', sha256)"),
)
WORKS: tuple[Rule, ...] = (
    (
        "C4",
        "eligibility_status <> 'eligible' or (length(coalesce(abstract, '')) > 0 and language = 'ru' and genre in ('research_article', 'review_article', 'short_communication') "
        "and published_at rlike r'^(200[0-9]|201[0-9]|202[0-5])-[0-9]{2}-[0-9]{2}\\z' and duplicate_of_work_id is null and exclusion_reason is null)",
    ),
    ("C5", "eligibility_status not in ('rejected', 'quarantined') or length(coalesce(exclusion_reason, '')) > 0"),
)
FRAME: tuple[Rule, ...] = (
    ("C15", "if(selection_role = 'not_selected', annotation_item_id is null and not seen_by_annotators and size(allowed_classification_splits) = 0, annotation_item_id is not null and seen_by_annotators and allowed_classification_splits = array('train'))"),
    ("C16", "size(search_basis) > 0 and size(array_distinct(search_basis)) = size(search_basis) and size(query_refs) > 0 and size(array_distinct(query_refs)) = size(query_refs) and stratum_population_size >= 1 and inclusion_probability > 0 and inclusion_probability <= 1"),
)


def _filled(*keys: str) -> str:
    return " and ".join(f"length({k}) > 0" for k in keys)


def _unset(*keys: str) -> str:
    return " and ".join(f"{k} is null" for k in keys)


_ITEM = _filled("audit_id", "audit_frame_version", "candidate_frame_id", "annotation_item_id", "task_batch_id", "labeling_guide_version", "input_sha256", "completed_at")
_NO_ANSWER = _unset("annotator_id", "annotator_decision", "confidence", "decision_rationale")
_NO_RULING = _unset("adjudicator_id", "adjudicated_decision", "adjudication_reason", "adjudication_kind", "grnti_conflict_outcome") + " and size(coalesce(source_label_record_ids, array())) = 0"
_ANSWER = f"{_ITEM} and {_NO_RULING} and {_filled('annotator_id', 'decision_rationale')} and annotator_decision is not null and confidence is not null"
_RULING = f"{_ITEM} and {_NO_ANSWER} and {_filled('adjudicator_id', 'adjudication_reason')} and grnti_assignment is null"
_CLASSES = "('C1', 'C2', 'C3', 'C4', 'C5')"
LABELS: tuple[Rule, ...] = (
    (
        "C17",
        f"record_type <> 'grnti_assignment' or (grnti_assignment is not null and label_provenance in ('publisher_explicit_grnti', 'bibliographic_grnti') and {_NO_ANSWER} and {_NO_RULING} "
        f"and {_unset('task_batch_id', 'input_sha256', 'evidence_bundle_sha256', 'labeling_guide_version', 'completed_at')})",
    ),
    ("C19", "grnti_assignment is null or h2_class_id <=> element_at(map('29.05', 'C1', '29.15', 'C2', '29.19', 'C3', '29.27', 'C4', '29.33', 'C5'), regexp_extract(grnti_assignment.code, '^([0-9]{2}[.][0-9]{2})', 1))"),
    ("C20", "label_status <> 'eligible' or grnti_assignment is null or (label_verification_status = 'verified' and h2_class_id is not null and grnti_assignment.is_primary_explicit)"),
    ("C18", "record_type <> 'grnti_assignment' or if(grnti_assignment is null, label_provenance in ('publisher_explicit_grnti', 'bibliographic_grnti'), label_provenance = element_at(map('publisher', 'publisher_explicit_grnti', 'bibliographic_catalog', 'bibliographic_grnti'), grnti_assignment.assignment_source_type))"),
    ("C21", f"record_type <> 'annotation' or ({_ANSWER} and {_unset('grnti_assignment', 'h2_class_id', 'evidence_bundle_sha256')} and label_status = 'pending' and label_verification_status = 'pending' and label_provenance = 'none')"),
    (
        "C22",
        f"record_type <> 'annotation_adjudication' or ({_RULING} and {_unset('evidence_bundle_sha256', 'grnti_conflict_outcome')} and adjudicated_decision is not null and label_provenance = 'expert_adjudicated' "
        "and label_verification_status = 'verified' and adjudication_kind = 'annotator_disagreement' and size(source_label_record_ids) = 2)",
    ),
    ("C23", f"record_type <> 'annotation_adjudication' or if(adjudicated_decision in {_CLASSES}, h2_class_id <=> adjudicated_decision and label_status = 'eligible', h2_class_id is null and label_status = element_at(map('OTHER', 'other_class', 'AMBIGUOUS', 'ambiguous_multilabel', 'INSUFFICIENT', 'insufficient'), adjudicated_decision))"),
    ("C24", f"record_type <> 'grnti_conflict_resolution' or ({_RULING} and adjudicated_decision is null and label_provenance = 'none' and grnti_conflict_outcome is not null and adjudication_kind = 'grnti_conflict' and size(source_label_record_ids) >= 3 and evidence_bundle_sha256 is not null)"),
    (
        "C25",
        f"record_type <> 'grnti_conflict_resolution' or case grnti_conflict_outcome when 'catalog_confirmed' then h2_class_id in {_CLASSES} and label_verification_status = 'verified' and label_status = 'eligible' "
        "when 'catalog_rejected' then h2_class_id is null and label_verification_status = 'rejected' and label_status = 'conflict_excluded' "
        "when 'unresolved_excluded' then h2_class_id is null and label_verification_status = 'conflict' and label_status = 'conflict_excluded' end",
    ),
)
ANNOTATION_FORM: tuple[Rule, ...] = (("C26", "if(annotator_decision is null, confidence is null and decision_rationale is null and completed_at is null, confidence is not null and decision_rationale is not null and completed_at is not null)"),)
_TWO_ANSWERS = "size(source_decisions) = 2 and forall(source_decisions, d -> d.record_type = 'annotation')"
ADJUDICATION_FORM: tuple[Rule, ...] = (
    (
        "C27",
        f"if(adjudication_kind = 'annotator_disagreement', {_TWO_ANSWERS} and size(coalesce(grnti_evidence, array())) = 0 and evidence_bundle_sha256 is null and adjudicated_decision is not null and grnti_conflict_outcome is null, "
        f"(({_TWO_ANSWERS}) or (size(source_decisions) = 1 and source_decisions[0].record_type = 'annotation_adjudication')) and size(grnti_evidence) >= 2 and evidence_bundle_sha256 is not null and adjudicated_decision is null "
        "and grnti_conflict_outcome in ('catalog_confirmed', 'catalog_rejected', 'unresolved_excluded'))",
    ),
)
AUDIT_RUN: tuple[Rule, ...] = (("C28", "calibration_size = 30 and audit_size = 200 and size(annotator_ids) = 2 and size(array_distinct(annotator_ids)) = 2"),)


def holds(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def violations(rows: DataFrame, key: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(record_key, rule_id), a row for each broken rule of each row."""
    broken = F.array_compact(F.array(*(F.when(~holds(c), F.lit(r)) for r, c in rules)))
    return rows.select(F.col(key).cast("string").alias("record_key"), F.explode(broken).alias("rule_id"))


def unexpected_keys(lines: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """(value, missing, extra) of JSON lines whose key set isn't exactly `required`."""
    keys = F.json_object_keys("value")
    want = F.array(*map(F.lit, required))
    out = lines.select("value", F.array_except(want, keys).alias("missing"), F.array_except(keys, want).alias("extra"))
    return out.where("value is not null and (missing is null or size(missing) > 0 or size(extra) > 0)")
