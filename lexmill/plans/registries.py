"""Queries that check registries derived from the supplied tables, with seeded violations.

Every document gives one line of a registry.  Its scenario is doc_id modulo the number of scenarios:
0 is a good line, every other one breaks the rules that stand beside it.  The operators
read the lines; the SQL knows nothing but the list of scenarios, so it holds the operators
against what was seeded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registries as G
from .queries import ORACLES, QUERIES, table

SHA = "repeat('0', 64)"
_TIME = "'2024-05-01T00:00:00Z'"
#: What the keys of a good line hold, as SQL over doc_id; keys that aren't here are null, or empty lists.
GOOD: dict[str, dict[str, str]] = {
    "works": dict(
        created_at=_TIME, work_id="concat('r', doc_id)", source_group_id="'g'", source_id="source", journal_id="source", journal_title="concat('Journal ', source)", canonical_url="concat('https://h/', doc_id)",
        identity_confidence="'high'", title="concat('Title ', doc_id)", abstract="'An abstract'", published_at="'2014-02-03'", language="'ru'", genre="'review_article'", eligibility_status="'eligible'", updated_at=_TIME,
    ),
    "artifacts": dict(
        created_at=_TIME, artifact_record_id="concat('r', doc_id)", artifact_id=f"concat('sha256:', {SHA})", work_id="concat('w', doc_id)", retrievals=f"array(struct('t' as retrieval_id, 'https://h/' as retrieved_url, {_TIME} as retrieved_at, {SHA} as response_metadata_sha256))",
        rights_record_ids="array('x')", content_role="'title_abstract'", representation="'html'", path="'p'", sha256=SHA, bytes="n_chars", characters="n_chars", h2_input_sha256=SHA, label_leakage_audit_version="'v1'",
        label_leakage_audit_status="'passed'", acquisition_status="'retrieved'", extraction_status="'succeeded'", qa_status="'passed'", processing_status="'eligible'", updated_at=_TIME,
    ),
    "rights": dict(
        created_at=_TIME, rights_record_id="concat('r', doc_id)", scope_type="'work'", scope_id="concat('w', doc_id)", operation="'ml_training'", status="'allowed'", access_basis="'open'", basis_type="'explicit_license'", rights_checked_at="'2024-05-01'",
    ),
    "h2_audit_frame": dict(
        frame_record_id="concat('r', doc_id)", audit_frame_version="'v1'", audit_id="'a'", candidate_frame_id="'c'", annotation_item_id="concat('item', doc_id)", work_id="concat('w', doc_id)", candidate_class_id="'C4'", search_basis="array('pacs', 'udc')",
        query_refs="array(struct('q' as query_id, '1' as query_version))", stratum_id="lang", stratum_assignment_rule="'by language'", stratum_population_size="10", inclusion_probability="0.5D", selection_seed="7", selection_role="'audit'",
        seen_by_annotators="true", allowed_classification_splits="array('train')", created_at=_TIME, source_manifest_sha256=SHA,
    ),
    "h2_labels": dict(
        label_record_id="concat('r', doc_id)", record_type="'grnti_assignment'", work_id="concat('w', doc_id)", h2_scheme_version="'1'", h2_class_id="'C4'", label_provenance="'publisher_explicit_grnti'", label_verification_status="'verified'", label_status="'eligible'",
        grnti_assignment=f"struct('29.27.35' as code, '1' as scheme_version, 'publisher' as assignment_source_type, source as assignment_source_id, 'https://h/' as source_url, {_TIME} as retrieved_at, {SHA} as evidence_sha256, true as is_primary_explicit)", created_at=_TIME,
    ),
    "h2_audit_run": dict(
        {k: "'x'" for k, t in G.fields(G.REGISTRIES["h2_audit_run"]).items() if t == "id"} | {k: SHA for k, t in G.fields(G.REGISTRIES["h2_audit_run"]).items() if t == "sha"},
        audit_id="concat('r', doc_id)", input_serialization="'utf8-nfc-title-lf2-abstract-lf-v1'", selection_seed="7", calibration_size="30", audit_size="200", annotator_ids="array('a', 'b')", code_commit="'0123456'", created_at=_TIME,
    ),
    "h2_queries": dict(
        query_id="concat('r', doc_id)", query_version="'1'", source_id="source", query_type="'api'", query_text="lang", filters="map('lang', lang)", rights_record_id="'x'", executed_at=_TIME, result_count="n_chars", response_sha256=SHA, code_commit="'0123456'",
    ),
    "h2_annotation_form": dict(
        task_batch_id="'b'", audit_id="'a'", audit_frame_version="'v1'", candidate_frame_id="'c'", annotation_item_id="concat('r', doc_id)", h2_scheme_version="'1'", blinded_title="'t'", labeling_guide_version="'1'", input_sha256=SHA, annotator_id="'p'",
    ),
    "h2_adjudication_form": dict(
        task_batch_id="'b'", audit_id="'a'", audit_frame_version="'v1'", candidate_frame_id="'c'", annotation_item_id="concat('r', doc_id)", h2_scheme_version="'1'", adjudication_kind="'annotator_disagreement'", blinded_title="'t'", labeling_guide_version="'1'",
        input_sha256=SHA, adjudicator_id="'j'", source_decisions="array(struct('l1' as label_record_id, 'annotation' as record_type, 'C1' as decision, 'why' as rationale), struct('l2' as label_record_id, 'annotation' as record_type, 'C2' as decision, 'why' as rationale))", adjudicated_decision="'C1'", adjudication_reason="'r'", completed_at=_TIME,
    ),
}
_ITEM = dict(audit_id="'a'", audit_frame_version="'v1'", candidate_frame_id="'c'", annotation_item_id="concat('item', doc_id)", task_batch_id="'b'", input_sha256=SHA, labeling_guide_version="'1'", completed_at=_TIME)
_ANSWER = _ITEM | dict(record_type="'annotation'", grnti_assignment="null", h2_class_id="null", label_provenance="'none'", label_verification_status="'pending'", label_status="'pending'", annotator_id="'p'", annotator_decision="'C4'", confidence="'high'", decision_rationale="'why'")
_RULING = _ITEM | dict(record_type="'annotation_adjudication'", grnti_assignment="null", label_provenance="'expert_adjudicated'", adjudicator_id="'j'", adjudicated_decision="'C4'", adjudication_reason="'why'", adjudication_kind="'annotator_disagreement'", source_label_record_ids="array('a', 'b')")
_CLASH = _RULING | dict(record_type="'grnti_conflict_resolution'", label_provenance="'none'", adjudicated_decision="null", adjudication_kind="'grnti_conflict'", source_label_record_ids="array('a', 'b', 'c')", evidence_bundle_sha256=SHA, grnti_conflict_outcome="'catalog_confirmed'")
_EVIDENCE = f"named_struct('label_record_id', 'l', 'code', '29.05.01', 'assignment_source_type', 'publisher', 'assignment_source_id', '%s', 'source_url', 'https://h/', 'evidence_sha256', {SHA}, 'is_primary_explicit', true)"
_CONFLICT = dict(adjudication_kind="'grnti_conflict'", evidence_bundle_sha256=SHA, adjudicated_decision="null", grnti_conflict_outcome="'catalog_rejected'", grnti_evidence=f"array({_EVIDENCE % 's1'}, {_EVIDENCE % 's2'})")
_DONE = dict(annotator_decision="'C1'", confidence="'low'", decision_rationale="'why'", completed_at=_TIME)
_NOT_SELECTED = dict(selection_role="'not_selected'", annotation_item_id="null", seen_by_annotators="false", allowed_classification_splits="array()")
_BARE = dict(acquisition_status="'ready'", processing_status="'not_started'", artifact_id="null", sha256="null", path="null", bytes="null", h2_input_sha256="null")
#: The scenarios of each registry: the rules broken, what the line's keys hold instead, and a change of the line's text.
SCENARIOS: dict[str, list[tuple]] = {
    "works": [
        ("C1", {}, ('"doi":', '"doj":')), ("C1", {}, ('"edn":', '"extra":1,"edn":')), ("C2", {"schema_version": "'works-v2'"}), ("C3:title", {"title": "''"}), ("C3:journal_title", {"journal_title": "null"}), ("C3:language C4", {"language": "'r'"}),
        ("C3:genre C4", {"genre": "'poem'"}), ("C3:authors", {}, ('"authors":[]', '"authors":[1]')), ("C3:work_aliases", {"work_aliases": "array('a', 'a')"}), ("C3:pacs_codes_raw", {"pacs_codes_raw": f"array(struct('' as code, 'u' as source_url, {_TIME} as retrieved_at, {SHA} as evidence_sha256))"}),
        ("C3:platform", {}, ('"platform":null', '"platform":7')), ("C4", {"abstract": "''"}), ("C4", {"abstract": "null"}), ("C4", {"language": "'en'"}), ("C4", {"genre": "'other'"}), ("C4", {"published_at": "'1999-12-31'"}), ("C4", {"published_at": "'2026-01-01'"}), ("", {"published_at": "'2000-13-99'"}),
        ("C4", {"published_at": "null"}), ("C4", {"duplicate_of_work_id": "'w'"}), ("C4", {"exclusion_reason": "'x'"}), ("C5", {"eligibility_status": "'rejected'"}), ("C5", {"eligibility_status": "'quarantined'", "exclusion_reason": "''"}), ("", {"eligibility_status": "'rejected'", "exclusion_reason": "'x'", "genre": "'other'"}),
    ],
    "artifacts": [
        ("C2", {"schema_version": "'v1'"}), ("C3:bytes C7", {"bytes": "-1"}), ("C3:retrievals", {}, ('"retrieval_id"', '"retrieval"')), ("C3:representation", {"representation": "'doc'"}), ("C6 C7", {"artifact_id": "null"}), ("", _BARE), ("C6", _BARE | {"path": "'p'"}), ("C6", _BARE | {"bytes": "1"}),
        ("C7", {"retrievals": "array()"}), ("C7", {"rights_record_ids": "array()"}), ("C7", {"qa_status": "'failed'"}), ("C7", {"error_code": "'e'"}), ("C8", {"label_leakage_audit_status": "'failed'"}), ("C8", {"label_leakage_audit_version": "null"}), ("", {"content_role": "'full_text'", "label_leakage_audit_status": "'failed'"}),
        ("V8", {"sha256": "repeat('1', 64)"}), ("C3:artifact_id C7 V8", {"artifact_id": "'sha256:0'"}),
    ],
    "rights": [
        ("C1", {}, ('"status":', '"stat":1,"status":')), ("C3:operation", {"operation": "'reading'"}), ("C3:status", {"status": "'denied'"}), ("C9", {"operation": "'acquisition'", "acquisition_method": "'api'"}), ("", {"operation": "'acquisition'", "acquisition_method": "'api'", "acquisition_scope": "'bulk'"}),
        ("C10", {"operation": "'derivatives_release'"}), ("", {"operation": "'derivatives_release'", "derivative_scope": "array('identifiers')"}), ("C11", {"status": "'conditional'"}), ("C12", {"basis_type": "'lawful_access_research_assumption'"}),
        ("", {"basis_type": "'lawful_access_research_assumption'", "status": "'conditional'", "rights_conditions": "array('c')"}), ("C12 C14", {"basis_type": "'lawful_access_research_assumption'", "status": "'conditional'", "rights_conditions": "array('c')", "operation": "'redistribution'"}),
        ("C13", {"basis_type": "'unknown'"}), ("", {"basis_type": "'unknown'", "status": "'unknown'"}), ("C14 C13", {"basis_type": "'unknown'", "operation": "'checkpoint_release'"}), ("C3:derivative_scope", {"derivative_scope": "array('all')"}),
    ],
    "h2_audit_frame": [
        ("", _NOT_SELECTED), ("C15", _NOT_SELECTED | {"seen_by_annotators": "true"}), ("C15", _NOT_SELECTED | {"annotation_item_id": "'i'"}), ("C15", {"allowed_classification_splits": "array()"}), ("C15", {"annotation_item_id": "null"}), ("C3:search_basis C16", {"search_basis": "array()"}),
        ("C3:search_basis C16", {"search_basis": "array('pacs', 'pacs')"}), ("C3:query_refs C16", {"query_refs": "array()"}), ("C3:stratum_population_size C16", {"stratum_population_size": "0"}), ("C3:inclusion_probability C16", {"inclusion_probability": "0.0D"}), ("C3:inclusion_probability C16", {"inclusion_probability": "1.5D"}),
        ("C3:allowed_classification_splits C15", {"allowed_classification_splits": "array('test')"}), ("C3:source_manifest_sha256", {"source_manifest_sha256": "'0'"}), ("C2", {"schema_version": "'x'"}),
    ],
    "h2_labels": [
        ("C17", {"annotator_id": "'p'"}), ("C17", {"grnti_assignment": "null"}), ("C18", {"label_provenance": "'bibliographic_grnti'"}), ("C19", {"h2_class_id": "'C5'"}), ("C19 C20", {"h2_class_id": "null"}), ("C20", {"label_verification_status": "'pending'"}),
        ("", _ANSWER), ("C21", _ANSWER | {"confidence": "null"}), ("C21", _ANSWER | {"task_batch_id": "null"}), ("C17", {"completed_at": _TIME}), ("C21", _ANSWER | {"label_status": "'eligible'"}), ("", _RULING), ("C22", _RULING | {"source_label_record_ids": "array('a')"}), ("C22", _RULING | {"annotator_id": "'p'"}), ("C23", _RULING | {"h2_class_id": "'C5'"}),
        ("", _RULING | {"adjudicated_decision": "'OTHER'", "h2_class_id": "null", "label_status": "'other_class'"}), ("C23", _RULING | {"adjudicated_decision": "'AMBIGUOUS'", "h2_class_id": "null", "label_status": "'insufficient'"}),
        ("", _CLASH), ("C24", _CLASH | {"source_label_record_ids": "array('a', 'b')"}), ("C24", _CLASH | {"evidence_bundle_sha256": "null"}), ("C25", _CLASH | {"label_verification_status": "'rejected'"}), ("C25", _CLASH | {"grnti_conflict_outcome": "'unresolved_excluded'"}),
        ("", _CLASH | {"grnti_conflict_outcome": "'unresolved_excluded'", "h2_class_id": "null", "label_verification_status": "'conflict'", "label_status": "'conflict_excluded'"}), ("C3:record_type", {"record_type": "'note'"}), ("C3:source_label_record_ids C17", {"source_label_record_ids": "array('')"}),
    ],
    "h2_audit_run": [("C28", {"calibration_size": "29"}), ("C28", {"audit_size": "100"}), ("C28 C3:annotator_ids", {"annotator_ids": "array('a', 'a')"}), ("C28 C3:annotator_ids", {"annotator_ids": "array('a', 'b', 'c')"}), ("C3:code_commit", {"code_commit": "'012345'"}), ("C3:input_serialization", {"input_serialization": "'x'"}), ("C1", {}, ('"audit_size":', '"audit":'))],
    "h2_queries": [("C3:query_type", {"query_type": "'x'"}), ("C3:result_count", {"result_count": "-1"}), ("C3:filters", {}, ('"filters":{', '"filters":[],"x":{')), ("C2", {"schema_version": "'h2-queries-v2'"}), ("C3:response_sha256", {"response_sha256": "upper(repeat('a', 64))"})],
    "h2_annotation_form": [("", _DONE), ("C26", _DONE | {"confidence": "null"}), ("C26", {"confidence": "'low'"}), ("C26", _DONE | {"completed_at": "null"}), ("C3:annotator_decision", _DONE | {"annotator_decision": "'C9'"}), ("C3:blinded_title", {"blinded_title": "''"})],
    "h2_adjudication_form": [
        ("C27", {"adjudicated_decision": "null"}), ("C27", {"evidence_bundle_sha256": SHA}), ("C27", {"source_decisions": "array(struct('l1' as label_record_id, 'annotation' as record_type, 'C1' as decision, 'why' as rationale))"}), ("", _CONFLICT), ("C27", _CONFLICT | {"grnti_evidence": f"array({_EVIDENCE % 's1'})"}),
        ("C27", _CONFLICT | {"grnti_conflict_outcome": "null"}), ("", _CONFLICT | {"source_decisions": "array(struct('l1' as label_record_id, 'annotation_adjudication' as record_type, 'C1' as decision, 'why' as rationale))"}), ("C3:source_decisions", {}, ('"rationale":"why"', '"rationale":""')),
        ("C3:grnti_evidence", _CONFLICT, ('"code":"29.05.01"', '"code":"29"')),
    ],
}
# a line whose list isn't one has a key more, too
SCENARIOS["h2_queries"][2] = ("C1 C3:filters", *SCENARIOS["h2_queries"][2][1:])


def lines(docs, registry):
    """(value): a line of the registry for every document, in its scenario."""
    scenarios = [("", {}), *SCENARIOS[registry]]
    declared = G.fields(G.REGISTRIES[registry])
    k = f"doc_id % {len(scenarios)}"
    cols = []
    for name, kind in declared.items():
        version = f"'{kind[1:]}'" if kind.startswith("=") else None
        good = GOOD[registry].get(name, version or ("array()" if kind.startswith("[") and not kind.endswith("?") else "null"))
        cases = "".join(f" when {i} then cast({s[1][name]} as {G.ddl(kind)})" for i, s in enumerate(scenarios) if name in s[1])
        cols.append(f"case {k}{cases} else cast({good} as {G.ddl(kind)}) end as {name}" if cases else f"cast({good} as {G.ddl(kind)}) as {name}")
    value = F.expr(f"to_json(struct({', '.join(cols)}), map('ignoreNullFields', 'false'))")
    for i, s in enumerate(scenarios):
        if len(s) > 2:
            value = F.when(F.expr(f"{k} = {i}"), F.replace(value, F.lit(s[2][0]), F.lit(s[2][1]))).otherwise(value)
    return docs.select(value.alias("value"))


def _seeded(registry):
    def run(spark, sf_dir):
        return G.check(lines(table(spark, sf_dir, "documents"), registry), registry)

    run.__name__ = f"rules_{registry.removeprefix('h2_')}"
    run.__doc__ = f"The registry {registry} against its keys, types and rules."
    scenarios = [("", {}), *SCENARIOS[registry]]
    broken = ", ".join(f"({i}, '{rule}')" for i, s in enumerate(scenarios) for rule in s[0].split())
    QUERIES[run.__name__] = run
    ORACLES[run.__name__] = f"SELECT 'r' || doc_id AS record_key, rule_id FROM documents JOIN (VALUES {broken}) t(k, rule_id) ON doc_id % {len(scenarios)} = k"


for _name in G.REGISTRIES:
    _seeded(_name)
