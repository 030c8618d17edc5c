"""Closed registries as JSON lines: declared keys, constants and types, checked on the parsed line.

A declaration gives each key a type; a line is parsed once to a variant, and every
check is a column on it.  Types: `=x` a constant, `id` a string that isn't empty, `text` any
string, `date`, `time`, `uri` strings, `sha` and `artifact` hashes, `code` a classifier's code,
`commit` seven characters or more, `int` from 0, `count` from 1, `share` over 0 up to 1, `bool`, `map` an object, `a|b` one of,
`{name}` an object of PARTS, `[type]` a list, `[type]!` without repeats, `[type]+` not empty
(`[type]2` of two, `[type]1` of one at most).  A `?` at the end allows null.

Formats are not enforced, as in the standard; patterns are.  A key that is absent
breaks the key rule only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rules as R

#: Objects within registries.
PARTS: dict[str, str] = {
    "retrieval": "retrieval_id id, retrieved_url uri, retrieved_at time, response_metadata_sha256 sha",
    "codeSignal": "code id, source_url uri, retrieved_at time, evidence_sha256 sha",
    "queryRef": "query_id id, query_version id",
    "sourceDecision": "label_record_id id, record_type annotation|annotation_adjudication, decision C1|C2|C3|C4|C5|OTHER|AMBIGUOUS|INSUFFICIENT, rationale id",
    "grntiEvidence": "label_record_id id, code code, assignment_source_type publisher|bibliographic_catalog, assignment_source_id id, source_url uri, evidence_sha256 sha, is_primary_explicit bool",
    "grntiAssignment": "code code, scheme_version id, assignment_source_type publisher|bibliographic_catalog, assignment_source_id id, source_url uri, retrieved_at time, evidence_sha256 sha, is_primary_explicit bool",
}
_DECISION = "C1|C2|C3|C4|C5|OTHER|AMBIGUOUS|INSUFFICIENT"
#: The keys of each registry with their types.
REGISTRIES: dict[str, str] = {
    "works": "schema_version =works-v1, created_at time, work_id id, work_aliases [id]!, source_group_id id, source_id id, platform text?, journal_id id, journal_title id, canonical_url uri, doi text?, edn text?, "
    "identity_confidence high|medium|low, title id, authors [text], abstract text?, keywords [text], published_at date?, language pair, genre research_article|review_article|short_communication|other, "
    "pacs_codes_raw [{codeSignal}], udc_codes_raw [{codeSignal}], publisher_section text?, duplicate_of_work_id text?, eligibility_status pending|eligible|rejected|quarantined, exclusion_reason text?, updated_at time",
    "artifacts": "schema_version =artifacts-v1, created_at time, artifact_record_id id, artifact_id artifact?, work_id id, parent_artifact_id text?, retrievals [{retrieval}], rights_record_ids [id]!, "
    "content_role full_text|title_abstract|metadata_only|formula_context, representation pdf|html|xml|json|rss|plain_text|ocr_text, mime_type text?, path text?, sha256 sha?, bytes int?, extraction_method text?, "
    "extraction_version text?, ocr_method text?, ocr_version text?, preprocessing_version text?, tokenizer_repo text?, tokenizer_revision text?, characters int?, words int?, subtokens int?, h2_input_sha256 sha?, "
    "label_leakage_audit_version text?, label_leakage_audit_status not_checked|passed|failed, acquisition_status discovered|rights_blocked|ready|retrieved|failed, extraction_status not_started|running|succeeded|failed, "
    "qa_status not_evaluated|passed|quarantined|failed, processing_status not_started|processed|eligible|rejected, error_code text?, error_detail text?, updated_at time",
    "rights": "schema_version =rights-v1, created_at time, rights_record_id id, scope_type source_group|source|journal|work|artifact, scope_id id, "
    "operation acquisition|storage|evaluation|ml_training|redistribution|derivatives_release|checkpoint_release, status allowed|conditional|permission_required|prohibited|unknown, access_basis id, "
    "basis_type explicit_license|written_permission|contract|statutory_exception|lawful_access_research_assumption|unknown, acquisition_method manual_download|api|crawler|platform_export|other?, "
    "acquisition_scope single|sample|bulk?, terms_url uri?, rights_checked_at date, derivative_scope [aggregate_metrics|identifiers|text_fragments|dataset]!?, rights_conditions [text], rights_evidence_sha256 sha?, "
    "rights_expires_at date?, supersedes_rights_record_id text?",
    "h2_labels": "schema_version =h2-labels-v1, label_record_id id, record_type grnti_assignment|annotation|annotation_adjudication|grnti_conflict_resolution, audit_id text?, audit_frame_version text?, "
    "candidate_frame_id text?, annotation_item_id text?, task_batch_id text?, input_sha256 sha?, evidence_bundle_sha256 sha?, work_id id, h2_scheme_version id, grnti_assignment {grntiAssignment}?, "
    "h2_class_id C1|C2|C3|C4|C5?, label_provenance publisher_explicit_grnti|bibliographic_grnti|expert_adjudicated|none, label_verification_status pending|verified|conflict|rejected, "
    f"label_status eligible|ambiguous_multilabel|other_class|insufficient|conflict_excluded|pending, annotator_id text?, annotator_decision {_DECISION}?, confidence high|medium|low?, labeling_guide_version text?, "
    f"decision_rationale text?, adjudicator_id text?, adjudicated_decision {_DECISION}?, adjudication_reason text?, source_label_record_ids [id]!, adjudication_kind annotator_disagreement|grnti_conflict?, "
    "grnti_conflict_outcome catalog_confirmed|catalog_rejected|unresolved_excluded?, completed_at time?, created_at time",
    "h2_audit_frame": "schema_version =h2-audit-frame-v1, frame_record_id id, audit_frame_version id, audit_id id, candidate_frame_id id, annotation_item_id text?, work_id id, "
    "candidate_class_id C1|C2|C3|C4|C5|BOUNDARY|OTHER, search_basis [publisher_grnti|bibliographic_grnti|pacs|udc|publisher_section|keywords|title_terms|manual_boundary|incomplete_metadata|synthetic_example|other]!+, "
    "query_refs [{queryRef}]!+, stratum_id id, stratum_assignment_rule id, stratum_population_size count, inclusion_probability share, selection_seed int, selection_role not_selected|calibration|audit, "
    "seen_by_annotators bool, allowed_classification_splits [train]!1, created_at time, source_manifest_sha256 sha",
    "h2_audit_run": "schema_version =h2-audit-run-v1, audit_id id, audit_frame_version id, candidate_frame_id id, h2_scheme_version id, calibration_labeling_guide_version id, audit_labeling_guide_version id, "
    "grnti_scheme_version id, query_version id, preprocessing_version id, input_serialization =utf8-nfc-title-lf2-abstract-lf-v1, selection_seed int, calibration_size int, audit_size int, annotator_ids [id]!2, "
    "adjudicator_id id, code_commit commit, grnti_reference_path id, grnti_reference_sha256 sha, grnti_excerpt_path id, grnti_excerpt_sha256 sha, calibration_labeling_guide_path id, "
    "calibration_labeling_guide_sha256 sha, audit_labeling_guide_path id, audit_labeling_guide_sha256 sha, decision_tree_path id, decision_tree_sha256 sha, query_manifest_path id, query_manifest_sha256 sha, "
    "preprocessing_rules_path id, preprocessing_rules_sha256 sha, source_candidate_manifest_path id, source_candidate_manifest_sha256 sha, created_at time",
    "h2_queries": "schema_version =h2-queries-v1, query_id id, query_version id, source_id id, query_type site_search|catalog_export|manual_index|api|other, query_text id, filters map, rights_record_id id, "
    "executed_at time, result_count int, response_sha256 sha, code_commit commit",
    "h2_annotation_form": "schema_version =h2-annotation-form-v1, task_batch_id id, audit_id id, audit_frame_version id, candidate_frame_id id, annotation_item_id id, h2_scheme_version id, blinded_title id, "
    f"blinded_abstract text?, labeling_guide_version id, input_sha256 sha, annotator_id id, annotator_decision {_DECISION}?, confidence high|medium|low?, decision_rationale text?, completed_at time?",
    "h2_adjudication_form": "schema_version =h2-adjudication-form-v1, task_batch_id id, audit_id id, audit_frame_version id, candidate_frame_id id, annotation_item_id id, h2_scheme_version id, "
    "adjudication_kind annotator_disagreement|grnti_conflict, blinded_title id, blinded_abstract text?, labeling_guide_version id, input_sha256 sha, evidence_bundle_sha256 sha?, adjudicator_id id, "
    f"source_decisions [{{sourceDecision}}]!, grnti_evidence [{{grntiEvidence}}]!, adjudicated_decision {_DECISION}?, grnti_conflict_outcome catalog_confirmed|catalog_rejected|unresolved_excluded?, "
    "adjudication_reason id, completed_at time",
}
#: Key column, and the rules beyond keys and types, of each registry.
KEYS = {"works": "work_id", "artifacts": "artifact_record_id", "rights": "rights_record_id", "h2_labels": "label_record_id", "h2_audit_frame": "frame_record_id", "h2_audit_run": "audit_id", "h2_queries": "query_id", "h2_annotation_form": "annotation_item_id", "h2_adjudication_form": "annotation_item_id"}
RULES = {"works": R.WORKS, "artifacts": R.ARTIFACTS, "rights": R.RIGHTS, "h2_labels": R.LABELS, "h2_audit_frame": R.FRAME, "h2_audit_run": R.AUDIT_RUN, "h2_queries": (), "h2_annotation_form": R.ANNOTATION_FORM, "h2_adjudication_form": R.ADJUDICATION_FORM}
#: Patterns of string types.
PATTERNS = {"id": "(?s).+", "pair": "(?s)..+", "sha": "^[0-9a-f]{64}\\z", "artifact": "^sha256:[0-9a-f]{64}\\z", "code": "^[0-9]{2}([.][0-9]{2}){1,2}\\z", "commit": "(?s).{7,}"}
_PLAIN = ("text", "date", "time", "uri")
_LIST = re.compile(r"\[(.*)\](!?)(\+|1|2)?$")


def fields(declaration: str) -> dict[str, str]:
    return dict(f.split(" ", 1) for f in declaration.split(", "))


def ddl(kind: str) -> str:
    """The Spark type of a declared one."""
    kind = kind.removesuffix("?")
    if m := _LIST.match(kind):
        return f"array<{ddl(m.group(1))}>"
    if kind.startswith("{"):
        return "struct<" + ", ".join(f"{k}: {ddl(t)}" for k, t in fields(PARTS[kind[1:-1]]).items()) + ">"
    return {"int": "bigint", "count": "bigint", "share": "double", "bool": "boolean", "map": "map<string, string>"}.get(kind, "string")


def _json_kind(v: str) -> str:
    return f"regexp_extract(schema_of_variant({v}), '^[A-Z]+', 0)"


def fits(kind: str, v: str, depth: int = 0) -> str:
    """SQL: whether the variant `v` is of a declared type."""
    if kind.endswith("?"):
        return f"({_json_kind(v)} = 'VOID' or {fits(kind[:-1], v, depth)})"
    text = f"variant_get({v}, '$', 'string')"
    if kind.startswith("="):
        return f"({_json_kind(v)} = 'STRING' and {text} = '{kind[1:]}')"
    if m := _LIST.match(kind):
        items, e = f"variant_get({v}, '$', 'array<variant>')", f"e{depth}"
        parts = [f"forall({items}, {e} -> {fits(m.group(1), e, depth + 1)})"]
        if m.group(2):
            parts.append(f"size(array_distinct(transform({items}, {e} -> to_json({e})))) = size({items})")
        if m.group(3):
            parts.append(f"size({items}) {dict(zip('+12', ('>= 1', '<= 1', '= 2')))[m.group(3)]}")
        return f"if({_json_kind(v)} = 'ARRAY', {' and '.join(parts)}, false)"
    if kind.startswith("{"):
        inner = fields(PARTS[kind[1:-1]])
        keys = f"array_sort(json_object_keys(to_json({v}))) = array({', '.join(repr(k) for k in sorted(inner))})"
        each = [fits(t, f"variant_get({v}, '$.{k}', 'variant')", depth) for k, t in inner.items()]
        return f"if({_json_kind(v)} = 'OBJECT', {' and '.join([keys, *each])}, false)"
    if kind in ("int", "count", "share"):
        number = f"variant_get({v}, '$', 'double')"
        test = {"int": f"{number} >= 0 and {number} = floor({number})", "count": f"{number} >= 1 and {number} = floor({number})", "share": f"{number} > 0 and {number} <= 1"}[kind]
        return f"if({_json_kind(v)} in ('BIGINT', 'DECIMAL', 'DOUBLE'), {test}, false)"
    if kind in ("bool", "map"):
        return f"{_json_kind(v)} = '{'BOOLEAN' if kind == 'bool' else 'OBJECT'}'"
    if kind in _PLAIN:
        return f"{_json_kind(v)} = 'STRING'"
    test = f"{text} rlike r'{PATTERNS[kind]}'" if kind in PATTERNS else f"{text} in ({', '.join(repr(x) for x in kind.split('|'))})"
    return f"({_json_kind(v)} = 'STRING' and {test})"


def typed(lines: DataFrame, registry: str) -> DataFrame:
    """The columns of a registry from lines (value string); what can't be read is null."""
    schema = ", ".join(f"{k} {ddl(t)}" for k, t in fields(REGISTRIES[registry]).items())
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a registry, blank ones left out."""
    return spark.read.text(path).where("trim(value) <> ''")


def check(lines: DataFrame, registry: str) -> DataFrame:
    """(record_key, rule_id): a row for every rule that a line breaks.

    C1 the key set, C2 the version, C3:key a type, then the registry's own rules; C0 a line that is no JSON object.
    Where a key is missing its own rules can't be judged: such a line has C1, and the types of the keys it has.
    """
    declared = fields(REGISTRIES[registry])
    parsed = lines.select("value", F.try_parse_json("value").alias("v"))
    names = ", ".join(repr(k) for k in declared)
    keys = "json_object_keys(value)"
    broken = [f"if({keys} is null, 'C0', if(size(array_except(array({names}), {keys})) = 0 and size(array_except({keys}, array({names}))) = 0, null, 'C1'))"]
    for k, t in declared.items():
        v = f"variant_get(v, '$.{k}', 'variant')"
        broken.append(f"if({v} is null or {fits(t, v)}, null, '{'C2' if k == 'schema_version' else f'C3:{k}'}')")
    shaped = parsed.select(F.get_json_object("value", f"$.{KEYS[registry]}").alias("record_key"), F.explode(F.expr(f"array_compact(array({', '.join(broken)}))")).alias("rule_id"))
    return shaped.unionByName(R.violations(typed(lines.where(f"size(array_except(array({names}), json_object_keys(value))) = 0"), registry), KEYS[registry], RULES[registry]))
