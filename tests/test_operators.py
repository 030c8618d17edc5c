import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import layout as L
from lexmill.operators import resolve as R
from lexmill.operators.rules import ADJUDICATION_FORM, ANNOTATION_FORM, ARTIFACTS, AUDIT_RUN, LABELS, RIGHTS, violations


def page(two_from=None, h=1650, w=1275):
    gray = np.full((h, w), 255, np.uint8)
    gray[100:, 60 : w - 60] = 0
    if two_from is not None:
        gray[two_from:, int(w * 0.42) : int(w * 0.58) + 1] = 255
    return gray


@pytest.mark.parametrize(("two_from", "number", "expect"), [(None, 0, 792.0), (600, 0, None), (1600, 0, 792.0), (None, 1, 0.0)])
def test_split(spark, two_from, number, expect):
    gray = page(two_from)
    df = spark.createDataFrame([(gray.shape[1], gray.shape[0], bytearray(gray.tobytes()), 792.0, number)], "w int, h int, gray binary, height double, page int")
    got = df.select(L.split_y("w", "h", "gray", "height", "page").alias("y")).first()["y"]
    if expect is None:
        assert abs(got - (600 * 72 / 150 + 10)) <= 12 * 72 / 150
    else:
        assert got == expect


def test_clips_and_assembly(spark):
    df = spark.createDataFrame([(600.0, 800.0, 100.0, "a", "", "c")], "w double, h double, t double, x string, y string, z string")
    clips = df.select(L.column_clips(F.col("w"), F.col("h"), F.col("t")).alias("c")).first()["c"]
    assert (clips[0]["x1"], clips[1]["x0"], clips[0]["y0"]) == (293.0, 307.0, 100.0)
    assert df.select(L.assembled(F.col("x"), F.col("y"), F.col("z")).alias("s")).first()["s"] == "a\n\nc"
    boxes = df.select(L.column_clips(F.col("w"), F.col("h"), F.col("t")).alias("c")).select(L.intersection(F.col("c")[0], F.col("c")[1]).alias("i"))
    assert boxes.first()["i"] is None


def test_rights(spark):
    scopes = spark.createDataFrame([("a1", "g", "s", "j", "w")], "artifact string, source_group string, source string, journal string, work string")
    rows = [("r1", "source", "s", "ml", "allowed", "2024", None, None), ("r2", "work", "w", "ml", "prohibited", "2023", None, None), ("r3", "artifact", "a1", "ml", "allowed", "2023", "2020-01-01", None), ("r4", "journal", "j", "copy", "allowed", "2023", None, None), ("r5", "journal", "j", "copy", "prohibited", "2024", None, "r4")]
    rights = spark.createDataFrame(rows, "rights_record_id string, scope_type string, scope_id string, operation string, status string, created_at string, rights_expires_at string, supersedes_rights_record_id string")
    got = {r["operation"]: r["rights_record_id"] for r in R.effective_rights(scopes, rights, "2024-06-01").collect()}
    assert got == {"ml": "r2", "copy": "r5"}


def test_consensus(spark):
    rows = [("i1", "annotation", "C1", None), ("i1", "annotation", "C1", None), ("i2", "annotation", "C4", None), ("i2", "annotation", "C5", None), ("i2", "annotation_adjudication", None, "C4"), ("i3", "annotation", "C1", None), ("i3", "annotation", "C2", None)]
    got = {r["annotation_item_id"]: (r["decision"], r["disagreement"], r["invalid"]) for r in R.consensus(spark.createDataFrame(rows, "annotation_item_id string, record_type string, annotator_decision string, adjudicated_decision string")).collect()}
    assert got == {"i1": ("C1", False, False), "i2": ("C4", True, False), "i3": (None, True, True)}


def test_splits_and_keys(spark):
    rows = [("w1", "mlm", "train"), ("w1", "classification", "train"), ("w2", "mlm", "train"), ("w2", "mlm", "test")]
    df = spark.createDataFrame(rows, "work_id string, task string, split string")
    assert [r["work_id"] for r in R.split_violations(df).collect()] == ["w2"]
    assert R.missing(df, "work_id", spark.createDataFrame([("w1",)], "id string"), "id").count() == 2
    sample = R.stratified(df, ["split"], "work_id", 1, 3)
    assert sorted((r["split"], round(r["inclusion_probability"], 3)) for r in sample.collect()) == [("test", 1.0), ("train", 0.333)]


def test_listings(spark):
    archive = spark.createDataFrame([('<a href="/ru/articles/1999/9/">x</a><a href="/ru/articles/1999/10/">y</a><a href="/ru/articles/1999/9/">z</a>',)], "html string")
    assert [r["path"] for r in R.issue_paths(archive).collect()] == ["/ru/articles/1999/9/", "/ru/articles/1999/10/"]
    assert [r["path"] for r in R.issue_paths(archive, 1, numeric=True).collect()] == ["/ru/articles/1999/10/"]
    issue = spark.createDataFrame([("/i/", '<a href="/i/a/">One</a><a href="/i/a/">Last\n one</a><a href="/i/b/"></a><a href="/j/a/">no</a>')], "issue_path string, html string")
    assert {r["path"]: r["title"] for r in R.article_paths(issue).collect()} == {"/i/a/": "Last one", "/i/b/": None}
    docs = spark.createDataFrame([("/i/", f"/i/{k}/", "t" * 80) for k in "abc"] + [("/j/", "/j/a/", "t")], "issue_path string, path string, text string")
    assert R.capped(docs, 2).count() == 2 and R.capped(docs, 0, 0).count() == 0 and R.capped(docs).count() == 3


def test_label_rules(spark):
    form = spark.createDataFrame([("ok", None, None, None, None), ("bad", "C1", "high", None, "t")], "id string, annotator_decision string, confidence string, decision_rationale string, completed_at string")
    assert [r["record_key"] for r in violations(form, "id", ANNOTATION_FORM).collect()] == ["bad"]
    run = spark.createDataFrame([("r", 30, 200, ["a", "a"])], "id string, calibration_size long, audit_size long, annotator_ids array<string>")
    assert [r["rule_id"] for r in violations(run, "id", AUDIT_RUN).collect()] == ["C28"]
    schema = (
        "id string, record_type string, grnti_assignment struct<code:string,is_primary_explicit:boolean,assignment_source_type:string>, h2_class_id string, label_status string, label_verification_status string, annotator_id string, annotator_decision string,"
        "confidence string, decision_rationale string, adjudicator_id string, adjudicated_decision string, adjudication_reason string, adjudication_kind string, source_label_record_ids array<string>, evidence_bundle_sha256 string,"
        "label_provenance string, grnti_conflict_outcome string"
    )
    code = ("g", "grnti_assignment", ("29.27.01", True, "publisher"), "C4", "eligible", "verified", *[None] * 10, "publisher_explicit_grnti", None)
    note = ("n", "annotation", None, None, "pending", "pending", "p", "C4", "high", "why", *[None] * 6, "none", None)
    rule = ("j", "annotation_adjudication", None, "C4", "eligible", "verified", None, None, None, None, "q", "C4", "why", "annotator_disagreement", ["a", "b"], None, "expert_adjudicated", None)
    other = (*rule[:3], None, "other_class", *rule[5:11], "OTHER", *rule[12:])
    clash = ("k", "grnti_conflict_resolution", None, None, "conflict_excluded", "rejected", None, None, None, None, "q", None, "why", "grnti_conflict", ["a", "b", "c"], "e", "none", "catalog_rejected")
    item = "audit_id audit_frame_version candidate_frame_id annotation_item_id task_batch_id labeling_guide_version input_sha256 completed_at".split()

    def labels(rows):
        return spark.createDataFrame(rows, schema).withColumns({c: F.when(F.col("record_type") != "grnti_assignment", F.lit("x")) for c in item})

    assert violations(labels([code, note, rule, other, clash]), "id", LABELS).count() == 0
    wrong = [(*code[:3], "C5", *code[4:]), (*code[:16], "bibliographic_grnti", None), (*note[:8], None, *note[9:]), (*rule[:14], ["a"], *rule[15:]), (*other[:4], "eligible", *other[5:]), (*clash[:14], ["a"], *clash[15:]), (*clash[:17], "catalog_confirmed")]
    assert sorted(r["rule_id"] for r in violations(labels(wrong), "id", LABELS).collect()) == ["C18", "C19", "C21", "C22", "C23", "C24", "C25"]


def test_rights_artifact_and_form_rules(spark):
    rights = spark.createDataFrame(
        [("a", "ml_training", "conditional", "lawful_access_research_assumption", ["c"]), ("b", "redistribution", "allowed", "lawful_access_research_assumption", []), ("c", "checkpoint_release", "allowed", "unknown", [])],
        "id string, operation string, status string, basis_type string, rights_conditions array<string>",
    ).selectExpr("*", "cast(null as string) as acquisition_method", "cast(null as string) as acquisition_scope", "cast(null as array<string>) as derivative_scope")
    assert sorted((r["record_key"], r["rule_id"]) for r in violations(rights, "id", RIGHTS).collect()) == [("b", "C12"), ("b", "C14"), ("c", "C13"), ("c", "C14")]
    sha = "0" * 64
    good = ("a", "eligible", "retrieved", ["x"], ["r"], f"sha256:{sha}", sha, "p", 1, "succeeded", "passed", None, None, "title_abstract", sha, "v1", "passed")
    schema = (
        "id string, processing_status string, acquisition_status string, retrievals array<string>, rights_record_ids array<string>, artifact_id string, sha256 string, path string, bytes long, extraction_status string, qa_status string,"
        "error_code string, error_detail string, content_role string, h2_input_sha256 string, label_leakage_audit_version string, label_leakage_audit_status string"
    )
    bad = [("b", *good[1:10], "failed", *good[11:]), ("c", *good[1:16], "failed")]
    assert [(r["record_key"], r["rule_id"]) for r in violations(spark.createDataFrame([good, *bad], schema), "id", ARTIFACTS).collect()] == [("b", "C7"), ("c", "C8")]
    schema = "id string, adjudication_kind string, source_decisions array<struct<record_type:string>>, grnti_evidence array<string>, evidence_bundle_sha256 string, adjudicated_decision string, grnti_conflict_outcome string"
    two, one = [("annotation",)] * 2, [("annotation_adjudication",)]
    forms = [("a", "annotator_disagreement", two, [], None, "C1", None), ("b", "grnti_conflict", one, ["x", "y"], "e", None, "catalog_rejected"), ("c", "grnti_conflict", [("annotation",)], ["x", "y"], "e", None, "catalog_rejected")]
    assert [r["record_key"] for r in violations(spark.createDataFrame(forms, schema), "id", ADJUDICATION_FORM).collect()] == ["c"]
