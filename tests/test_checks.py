from lexmill.operators import checks as C


def first(df):
    return sorted(r[0] for r in df.collect())


def test_keys_and_values(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 2, None), ("b", 2, "y"), ("c", 3, None)], "k string, n int, v string")
    assert first(C.duplicated(rows, "k", "n")) == ["a", "b"] and first(C.duplicated(rows, "k", "n", "v")) == ["a"]
    assert first(C.several_values(rows, "k", "v")) == ["b"]
    assert first(C.shared(rows, spark.createDataFrame([("c",), ("z",)], "k string"), "k")) == ["c"]
    ids = spark.createDataFrame([("item-1", "10.1/X", None), ("it-10.1/x", "10.1/X", ""), ("item-phys", None, "Phys")], "id string, doi string, journal string")
    assert first(C.telling_ids(ids, "id", "doi", "journal")) == ["it-10.1/x", "item-phys"]
    assert C.duplicated(rows.limit(0), "k").count() == 0


def test_answers_hashes_and_versions(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    answers = spark.createDataFrame([("a", "h"), ("a", "h"), ("b", "h"), ("d", "h")], "k string, v string")
    assert first(C.wrong_count(items, answers, "k")) == ["b", "c"]
    assert first(C.differing(answers, spark.createDataFrame([("a", "h"), ("b", None)], "k string, v string"), "k", "v")) == ["b"]
    new = spark.createDataFrame([("a", "h"), ("a", "h"), ("b", "i"), ("d", "h"), ("e", "h")], "k string, v string")
    assert first(C.overwritten(answers, new, "k")) == ["b"] and C.overwritten(answers, answers, "k").count() == 0


def test_probability(spark):
    rows = [("s", True, 2, 0.5), ("s", False, 2, 0.5), ("t", True, 3, 1.0), ("u", True, 1, None), ("v", True, 2, 0.5), ("v", True, 2, 0.5)]
    frame = spark.createDataFrame(rows, "stratum string, selected boolean, stratum_population_size long, inclusion_probability double")
    assert first(C.wrong_probability(frame, "stratum")) == ["t", "u", "v"]


def test_conflicts(spark):
    kinds = [("n1", "annotation", "C1", None, None), ("n2", "annotation", "C1", None, None), ("n3", "annotation", "C2", None, None), ("j", "annotation_adjudication", None, None, None), ("g1", "grnti_assignment", None, ("s1",), None), ("g2", "grnti_assignment", None, ("s2",), None)]
    lists = {"agreed": ["n1", "n2", "g1", "g2"], "ruled": ["j", "g1", "g2"], "differ": ["n1", "n3", "g1", "g2"], "one source": ["j", "g1"], "missing": ["j", "g1", "g2", "zz"], "none": None}
    rows = kinds + [(k, "grnti_conflict_resolution", None, None, v) for k, v in lists.items()]
    labels = spark.createDataFrame(rows, "label_record_id string, record_type string, annotator_decision string, grnti_assignment struct<assignment_source_id:string>, source_label_record_ids array<string>")
    assert first(C.broken_conflicts(labels)) == ["differ", "missing", "none", "one source"]
