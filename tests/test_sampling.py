"""Ranks, quotas, samples and resampling against plain versions; nulls, ties, repeated rows and empty tables."""

import random

import numpy as np
from pyspark.sql import functions as F

from lexmill.functions.text import uniform
from lexmill.operators import bootstrap as B
from lexmill.operators import ranks as K
from lexmill.operators import sampling as M
from lexmill.operators import source_only as O


def test_ranks_in_strata_with_nulls_ties_and_repeats(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)]
    df = spark.createDataFrame(rows, "s string, k long").withColumn("rank", F.lit("clash"))
    out = K.ranked(df.drop("rank"), ["s"], uniform(1, F.col("k")), "k", buckets=7).collect()
    for s, n in (("a", 3), (None, 2), ("b", 1)):
        here = [r for r in out if r["s"] == s]
        assert sorted(r["rank"] for r in here) == list(range(1, n + 1)) and {r["population"] for r in here} == {n}
    assert K.ranked(df.drop("rank").limit(0), ["s"], uniform(1, F.col("k")), "k").count() == 0
    wide = spark.range(5000).withColumn("s", F.lit("x"))
    got = [r["id"] for r in K.ranked(wide, ["s"], uniform(3, F.col("id")), "id", buckets=16).orderBy("rank").collect()]
    assert got == [r["id"] for r in wide.orderBy(uniform(3, F.col("id")), "id").collect()]


def test_ranks_by_value_and_ntile(spark):
    draw = random.Random(2)
    rows = [(k, None if k % 50 == 0 else draw.choice((5, 5, 5, draw.randrange(1000)))) for k in range(997)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = {r["k"]: r["rank"] for r in K.by_value(df, "v", "k", parts=13).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert got == {k: n for n, (k, _) in enumerate(order, 1)}
    tiles = spark.range(1, 24).select("id", K.ntile(F.col("id"), F.lit(23), 10).alias("t")).orderBy("id")
    assert [r["t"] for r in tiles.collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3, *(t for t in range(4, 11) for _ in range(2))]
    assert K.by_value(df.limit(0), "v", "k").count() == 0


def test_quotas_add_up(spark):
    sizes = spark.createDataFrame([("a", 700), ("b", 201), ("c", 99), (None, 1000)], "s string, population long")
    out = K.largest_remainder(sizes, ["s"], {"x": 1600, "y": 200, "z": 200}).collect()
    assert [sum(r[f"upto_{p}"] for r in out) for p in "xyz"] == [1600, 1800, 2000]
    assert all(r["upto_z"] == r["population"] for r in out)
    few = K.largest_remainder(sizes.where("s = 'c'"), ["s"], {"x": 1600, "y": 200, "z": 200}).first()
    assert (few["upto_x"], few["upto_z"]) == (79, 99)


def test_class_split_keeps_its_limits(spark):
    rows = [(k, f"C{1 + k % 5}", "big" if k % 7 else f"s{k % 3}") for k in range(6000)]
    split = M.class_split(spark.createDataFrame(rows, "work_id long, h2_class_id string, source_id string"), 5).cache()
    sizes = {(r["h2_class_id"], r["part"]): r["count"] for r in split.groupBy("h2_class_id", "part").count().collect()}
    assert all(sizes[f"C{c}", p] == n for c in range(1, 6) for p, n in M.CLASS_PARTS.items())
    assert M.split_faults(split).count() == 0 and split.select("work_id").distinct().count() == split.count()


def test_bootstrap_draws_as_many_as_there_are(spark):
    units = spark.createDataFrame([(k, "a" if k < 30 else None, float(k)) for k in range(50)], "k long, cell string, v double")
    out = B.draws(units, ["cell"], "k", 9, 7)
    assert {(r["b"], r["cell"]): r["n"] for r in out.groupBy("b", "cell").agg(F.sum("times").alias("n")).collect()} == {(b, c): n for b in range(1, 8) for c, n in (("a", 30), (None, 20))}
    centre = B.interval(B.means(units, ["cell"], "k", F.col("v"), 9, 400)).first()
    assert abs(centre["centre"] - 24.5) < 0.5 and centre["low"] < 24.5 < centre["high"]
    grid = units.select("k").crossJoin(spark.range(3).withColumnRenamed("id", "seed")).withColumn("d", F.col("k") * 1.0 + F.col("seed"))
    assert abs(B.interval(B.crossed(grid, ["seed", "k"], "d", 4, 200)).first()["centre"] - 25.5) < 1.5


def _nodes(plan):
    yield plan
    kind, children = plan.getClass().getSimpleName(), plan.children()
    below = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [children.apply(k) for k in range(children.size())]
    for b in below:
        yield from _nodes(b)


def _most_sent(df):
    """Rows of the largest table that the driver sent to all tasks, once `df` was collected."""
    plan = df._jdf.queryExecution().executedPlan()
    return max((p.metrics().apply("numOutputRows").value() for p in _nodes(plan) if p.getClass().getSimpleName() == "BroadcastExchangeExec"), default=0)


def test_bootstrap_draws_are_not_sent_by_the_driver(spark):
    units = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "a").alias("cell"), (F.col("id") % 7).cast("double").alias("v"))
    out = B.means(units, ["cell"], "id", F.col("v"), 5, 50)
    assert {r["b"] for r in out.collect()} == set(range(1, 51))
    assert _most_sent(out) <= 3000


def test_bootstrap_ci_sends_no_draws_and_agrees_with_its_sql(spark, tmp_path):
    import duckdb

    from lexmill.plans.queries import ORACLES, QUERIES

    docs = [(k, "en" if k < 2000 else f"l{k % 5}", "big" if k < 2000 else f"s{k}" if k > 2490 else f"s{k % 3}") for k in range(2500)]
    spark.createDataFrame(docs, "doc_id long, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(2500).selectExpr("id as doc_id", "cast(id % 4 as int) as quality", "cast(id % 11 = 0 as int) as toxic").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    out = QUERIES["bootstrap_ci"](spark, str(tmp_path))
    got = [tuple(r) for r in out.collect()]
    assert _most_sent(out) <= 2500
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == db.execute(ORACLES["bootstrap_ci"]).fetchall()


def test_bootstrap_ci_does_not_send_the_labels(spark, tmp_path):
    from lexmill.plans.queries import QUERIES

    spark.range(5000).selectExpr("id as doc_id", "'en' as lang", "'s' as source").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(5000).selectExpr("id as doc_id", "1 as quality", "cast(id % 11 = 0 as int) as toxic").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    out = QUERIES["bootstrap_ci"](spark, str(tmp_path))
    assert [r["replicates"] for r in out.collect()] == [50]
    assert _most_sent(out) <= K.BUCKETS  # offsets of ranks


def test_bootstrap_draws_as_written_plainly(spark):
    rows = [(k, None if k % 5 == 0 else "ab"[k % 2], k % 4 and float(k) or None) for k in range(60)] + [(7, "b", 7.0), (60, "alone", 1.0)]
    units = spark.createDataFrame(rows, "k long, cell string, v double")
    cells = {}
    for r in units.withColumn("u", uniform(3, F.col("k"))).collect():
        cells.setdefault(r["cell"], []).append((r["u"], r["k"], r["v"]))
    slots = spark.createDataFrame([(b, c, i, len(x)) for c, x in cells.items() for b in range(1, 10) for i in range(1, len(x) + 1)], "b int, cell string, i long, n long")
    plain = {}
    for r in slots.withColumn("u", uniform(3, F.col("b"), F.col("cell"), F.col("i"))).collect():
        _, k, v = sorted(cells[r["cell"]], key=lambda x: x[:2])[min(int(r["u"] * r["n"]) + 1, r["n"]) - 1]
        plain[k, r["cell"], v, r["b"]] = plain.get((k, r["cell"], v, r["b"]), 0) + 1
    got = {}
    for r in B.draws(units, ["cell"], "k", 3, 9).collect():
        at = r["k"], r["cell"], r["v"], r["b"]
        got[at] = got.get(at, 0) + r["times"]
    assert got == plain
    assert B.draws(units.limit(0), ["cell"], "k", 3, 9).count() == 0


def test_classifier_finds_what_the_source_tells():
    x = np.array([[1, 0], [0, 1]] * 2, float)
    w = O.fit(x, np.array([0, 1, 1, 0]), np.array([90.0, 90.0, 10.0, 10.0]), 2)
    p = np.exp(np.hstack([x[:2], np.ones((2, 1))]) @ w)
    p /= p.sum(axis=1, keepdims=True)
    assert abs(p[0, 0] - 0.9) < 0.03 and abs(p[1, 1] - 0.9) < 0.03


def test_source_only_scores(spark):
    rows = [(k, f"C{1 + k % 2}", f"s{k % 2 if k % 10 else 5}", "early", k % 3) for k in range(400)]
    out = O.scores(spark.createDataFrame(rows, "work_id long, h2_class_id string, journal_id string, period string, decile long"), 1, repeats=2).collect()
    assert len(out) == 2 and all(r["macro_f1"] > 0.9 for r in out)


def test_spans_pairs_and_sources_left_out(spark):
    from lexmill.operators import pairs as X

    found = spark.createDataFrame([(1, 1, 0.0, 10.0), (1, 1, 0.0, 10.0), (1, 2, 4.0, 14.0), (2, 1, 0.0, 10.0), (None, 1, 0.0, 1.0)], "doc long, i long, start double, end double")
    gold = spark.createDataFrame([(1, 7, 1.0, 11.0), (1, 8, 30.0, 40.0), (2, 9, 6.0, 16.0), (None, 1, 0.0, 1.0)], "doc long, j long, start double, end double")
    assert [(r["doc"], r["i"], r["j"], round(r["iou"], 3)) for r in X.match_spans(found, gold).collect()] == [(1, 1, 7, 0.818)]
    rows = spark.createDataFrame([(k, k % 3 == 0, None if k > 7 else "b") for k in range(12)], "k long, marked boolean, bucket string")
    assert sorted((r["marked"], r["control"], r["bucket"]) for r in X.matched(rows, F.col("marked"), ["bucket"], "k").collect() if r["bucket"]) == [(0, 1, "b"), (3, 2, "b"), (6, 4, "b")]
    works = spark.createDataFrame([(f"s{k % 2}", f"C{k % 4}") for k in range(100)] + [("few", "C0")], "source string, c string")
    got = X.leave_out(works, "source", "c", 50, 2, 10).collect()
    assert {r["held_out"] for r in got} == {"s0", "s1"} and sum(r["test"] for r in got) == 100 and all(r["test"] + r["train"] == (26 if r["c"] == "C0" else 25) for r in got)
    assert X.masks(spark.createDataFrame([(1, "a b c d"), (2, None)], "k long, t string"), "k", F.split("t", " "), 2, 0.5).count() == 4


def test_agreement_of_empty_and_equal_answers(spark):
    from lexmill.operators import agreement as A

    pairs = spark.createDataFrame([("C1", "C1"), ("C1", "C2"), (None, "C1")], "a string, b string")
    table = A.cells(pairs, "a", "b", ("C1", "C2", "C3"))
    assert table.count() == 9 and {(r["a"], r["b"]): r["n"] for r in table.collect()}[("C1", "C2")] == 1
    assert A.kappa(A.cells(pairs.where("a = b"), "a", "b", ("C1", "C2"))).first()["kappa"] is None
    assert A.kappa(A.cells(pairs.limit(0), "a", "b", ("C1", "C2"))).first()["observed"] is None
    scores = {r["c"]: r for r in A.class_scores(A.cells(spark.createDataFrame([("C1", "C1"), ("C1", "OTHER"), ("C2", "C1")], "a string, b string"), "a", "b", A.OUTCOMES), ("C1", "C2")).collect()}
    assert (scores["C1"]["tp"], scores["C1"]["fn"], scores["C1"]["fp"], scores["C2"]["f1"]) == (1.0, 1.0, 1.0, 0.0)


def test_profiles(spark):
    from lexmill.operators import profile as P

    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, `odd name` long")
    assert [(r["name"], r["type"], r["known"], r["missing"]) for r in P.columns(rows).collect()] == [("k", "string", 3, 0), ("odd name", "bigint", 2, 1)]
    assert {r["k"]: r["verdict"] for r in P.quotas(rows, "k", 0.4, 0.6, 2).collect()} == {"a": "above", "b": "below"}
    assert {r["verdict"] for r in P.quotas(rows, "k", groups=3).collect()} == {"too few"} and P.quotas(rows.limit(0), "k").count() == 0
