import random

import pytest
from oracle import check

from lexmill.plans.queries import ORACLES, QUERIES, flagship

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    check(spark, QUERIES[name], ORACLES[name], SF)


def test_flagship_has_rows(spark):
    assert flagship(spark, SF).count() > 0


def test_mrr_of_whole_vectors(spark, tmp_path):
    draw = random.Random(3)
    rows = [(k, [draw.uniform(-1, 1) * (0.1 if i < 8 else 1) for i in range(64)], k % 7) for k in range(1, 201)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]
    first = []
    for q, x, y in (r for r in rows if r[0] % 50 == 0):
        order = sorted((-round(sum(a * b for a, b in zip(x, v, strict=True)), 9), k, label) for k, v, label in rows if k != q)
        first.append(next(n for n, r in enumerate(order, 1) if r[2] == y))
    got = QUERIES["mrr_at_k"](spark, str(tmp_path)).first()
    assert got["mrr"] == pytest.approx(sum(1 / k for k in first) / len(first), abs=1e-6)
    assert got["accuracy_10"] == pytest.approx(sum(k <= 10 for k in first) / len(first), abs=1e-6)


def test_every_query_has_sql_but_the_classifier():
    assert set(QUERIES) - set(ORACLES) == {"source_only"}


def test_retrieval_in_blocks(spark, monkeypatch):
    from lexmill.plans import statistics

    whole = {tuple(r) for r in statistics.retrieval(spark, SF).collect()}
    monkeypatch.setattr(statistics, "QUERY_BLOCK", 3)
    assert {tuple(r) for r in statistics.retrieval(spark, SF).collect()} == whole and len(whole) == 10
