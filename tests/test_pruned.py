import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import pruned
from corpusloom.operators.retrieval import top_k_batch


def clustered(spark, n=1500, dim=16, seed=1):
    """Vectors about 30 centres, with repeated, opposite, zero and null ones."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 30] * 3 + rng.normal(scale=0.3, size=dim)]) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(40)] + [(n + 50 + i, [-x for x in rows[i][1]]) for i in range(10)]
    rows += [(n + 70, [0.0] * dim), (n + 71, [0.0] * dim), (n + 72, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def asked(index):
    q = index.where("vec_id % 50 = 0 OR vec_id >= 1568 OR vec_id = 1551").where("embedding IS NOT NULL")
    return q.select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("question_embedding"))


def rows_of(df):
    return sorted((r.question_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def index(spark):
    return clustered(spark).cache()


@pytest.mark.parametrize("k,block", [(1, 1000), (5, 1000), (5, 7), (70, 1000)])
def test_pruned_answers_are_exact(spark, index, monkeypatch, k, block):
    monkeypatch.setattr(pruned, "QUESTIONS", block)
    q = asked(index)
    assert rows_of(pruned.top_k_pruned(pruned.pivot_index(index), q, k)) == rows_of(top_k_batch(index, q, k))


def test_pruned_answers_with_few_rows_or_pivots(spark, index):
    q = asked(index)
    few = index.where("vec_id < 3 OR vec_id > 1569")
    for pivots in (1, 2, None):
        assert rows_of(pruned.top_k_pruned(pruned.pivot_index(few, pivots=pivots), q, 5)) == rows_of(top_k_batch(few, q, 5))
    assert pruned.top_k_pruned(pruned.pivot_index(index.where("false")), q, 5).count() == 0
    assert pruned.top_k_pruned(pruned.pivot_index(index), q.where("false"), 5).count() == 0


def test_most_pairs_are_not_compared(spark, index):
    ix, q = pruned.pivot_index(index), asked(index).where("question_id % 50 = 0 AND question_id < 1500")
    assert pruned.compared_share(ix, q, 5) < 0.35
    plan = pruned.top_k_pruned(ix, q, 5)._jdf.queryExecution().executedPlan().toString()
    assert "In(pivot" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_many_copies_leave_few_candidates(spark):
    one = [0.3, 0.4, 0.5, 0.1]
    rows = [(i, one) for i in range(3000)] + [(5000 + i, [0.3, 0.4, 0.5, 0.1 + i / 1000]) for i in range(50)]
    copies = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    q = copies.where("vec_id < 3 OR vec_id = 5020").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("question_embedding"))
    assert rows_of(pruned.top_k_pruned(pruned.pivot_index(copies), q, 5)) == rows_of(top_k_batch(copies, q, 5))
    few = pruned._trimmed(np.full(1000, 0.25), np.arange(1000)[::-1], 5)
    assert sorted(few) == [995, 996, 997, 998, 999] and len(pruned._trimmed(np.full(1000, 0.00005), np.arange(1000), 5)) == 1000


@pytest.mark.parametrize("k,block", [(1, 1000), (5, 1000), (5, 7), (70, 1000)])
def test_coded_answers_are_exact(spark, index, monkeypatch, k, block):
    monkeypatch.setattr(pruned, "QUESTIONS", block)
    q = asked(index)
    assert rows_of(pruned.top_k_coded(pruned.coded_index(index), index, q, k)) == rows_of(top_k_batch(index, q, k))


def test_codes_are_small_and_bounds_hold(spark, index):
    codes = pruned.coded_index(index)
    for c, v in ((r.asDict(), r.embedding) for r in codes.join(index.withColumnRenamed("vec_id", "key"), "key").collect()):
        if v is not None:
            v = np.array(v, float)
            unit = v / (np.sqrt(v @ v) or 1)
            assert len(c["code"]) == len(v) and np.linalg.norm(unit - c["scale"] * np.frombuffer(bytes(c["code"]), np.int8)) <= c["off"] < 0.05
    assert pruned.top_k_coded(codes.where("false"), index, asked(index), 5).count() == 0 and pruned.top_k_coded(codes, index, asked(index).where("false"), 5).count() == 0
