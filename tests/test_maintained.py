import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import maintained
from corpusloom.sources.keyed import KeyedStore

SCHEMA = "k long, g string, v long, w string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("compacts", [False, True])
def test_totals_equal_a_recount(spark, tmp_path, compacts):
    """After runs that insert, replace, move between groups, delete, and change nothing; also when runs are skipped or buckets rewritten between."""
    rng = np.random.default_rng(4)
    store = KeyedStore(spark, f"file://{tmp_path}/t", SCHEMA, "k", 4)
    totals = maintained.totals_store(spark, f"file://{tmp_path}/n", store.schema, ["g"], ["v"])
    assert maintained.follow(store, totals, ["g"], ["v"]) == 0
    for run in range(5):
        keys = rng.choice(60, 25, replace=False)
        new = [(int(k), None if k % 7 == 0 else f"g{rng.integers(0, 4)}", None if k % 11 == 0 else int(rng.integers(0, 100)), "x") for k in keys]
        gone = [(int(k),) for k in rng.choice(60, 10)] if run else [(99,)]
        store.commit(spark.createDataFrame(new, SCHEMA), spark.createDataFrame(gone, "k long"))
        if compacts and run in (1, 3):
            store.compact(0.0)
        if run == 2:
            continue  # a run whose totals were lost
        version = maintained.follow(store, totals, ["g"], ["v"])
        recount = store.read().groupBy("g").agg(F.count("*").alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("sum_v"))
        assert rows(totals.read()) == rows(recount) and version == store.versions()[-1]
        before = totals.versions()
        assert maintained.follow(store, totals, ["g"], ["v"]) == version and totals.versions() == before  # nothing twice


def test_only_changes_are_read(spark, tmp_path):
    store = KeyedStore(spark, f"file://{tmp_path}/t", SCHEMA, "k", 16)
    store.commit(spark.range(10_000).selectExpr("id AS k", "cast(id % 3 AS string) AS g", "id AS v", "'w' AS w"))
    store.commit(spark.range(2).selectExpr("id AS k", "'new' AS g", "id AS v", "'w' AS w"), spark.range(5, 6).selectExpr("id AS k"))
    old, new = store.between(1)
    assert {r.k for r in old.collect()} == {0, 1, 5} and {r.k for r in new.collect()} == {0, 1}
    assert [len(x.collect()) for x in store.between(2)] == [0, 0] and store.between(None)[1].count() == 9_999
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan.split("PartitionFilters")[1]


def test_a_bucket_that_became_empty(spark, tmp_path):
    store = KeyedStore(spark, f"file://{tmp_path}/t", SCHEMA, "k", 8)
    store.commit(spark.range(8).selectExpr("id AS k", "'g' AS g", "id AS v", "'w' AS w"))
    totals = maintained.totals_store(spark, f"file://{tmp_path}/n", store.schema, ["g"], ["v"])
    maintained.follow(store, totals, ["g"], ["v"])
    store.commit(None, spark.range(8).selectExpr("id AS k"))
    store.compact(0.0)
    maintained.follow(store, totals, ["g"], ["v"])
    assert totals.read().count() == 0 == store.read().count()
