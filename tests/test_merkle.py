import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import merkle


def brute(old, new):
    out = {k: "removed" for k in old.keys() - new.keys()} | {k: "added" for k in new.keys() - old.keys()}
    return out | {k: "changed" for k in old.keys() & new.keys() if old[k] != new[k]}


def compared(spark, tmp_path, old, new, kind="long"):
    frame = lambda rows: spark.createDataFrame([(k, v, 1) for k, v in rows.items()], f"k {kind}, v string, w int")
    a, b = frame(old), frame(new)
    bounds = merkle.range_bounds(a, "k", 4, 3)
    merkle.write_ranges(a, "k", f"{tmp_path}/a", bounds, 4, 3)
    merkle.write_ranges(b.repartition(7), "k", f"{tmp_path}/b", bounds, 4, 3)
    got = {r.k: r.change for r in merkle.changes(spark, f"{tmp_path}/a", f"{tmp_path}/b", "k", a.schema, 4, 3).collect()}
    return got, {r.node for r in merkle.differing_leaves(spark, f"{tmp_path}/a", f"{tmp_path}/b", 4, 3).collect()}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_changes_are_those_of_the_full_join(spark, tmp_path, kind):
    key = str if kind == "string" else int
    old = {key(k): f"v{k}" for k in range(500)} | {None: "null"}
    new = {k: v for k, v in old.items() if k is None or int(k) % 50 != 7} | {key(k): "new" for k in (3, 4, 5)} | {key(-9): "x", key(900): None}
    got, leaves = compared(spark, tmp_path, old, new, kind)
    assert got == brute(old, new) and leaves


def test_equal_and_empty_tables(spark, tmp_path):
    old = {k: f"v{k}" for k in range(300)}
    assert compared(spark, tmp_path / "1", old, dict(reversed(old.items()))) == ({}, set())
    assert compared(spark, tmp_path / "2", old, {})[0] == brute(old, {})
    assert compared(spark, tmp_path / "3", {}, old)[0] == brute({}, old)
    assert compared(spark, tmp_path / "4", {}, {}) == ({}, set())


def test_only_differing_ranges_are_read(spark, tmp_path):
    old = {k: f"v{k}" for k in range(6400)}
    got, leaves = compared(spark, tmp_path, old, old | {k: "new" for k in range(3000, 3020)})
    assert len(got) == 20 and 1 <= len(leaves) <= 2
    df = merkle.changes(spark, f"{tmp_path}/a", f"{tmp_path}/b", "k", spark.createDataFrame([], "k long, v string, w int").schema, 4, 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)  # of the two scans
    assert len(filters) == 2 and all({int(x) for x in re.findall(r"(?:= |IN \(|,)(\d+)", f)} == leaves for f in filters)


def test_leaf_numbers(spark):
    bounds = [3, 5, 9, 20, 21, 30, 31, 33, 90]
    rows = spark.range(-2, 100).select("id", merkle.leaf_of(F.col("id"), bounds, 3).alias("leaf")).collect()
    assert all(r.leaf == sum(b <= r.id for b in bounds) for r in rows)
    assert spark.range(1).select(merkle.leaf_of(F.col("id"), []).alias("x")).head().x == 0
