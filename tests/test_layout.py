import pytest
from pyspark.sql import functions as F

from corpusloom.operators.incremental import changed_pieces
from corpusloom.sources.layout import BucketedTable


@pytest.fixture
def tables(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # or a small side would be broadcast
    docs = spark.range(4000).select(F.col("id"), (2010 + F.col("id") % 4).cast("int").alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    state = docs.where("id % 3 > 0").select("id", F.when(F.col("id") % 5 == 0, "old").otherwise(F.col("h")).alias("h"))
    records = BucketedTable(spark, "layout_records", f"file://{tmp_path}/r", docs.schema, "id", "year", 8)
    states = BucketedTable(spark, "layout_state", f"file://{tmp_path}/s", state.schema, "id", None, 8)
    records.overwrite(docs)
    states.overwrite(state)
    yield records, states, docs, state
    records.drop()
    states.drop()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_join_of_records_and_state_has_no_exchange(tables):
    records, states, docs, state = tables
    got = changed_pieces(records.read(), states.read(), ["h"], "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    got.collect()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # nor after adaptive planning
    plain = changed_pieces(docs, state, ["h"], "id")
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.collect()) == sorted(plain.collect())


def test_a_run_of_one_year_rewrites_its_partition(tables, tmp_path):
    records, states, docs, state = tables
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "r").rglob("*.parquet")}
    before = files()
    assert len(list((tmp_path / "r" / "year=2011").glob("*.parquet"))) == 8  # a file for each bucket
    records.overwrite(docs.where("year = 2012").withColumn("h", F.lit("new")))
    after = files()
    assert {p.parent.name for p in before.keys() ^ after.keys()} == {"year=2012"}
    assert records.read().groupBy("h").count().where("h = 'new'").head()["count"] == 1000 and records.read().count() == 4000
    pruned = records.read().where("year = 2012")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned
    states.overwrite(state.limit(10))
    assert states.read().count() == 10
