import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.incremental import counters_of, outcome_rows, run_counters
from corpusloom.queries import _committed, _ingested
from corpusloom.sources.keyed import KeyedStore
from corpusloom.sources.store import Locked

from .test_queries import SF


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def store_of(spark, path, buckets=8):
    return KeyedStore(spark, f"file://{path}", "k long, v string", "k", buckets)


def pairs(spark, of):
    return spark.createDataFrame(sorted(of.items()), "k long, v string")


def test_versions_follow_the_commits(spark, tmp_path):
    store, want, states = store_of(spark, tmp_path / "s"), {}, []
    assert store.read().count() == 0 and store.current() is None and store.versions() == [] and store.vacuum() == [] and store.compact() == []
    for k in range(6):
        new = {i: f"{k}-{i}" for i in range(k * 7, 60, k + 1)}
        gone = set(range(k, 60, 11)) if k else set()
        store.commit(pairs(spark, new), spark.createDataFrame([(i,) for i in sorted(gone)], "k long") if k else None)
        want = {i: v for i, v in want.items() if i not in gone} | new
        states.append(sorted(want.items()))
        if k == 3:
            assert store.compact(0.0)  # the content stays
            states.append(states[-1])
    assert store.versions() == list(range(1, 8))
    for version, state in enumerate(states, 1):
        assert rows(store.read(version)) == sorted(state, key=repr)
    assert rows(store.read()) == sorted(states[-1], key=repr)
    keys = spark.createDataFrame([(3,), (4,)], "k long")
    assert {r.k for r in store.beside(keys).collect()} <= dict(states[-1]).keys() and {3, 4} & dict(states[-1]).keys() <= {r.k for r in store.beside(keys).collect()}
    assert store.vacuum(1) and store.versions() == [7] and rows(store.read()) == sorted(states[-1], key=repr)
    with pytest.raises(ValueError):
        store.read(3)


def test_a_commit_writes_its_share(spark, tmp_path):
    store = store_of(spark, tmp_path / "s")
    store.commit(spark.range(100_000).selectExpr("id AS k", "sha2(cast(id AS string), 256) AS v"))
    whole = size(tmp_path / "s")
    store.commit(spark.range(0, 100_000, 100).selectExpr("id AS k", "sha2(cast(-id AS string), 256) AS v"))
    assert size(tmp_path / "s") - whole < 0.03 * whole
    store.commit(spark.range(1).selectExpr("id AS k", "'one' AS v"))
    touched = [f for f in os.listdir(tmp_path / "s") if f.startswith("changes")]
    assert min(len(list((tmp_path / "s" / f).glob("_bucket=*"))) for f in touched) == 1  # one key, one bucket
    plan = store.read(buckets=[5])._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan and "PartitionFilters" in plan


def test_only_worn_buckets_are_rewritten(spark, tmp_path):
    store = store_of(spark, tmp_path / "s")
    store.commit(spark.range(1000).selectExpr("id AS k", "'a' AS v"))
    one = spark.range(1000).selectExpr("id AS k", "'b' AS v").withColumn("b", store.bucket()).where("b = 2").drop("b")
    store.commit(one)
    before = rows(store.read())
    assert store.compact(0.5) == [2] and rows(store.read()) == before and store.compact(0.5) == []
    again = KeyedStore(spark, f"file://{tmp_path}/s", "k long, v string", "k", 99)
    assert again.buckets == 8 and rows(again.read()) == before  # the number of buckets is the store's own
    store.replace(one)
    assert rows(store.read()) == rows(one)


def test_names_nulls_and_locks(spark, tmp_path):
    store = store_of(spark, tmp_path / "s")
    first = spark.createDataFrame([(None, "none"), (1, None)], "k long, v string").withColumn("extra", F.lit(1))
    assert store.commit(first, name="batch-0") == 1 == store.commit(pairs(spark, {9: "x"}), name="batch-0")
    store.commit(spark.createDataFrame([(None, "other")], "k long, v string"), spark.createDataFrame([(1,), (1,), (7,)], "k long"), name="batch-1")
    assert rows(store.read()) == [(None, "other")]
    store.commit(pairs(spark, {5: "both"}), spark.createDataFrame([(5,), (None,)], "k long"))  # of a key in both the row counts
    assert rows(store.read()) == [(5, "both")]
    store.commit(pairs(spark, {}))
    assert rows(store.read()) == [(5, "both")]
    with pytest.raises(ValueError):
        store.commit()
    with store.lock(), pytest.raises(Locked):
        with store.lock():
            pass


@pytest.mark.parametrize("most", [0, 100_000])
def test_changes_of_any_number(spark, tmp_path, monkeypatch, most):
    from corpusloom.sources import keyed

    monkeypatch.setattr(keyed, "BROADCAST_KEYS", most)
    store = KeyedStore(spark, f"file://{tmp_path}/s", "a string, b int, v int", ["a", "b"], 3)
    store.commit(spark.range(50).selectExpr("cast(id % 5 AS string) AS a", "cast(id AS int) AS b", "1 AS v"))
    store.commit(spark.range(20).selectExpr("cast(id % 5 AS string) AS a", "cast(id AS int) AS b", "2 AS v"), spark.range(40, 45).selectExpr("cast(id % 5 AS string) AS a", "cast(id AS int) AS b"))
    assert store.read().groupBy("v").count().orderBy("v").collect() == [(1, 25), (2, 20)]


def test_counters_are_those_of_the_rows(spark):
    """What is observed while the state is written is what a recount gives."""
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    records, state = _ingested(spark, SF)
    of = lambda where: records.where(where).select(F.col("id").alias("record_id"))
    args = (_committed(records, state), of("n_chars % 7 = 0"), of("quality = 0"))
    assert outcome_rows(records, state, *args).agg(*counters_of()).collect() == run_counters(records, *args).collect()


def test_one_evaluation_of_a_run(spark, tmp_path):
    """Texts are chunked and embedded once, whatever is counted and written."""
    import datetime as dt

    from corpusloom.__main__ import stores
    from corpusloom.plans.pipeline import ingest_into

    from .test_sources_and_runs import COUNTERS, records_and_texts

    seen = spark.sparkContext.accumulator(0)

    class Counting:
        dim = 4

        def embed(self, texts):
            import numpy as np

            seen.add(len(texts))
            return np.ones((len(texts), 4), np.float32)

    records, texts = records_and_texts(spark)
    s = stores(spark, f"file://{tmp_path}")
    s["records"].commit(records)
    stats = ingest_into(s, texts, F.lit(dt.datetime(2025, 1, 1)), embedder=Counting())
    assert stats == COUNTERS | {"records_seen": 2, "metadata_ingested": 2, "judgment_pdf_ingested": 1}
    assert seen.value == s["index"].read().count() == 5
    assert ingest_into(s, texts, F.lit(dt.datetime(2025, 1, 2)), embedder=Counting()) == COUNTERS | {"records_seen": 2, "unchanged": 2} and seen.value == 5
    broken = texts.withColumns({"text": F.lit(None).cast("string"), "error": F.lit("broken")})
    s["records"].commit(records.where("id = 'A'").withColumn("judgment_pdf_sha256", F.lit("s2")))
    assert ingest_into(s, broken, F.lit(dt.datetime(2025, 1, 3)), embedder=Counting())["errors"] == 1
    assert [tuple(r)[:3] for r in s["dead"].read().collect()] == [("conversion", "judgment_pdf/A", "broken")]
    assert ingest_into(s, texts, F.lit(dt.datetime(2025, 1, 4)), embedder=Counting())["judgment_pdf_ingested"] == 1 and s["dead"].read().count() == 0


def test_a_page_that_cannot_be_parsed_is_a_row(spark, tmp_path, monkeypatch):
    import datetime as dt

    from corpusloom.__main__ import stores
    from corpusloom.plans import scrape
    from corpusloom.sources import html

    s = stores(spark, f"file://{tmp_path}")
    page = spark.createDataFrame([(2025, "<p>")], "year int, html string")

    def gives_up(page, table_id):
        raise AssertionError("no way")

    with monkeypatch.context() as m:
        m.setattr(html, "listing_cells", gives_up)
        rows_ = html.parsed_rows(page, "html", lambda p: gives_up(p, ""), html.LISTING_ROW, errors=True)
        assert [(r.year, r.serial, r.error) for r in rows_.collect()] == [(2025, None, "AssertionError: no way")]
    broken = lambda *_, **__: page.select("year", *(F.lit(None).cast(f.dataType).alias(f.name) for f in html.listing_records(page).schema if f.name != "year"), F.lit("AssertionError: no way").alias("error"))
    with monkeypatch.context() as m:
        m.setattr(scrape, "listing_records", broken)
        got = scrape.scrape_year(page, 2025, s["records"], F.lit(dt.datetime(2025, 1, 1)), dead=s["dead"])
    assert got["failed"] and got["parsed"] == 0 and [tuple(r)[:3] for r in s["dead"].read().collect()] == [("page", "2025", "AssertionError: no way")]
