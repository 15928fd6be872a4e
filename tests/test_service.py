import pytest
from pyspark.sql import functions as F

from corpusloom.plans import service
from corpusloom.schemas import CHUNK, RECORD
from corpusloom.sources.keyed import KeyedStore
from corpusloom.sources.store import Locked


def test_job_order_lock_and_status(spark, tmp_path):
    store = KeyedStore(spark, f"file://{tmp_path}/records", RECORD, "id")
    ran = []
    good = service.run_job(lambda: ran.append("s") or {"n": 1}, lambda: ran.append("i") or {"m": 2}, store)
    assert good.ok and ran == ["s", "i"] and service.as_dict(good)["stats"] == {"scrape": {"n": 1}, "ingest": {"m": 2}}

    def fails():
        raise RuntimeError("down")

    bad = service.run_job(fails, lambda: ran.append("never"), store)
    assert not bad.ok and bad.errors == {"scrape": "RuntimeError: down"} and "never" not in ran
    with store.lock(), pytest.raises(Locked):
        service.run_job(dict, dict, store)
    assert service.health({"records": store}) == {"status": "ok", "stores": {"records": False}}
    assert service.ingest_status({"records": store}) == {"records": 0}


def test_chat_over_stores(spark, tmp_path):
    stores = {
        "index": KeyedStore(spark, f"file://{tmp_path}/index", CHUNK + ", embedding array<float>, ingested_at timestamp", "chunk_id"),
        "records": KeyedStore(spark, f"file://{tmp_path}/records", RECORD, "id"),
    }
    assert service.chat(stores, "anything")["sources"] == []
    with pytest.raises(ValueError):
        service.chat(stores, "x", top_k=21)
    with pytest.raises(ValueError):
        service.chat(stores, "x", chunk_type="pdf")


def test_page_and_vector_reports(spark):
    pages = spark.createDataFrame([(2010, "<p>"), (2011, "<p>")], "year int, html string")
    records = spark.createDataFrame([(2010,)], "year int")
    assert [r.year for r in service.suspicious_pages(pages, records).collect()] == [2011]
    index = spark.range(2).select(F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    assert service.vector_check(index, 2)["ok"] and service.vector_check(index, 3)["other_dimension"] == 2
