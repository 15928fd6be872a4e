import datetime as dt

from pyspark.sql import functions as F

from corpusloom.operators.upsert import outcomes
from corpusloom.streaming.outcomes import FORGOTTEN, with_outcomes, write_outcomes

SCHEMA = "k string, seq long, h string, at timestamp"


def feed_of(spark, n=300):
    h = F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") * F.col("id") % 3).cast("string"))
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 11).cast("string"))
    return spark.range(n).select(key.alias("k"), F.col("id").alias("seq"), h.alias("h"), F.timestamp_seconds("id").alias("at"))


def test_batches_restarts_and_replays(spark, tmp_path):
    feed, at = feed_of(spark), str(tmp_path)
    run = lambda: write_outcomes(with_outcomes(spark.readStream.schema(SCHEMA).parquet(f"{at}/in"), "k", "seq", "h"), f"{at}/out", f"{at}/ck")
    for k in range(3):
        feed.where(F.col("seq").between(100 * k, 100 * k + 99)).write.mode("append").parquet(f"{at}/in")
        run()  # a query of its own each time
    run()  # nothing new
    feed.where("seq < 30").write.mode("append").parquet(f"{at}/in")  # rows that were handled already
    run()
    want = outcomes(feed, "k", "seq", "h").select("k", "seq", "outcome")
    got = spark.read.parquet(f"{at}/out")
    assert got.columns == ["k", "seq", "outcome"] and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_idle_keys_are_forgotten(spark, tmp_path):
    at = str(tmp_path)
    time = lambda h: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=h)
    batches = [[("a", 1, "x", time(0)), ("b", 2, "y", time(0))], [("b", 3, "y", time(5))], [("b", 4, "y", time(10))], [("a", 5, "x", time(11))]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{at}/in")
        write_outcomes(with_outcomes(spark.readStream.schema(SCHEMA).parquet(f"{at}/in"), "k", "seq", "h", "at", "2 hours"), f"{at}/out", f"{at}/ck")
    got = [(r.seq, r.k, r.outcome) for r in spark.read.parquet(f"{at}/out").collect()]
    assert (1, "a", FORGOTTEN) in got and (5, "a", "inserted") in got and (3, "b", "unchanged") in got
