"""Mixing sources to target weights by hash-threshold histograms.

Token counts are summed by source and hash bucket; the bucket in which a source's
budget runs out is refined by the next bits of the hash, and so on, until a single
hash value remains. The result is a threshold for each source: documents are then
taken by comparing their hash, without sorting them. Thresholds nest: a larger
budget takes a superset. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.summary import sorted_rank
from ..sources.scratch import ROWS_A_FILE
from .common import WORD_SQL, discard, shuffle_partitions, stored, tidy

#: Bits of the 60-bit hash that each level of the histogram looks at.
LEVELS = (10, 14, 36)
HASH_BITS = sum(LEVELS)
#: Up to so many sources (one short row each) the thresholds are broadcast; beyond, joined by shuffle.
BROADCAST_SOURCES = 10_000


def doc_hash(id_col: str):
    """60 bits of md5 of the id as text; null ids hash as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(source, source_size) → the same with target: water level times weight, at most `most` times the size.

    Sources in code-point order, null last, weigh weights[0], weights[1], ... repeating. The level at which the targets sum to share × all
    sizes is found by rounds: sources that the level lifts above their cap get the cap, and the others share the rest by weight. A
    round is one aggregate over the sources, which sends three numbers; their order comes from range partitions. So any number of sources will do.
    """
    parts = max(1, min(shuffle_partitions(totals.sparkSession), totals.count() // ROWS_A_FILE))
    ranked = sorted_rank(totals.withColumn("last", F.col("source").isNull()), ["last", "source"], parts)
    w = F.element_at(F.array(*(F.lit(x).cast("long") for x in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    t = stored(ranked.select("source", "source_size", w.alias("w"), (F.col("source_size") * most).alias("cap")), "mix-weights")
    level, n_capped = None, 0
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("w") > F.col("cap")
        row = t.agg(
            F.sum("source_size").alias("total"), F.sum(F.when(capped, F.col("cap")).otherwise(0)).alias("capped"),
            F.sum(F.when(capped, 0).otherwise(F.col("w"))).alias("open"), F.count_if(capped).alias("n"),
        ).head()
        if level is not None and (row["n"] == n_capped or not row["open"]):
            break
        n_capped = row["n"]
        level = (share * (row["total"] or 0) - row["capped"]) / row["open"] if row["open"] else 0.0
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("w")) if row["open"] else F.col("cap").cast("double")
    return t.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = (),
) -> DataFrame:
    """docs → id, size, source_size, target, taken and the columns in carry.

    size: words of the text (null: 0). taken: words of the document in the mix, repeats counted:
    every document of a source is taken floor(target / source_size) times; the remaining budget takes the
    documents whose hash is below the source's threshold once more, and the rows that share the hash
    at the threshold split what is then left in proportion to their size. So a source's taken words miss
    its target by less than one word for each row at the threshold, and no document exceeds `most` times its size.
    Equal inputs give equal results in any partitioning. Null sources are a source; empty texts take 0;
    rows with one id (or none) share a hash, so they are decided together. An empty table gives no rows.

    Cost: one pass over the texts, which leaves (id, source, size, hash) in the shared folder; three
    aggregations of it, pre-aggregated before the shuffle; carried columns are read in one more pass, not stored; a hot source is at most 2^10 rows of its histogram.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_SQL)), F.lit(0)).cast("long")
    carried = {c: f"_carried_{k}" for k, c in enumerate(carry)}
    whole = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), doc_hash(id_col).alias("h"), *(F.col(c).alias(k) for c, k in carried.items()))
    with tidy(docs.sparkSession):
        rows = stored(whole.drop(*carried.values()), "mix-sizes")
        sums = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
        n = sums.count()
        goal = source_targets(sums, weights, share, most)
        repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
        goal = goal.withColumn("repeats", repeats).withColumn("rest", F.floor(F.col("target")).cast("long") - F.col("repeats") * F.col("source_size"))
        #: low: all hashes below it are taken; width: the bits that are not yet decided.
        goal = stored(goal.withColumn("low", F.lit(0).cast("long")), "mix-goals", n)
        discard(sums)
        small = n <= BROADCAST_SOURCES

        def with_goal(df: DataFrame, g: DataFrame) -> DataFrame:
            g = g.withColumnRenamed("source", "s")
            return df.join(F.broadcast(g) if small else g, F.col("source").eqNullSafe(F.col("s"))).drop("s")

        left = HASH_BITS
        for bits in LEVELS:
            inside = with_goal(rows, goal.select("source", "low")).where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + F.lit(1 << left)))
            left -= bits
            bucket = F.shiftright(F.col("h") - F.col("low"), left)
            hist = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
            below = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
            hist = with_goal(hist.withColumn("below", below), goal)
            #: The last bucket that begins within the budget holds the threshold.
            edge = hist.where(F.col("below") <= F.col("rest")).groupBy("source").agg(F.max(F.struct("bucket", "below", "words")).alias("e"))
            finer = goal.withColumnRenamed("source", "s").join(edge, F.col("s").eqNullSafe(F.col("source")), "left").select(
                F.col("s").alias("source"), "source_size", "target", "repeats",
                (F.col("rest") - F.coalesce("e.below", F.lit(0))).alias("rest"),
                (F.col("low") + F.shiftleft(F.coalesce("e.bucket", F.lit(0)), left)).alias("low"),
                F.coalesce("e.words", F.lit(0)).alias("edge"),
            )
            finer = stored(finer if left == 0 else finer.drop("edge"), "mix-goals", n)
            discard(goal)
            goal = finer
    partly = F.when(F.col("edge") > 0, F.floor(F.col("size") * F.least(F.lit(1.0), F.col("rest") / F.col("edge")))).otherwise(0).cast("long")
    more = F.when(F.col("h") < F.col("low"), F.col("size")).when(F.col("h") == F.col("low"), partly).otherwise(0)
    taken = F.least(F.col("repeats") * F.col("size") + more, most * F.col("size"))
    result = with_goal(whole if carry else rows, goal)
    return result.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), *(F.col(k).alias(c) for c, k in carried.items()))
