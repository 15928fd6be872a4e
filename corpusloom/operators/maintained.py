"""Totals of a keyed table that follow its commits: what left counts against them, what came counts for them; nothing else is read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.keyed import KeyedStore


def totals_store(spark: SparkSession, path: str, schema: T.StructType, groups: Sequence[str], sums: Sequence[str] = (), buckets: int = 4) -> KeyedStore:
    """Where totals are kept: a row for each combination of the groups, with n and the sums, which are whole numbers."""
    fields = [*(T.StructField(g, schema[g].dataType) for g in groups), T.StructField("n", T.LongType()), *(T.StructField(f"sum_{c}", T.LongType()) for c in sums)]
    return KeyedStore(spark, path, T.StructType(fields), list(groups), buckets)


def signed(old: DataFrame, new: DataFrame, groups: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Rows as they were and as they are → what each group's totals change by; groups that stay are left out. Summed before the shuffle, so a hot group is a row a task."""
    marked = old.select(*groups, *sums, F.lit(-1).cast("long").alias("_s")).unionByName(new.select(*groups, *sums, F.lit(1).cast("long").alias("_s")))
    change = marked.groupBy(*groups).agg(F.sum("_s").alias("n"), *(F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0)) * F.col("_s")).alias(f"sum_{c}") for c in sums))
    moved = F.col("n") != 0
    for c in sums:
        moved = moved | (F.col(f"sum_{c}") != 0)
    return change.where(moved)


def _same(groups: Sequence[str]) -> Column:
    out = F.lit(True)
    for g in groups:
        out = out & F.col(g).eqNullSafe(F.col("_" + g))
    return out


def follow(table: KeyedStore, totals: KeyedStore, groups: Sequence[str], sums: Sequence[str] = ()) -> int:
    """Bring totals to the table's current version; that version. They name the version they hold, so what a lost run has not folded in is folded in
    by the next, once. A version must not be vacuumed before the totals have left it behind."""
    at = totals._version(None)
    since = int(at["name"].rpartition("-")[2]) if at else None
    current = table._version(None)
    until = current["version"] if current else 0
    if until == (since or 0):
        return until
    change = signed(*table.between(since or None, until), groups, sums)
    names = ["n", *(f"sum_{c}" for c in sums)]
    known = totals.read().select(*(F.col(g).alias("_" + g) for g in groups), *(F.col(c).alias("_" + c) for c in names))
    both = change.join(known, _same(groups), "left")
    rows = both.select(*groups, *((F.col(c) + F.coalesce("_" + c, F.lit(0))).alias(c) for c in names))
    totals.commit(rows.where("n > 0"), rows.where("n <= 0").select(*groups), name=f"version-{until}")
    return until
