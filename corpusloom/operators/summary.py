"""Counters of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored


def yearly_counters(rows: DataFrame, year: str, outcome: str, names: list[str]) -> DataFrame:
    """One row per year: parsed, and a counter for each outcome."""
    return rows.groupBy(year).agg(F.count("*").alias("parsed"), *(F.count_if(F.col(outcome) == n).alias(n) for n in names))


def run_summary(counters: DataFrame, year: str, failed: str) -> DataFrame:
    """One row: sums of all counters and the failed years in order. counters has a row per year of a run."""
    sums = [c for c, kind in counters.dtypes if kind == "bigint" and c != year]
    return counters.agg(*(F.sum(c).alias(c) for c in sums), F.sort_array(F.collect_list(F.when(F.col(failed), F.col(year)))).alias("failed"))


def sorted_rank(rows: DataFrame, order: list, parts: int) -> DataFrame:
    """rows with their global rank from 1, without gathering them in one task.

    One range exchange deals and sorts the rows; what it dealt is written with each row's partition and number within it, so that the counts
    before a partition (one row each) and the rows that they are added to come from the same deal. Rows that are equal in order are
    ranked in any order.
    """
    within = (1 << 33) - 1  # the bits of monotonically_increasing_id that number the rows of a partition
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    ranked = dealt.join(F.broadcast(before), part == F.col("_p"))
    return ranked.withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit(within)) + 1).drop("_at", "_p", "_before")
