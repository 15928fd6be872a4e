"""What differs between two versions of a table, by trees of hashes over key ranges.

A table is stored in ranges of its key, with a tree above them: a leaf has order-free hashes of the rows of its range, an inner node those of its children.
Two trees over the same ranges are compared from the root down, and only below nodes that differ; only the ranges of differing leaves are read and joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import tidy

#: Children of a node, and levels of nodes below the root: FANOUT ** DEPTH ranges.
FANOUT, DEPTH = 16, 2
ADDED, REMOVED, CHANGED = "added", "removed", "changed"
_HASHES = ("n", "x", "low", "high")


def range_bounds(rows: DataFrame, key: str, fanout: int = FANOUT, depth: int = DEPTH) -> list:
    """Keys that part the rows into about equal ranges: fanout ** depth - 1 of them at most, ascending."""
    n = fanout**depth
    got = rows.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 10 * n).alias("b")).head()["b"]
    return sorted(set(got or []))


def leaf_of(key: Column, bounds: list, fanout: int = FANOUT) -> Column:
    """Number of the range: how many bounds are at most the key (null: 0). Sought among every fanout-th bound first."""
    if not bounds:
        return F.lit(0)
    coarse, every = bounds[fanout - 1 :: fanout], F.array(*map(F.lit, bounds))
    under = lambda own: F.size(F.filter(own, lambda b: b <= key))
    first = under(F.array(*map(F.lit, coarse))) * fanout if coarse else F.lit(0)
    return F.when(key.isNull(), 0).otherwise(first + under(F.slice(every, first + 1, F.lit(fanout - 1)))).cast("int")


def _sums() -> list[Column]:
    """Hashes of many nodes or rows as one, whatever their order; equal rows count as often as they are there."""
    return [F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.pmod(F.sum("low"), F.lit(1 << 32)).alias("low"), F.pmod(F.sum("high"), F.lit(1 << 32)).alias("high")]


def write_ranges(rows: DataFrame, key: str, path: str, bounds: list, fanout: int = FANOUT, depth: int = DEPTH) -> None:
    """Store rows by range (path/rows) and the tree above them (path/tree). Any order and dealing of the rows gives the same tree."""
    with tidy(rows.sparkSession):
        _write_ranges(rows, key, path, bounds, fanout, depth)


def _write_ranges(rows: DataFrame, key: str, path: str, bounds: list, fanout: int, depth: int) -> None:
    columns = rows.columns
    kept = rows.withColumn("_leaf", leaf_of(F.col(key), bounds, fanout))
    kept.repartitionByRange(key).sortWithinPartitions("_leaf", key).write.partitionBy("_leaf").parquet(f"{path}/rows")
    spark = rows.sparkSession
    stored = spark.read.schema(kept.schema).parquet(f"{path}/rows")
    h = F.xxhash64(*columns)
    hashed = stored.select(F.col("_leaf").alias("node"), F.lit(1).cast("long").alias("n"), h.alias("x"), h.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"), F.shiftrightunsigned(h, 32).alias("high"))
    nodes = hashed.groupBy("node").agg(*_sums()).withColumn("level", F.lit(depth))
    nodes.write.partitionBy("level").parquet(f"{path}/tree")
    for level in range(depth - 1, -1, -1):
        below = _level(spark, path, level + 1)
        below.withColumn("node", F.floor(F.col("node") / fanout).cast("int")).groupBy("node").agg(*_sums()).withColumn("level", F.lit(level)).write.mode("append").partitionBy("level").parquet(f"{path}/tree")


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema("node int, n long, x long, low long, high long, level int").parquet(f"{path}/tree").where(F.col("level") == level).drop("level")


def differing_leaves(spark: SparkSession, old: str, new: str, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(node) of the leaves that differ, found from the root down."""
    differ = None
    for level in range(depth + 1):
        a, b = (_level(spark, p, level) for p in (old, new))
        if differ is not None:
            parents = F.broadcast(differ.select(F.col("node").alias("_up")))  # fanout ** level nodes at most, by the depth
            a, b = (t.join(parents, F.floor(F.col("node") / fanout) == F.col("_up"), "left_semi") for t in (a, b))
        b = b.select(F.col("node").alias("_node"), *(F.col(c).alias("_" + c) for c in _HASHES))
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col("_" + c)) for c in _HASHES])
        differ = a.join(b, F.col("node") == F.col("_node"), "full_outer").where(~same).select(F.coalesce("node", "_node").alias("node"))
    return differ


def changes(spark: SparkSession, old: str, new: str, key: str, schema: T.StructType, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(key, change) of two tables that `write_ranges` stored with the same bounds: added, removed or changed. Keys are unique; a null key is one of them.

    Only the folders of differing ranges are read; their numbers are known before the plan is made.
    """
    leaves = [r["node"] for r in differing_leaves(spark, old, new, fanout, depth).collect()]  # fanout ** depth at most
    columns = [f.name for f in schema]

    def side(path: str, name: str) -> DataFrame:
        rows = spark.read.schema(T.StructType([*schema, T.StructField("_leaf", T.IntegerType())])).parquet(f"{path}/rows")
        return rows.where(F.col("_leaf").isin(leaves)).select(F.col(key).alias(name), F.xxhash64(*columns).alias(f"{name}_hash"), F.lit(True).alias(f"{name}_there"))

    both = side(old, "was").join(side(new, "is"), F.col("was").eqNullSafe(F.col("is")), "full_outer")
    change = F.when(F.col("was_there").isNull(), ADDED).when(F.col("is_there").isNull(), REMOVED).when(F.col("was_hash") != F.col("is_hash"), CHANGED)
    return both.select(F.when(F.col("was_there"), F.col("was")).otherwise(F.col("is")).alias(key), change.alias("change")).where("change IS NOT NULL")
