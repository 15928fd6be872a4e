"""Idempotent upserts of an ordered feed into a keyed snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"


#: Rows of one key that a task orders; a hotter key is dealt by ranges of the sequence.
ROWS_A_RANGE = 1_000_000
#: Up to so many keys of a batch are broadcast to the snapshot.
BROADCAST_KEYS = 100_000


def ranges_of(feed: DataFrame, key: str) -> int:
    """Ranges of the sequence that the hottest key needs: see `outcomes`."""
    most = feed.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).head()["n"] or 0
    return max(1, -(-most // ROWS_A_RANGE))


def outcomes(feed: DataFrame, key: str, seq: str, hash_col: str, stored: DataFrame | None = None, ranges: int = 1) -> DataFrame:
    """feed → feed with outcome, in order of seq within a key; equal hashes (also two NULLs) are unchanged.

    stored: (key, hash_col) of the snapshot, of which each row precedes the feed. A row needs its predecessor only, so with
    ranges > 1 the rows of a key are dealt by ranges of seq: a key that a third of the feed has is many groups, and the
    first row of each takes its predecessor from the last one of the range before, of which there is one a range and key.
    """
    rows = feed.withColumn("_fed", F.lit(True))
    if stored is not None:
        rows = rows.unionByName(stored.select(key, hash_col, F.lit(False).alias("_fed")), allowMissingColumns=True)
    bounds = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        bounds = sorted(set(feed.agg(F.percentile_approx(seq, shares).alias("b")).head()["b"] or []))
    place = sum((F.when(F.col("_fed") & (F.col(seq) > b), 1).otherwise(0) for b in bounds), F.lit(0))
    rows = rows.withColumn("_part", place)
    order = (F.col("_fed"), F.col(seq))
    w = Window.partitionBy(key, "_part").orderBy(*order)
    rows = rows.withColumns({"_first": F.row_number().over(w) == 1, "_prev": F.lag(hash_col).over(w)})
    none = F.lit(None).cast(rows.select(F.struct(F.col(hash_col).alias("h"))).schema[0].dataType)
    if bounds:
        last = rows.groupBy(key, "_part").agg(F.max_by(F.struct(F.col(hash_col).alias("h")), F.struct(*order)).alias("_last"))
        last = last.select(F.col(key).alias("_k"), F.col("_part").alias("_q"), F.lag("_last").over(Window.partitionBy(key).orderBy("_part")).alias("_before"))
        rows = rows.join(last, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_q")), "left").drop("_k", "_q")
    else:
        rows = rows.withColumn("_before", none)
    before = F.when(F.col("_first"), F.col("_before")["h"]).otherwise(F.col("_prev"))
    outcome = F.when(F.col("_first") & F.col("_before").isNull(), INSERTED).when(before.eqNullSafe(F.col(hash_col)), UNCHANGED).otherwise(UPDATED)
    return rows.withColumn("outcome", outcome).where("_fed").drop("_fed", "_part", "_first", "_prev", "_before")


def snapshot(feed: DataFrame, key: str, seq: str, at: str, hash_col: str, site: Sequence[str], carried: Sequence[str] = (), stored: DataFrame | None = None, ranges: int = 1, untouched: bool = True) -> DataFrame:
    """The snapshot after the feed: key, site fields, carried fields, first_seen_at, last_seen_at, updated_at.

    Site fields are those of the last row that was inserted or updated; carried fields keep their last non-null value, so a
    failed download never blanks a path; keys that the feed does not mention pass through (or are left out: untouched). Nothing is deleted.
    Aggregations only: each key is reduced on the map side to a few values before the shuffle, whatever its rows;
    whether a row changes anything needs its predecessor: see `outcomes`, also for ranges.
    """
    rest = None
    if stored is not None:  # the window orders the feed's keys only; all others pass through
        keys = feed.select(F.col(key).alias("_k")).distinct()
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
        same = F.col(key).eqNullSafe(F.col("_k"))
        stored, rest = stored.join(keys, same, "left_semi"), stored.join(keys, same, "left_anti")
    rows = outcomes(feed, key, seq, hash_col, stored, ranges)
    changed = F.col("outcome") != UNCHANGED
    order = F.col(seq)

    def last(c: str, when: Column) -> Column:
        return F.max_by(F.col(c), F.when(when, order))

    new = rows.groupBy(key).agg(
        *(last(c, changed).alias(c) for c in site),
        *(last(c, F.col(c).isNotNull()).alias(c) for c in carried),
        F.min_by(at, order).alias("first_seen_at"),
        F.max_by(at, order).alias("last_seen_at"),
        last(at, changed).alias("updated_at"),
        F.count_if(changed).alias("_changes"),
    )
    if stored is None:
        return new.drop("_changes")
    old = stored.select(F.col(key).alias("_key"), *(F.col(c).alias("_" + c) for c in (*site, *carried, "first_seen_at", "last_seen_at", "updated_at")))
    both = new.join(old, F.col(key).eqNullSafe(F.col("_key")), "left")
    touched = both.select(
        key,
        *(F.when(F.col("_changes") > 0, F.col(c)).otherwise(F.col("_" + c)).alias(c) for c in site),
        *(F.coalesce(c, "_" + c).alias(c) for c in carried),
        F.coalesce("_first_seen_at", "first_seen_at").alias("first_seen_at"),
        F.coalesce("last_seen_at", "_last_seen_at").alias("last_seen_at"),
        F.coalesce("updated_at", "_updated_at").alias("updated_at"),
    )
    return touched if not untouched else touched.unionByName(rest.select(key, *site, *carried, "first_seen_at", "last_seen_at", "updated_at"))


def set_fields(table: DataFrame, patches: DataFrame, key: str, fields: Sequence[str], nulls: bool = False) -> DataFrame:
    """Patch single columns: non-null patch values win, or with nulls all of them; patches of unknown keys do nothing. One patch row per key."""
    p = patches.select(F.col(key), *(F.col(f).alias("_p_" + f) for f in fields), F.lit(True).alias("_patched"))
    joined = table.join(p, key, "left")
    value = lambda c: F.when(F.col("_patched"), F.col("_p_" + c)).otherwise(F.col(c)) if nulls else F.coalesce("_p_" + c, c)
    return joined.select(*(value(c).alias(c) if c in fields else F.col(c) for c in table.columns))


def last_per_key(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """Of rows with one key the last in order, by aggregation of whole rows."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.max_by(whole, order).alias("r")).select("r.*")


def content_owner(rows: DataFrame, id_col: str, sha: Column) -> DataFrame:
    """Content-addressed memo: for each row its sha, the least id with that content, and whether that is another row.

    The owner is an aggregate that is joined back, so content that a third of all rows share is combined before the shuffle
    and its join can be split.
    """
    keyed = rows.select(F.col(id_col), sha.alias("sha256"))
    owners = keyed.groupBy("sha256").agg(F.min(id_col).alias("owner_id"))
    return keyed.join(owners, "sha256").select(id_col, "sha256", "owner_id", (F.col(id_col) != F.col("owner_id")).alias("cached"))
