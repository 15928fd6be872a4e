"""Reports over the store, its files and its markdown: what is missing, orphaned, broken or owned twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, looks_like_pdf

#: Actions of the file audit (fixed values), in order of precedence.
CLEAR, DELETE, RENAME, BACKFILL = (
    "CLEAR (missing/empty file)",
    "DELETE + CLEAR (not real PDF content)",
    "RENAME to add .pdf extension -> ",
    "BACKFILL missing sha256 (file was fine, checksum wasn't recorded)",
)


def file_facts(content: Column) -> Column:
    """What the audit has to know of a file: is it filled, does it look like a PDF, its sha256. NULL for no file."""
    return F.when(content.isNotNull(), F.struct((F.length(content) > 0).alias("filled"), looks_like_pdf(content).alias("is_pdf"), F.sha2(content.cast("binary"), 256).alias("sha256")))


def _action(path: Column, filled: Column, is_pdf: Column, sha: Column) -> Column:
    return (
        F.when(blank_to_null(path).isNull(), None)
        .when(~F.coalesce(filled, F.lit(False)), CLEAR)
        .when(~is_pdf, DELETE)
        .when(~F.lower(path).endswith(".pdf"), F.concat(F.lit(RENAME), path, F.lit(".pdf")))
        .when(blank_to_null(sha).isNull(), BACKFILL)
    )


def audit_action(path: Column, content: Column, sha: Column) -> Column:
    """What a record's file needs; NULL: nothing, or no path. content is the file's, NULL if there is none."""
    return _action(path, F.length(content) > 0, looks_like_pdf(content), sha)


def action_by_facts(path: Column, facts: Column, sha: Column) -> Column:
    """The same from a file's facts (see `file_facts`), so that no content has to be joined."""
    return _action(path, facts["filled"], facts["is_pdf"], sha)


def _repaired(records: DataFrame, path: str, sha: str, action: Column, fresh: Column) -> DataFrame:
    cleared = action.isin(CLEAR, DELETE)
    return records.withColumns(
        {
            path: F.when(cleared, None).when(action.startswith(RENAME), F.concat(F.col(path), F.lit(".pdf"))).otherwise(F.col(path)),
            sha: F.when(cleared, None).when(action.isNotNull(), fresh).otherwise(F.col(sha)),
        }
    )


def repaired(records: DataFrame, path: str, sha: str, content: Column) -> DataFrame:
    """The records as the audit's actions leave them."""
    return _repaired(records, path, sha, audit_action(F.col(path), content, F.col(sha)), F.sha2(content.cast("binary"), 256))


def repaired_by_facts(records: DataFrame, path: str, sha: str, facts: Column) -> DataFrame:
    return _repaired(records, path, sha, action_by_facts(F.col(path), facts, F.col(sha)), facts["sha256"])


def cleared_count(actions: DataFrame, action: str = "action") -> DataFrame:
    return actions.agg(F.count_if(F.col(action).rlike("^(CLEAR|DELETE)")).alias("n_cleared"), F.count(action).alias("n_actions"))


def reconciled(files: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer comparison of two key sets: consistent, missing_text or orphan_text for each key."""
    a = files.select(*keys).distinct().withColumn("_file", F.lit(True))
    b = texts.select(*keys).distinct().withColumn("_text", F.lit(True))
    status = F.when(F.col("_file") & F.col("_text"), "consistent").when(F.col("_file"), "missing_text").otherwise("orphan_text")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def path_owners(rows: DataFrame, id_col: str, path_cols: list[str]) -> DataFrame:
    """path, owner_id: the least id that names the path in any of its columns."""
    long = rows.select(F.col(id_col), F.explode(F.array(*path_cols)).alias("path")).where("path IS NOT NULL")
    return long.groupBy("path").agg(F.min(id_col).alias("owner_id"))


def destination(id_col: Column, name: Column, owner: Column) -> Column:
    """The plain name for its owner, or for everyone if nobody owns it; else the name prefixed with the id."""
    return F.when(owner.isNull() | (owner == id_col), name).otherwise(F.concat(id_col.cast("string"), F.lit("__"), name))


def totals_check(site: DataFrame, parsed: DataFrame, key: str) -> DataFrame:
    """site (key, site_total) against parsed (key, n): the gap where the site names a total."""
    j = site.join(parsed, key, "left").withColumn("parsed", F.coalesce("n", F.lit(0).cast("long")))
    gap = F.col("site_total") - F.col("parsed")
    return j.select(key, "site_total", "parsed", gap.alias("gap"), (F.coalesce(gap, F.lit(0)) > 0).alias("short"))


def gap_sums(checked: DataFrame) -> DataFrame:
    """Sums over the keys whose total is known."""
    known = F.col("site_total").isNotNull()
    return checked.agg(F.sum("site_total").alias("site_total"), F.sum(F.when(known, F.col("parsed"))).alias("parsed"), F.sum("gap").alias("gap"))


def inspected(ids: DataFrame, records: DataFrame, state: DataFrame, key: str = "id") -> DataFrame:
    """For each asked id its record and state, and whether it was found; the short list of ids is what is broadcast."""
    asked = ids.select(key).distinct()
    if asked.count() <= 10_000:
        records, state = records.join(F.broadcast(asked), key, "left_semi"), state.join(F.broadcast(asked), key, "left_semi")
    return asked.join(records.withColumn("found", F.lit(True)), key, "left").join(state, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))
