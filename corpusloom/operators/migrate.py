"""Legacy records to the current schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import content_hash
from ..functions.text import basename, blank_to_null
from ..schemas import HASHED


def migrated(old: DataFrame, files: DataFrame, directory: str = "downloaded_pdfs", schema_version: int = 2) -> DataFrame:
    """Rename, null-fill, normalize the local path to a file that exists, recompute the hash.

    A record that has the new URL field keeps it. files: (name, length, sha256) of the directory; a path whose file is
    missing or empty is cleared, and outcome says so.
    """
    url = F.col("judgment_pdf_url") if "judgment_pdf_url" in old.columns else F.lit(None).cast("string")
    url = F.coalesce(url, F.col("remote_pdf_url")) if "remote_pdf_url" in old.columns and "judgment_pdf_url" not in old.columns else url
    sc_url = F.col("sc_judgment_pdf_url") if "sc_judgment_pdf_url" in old.columns else F.lit(None).cast("string")
    rows = old.withColumns({"judgment_pdf_url": url, "sc_judgment_pdf_url": sc_url, "_name": blank_to_null(basename(F.col("local_pdf_path")))})
    f = files.where("length > 0").select(F.col("name").alias("_f"), F.col("sha256").alias("_sha"))
    rows = rows.join(f, F.col("_name") == F.col("_f"), "left")
    found = F.col("_f").isNotNull()
    rows = rows.withColumns(
        {
            "judgment_local_pdf_path": F.when(found, F.concat(F.lit(directory + "/"), F.col("_name"))),
            "judgment_pdf_sha256": F.when(found, F.col("_sha")),
            "sc_judgment_local_pdf_path": F.lit(None).cast("string"),
            "sc_judgment_pdf_sha256": F.lit(None).cast("string"),
            "schema_version": F.lit(schema_version),
            "outcome": F.when(F.col("_name").isNull(), "no_path").when(found, "kept").otherwise("cleared"),
        }
    )
    missing = {c: F.lit(None).cast("string") for c in HASHED if c not in rows.columns}
    rows = rows.withColumns(missing) if missing else rows
    gone = [c for c in ("remote_pdf_url", "local_pdf_path", "pdf_sha256", "_name", "_f", "_sha") if c in rows.columns]
    return rows.withColumn("content_hash", content_hash(*(F.col(c) for c in HASHED))).drop(*gone)
