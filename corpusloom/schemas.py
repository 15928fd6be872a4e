"""Explicit schemas: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()

#: A record of the store; the names are fixed values of the record format.
RECORD = T.StructType(
    [
        T.StructField("schema_version", _I),
        T.StructField("id", _S, False),
        T.StructField("serial_no", _I),
        T.StructField("year", _I),
        T.StructField("case_info", _S),
        T.StructField("remarks", _S),
        T.StructField("other_citation", _S),
        T.StructField("neutral_citation", _S),
        T.StructField("decision_date", _S),
        T.StructField("sc_status", _S),
        T.StructField("category", _S),
        T.StructField("judgment_pdf_url", _S),
        T.StructField("judgment_local_pdf_path", _S),
        T.StructField("judgment_pdf_sha256", _S),
        T.StructField("sc_judgment_pdf_url", _S),
        T.StructField("sc_judgment_local_pdf_path", _S),
        T.StructField("sc_judgment_pdf_sha256", _S),
        T.StructField("judgment_gdrive_view_url", _S),
        T.StructField("sc_judgment_gdrive_view_url", _S),
        T.StructField("content_hash", _S),
        T.StructField("first_seen_at", T.TimestampType()),
        T.StructField("last_seen_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

#: The site's own fields, in the order in which they are hashed.
HASHED = ("case_info", "remarks", "other_citation", "neutral_citation", "decision_date", "sc_status", "category", "judgment_pdf_url", "sc_judgment_pdf_url")
#: Our own bookkeeping, which an update must not blank.
CARRIED = ("judgment_local_pdf_path", "judgment_pdf_sha256", "sc_judgment_local_pdf_path", "sc_judgment_pdf_sha256", "judgment_gdrive_view_url", "sc_judgment_gdrive_view_url")

CHUNK_TYPES = ("metadata", "judgment_pdf", "sc_judgment_pdf")
CHUNK = "chunk_id string, record_id string, chunk_type string, chunk_index int, text string, chunk_hash string"
STATE = "id string, content_hash string, judgment_pdf_sha256 string, sc_judgment_pdf_sha256 string, judgment_chunk_count int, sc_judgment_chunk_count int"
#: What failed in a run and is to be tried again: the step, what it worked on, and why.
DEAD = "step string, item string, error string, failed_at timestamp"
UPLOAD_CACHE = "sha256 string, file_id string, view_url string, name string"
LISTING_ROW = T.StructType(
    [T.StructField(c, _S) for c in ("serial", "case_info", "remarks", "other_citation", "neutral_citation", "decision_date", "sc_status", "category", "download_href", "second_href")]
)
ANCHOR_ROW = T.StructType([T.StructField("position", _I), T.StructField("href", _S), T.StructField("text", _S)])
