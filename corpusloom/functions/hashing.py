"""Content hashes and deterministic identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The name space of DNS names (a fixed value of RFC 4122).
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def content_hash(*fields: Column) -> Column:
    """sha256 of the fields joined with |; NULL is rendered None, so that it differs from the empty string."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("None")) for c in fields)), 256)


def chunk_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def uuid5(name: Column, namespace: str = NAMESPACE_DNS) -> Column:
    """Name-based UUID, version 5: sha1 of name space and name with version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
