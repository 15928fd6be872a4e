"""Word-window chunking without UDFs: folds over arrays of words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bound
from ..functions.hashing import chunk_hash
from ..functions.text import PARAGRAPH_BREAK, metadata_card, paragraphs, words


def windows(w: Column, target: int, overlap: int) -> Column:
    """Joined windows of `target` words that start every target - overlap words, to the last word."""
    step = target - overlap
    starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, F.lit(target)), " "))


def window_count(w: Column, target: int, overlap: int) -> Column:
    """How many windows there are, without making them."""
    return F.ceil(F.size(w) / (target - overlap)).cast("int")


def packed(paras: Column, target: int, overlap: int) -> Column:
    """Greedy packing of paragraphs (word arrays) into chunks.

    A paragraph that does not fit closes the chunk, whose last `overlap` words begin the next; one longer than `target` is
    cut into windows and carries nothing in or out.
    """
    if not 0 <= overlap < target:
        raise ValueError("overlap must be at least 0 and less than target")
    none = F.array().cast("array<string>")

    def flushed(s: Column) -> Column:
        return F.when(F.size(s["cur"]) > 0, F.concat(s["out"], F.array(F.array_join(s["cur"], " ")))).otherwise(s["out"])

    def step(s: Column, p: Column) -> Column:
        tail = F.slice(s["cur"], F.greatest(F.size(s["cur"]) - overlap + 1, F.lit(1)), F.lit(max(overlap, 1)))
        tail = tail if overlap else none
        return (
            F.when(F.size(p) > target, F.struct(F.concat(flushed(s), windows(p, target, overlap)).alias("out"), none.alias("cur")))
            .when(F.size(s["cur"]) + F.size(p) > target, F.struct(flushed(s).alias("out"), F.concat(tail, p).alias("cur")))
            .otherwise(F.struct(s["out"].alias("out"), F.concat(s["cur"], p).alias("cur")))
        )

    return F.aggregate(paras, F.struct(none.alias("out"), none.alias("cur")), step, flushed)


def chunk_texts(docs: DataFrame, text_col: str, target: int = 380, overlap: int = 60, breaks: str = PARAGRAPH_BREAK) -> DataFrame:
    """docs → one row per chunk: the columns of docs but the text, chunk_index, text, chunk_hash."""
    chunks = packed(paragraphs(F.col(text_col), breaks), target, overlap)
    keys = [c for c in docs.columns if c != text_col]
    rows = docs.select(*keys, F.posexplode(chunks).alias("chunk_index", "text"))
    return rows.withColumn("chunk_hash", chunk_hash(F.col("text")))


def hard_split(docs: DataFrame, text_col: str, target: int = 380, overlap: int = 60) -> DataFrame:
    """docs → one row per window over the whole text's words."""
    keys = [c for c in docs.columns if c != text_col]
    chunks = bound(words(F.col(text_col)), lambda w: windows(w, target, overlap))
    rows = docs.select(*keys, F.posexplode(chunks).alias("chunk_index", "text"))
    return rows.withColumn("chunk_hash", chunk_hash(F.col("text")))


def document_chunks(docs: DataFrame, target: int = 380, overlap: int = 60, chunker: Callable[..., DataFrame] = chunk_texts) -> DataFrame:
    """(record_id, kind, text) → chunk rows with their ids. chunker: also `parallel_packing.chunk_long_texts`, which runs jobs of its own for very long texts."""
    rows = chunker(docs.select("record_id", F.col("kind").alias("chunk_type"), "text"), "text", target, overlap)
    return rows.select(F.concat_ws("::", "record_id", "chunk_type", F.col("chunk_index").cast("string")).alias("chunk_id"), "record_id", "chunk_type", "chunk_index", "text", "chunk_hash")


def metadata_chunks(records: DataFrame) -> DataFrame:
    """One chunk per record: its labelled card."""
    card = metadata_card(*(F.col(c) for c in ("case_info", "year", "category", "decision_date", "neutral_citation", "other_citation", "sc_status", "remarks")))
    rows = records.select(F.concat("id", F.lit("::metadata")).alias("chunk_id"), F.col("id").alias("record_id"), F.lit("metadata").alias("chunk_type"), F.lit(0).alias("chunk_index"), card.alias("text"))
    return rows.withColumn("chunk_hash", chunk_hash(F.col("text")))
