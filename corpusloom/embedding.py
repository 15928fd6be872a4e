"""Embedders, answerers, publishers and extractors: interfaces with offline defaults."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from importlib import import_module
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sources.scratch import small_batches


class Embedder(Protocol):
    dim: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class HashedWords:
    """A stand-in for a learned model: signed hashed word counts, L2-normalized. Deterministic, offline."""

    def __init__(self, dim: int = 384):
        self.dim = dim

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for row, text in zip(out, texts):
            for w in re.findall(r"\w+", (text or "").lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                row[h % self.dim] += 1.0 if h >> 63 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)


def embedding_column(embedder: Embedder, text: Column, batch: int = 32) -> Column:
    """Vectors of a text column: one embedder per worker, batches of texts."""

    @F.pandas_udf("array<float>")
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            texts = s.tolist()
            rows = [v for i in range(0, len(texts), batch) for v in embedder.embed(texts[i : i + batch])]
            yield pd.Series(rows, dtype=object)

    return embed(text)


class Answerer(Protocol):
    def answer(self, question: str, chunks: list[dict]) -> str: ...


NO_CONTEXT = "No relevant records were found for this question."


class Extractive:
    """Answers with the first sentence of each cited chunk."""

    def answer(self, question: str, chunks: list[dict]) -> str:
        if not chunks:
            return NO_CONTEXT
        return " ".join(f"{re.split(r'(?<=[.!?])\s', c['text'].strip(), maxsplit=1)[0]} [{i}]" for i, c in enumerate(chunks, 1))


def published(files: DataFrame, cache: DataFrame, base: str) -> DataFrame:
    """Content-addressed links: (sha256, name) → (sha256, file_id, view_url, name), from the cache where it has them."""
    fresh = files.groupBy("sha256").agg(F.min("name").alias("name")).join(cache.select("sha256"), "sha256", "left_anti")
    fresh = fresh.select("sha256", F.substring("sha256", 1, 32).alias("file_id"), F.concat(F.lit(base.rstrip("/") + "/"), F.col("sha256")).alias("view_url"), "name")
    return cache.select("sha256", "file_id", "view_url", "name").unionByName(fresh)


class PdfExtractor(Protocol):
    def pages(self, content: bytes) -> list[str]: ...


class PlainPages:
    """A stand-in for a PDF library: what follows the header's line is UTF-8 text, with a form feed between pages."""

    def pages(self, content: bytes) -> list[str]:
        head, _, rest = content.partition(b"\n")
        if not head.startswith(b"%PDF-"):
            raise ValueError("no PDF header")
        return rest.decode().split("\f")


def loaded(name: str) -> object:
    """An object of the class module:Class, for extractors, recognisers and the like that users bring."""
    module, _, cls = name.partition(":")
    return getattr(import_module(module), cls)()


#: Bytes of files whose pages are handed on together.
PAGES_BYTES = 1 << 20


def extracted(files: DataFrame, extractor: PdfExtractor) -> DataFrame:
    """(path, content) → (path, page, text, error): a file that fails is a row with its error, not a failed task.

    A worker holds a small batch of files and the pages of one file, or of small files together, at a time.
    """

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = pa.string(), pa.int32(), pa.string(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["path", "page", "text", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for path, content in zip(b.column(0), b.column(1)):
                path, content = path.as_py(), content.as_py()
                try:
                    rows += [(path, i, t, None) for i, t in enumerate(extractor.pages(content), 1)]
                except Exception as e:  # any extractor, any file
                    rows.append((path, 0, None, f"{type(e).__name__}: {e}"))
                held += len(content or b"")
                if held > PAGES_BYTES or len(rows) > 10_000:
                    if rows:
                        yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    return small_batches(files.select("path", "content")).mapInArrow(run, "path string, page int, text string, error string")


class Recognizer(Protocol):
    def text(self, content: bytes, page: int) -> str: ...


def with_ocr(pages: DataFrame, files: DataFrame, recognizer: Recognizer) -> DataFrame:
    """pages (path, page, text) → with ocr_text, recognised for pages without a text of their own only; NULL for others and where it fails.

    Only the files of such pages (path, content) are read and sent to Python. See `page_texts` for what becomes of both texts."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            texts = []
            for page, content in zip(df["page"], df["content"]):
                try:
                    texts.append(recognizer.text(bytes(content), int(page)) or None)
                except Exception:  # a page that cannot be recognised is a page without text
                    texts.append(None)
            yield pd.DataFrame({"path": df["path"], "page": df["page"], "ocr_text": pd.Series(texts, index=df.index, dtype=object)})

    blank = pages.where((F.col("page") > 0) & (F.trim(F.coalesce("text", F.lit(""))) == "")).select("path", "page")
    found = blank.join(files.select("path", "content"), "path").select("path", "page", "content").mapInPandas(run, "path string, page int, ocr_text string")
    return pages.join(found, ["path", "page"], "left")
