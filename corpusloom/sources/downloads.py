"""Files as sinks: documents fetched, texts written, published copies. A file appears under its name only when it is whole."""

from __future__ import annotations

import hashlib
import posixpath
import re
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .client import Client

MAGIC, HEAD, BLOCK = b"%PDF-", 1024, 1 << 15
#: Attempts at a body that breaks off, and the wait before the second, doubled before each further one (seconds).
ATTEMPTS, WAIT = 4, 3.0


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file:/x too) or of a local path, and the path within it."""
    if "://" in path and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)


def is_filled(path: str) -> bool:
    f, at = opened(path)
    info = f.get_file_info(at)
    return info.type == pafs.FileType.File and info.size > 0


def file_sha256(path: str) -> str:
    f, at = opened(path)
    h = hashlib.sha256()
    with f.open_input_stream(at) as stream:
        while block := stream.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def written(path: str, blocks: Iterator[bytes], accept: Callable[[bytes], bool] = lambda head: True) -> str | None:
    """Write blocks to path by way of a partial file; the content's sha256, or None if its first bytes are not accepted."""
    f, at = opened(path)
    f.create_dir(posixpath.dirname(at), recursive=True)
    part, head, h = f"{at}.{uuid.uuid4().hex}.part", b"", hashlib.sha256()
    try:
        with f.open_output_stream(part) as out:
            for block in blocks:
                head += block[: HEAD - len(head)]
                h.update(block)
                out.write(block)
        if not accept(head):
            return None
        f.move(part, at)
        return h.hexdigest()
    finally:
        if f.get_file_info(part).type != pafs.FileType.NotFound:
            f.delete_file(part)


def body(response) -> Iterator[bytes]:
    with response:
        while block := response.read(BLOCK):
            yield block


def download(client: Client, url: str, path: str, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(sha256, error) of one document. A filled file is only hashed again; a body that breaks off is fetched anew; what is no PDF is not kept."""
    if is_filled(path):
        return file_sha256(path), None
    for attempt in range(ATTEMPTS):
        response = client.open(url, headers={"Connection": "close"})
        if response is None:
            return None, "no answer"
        try:
            sha = written(path, body(response), lambda head: MAGIC in head)
            return sha, None if sha else "not a PDF"
        except Exception as e:  # a broken connection has many types
            if attempt + 1 == ATTEMPTS:
                return None, f"{type(e).__name__}: {e}"
            sleep(WAIT * 2**attempt)
    raise AssertionError("not reached")


def downloaded(wanted: DataFrame, folder: str, client: Callable[[str], Client] = Client, pause: float = 2.0) -> DataFrame:
    """wanted (record_id, kind, url, path) → record_id, kind, path, sha256, error, after each document was fetched to folder/path.

    Rows of one host are one task, so that its spacing holds whatever the cluster; hosts go side by side. A failed document is a row with its
    error and NULL path and hash. What is there is not fetched again, so a task that is repeated goes on where it was lost. Rows without a URL are left out.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients: dict[str, Client] = {}
        for df in parts:
            out = []
            for record, kind, url, path, host in df.itertuples(index=False):
                there = is_filled(f"{folder}/{path}")
                if host not in clients:
                    clients[host] = client(url)
                sha, error = download(clients[host], url, f"{folder}/{path}", clients[host].sleep)
                out.append((record, kind, path if sha else None, sha, error))
                if sha and not there:
                    clients[host].sleep(pause)
            yield pd.DataFrame(out, columns=["record_id", "kind", "path", "sha256", "error"])

    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    rows = wanted.where("url IS NOT NULL AND url <> ''").select("record_id", "kind", "url", "path", host.alias("host"))
    return rows.repartition("host").sortWithinPartitions("host", "record_id", "kind").mapInPandas(run, "record_id string, kind string, path string, sha256 string, error string")


def write_files(rows: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """(path, content: binary or string) → path, sha256, after each file was written to folder/path. Repeating it changes nothing."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            out = []
            for name, data in df.itertuples(index=False):
                out.append((name, written(f"{folder}/{name}", iter([data.encode() if isinstance(data, str) else bytes(data)]))))
            yield pd.DataFrame(out, columns=["path", "sha256"])

    return rows.where(F.col(path).isNotNull() & F.col(content).isNotNull()).select(path, content).mapInPandas(run, "path string, sha256 string")


def write_texts(texts: DataFrame, folder: str) -> DataFrame:
    """(record_id, kind, text) → the files folder/kind/record_id.md."""
    return write_files(texts.select(F.concat_ws("/", "kind", F.concat("record_id", F.lit(".md"))).alias("path"), F.col("text").alias("content")), folder)


def publish_copies(files: DataFrame, folder: str) -> DataFrame:
    """(sha256, content) → content-addressed copies folder/sha256, one for each content."""
    once = files.groupBy("sha256").agg(F.any_value("content").alias("content"))
    return write_files(once.select(F.col("sha256").alias("path"), "content"), folder)


def removed(path: str) -> bool:
    """Delete a file if it is there."""
    f, at = opened(path)
    if f.get_file_info(at).type != pafs.FileType.File:
        return False
    f.delete_file(at)
    return True


def renamed(path: str, to: str) -> None:
    f, at = opened(path)
    f.move(at, opened(to)[1])
