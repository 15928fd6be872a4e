"""One huge JSON array as a table, read by many tasks.

A reader that begins in the middle of a JSON text does not know whether it is inside a string, or how deep. But what a block of text does to both is a function of
either start, and such functions compose. So each split of the file is summed up on its own; the sums, a row a split, are scanned in the order of the file; then
each split knows its start, cuts out the elements that lie in it, and hands on the pieces of those that reach beyond.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .scratch import stored

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NO_SIGN = re.compile(rf"{_STRING}|\\.", re.S)
#: What is left of a string in which a text begins.
_REST = re.compile(_STRING[1:], re.S)
_MARK = re.compile(rf'{_STRING}|\\.|["{{}}\[\],]', re.S)
#: All up to the next bracket, or the quote of a string that does not end.
_DEEP = re.compile(rf'(?:[^"\\{{}}\[\]]++|{_STRING}|\\.|\\\Z)*+(["{{}}\[\]])?', re.S)
_OTHERS = bytes(set(range(256)) - set(b"{}[]"))


def effect(text: str, inside: bool) -> tuple[bool, int, int]:
    """(inside a string after it, change of depth, least depth on the way) of a text that begins inside a string or not."""
    if inside:
        m = _REST.match(text)
        if not m:
            return True, 0, 0
        text = text[m.end() :]
    plain, quote, _ = _NO_SIGN.sub("", text).partition('"')
    signs = np.frombuffer(plain.encode("utf-8", "surrogatepass").translate(None, _OTHERS), np.uint8)
    depths = np.cumsum(np.where((signs == ord("{")) | (signs == ord("[")), 1, -1))
    return bool(quote), int(depths[-1]) if len(depths) else 0, min(0, int(depths.min(initial=0)))


def then(a: tuple[bool, int, int], b: tuple[bool, int, int]) -> tuple[bool, int, int]:
    """The effect of two texts one after the other; b is that of the second for the state in which the first ends."""
    return b[0], a[1] + b[1], min(a[2], a[1] + b[2])


def _blank(text: str) -> None:
    if text.strip(" \t\r\n\ufeff"):
        raise ValueError("not an array of objects")


def elements(texts: Iterator[str], inside: bool, depth: int) -> Iterator[tuple[bool, bool, str]]:
    """(began here, ended here, text) of each element, or part of one, in texts that follow each other and begin in that state.

    Raises ValueError for what is no array of objects; what is wrong inside an object is left to whoever parses it.
    """
    held: list[str] = []
    began = depth < 2
    for text in texts:
        at = pos = 0
        if inside:
            m = _REST.match(text)
            if m and depth < 2:
                raise ValueError("not an array of objects")
            inside, pos = not m, m.end() if m else len(text)
        while not inside:
            m = _DEEP.match(text, pos) if depth >= 2 else _MARK.search(text, pos)
            sign = m and m[m.lastindex or 0]
            if not sign or depth >= 2 and not m.lastindex:
                break
            pos, begin = m.end(), m.end() - len(sign)
            if sign[0] == '"':
                if depth < 2:
                    raise ValueError("not an array of objects")
                inside = True
            elif len(sign) > 1:
                continue
            elif sign == ",":
                _blank(text[at:begin] if depth else ",")
                at = pos
            elif sign in "{[":
                if depth < 2:
                    _blank(text[at:begin])
                    if sign != "[{"[depth]:
                        raise ValueError("not an array of objects")
                    at = begin if depth else pos
                depth += 1
            else:
                depth -= 1
                if depth == 1:
                    held.append(text[at:pos])
                    yield began, True, "".join(held)
                    held, began = [], True
                elif depth == 0:
                    _blank(text[at:begin])
                elif depth < 0:
                    raise ValueError("a bracket too many")
                else:
                    continue
                at = pos
        if depth >= 2:
            held.append(text[at:])
        else:
            _blank(text[at:])
    if depth >= 2:
        yield began, False, "".join(held)


#: Splits of a file for each core, and bytes of a split, at most.
SPLITS_A_CORE, SPLIT_BYTES = 8, 128 << 20


def split_bytes(spark: SparkSession, path: str, least: int) -> int:
    """How large splits of the files at path should be: at least so large, and so that their number does not grow with the files until they are of SPLIT_BYTES."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    length = at.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return max(least, min(SPLIT_BYTES, -(-length // (SPLITS_A_CORE * sc.defaultParallelism))))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[str]]]:
    """(where a split begins, its texts) of rows (start, text) that come split by split; the texts of a batch are one, with the braces that parted them."""

    def rows() -> Iterator[tuple[int, str]]:
        for b in batches:
            starts, texts = b.column(0).to_numpy(), b.column(1).to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), len(texts)]
            for i, j in zip(cuts, cuts[1:]):
                if i < j:
                    yield int(starts[i]), "}".join(texts[i:j])

    for start, own in groupby(rows(), key=lambda x: x[0]):
        yield start, (text for _, text in own)


def _closed(texts: Iterator[str], last: bool) -> Iterator[str]:
    """Texts with the braces that parted them; after the very last one there is none."""
    held = None
    for text in texts:
        if held is not None:
            yield held + "}"
        held = text
    if held is not None:
        yield held if last else held + "}"


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(start, k, text): the objects of the JSON array in one file, in the order of start and k. ValueError if the file is no array of objects.

    The file is split at closing braces, wherever these stand, so its splits are Spark's own; an object that reaches from one into the next is put
    together from its pieces. Two scans; a row for each split goes to the driver.
    """
    rows = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("text"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, texts in _splits(batches):
            both = [(False, 0, 0), (True, 0, 0)]
            for text in _closed(texts, True):
                both = [then(x, effect(text, x[0])) for x in both]
            yield pa.RecordBatch.from_arrays([pa.array([start]), *(pa.array([x]) for one in both for x in one)], names=["start", "in0", "depth0", "least0", "in1", "depth1", "least1"])

    sums = rows.mapInArrow(summed, "start long, in0 boolean, depth0 long, least0 long, in1 boolean, depth1 long, least1 long").orderBy("start").collect()
    states: dict[int, tuple[bool, int, int, bool]] = {}  # split → inside, depth, where the element began that it begins in, whether it is the last
    inside, depth, owner = False, 0, 0
    for k, r in enumerate(sums):
        states[r["start"]] = (inside, depth, owner, k == len(sums) - 1)
        own = (r["in1"], r["depth1"], r["least1"]) if inside else (r["in0"], r["depth0"], r["least0"])
        if k < len(sums) - 1:
            own = then(own, effect("}", own[0]))
        if depth + own[2] < 2:
            owner = r["start"]  # an element that is open at its end began here
        inside, depth = own[0], depth + own[1]
    if not sums or inside or depth:
        raise ValueError(f"{path}: not a whole JSON array")
    shared = spark.sparkContext.broadcast(states)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, texts in _splits(batches):
            inside, depth, owner, last = shared.value[start]
            out: list[tuple] = []
            for k, (began, ended, text) in enumerate(elements(_closed(texts, last), inside, depth)):
                whole = began and ended
                out.append((start, k, None if whole else start if began else owner, text))
                if len(out) >= 4_096:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    found = stored(rows.mapInArrow(cut, "start long, k long, owner long, text string"), "json-elements")  # at once, as both scans must have the same splits
    pieces = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "")
    last = F.lit((1 << 63) - 1)  # of what begins in a split, what does not end in it comes last
    put = found.where("owner IS NOT NULL").groupBy(F.col("owner").alias("start")).agg(pieces.alias("text")).select("start", last.alias("k"), "text")
    return found.where("owner IS NULL").select("start", "k", "text").unionByName(put)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["start", "k", "owner", "text"])


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a JSON array of objects, with start and k to order them; an object that cannot be parsed is an error when it is read."""
    return json_elements(spark, path).select("start", "k", F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("start", "k", "r.*")
