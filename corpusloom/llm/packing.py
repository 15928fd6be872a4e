"""Harmonic packing of token sequences.

Documents are cut into full sequences and a remainder. A remainder of length r belongs to the
reciprocal-capacity class k = floor(capacity / r), whose bins hold exactly k remainders, whatever
arrives: each worker fills its own bins without knowing the others'. What is left free in a bin of k
remainders is closed with tokens cut from the next document, and at a worker's end the open bins are
cut into sequences whose lengths are powers of two, so that nothing is padded.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import release, small_batches

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Parts of texts that a worker keeps the ids of.
CACHED_PARTS = 60_000
#: Remainders shorter than capacity / MAX_CLASS share the last class.
MAX_CLASS = 64


#: The letters and numbers among the characters below U+0180 in lower case, and the texts that have no others: the tokenizer's
#: classes can be said for them without properties, and each lower-cases to itself or to another of them.
_L, _N = "a-zªµºß-öø-ÿā-ſ", "0-9²³¹¼½¾"
_PLAIN = re.compile(r"[ -~\t\n\r¡-¬®-įı-ſ]*+\Z")
#: How the tokenizer cuts a text before its merges (fixed values of its file).
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^ \t\n\r{_L}{_N}]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Its names of the 256 bytes.
_BYTE_NAMES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}


#: The settings of a tokenizer file for which that holds (fixed values).
_KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}


def _is_known(settings: dict) -> bool:
    """May texts be cut by _PARTS? Only for the settings above, and if every added token begins as special ones do."""
    return all(settings.get(k) == v for k, v in _KNOWN.items()) and settings["model"].get("dropout") is None and all(t["content"].startswith("<|") for t in settings["added_tokens"])


class PartIds(dict):
    """ids of the parts of texts, as little-endian unsigned 32-bit bytes.

    With a tokenizer file of known settings a text of printable characters below U+0180 is cut into parts, whose merges are kept; any other
    text is left to the tokenizer itself, as is one that may hold a special token, and as are all with any other file.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.merge = self.tokenizer.model.tokenize
        self.known = _is_known(json.loads(self.tokenizer.to_str()))

    def __missing__(self, part: str) -> bytes:
        named = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_NAMES)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.merge(named)])
        if len(self) < CACHED_PARTS and len(part) <= 64:  # the first ones met are the frequent ones
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.known and _PLAIN.match(text) and "<|" not in text:
            return b"".join(map(self.__getitem__, _PARTS.findall(text.lower())))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(2)
def part_ids(tokenizer_file: str) -> PartIds:
    """One for each worker process, which serves many tasks."""
    return PartIds(tokenizer_file)


class Packer:
    """Packs token strings (4 bytes an id) into sequences; emits one piece (doc, start, length, crc, tokens, sequence, offset) at a time."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence, self.out, self.bins = capacity, first_sequence, [], {}

    def emit(self, pieces: list[tuple]) -> None:
        """pieces: (doc, start, ids, doc_tokens) of one sequence."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, at, full = len(ids) // 4, 0, self.capacity
        ready = self.bins.get(0)  # a bin with all its remainders and a gap
        if ready:
            pieces, gap = self.bins.pop(0)
            cut = min(gap, total)
            pieces.append((doc, 0, ids[: 4 * cut], total))
            at = cut
            if cut < gap:
                self.bins[0] = (pieces, gap - cut)
            else:
                self.emit(pieces)
        while total - at >= full:
            self.emit([(doc, at, ids[4 * at : 4 * (at + full)], total)])
            at += full
        if r := total - at:
            k = min(full // r, MAX_CLASS)
            pieces = self.bins.setdefault(k, [])
            pieces.append((doc, at, ids[4 * at :], total))
            if len(pieces) == k:
                self.close(self.bins.pop(k))

    def close(self, pieces: list[tuple]) -> None:
        gap = self.capacity - sum(len(p[2]) for p in pieces) // 4
        if not gap:
            self.emit(pieces)
        elif 0 not in self.bins:
            self.bins[0] = (pieces, gap)
        else:  # two bins wait for filler: the one with the smaller gap is filled from the other's remainders
            other, other_gap = self.bins.pop(0)
            (pieces, gap), (other, other_gap) = sorted([(pieces, gap), (other, other_gap)], key=lambda x: x[1])
            while gap:
                doc, start, ids, total = other.pop()
                n = len(ids) // 4
                cut = min(gap, n)
                pieces.append((doc, start, ids[: 4 * cut], total))
                if cut < n:
                    other.append((doc, start + cut, ids[4 * cut :], total))
                gap -= cut
                other_gap += cut
            self.emit(pieces)
            if other:
                self.bins[0] = (other, other_gap)

    def finish(self) -> None:
        """Cut the open bins into full sequences and powers of two."""
        waiting = self.bins.pop(0, ([], 0))[0]
        stream = waiting + [p for k in sorted(self.bins) for p in self.bins[k]]
        self.bins = {}
        left, want = sum(len(p[2]) for p in stream) // 4, 0
        pieces: list[tuple] = []
        for doc, start, ids, total in stream:
            while ids:
                if not want:
                    want = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                cut = min(want, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * cut], total))
                start, ids = start + cut, ids[4 * cut :]
                want, left = want - cut, left - cut
                if not want:
                    self.emit(pieces)
                    pieces = []


def pack(docs: DataFrame, tokenizer_file: str, end_id: int = 2, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs → id and PIECES: one row per piece of a document.

    A document is its text's ids and end_id (null text: end_id alone). Every id lies in exactly one piece;
    pieces of a sequence have gapless offsets from 0; a sequence is full or, for a worker's last few,
    a power of two long. Packing is local to a partition: no shuffle, memory of one text and at
    most MAX_CLASS open bins. sequence_id is partition << 40 plus a local number. Ids may be null or repeat:
    each row is a document of its own. capacity must be a power of two. An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, packer = part_ids(tokenizer_file), Packer(capacity, TaskContext.get().partitionId() << 40)
        kinds = None

        def rows() -> pa.RecordBatch:
            cols = list(zip(*packer.out)) or [()] * 7
            packer.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, kinds if i == 0 else pa.int64()) for i, c in enumerate(cols)], names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            kinds = b.column(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                packer.add(doc, parts.encode(text.as_py() or "") + end)
            yield rows()
        packer.finish()
        if packer.out:
            yield rows()
        release()

    return small_batches(docs).select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {PIECES}")
