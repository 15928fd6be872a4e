"""N-gram Jaccard join by set-relation skipping.

Each document is the set of its word shingles. Sets are indexed by the rarest of their shingles (a
prefix that two sets above the threshold must share). The index lists are sorted by size and position, so
that whole blocks that are too small, too large or too far back are skipped. Sets that are alike share
their answers: of a list of look-alikes one hub is compared with all others, and pairs are compared
only where what is known from the hubs leaves it open whether their groups are linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, release, shuffle_partitions, small_batches, stored, tidy
from .components import components

WORDS = 5
#: Threshold NUM / DEN of intersection by union.
NUM, DEN = 3, 4
#: Lists of up to so many sets are compared pair by pair at once.
SHORT_LIST = 8
#: Frequent shingles that are known to all tasks (16 bytes each): they come last in the order. A bound on speed, not on results.
FREQUENT = 1_000_000
#: Shingles in more sets than this are frequent. Those whose hash is in the lowest share LOW are counted exactly, as
#: prefixes come from there; of the others, those that a task meets REPORTED times in a chunk.
FREQUENT_SETS, LOW, REPORTED = SHORT_LIST, 0.3, 4
#: A frequent shingle's list is dealt into sublists of about so many sets, whose hubs meet in a list of their own.
#: The low bits of a list's key number the sublist, 0 if it is the whole list.
SUBLIST = 4096
SALT_BITS = 12
#: Above DENSE pairs an entry in lists of several components, SOME partners of each set are compared before all are.
DENSE, SOME = 128, 6
#: Sets of a block of a list whose sets are of several components.
BLOCK = 256
#: Bytes of text to a bucket of the index.
BUCKET_BYTES = 32 << 20
#: Bits of the filter that picks the documents whose sets are needed: 1 MB.
FILTER_BITS = 1 << 23

_U = np.uint64
_M, _F1, _F2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_POSTING = np.dtype([("key", "<u8"), ("id", "<i8"), ("size", "<u4"), ("pos", "<u4")])


#: Words whose hashes a worker keeps; documents whose entries it holds at once.
CACHED_WORDS, CHUNK = 100_000, 2_000


def chunks(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, CHUNK):
        yield b.slice(at, CHUNK)


class WordHash(dict):
    def __init__(self):
        from xxhash import xxh64_intdigest

        self.digest = xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        h = self.digest(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _F1
    h = (h ^ (h >> _U(27))) * _F2
    return h ^ (h >> _U(31))


def shingles(text: str | None, words: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles: A-Z lower-cased, words by ASCII white space."""
    if not text:
        return np.empty(0, _U)
    own = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(words.__getitem__, own), _U, len(own))
    n = min(WORDS, len(h))
    if not n:
        return h
    s = np.full(len(h) - n + 1, _U(n))
    for i in range(n):
        s = s * _M + h[i : len(h) - n + 1 + i]
    s = mixed(s)
    s.sort()
    return s[np.concatenate(([True], s[1:] != s[:-1]))]


def set_id(s: np.ndarray) -> int:
    """64-bit fingerprint of a set (0: the empty set)."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        h = (s * s).sum(dtype=_U) ^ (s.sum(dtype=_U) * _F2) ^ _U(len(s))
    return int(mixed(np.array([h], _U)).view(np.int64)[0]) or 1


def least_overlap(a, b):
    """Least intersection of linked sets of these sizes."""
    return -(-(NUM * (a + b)) // (NUM + DEN))


def prefix_length(n: int) -> int:
    return n - -(-(NUM * n) // DEN) + 1


@dataclass
class Frequent:
    shingles: np.ndarray  # sorted, without their low bits
    rank: np.ndarray  # by frequency
    parts: np.ndarray  # sublists


#: Bits of a shingle that are dropped where it is counted.
_DROPPED = _U(16)
_LOW_LIMIT = _U(int(LOW * 2**64))


def ordered_prefix(s: np.ndarray, frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a set, rarest first (unknown frequencies by hash), and the number of sublists of each shingle."""
    n = prefix_length(len(s))
    if not len(frequent.shingles):
        return s[:n], np.ones(n, np.int64)
    short = s >> _DROPPED
    at = np.minimum(np.searchsorted(frequent.shingles, short), len(frequent.shingles) - 1)
    is_frequent = frequent.shingles[at] == short
    rare = s[~is_frequent][:n]
    if len(rare) == n:
        return rare, np.ones(n, np.int64)
    rest = np.flatnonzero(is_frequent)
    rest = rest[np.argsort(frequent.rank[at[rest]], kind="stable")][: n - len(rare)]
    return np.concatenate([rare, s[rest]]), np.concatenate([np.ones(len(rare), np.int64), frequent.parts[at[rest]]])


def odd_sketch(s: np.ndarray) -> bytes:
    """A bit for each of 2 to 4 buckets a shingle, set if the bucket has an odd number of them. Of two sketches (the larger
    folded to the smaller's size) no more bits differ than shingles do."""
    bits = 1 << max(6, int(2 * len(s) - 1).bit_length())
    odd = np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).tobytes()


def sketch_allows(x: bytes, size_x: int, y: bytes, size_y: int) -> bool:
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum()) <= size_x + size_y - 2 * least_overlap(size_x, size_y)


def _scan(docs: DataFrame, buckets: int) -> DataFrame:
    """docs (id, text) → three kinds of rows.

    0: (id, n, set, sketch or NULL), one for each document; the sketch for a set that the task has not met before.
    1: (bucket, blob) the low shingles of a batch's sets, 6 bytes each. 2: (shingle, n) for what a chunk has often."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["kind", "id", "n", "set", "blob"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, held, size = WordHash(), set(), [], 0

        def rows(kind: int, n, keys, blobs) -> pa.RecordBatch:
            k = len(n)
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, kind, np.int32)), pa.nulls(k, id_kind), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=names)

        def often() -> pa.RecordBatch:
            value = np.concatenate(held)
            held.clear()
            value >>= _DROPPED
            value.sort()
            start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            n = np.diff(start, append=len(value))
            value, n = value[start[n >= REPORTED]], n[n >= REPORTED]
            return rows(2, n, value.astype(np.int64), [None] * len(n))

        for b in (c for b in batches for c in chunks(b)):
            id_kind = b.column(0).type
            n, ids, sketches, low = [], [], [], []
            for text in b.column(1):
                s = shingles(text.as_py(), words)
                n.append(len(s))
                ids.append(set_id(s))
                sketches.append(None)
                if ids[-1] and ids[-1] not in seen:
                    seen.add(ids[-1])
                    sketches[-1] = odd_sketch(s)
                    held.append(s)
                    low.append(s[: np.searchsorted(s, _LOW_LIMIT)])
                    size += len(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), pa.array(sketches, pa.binary())], names=names)
            if low:
                s = np.concatenate(low) >> _DROPPED
                to = (mixed(s) % _U(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                s, to = s[order], to[order]
                edges = np.flatnonzero(np.diff(to, prepend=-1))
                blobs = [x.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for x in np.split(s, edges[1:])]
                yield rows(1, np.zeros(len(blobs), np.int64), to[edges], blobs)
            if size > 1_000_000:
                yield often()
                held, size = [], 0
            if len(seen) > 100_000:
                seen.clear()
        if held:
            yield often()
        held.clear()
        release()

    return docs.mapInArrow(run, f"kind int, id {kind}, n long, set long, blob binary")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """Of rows (bucket, blob) in order of bucket, the blobs of one bucket after the other, joined."""
    bucket, held = None, []
    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1)):
            if k != bucket and held:
                yield b"".join(held)
                held = []
            bucket = k
            held.append(blob.as_py())
    if held:
        yield b"".join(held)


#: Rows below which another task is not worth its start.
ROWS_A_TASK = 5_000


def _few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """df, dealt by a key, in no more tasks than its rows are worth; rows of one key stay together, and in order."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK))
    return df.coalesce(tasks) if tasks < shuffle_partitions(df.sparkSession) else df


def _dealt(blobs: DataFrame) -> DataFrame:
    """(bucket, blob) in partitions, ordered by bucket: a task holds one bucket at a time."""
    return blobs.repartition(shuffle_partitions(blobs.sparkSession), "bucket").sortWithinPartitions("bucket")


def _frequent(scanned: DataFrame) -> Frequent:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handled = 0
        for blob in _by_bucket(batches):
            handled += len(blob)
            flat = np.frombuffer(blob, np.uint8).reshape(-1, 6)
            s = np.zeros((len(flat), 8), np.uint8)
            s[:, :6] = flat
            value, n = np.unique(s.reshape(-1).view(np.int64), return_counts=True)
            often = n > FREQUENT_SETS
            yield pa.RecordBatch.from_arrays([pa.array(value[often]), pa.array(n[often])], names=["shingle", "n"])
        release(handled)

    low = _dealt(scanned.where("kind = 1").select(F.col("set").alias("bucket"), "blob")).mapInArrow(count, "shingle long, n long")
    other = scanned.where("kind = 2").groupBy(F.col("set").alias("shingle")).agg(F.sum("n").alias("n"))
    counts = low.union(other.where((F.col("n") > FREQUENT_SETS) & (F.col("shingle") >= int(_LOW_LIMIT >> _DROPPED))))
    got = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    value, n = got.column("shingle").to_numpy().astype(_U), got.column("n").to_numpy()
    order = np.argsort(value)
    rank = np.empty(len(n), np.int32)
    rank[np.lexsort((value, n))] = np.arange(len(n))
    return Frequent(value[order], rank[order], np.minimum((1 << SALT_BITS) - 1, -(-n // SUBLIST)).astype(np.int16)[order])


def _postings(docs: DataFrame, frequent: Frequent, buckets: int) -> DataFrame:
    """docs (id, text) → (bucket, postings): the index entries of the batch's sets, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    low = _U((1 << SALT_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHash(), set()
        for b in (c for b in batches for c in chunks(b)):
            held = []
            for text in b.column(1):
                s = shingles(text.as_py(), words)
                own = set_id(s)
                if own and own not in seen:
                    seen.add(own)
                    prefix, parts = ordered_prefix(s, shared.value)
                    p = np.empty(len(prefix), _POSTING)
                    p["key"] = (prefix & ~low) | np.where(parts > 1, _U(1) + _U(own % 0x7FFFFFFF) % np.maximum(parts, 1).astype(_U), _U(0))
                    p["id"], p["size"], p["pos"] = own, len(s), np.arange(len(prefix))
                    held.append(p)
            if len(seen) > 100_000:
                seen.clear()
            if held:
                p = np.concatenate(held)
                held.clear()
                to = (mixed(p["key"] * _M) % _U(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                p, to = p[order], to[order]
                edges = np.flatnonzero(np.diff(to, prepend=-1))
                blobs = [x.tobytes() for x in np.split(p, edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(to[edges].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])
        release()

    return docs.mapInArrow(run, "bucket int, blob binary")


class IndexList:
    """The sets of one index list, in blocks of one size each, by position within."""

    def __init__(self, p: np.ndarray):
        self.p = p[np.lexsort((p["id"], p["pos"], p["size"]))]
        self.size, self.pos = self.p["size"].astype(np.int64), self.p["pos"].astype(np.int64)
        self.start = np.flatnonzero(np.diff(self.size, prepend=-1))
        self.sizes = self.size[self.start]
        self.place = self.size << 32 | self.pos

    def partners(self, size: int, pos: int) -> np.ndarray:
        """Rows that may be linked with a set of that size whose entry has that position, if this is their first common shingle.

        Skips the blocks whose size is out of range, or for which pos is too far back, and in each other block
        all entries behind the last position that leaves enough of the set."""
        low, high = np.searchsorted(self.sizes, [-(-NUM * size // DEN), size * DEN // NUM + 1])
        need = least_overlap(size, self.sizes[low:high])
        last = np.where(size - pos >= need, self.sizes[low:high] - need, -1)
        ends = np.searchsorted(self.place, (self.sizes[low:high] << 32) + last, side="right")
        spans = [np.arange(a, b) for a, b in zip(self.start[low:high], ends) if b > a]
        return np.concatenate(spans) if spans else np.empty(0, np.int64)


def pairs_of_list(p: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """(pairs of ids to compare, hubs or None): all pairs that pass for a short whole list, else each set with one hub."""
    lst = IndexList(p)
    ids = lst.p["id"]
    if whole and len(ids) <= SHORT_LIST:
        out = [(ids[i], ids[j]) for i in range(len(ids)) for j in lst.partners(int(lst.size[i]), int(lst.pos[i])) if j > i]
        return np.array(out, np.int64).reshape(-1, 2), None
    free = np.ones(len(ids), bool)
    out, hubs = [], []
    for i in np.argsort(mixed(ids.view(_U)), kind="stable"):  # the hub is the same in most lists of a group
        if not free[i]:
            continue
        free[i] = False
        near = lst.partners(int(lst.size[i]), int(lst.pos[i]))
        near = near[free[near]]
        free[near] = False
        hubs.append(i)
        out.append(np.column_stack([np.full(len(near), ids[i]), ids[near]]))
    return np.concatenate(out), lst.p[np.array(hubs)]


def pairs_of_two(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For lists of two sets each, p[k] and q[k]: the pairs of ids that pass."""
    a, b = p["size"].astype(np.int64), q["size"].astype(np.int64)
    need = least_overlap(a, b)
    passed = (a - p["pos"] >= need) & (b - q["pos"] >= need)
    return np.column_stack([p["id"][passed], q["id"][passed]])


_OUT = "kind int, a long, b long, key long, size int, pos int"


def _rows(kind: int, a, b, key, size, pos) -> pa.RecordBatch:
    n = len(a)
    col = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t))
    return pa.RecordBatch.from_arrays([col(kind, np.int32), col(a, np.int64), col(b, np.int64), col(key, np.int64), col(size, np.int32), col(pos, np.int32)], names=["kind", "a", "b", "key", "size", "pos"])


def _lists(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by key and id, each once; and where the list of each key starts and how long it is."""
    p = p[np.lexsort((p["id"], p["key"]))]
    if len(p):
        p = p[np.concatenate(([True], (np.diff(p["key"]) != 0) | (np.diff(p["id"]) != 0)))]
    start = np.flatnonzero(np.concatenate(([True], np.diff(p["key"]) != 0))) if len(p) else np.empty(0, np.int64)
    return p, start, np.diff(start, append=len(p))


def _first_pairs(postings: DataFrame) -> DataFrame:
    """kind 0: pairs (a, b) to compare; 1: entries of lists that were not compared pair by pair; 2: hubs of sublists."""

    def of_bucket(p: np.ndarray) -> Iterator[pa.RecordBatch]:
        p, start, length = _lists(p)
        salted = (p["key"][start] & _U((1 << SALT_BITS) - 1)) > 0
        two = start[(length == 2) & ~salted]
        pairs = [np.sort(pairs_of_two(p[two], p[two + 1]), axis=1)]
        size = len(pairs[0])
        for at, n, cut_up in zip(*(x[(length > 2) | salted].tolist() for x in (start, length, salted))):
            own = p[at : at + n]
            got, hubs = pairs_of_list(own, not cut_up)
            if hubs is not None:
                key = own["key"].view(np.int64)
                yield _rows(1, own["id"], 0, key, own["size"], own["pos"])
                if cut_up:
                    yield _rows(2, hubs["id"], 0, hubs["key"].view(np.int64), hubs["size"], hubs["pos"])
            if len(got):
                pairs.append(np.sort(got, axis=1) if hubs is None else got)
                size += len(got)
            if size > 100_000:
                got = np.unique(np.concatenate(pairs), axis=0)
                yield _rows(0, got[:, 0], got[:, 1], 0, 0, 0)
                pairs, size = [], 0
        if size:
            got = np.unique(np.concatenate(pairs), axis=0)
            yield _rows(0, got[:, 0], got[:, 1], 0, 0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handled = 0
        for blob in _by_bucket(batches):
            handled += len(blob)
            yield from of_bucket(np.frombuffer(blob, _POSTING))
        release(handled)

    return _dealt(postings).mapInArrow(run, _OUT)


#: Rows of whole lists that a task compares at once (one list more, at most).
LISTS_ROWS = 50_000


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of their column list, in tables of whole lists."""
    held, size, last = [], 0, None
    for b in batches:
        if not b.num_rows:
            continue
        of = b.column("list").to_numpy()
        new = np.flatnonzero(np.concatenate(([bool(held) and of[0] != last], of[1:] != of[:-1])))
        last = of[-1]
        if size + len(of) >= LISTS_ROWS and len(new):
            yield pa.Table.from_batches([*held, b.slice(0, int(new[-1]))])
            held, size, b = [], 0, b.slice(int(new[-1]))
        held.append(b)
        size += b.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _cross_pairs(entries: DataFrame, lists: DataFrame, some: int = 0) -> DataFrame:
    """entries (key, a, size, pos, root) of the lists (key, many, major, n_major) → pairs (a, b) that may be linked and have different roots:
    all of them, or of each set in each list about `some` that a hash picks, alike in all lists.

    Only sets that are not of the list's most frequent root look for partners. A list of more than BLOCK sets is dealt into blocks: those
    of that root, which meet all others but not each other, and the others, which also meet each other. Each two blocks that
    meet are a group of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handled = 0
        for t in _whole_lists(batches):
            handled += t.nbytes
            key, ids, size, pos, root, block, quota = (t.column(k).to_numpy() for k in ("list", "a", "size", "pos", "root", "own", "quota"))
            p = np.empty(len(key), _POSTING)
            p["key"], p["id"], p["size"], p["pos"] = key.view(_U), ids, size, pos
            root_of = dict(zip(ids.tolist(), root.tolist()))
            at_block = dict(zip(zip(key.tolist(), ids.tolist()), zip(block.tolist(), quota.tolist())))
            p, start, length = _lists(p)
            for at, n in zip(start[length > 1].tolist(), length[length > 1].tolist()):
                lst = IndexList(p[at : at + n])
                name = int(lst.p["key"].view(np.int64)[0])
                roots = np.array([root_of[i] for i in lst.p["id"].tolist()])
                blocks, quotas = (np.array(x) for x in zip(*(at_block[name, i] for i in lst.p["id"].tolist())))
                alone, looks = (blocks == blocks[0]).all(), quotas > 0
                for i in np.flatnonzero(looks).tolist():
                    near = lst.partners(int(lst.size[i]), int(lst.pos[i]))
                    near = near[((near > i) | ~looks[near] | (some > 0)) & (roots[near] != roots[i])]
                    if not alone:
                        near = near[blocks[near] != blocks[i]]
                    if some and len(near) > quotas[i]:
                        own = lst.p["id"].view(_U)
                        near = near[np.argsort(mixed(own[near] * _M ^ own[i]))[: quotas[i]]]
                    if len(near):
                        pair = np.sort(np.column_stack([np.full(len(near), lst.p["id"][i]), lst.p["id"][near]]), axis=1)
                        yield _rows(0, pair[:, 0], pair[:, 1], 0, 0, 0).select(["a", "b"])
        release(handled)

    long, is_major = F.col("many") > BLOCK, F.col("root") == F.col("major")
    apart = long & is_major
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    block = lambda of: F.pmod(F.xxhash64("a"), of.cast("long")).cast("int")
    dealt = entries.join(lists, "key")
    dealt = dealt.withColumns({"m": F.when(long, blocks(F.col("n_major"))).otherwise(0), "n": blocks(F.when(long, F.col("many") - F.col("n_major")).otherwise(F.col("many")))})
    dealt = dealt.withColumns({
        "own": F.when(apart, block(F.col("m"))).otherwise(F.col("m") + block(F.col("n"))),
        "first": F.when(apart, F.col("m")).otherwise(0),
        "meets": F.when(apart, F.col("n")).otherwise(F.col("m") + F.col("n")),
    })
    dealt = dealt.withColumn("quota", F.when(is_major, 0).otherwise(F.greatest(F.lit(1), F.floor(F.lit(some) / F.col("meets")))).cast("int"))
    columns = ["key", "a", "size", "pos", "root", "own", "quota"]
    once = dealt.where("meets = 1").select(*columns, F.col("first").alias("other"))
    again = dealt.where("meets > 1").select(*columns, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("meets") - 1)).alias("other"))
    groups = once.union(again).withColumn("list", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    groups = groups.select("list", "a", "size", "pos", "root", "own", "quota").repartition("list").sortWithinPartitions("list")
    return _few_tasks(groups, lists.agg(F.sum("many")).head()[0] or 0).mapInArrow(run, "a long, b long").distinct()


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set, shingles as bytes) for the sets in pairs: read again from one document each, picked by a filter of fixed size."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct().join(classes, "set").select("rep")
    bit = F.coalesce(F.xxhash64("rep"), F.lit(0).cast("long")).bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int")
    got = needed.select(bit.alias("bit")).distinct().limit(FILTER_BITS).toArrow().column("bit").to_numpy()
    bits = np.zeros(FILTER_BITS, bool)
    bits[got] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHash(), set()
        for b in (c for b in batches for c in chunks(b)):
            at = b.column(1).to_numpy(zero_copy_only=False)
            picked = shared.value[at >> 3] >> (at & 7) & 1
            ids, blobs = [], []
            for k in np.flatnonzero(picked):
                s = shingles(b.column(0)[int(k)].as_py(), words)
                own = set_id(s)
                if own and own not in seen:
                    seen.add(own)
                    ids.append(own)
                    blobs.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) // 8 for x in blobs], pa.int64()), pa.array(blobs, pa.binary())], names=["set", "n", "blob"])
        release()

    hashed = F.coalesce(F.xxhash64("id"), F.lit(0).cast("long")).bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int")
    return docs.select("text", hashed.alias("bit")).mapInArrow(run, "set long, n long, blob binary")


#: Partners of one set that meet in a group.
GROUP = 256


def _filtered(pairs: DataFrame, many: DataFrame, blobs: DataFrame, sketched: bool) -> DataFrame:
    """The pairs (a, b) that pass a test of their blobs (set, n, blob): sketches, or the sets themselves. many: (a, many) of the pairs.

    Each group holds a set a and up to about GROUP of its partners, each with its blob; a task streams over its groups, so a
    hub with very many partners is many groups."""
    parts = F.ceil(F.col("many") / GROUP).cast("int")
    hot = many.where(F.col("many") > GROUP)
    part = F.when(F.col("many").isNull(), 0).otherwise(F.pmod(F.xxhash64("b"), parts.cast("long")).cast("int"))
    dealt = pairs.join(hot, "a", "left").select("a", "b", part.alias("part"))
    of = lambda k: blobs.select(F.col("set").alias(k), "n", "blob")
    rows = dealt.join(of("b"), "b").select("a", "part", "b", "n", "blob")
    hubs = many.select("a", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    hubs = hubs.join(of("a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "n", "blob")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, size, own = None, 0, None
        for batch in batches:
            a, b = [], []
            for x, y, n, blob in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                if y is None:
                    hub, size, own = x, n, blob if sketched else np.frombuffer(blob, _U)
                    continue
                if x != hub:
                    raise ValueError("a partner without its hub")
                need = least_overlap(size, n)
                if min(size, n) < need:
                    continue
                if sketched:
                    passed = sketch_allows(own, size, blob, n)
                else:
                    s, t = own, np.frombuffer(blob, _U)
                    if len(s) > len(t):
                        s, t = t, s
                    at = np.searchsorted(t, s)
                    at[at == len(t)] = 0
                    passed = int((t[at] == s).sum()) >= need
                if passed:
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = rows.union(hubs).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return _few_tasks(dealt, many.agg(F.sum("many")).head()[0] or 0).mapInArrow(run, "a long, b long")


def _partners(pairs: DataFrame) -> DataFrame:
    """How many pairs each a has: apart from the joins with it, which can then be split at a hot hub."""
    return stored(pairs.groupBy("a").agg(F.count("*").alias("many")), "partners")


def _compared(docs: DataFrame, classes: DataFrame, sketches: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, a stored table: sketches rule out most others, and the sets are compared of those that are left."""
    many = _partners(pairs)
    likely = stored(_filtered(pairs, many, sketches, True), "likely-pairs")
    discard(many)
    many = _partners(likely)
    out = stored(_filtered(likely, many, _sets(docs, classes, likely), False), "links")
    discard(many, likely)
    return out


def _bucket_count(docs: DataFrame) -> int:
    """Buckets of the index, so that one of them is of about BUCKET_BYTES of text however large the table."""
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return max(8 * shuffle_partitions(docs.sparkSession), -(-total // BUCKET_BYTES))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs → id, n_shingles, component_id (the least id that is reachable by links).

    One row per input row. Two documents link when 4 × intersection >= 3 × union of their sets of 5-word shingles (of fewer
    words: the whole sequence; A-Z lower-cased; words by ASCII white space). Null and empty texts have the empty set and link
    with nothing: their component is their own id. Ids may repeat, and null ids come out null unless a
    document of their component has an id. Other columns are not read. Exact but for equal 64-bit hashes.

    Shuffles: fingerprints by set; about a quarter of all shingles, as bytes, once to count and once to index them; sketches
    of pairs that meet in the index, and the sets of those that may be linked; never pairs of copies. Lists of a frequent shingle are dealt into sublists of SUBLIST sets.
    A task holds one bucket of the index, or some lists, at a time. Tables on the way are removed when the last reader has written.
    """
    docs = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    with tidy(docs.sparkSession):
        members, by_set = _labelled(docs)
    out = members.join(by_set, (F.col("set") == F.col("s")) & (F.col("n") > 0), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs (id, text) → (id, n, set) of every document, and (s, component_id) of every set: stored tables."""
    buckets = _bucket_count(docs)
    scanned = stored(_scan(docs, buckets), "shingle-sets")
    members = stored(scanned.where("kind = 0").select("id", "n", "set"), "members")
    classes = stored(members.where("n > 0").groupBy("set").agg(F.min("id").alias("rep")), "sets")
    sketches = stored(scanned.where("kind = 0 AND blob IS NOT NULL").select("set", "n", "blob").dropDuplicates(["set"]), "sketches")
    frequent = _frequent(scanned)
    discard(scanned)
    first = stored(_first_pairs(_postings(docs, frequent, buckets)), "index-pairs")
    low = (1 << SALT_BITS) - 1
    hubs = first.where("kind = 2").select(F.col("key").bitwiseAND(F.lit(~low)).alias("key"), "a", "size", "pos").distinct()
    #: Hubs of the sublists of one shingle meet: each is its own root.
    several = hubs.groupBy("key").agg(F.count("*").alias("many"), F.min("a").alias("major"), F.lit(1).cast("long").alias("n_major"))
    several = stored(several.where("many > 1"), "lists")
    met = _cross_pairs(hubs.withColumn("root", F.col("a")), several)
    done = stored(first.where("kind = 0").select("a", "b").union(met).distinct(), "pairs")
    discard(several)
    links = _compared(docs, classes, sketches, done)
    roots = components(links)
    #: Lists that were not compared pair by pair, and whose sets are not all of one component by now. Where that leaves very many pairs,
    #: a few of each set come first: most of a loose group is of one component then, and the rest is compared with all.
    listed = first.where("kind = 1").select(F.col("key").bitwiseAND(F.lit(~low)).alias("key"), "a", "size", "pos")
    for some in (SOME, 0):
        entries = listed.join(roots, F.col("a") == F.col("node"), "left").withColumn("root", F.coalesce("root", "a")).drop("node")
        most = F.max(F.struct("n", "root"))
        by_root = entries.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("many"), F.sum(F.col("n") * F.col("n")).alias("within"), most["root"].alias("major"), most["n"].alias("n_major"))
        several = stored(by_root.where(F.col("within") < F.col("many") * F.col("many")), "lists")
        if some:
            crossing = several.agg(F.sum("many").alias("n"), F.sum(F.col("many").cast("double") * F.col("many") - F.col("within")).alias("pairs")).head()
            if not crossing["n"] or crossing["pairs"] <= DENSE * crossing["n"]:
                discard(several)
                continue
        known = done.union(done.select("b", "a"))
        left = stored(_cross_pairs(entries, several.drop("within"), some).join(known, ["a", "b"], "left_anti"), "pairs")
        discard(several)
        if left.head():
            new = _compared(docs, classes, sketches, left)
            #: The roots stand for all links found so far.
            both = stored(new.union(roots.select("node", "root")), "links")
            discard(new, links, roots)
            links, roots = both, components(both)
            every = stored(done.union(left), "pairs") if some else done
            discard(*(() if every is done else (done,)))
            done = every
        discard(left)
    discard(first, sketches, done, links)
    labelled = stored(classes.join(roots, F.col("set") == F.col("node"), "left").select("set", "rep", F.coalesce("root", "set").alias("root")), "labelled")
    discard(classes, roots)
    least = stored(labelled.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    by_set = stored(labelled.join(least, "root").select(F.col("set").alias("s"), "component_id"), "components")
    discard(labelled, least)
    return members, by_set
