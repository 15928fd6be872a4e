"""Spelling variants: words that differ by one code point, found by rolling-hash deletion keys.

Of each word all strings with one code point left out are keyed, without making the strings: from polynomial hashes of its prefixes and suffixes
NumPy computes the keys of a whole block of words as 64-bit integers. The keys are radix-partitioned by their high bits and sorted; keys that only one
word has are dropped, so that only integers were moved for them. The others get their words and are verified on the strings.

Two words of one length are near if they agree without the code point at one position; a word is near to those that become it when one
code point is deleted. Each such pair meets at exactly one key, so counts and best partners are aggregated by key, and no pairs are made.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, release, shuffle_partitions, small_batches, stored, tidy

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words that a task counts before it hands them on.
HELD = 250_000
#: Keys that one task sorts at once, and makes at once.
KEYS_A_BUCKET, KEYS_A_BLOCK = 1_000_000, 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
#: Kinds of keys: the word itself, the word without a code point, and the same with the position.
WHOLE, DELETED, REPLACED = 0, 1, 2


def runs_of(text: str) -> list[str]:
    """The runs of letters, A-Z lower-cased."""
    return RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, min_chars: int = 5) -> DataFrame:
    """docs → word, n. A run whose crc32 with its document's id (null: the empty string) is a multiple of `every` loses one code point; every = 0: none does."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = defaultdict(int)

        def rows() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])
            sums.clear()
            return got

        crc, handled = zlib.crc32, 0
        for b in batches:
            handled += b.nbytes
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                own: dict[str, int] = defaultdict(int)
                for run in runs_of(text.as_py() or ""):
                    own[run] += 1
                start = crc(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in own.items():
                    if every:
                        h = crc(run.encode(), start)
                        if not h % every:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                    if len(run) >= min_chars:
                        sums[run] += n
                if len(sums) > HELD:
                    yield rows()
        yield rows()
        release(handled)

    return small_batches(docs).select(F.col(id_col).cast("string"), text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(h: np.ndarray, length: int = 0) -> np.ndarray:
    h = h + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def deletion_keys(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(word number, kind, position, key) of the words' keys, in blocks.

    Each word has one key of itself, one for each position whose code point is not that of the position before (other deletions give the
    same string), and one for each position with the position mixed in. Arithmetic is modulo 2^64.
    """
    by_length: dict[int, list[int]] = defaultdict(list)
    for k, w in enumerate(words):
        by_length[len(w)].append(k)
    for length, numbers in by_length.items():
        powers = np.ones(length + 1, np.uint64)
        powers[1:] = np.cumprod(np.full(length, _BASE, np.uint64), dtype=np.uint64)
        step = max(1, KEYS_A_BLOCK // (2 * length + 1))
        for at in range(0, len(numbers), step):
            own = np.array(numbers[at : at + step])
            text = "".join(words[k] for k in own)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), length).astype(np.uint64) + np.uint64(1)
            suffix = np.zeros((len(own), length + 1), np.uint64)  # of codes[j:], whose last code has power 0
            suffix[:, :length] = np.cumsum((codes * powers[:length][::-1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
            # The hash of codes[:i] with its last code at power 0, times powers[length - 1 - i], is what the prefix adds to a word that is one shorter.
            prefix = np.zeros((len(own), length), np.uint64)
            for i in range(1, length):
                prefix[:, i] = prefix[:, i - 1] * _BASE + codes[:, i - 1]
            without = prefix * powers[:length][::-1] + suffix[:, 1:]
            shorter = _mixed(without, length - 1)
            position = np.broadcast_to(np.arange(length, dtype=np.int32), without.shape)
            number = np.broadcast_to(own[:, None], without.shape)
            first = np.ones(without.shape, bool)
            first[:, 1:] = codes[:, 1:] != codes[:, :-1]
            whole = _mixed(suffix[:, 0], length)
            replaced = _mixed(shorter + (position.astype(np.uint64) + np.uint64(1)) * _BASE)
            yield (
                np.concatenate([own, number[first], number.reshape(-1)]),
                np.repeat(np.array([WHOLE, DELETED, REPLACED], np.int8), [len(own), int(first.sum()), without.size]),
                np.concatenate([np.full(len(own), -1, np.int32), position[first], position.reshape(-1)]),
                np.concatenate([whole, shorter[first], replaced.reshape(-1)]),
            )


_NAMES = ("keys", "ids", "kinds", "positions")
_TYPES = (np.uint64, np.int64, np.int8, np.int32)


def _partitioned(buckets: int):
    """Arrow batches of (word, its id) → (bucket, four packed columns): the keys, by the high bits that make the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1).to_numpy()
            for number, kind, position, key in deletion_keys(b.column(0).to_pylist()):
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                columns = [key[order], ids[number[order]], kind[order], position[order]]
                bucket = bucket[order]
                edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
                packed = [pa.array([c[x:y].tobytes() for x, y in zip(edges, edges[1:])]) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), *packed], names=["bucket", *_NAMES])

    return run


def _met(table: pa.Table) -> pa.Table:
    """A bucket's keys, sorted: those that two different words have at least."""
    key, word, kind, position = (np.concatenate([np.frombuffer(x, t) for x in table.column(n).to_pylist()]) for n, t in zip(_NAMES, _TYPES))
    order = np.argsort(key, kind="stable")
    key, word = key[order], word[order]
    first = np.concatenate(([True], key[1:] != key[:-1]))
    edges = np.flatnonzero(first)
    of = np.cumsum(first) - 1
    several = np.logical_or.reduceat(word != word[edges][of], edges)[of]
    at = order[several]
    return pa.table({"key": key[several].view(np.int64), "id": word[several], "kind": kind[at], "position": position[at]})


def _partners(rows: list[tuple[str, int, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """Rows (word, n, kind, position) of one key → (word, near words that it meets here, n of the best, the best).

    Words are told apart by the strings that their keys stand for, so a collision of keys joins nothing.
    """
    replaced: dict[tuple[str, int], dict[str, int]] = defaultdict(dict)
    deleted: dict[str, dict[str, int]] = defaultdict(dict)
    whole: dict[str, int] = {}
    for word, n, kind, at in rows:
        if kind == WHOLE:
            whole[word] = n
        elif kind == DELETED:
            deleted[word[:at] + word[at + 1 :]][word] = n
        else:
            replaced[word[:at] + word[at + 1 :], at][word] = n
    best = lambda words: min(((-n, w) for w, n in words.items()))
    for words in replaced.values():
        if len(words) > 1:
            n1, w1 = best(words)
            n2, w2 = best({w: n for w, n in words.items() if w != w1})
            for w in words:
                yield (w, len(words) - 1, -n2, w2) if w == w1 else (w, len(words) - 1, -n1, w1)
    for d, words in deleted.items():
        if d in whole:
            n1, w1 = best(words)
            yield d, len(words), -n1, w1
            for w in words:
                yield w, 1, whole[d], d


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, word, n, kind, position) in order of the key → the partners of each key, whose words are a few hundred at most."""
    held: list[tuple[str, int, int, int]] = []
    last, out = None, []
    for b in batches:
        for key, *row in zip(*(c.to_pylist() for c in b.columns)):
            if key != last:
                out += _partners(held)
                held, last = [], key
            held.append(tuple(row))
        if len(out) > 20_000:
            yield _batch(out)
            out = []
    yield _batch([*out, *_partners(held)])


def _batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """words (word, n; each word once) → word, n_near, best_n, best, for the words that have a near word: their number, and the near word of largest n (ties: the smallest)."""
    spark = words.sparkSession
    keyed = words.withColumn("id", F.xxhash64("word"))
    total = words.agg(F.sum(2 * F.length("word") + 1).alias("k")).head()["k"] or 0
    buckets = max(4 * shuffle_partitions(spark), -(-total // KEYS_A_BUCKET))
    packed = small_batches(keyed).select("word", "id").mapInArrow(_partitioned(buckets), "bucket long, keys binary, ids binary, kinds binary, positions binary")
    met = packed.groupBy("bucket").applyInArrow(_met, "key long, id long, kind byte, position int")
    rows = met.join(keyed, "id").select("key", "word", "n", "kind", "position")
    # Dealt by key; a key's rows follow each other.
    sorted_rows = rows.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    partners = sorted_rows.mapInArrow(_verified, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return partners.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """forms (word, form; forms lead to no circle) → word, root: where following forms ends. A stored table.

    Pointers double: each round every word takes the root so far of its own root so far, until a round changes nothing.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        discard(at)
        at = moved
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """words (word, n) → word, form, root, n, n_near, form_n.

    form: the near word of largest n (ties: the smallest in code-point order) if its n is at least ratio times the word's own, else null;
    root: where forms end. Each word is expected once; words may have any length. An empty table gives an empty one.
    """
    with tidy(words.sparkSession):
        near = stored(near_words(words), "near-words")
        own = words.join(near, "word", "left")
        ok = F.col("best_n") >= ratio * F.col("n")
        own = own.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, F.col("best")).alias("form"), F.when(ok, F.col("best_n")).alias("form_n"))
        found = stored(own, "spelling-forms")
        discard(near)
        ends = roots(found.where(F.col("form").isNotNull()))
        return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_n: int = 3, every: int = 97) -> DataFrame:
    """docs → the words of all whole texts with at least min_chars code points and min_n occurrences, grouped: see `group_variants`.

    Words are maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; one of about `every` runs of a document has lost a code point
    (see `word_counts`). Null and empty texts have no words; a null id counts as the empty string; repeated rows count again. Other columns are not read.
    """
    with tidy(docs.sparkSession):
        words = stored(word_counts(docs, id_col, text_col, every, min_chars).where(F.col("n") >= min_n), "spelling-words")
    return group_variants(words)
