"""Exact similarity search that looks at part of the index: by pivots and the triangle inequality, or by 8-bit codes with proven bounds.

Both give the rows that `retrieval.top_k_batch` gives: the k best by cosine rounded to four decimals, ties by key. Bounds hold for the exact cosine, and
allow for the rounding and for errors of floating point (SLACK).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot, norm
from ..sources.scratch import stored

#: Half a step of the rounded score, and what sums of products in double precision may be off.
SLACK = 0.5e-4 + 1e-9
#: Pivots, which are broadcast with their vectors, at most.
PIVOTS = 1024
#: Questions whose vectors and bounds are broadcast at once.
QUESTIONS = 1_000


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of vectors in double precision. A vector that is null or holds nulls counts as zero; all others have one length."""
    rows = column.to_pylist()
    width = max((len(r) for r in rows if r), default=0)
    return np.array([r if r and None not in r else [0.0] * width for r in rows], np.float64).reshape(len(rows), width)


def _units(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one (zero vectors stay), and which are not zero."""
    n = np.sqrt((m * m).sum(1))
    return m / np.where(n > 0, n, 1)[:, None], n > 0


def _score(embedding: str, question: str) -> Column:
    both = norm(F.col(embedding)) * norm(F.col(question))
    return F.round(F.coalesce(F.when(both > 0, dot(F.col(embedding), F.col(question)) / both), F.lit(0.0)), 4)


def _best(pairs: DataFrame, key: str, k: int) -> DataFrame:
    """(question_id, key, score) → the k best of each question with their rank; each task keeps k of them before they are shuffled."""
    w = Window.partitionBy("question_id").orderBy(F.desc("score"), key)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


@dataclass
class PivotIndex:
    """rows: key, pivot, angle, embedding (a stored table); pivots: vectors of length one; low, high: the angles of each pivot's rows; size: their number.

    The last pivot has no vector: it holds the zero vectors, whose score is 0 for every question.
    """

    rows: DataFrame
    key: str
    pivots: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray


def pivot_index(index: DataFrame, key: str = "vec_id", embedding: str = "embedding", pivots: int | None = None) -> PivotIndex:
    """Each vector with the pivot that is nearest by angle. Pivots are the vectors of the least key hashes, about the square root of all, PIVOTS at most."""
    spark = index.sparkSession
    rows = index.select(F.col(key).alias("key"), F.col(embedding).alias("embedding"))
    n = rows.count()
    want = min(PIVOTS, max(1, round(n**0.5))) if pivots is None else pivots
    some = rows.orderBy(F.xxhash64("key"), "key").limit(want).toArrow()  # at most PIVOTS vectors
    units, real = _units(_matrix(some.column("embedding").combine_chunks())) if some.num_rows else (np.zeros((0, 0)), np.zeros(0, bool))
    units = units[real]
    shared = spark.sparkContext.broadcast(units)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            vec, there = _units(_matrix(b.column(1)))
            pivot, angle = np.full(len(vec), len(own), np.int32), np.zeros(len(vec))
            if len(own) and there.any():
                cosine = np.clip(vec[there] @ own.T, -1, 1)
                pivot[there] = cosine.argmax(1)
                angle[there] = np.arccos(cosine.max(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pivot), pa.array(angle), b.column(1)], names=["key", "pivot", "angle", "embedding"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    assigned = rows.mapInArrow(assign, f"key {kind['key']}, pivot int, angle double, embedding {kind['embedding']}")
    done = stored(assigned.repartitionByRange("pivot", F.xxhash64("key")).sortWithinPartitions("pivot"), "pivot-index")  # groups lie together, large ones in many files
    groups = done.groupBy("pivot").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).collect()  # a row for each pivot
    low, high, size = np.full(len(units) + 1, np.inf), np.full(len(units) + 1, -np.inf), np.zeros(len(units) + 1, np.int64)
    for r in groups:
        low[r["pivot"]], high[r["pivot"]], size[r["pivot"]] = r["low"], r["high"], r["n"]
    return PivotIndex(done, key, units, low, high, size)


def _block(questions: DataFrame) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Ids, vectors, unit vectors and which are not zero, of so few questions that every task may have them."""
    own = questions.toArrow()
    ids, vectors = own.column("question_id").combine_chunks(), own.column("question_embedding").combine_chunks()
    return ids, vectors, *(_units(_matrix(vectors)) if len(ids) else (np.zeros((0, 0)), np.zeros(0, bool)))


def _blocks(questions: DataFrame) -> Iterator[DataFrame]:
    """Questions (question_id, question_embedding) in blocks of about QUESTIONS."""
    rows = questions.select("question_id", "question_embedding")
    blocks = max(1, -(-rows.count() // QUESTIONS))
    for at in range(blocks):
        yield rows.where(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == at) if blocks > 1 else rows


def _visits(index: PivotIndex, units: np.ndarray, there: np.ndarray, k: int, kth: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(questions × pivots) which groups to look at and the angles to the pivots; and how far a row's angle to the pivot may be from the question's.

    Without bounds the nearest groups that have k rows together; with kth, the k-th best cosine of these at least, all groups that may hold a row as good.
    """
    n, p = len(units), len(index.pivots)
    angles = np.zeros((n, p + 1))
    if p and n:
        angles[:, :p] = np.where(there[:, None], np.arccos(np.clip(units @ index.pivots.T, -1, 1)), 0.0)
    full = index.size > 0
    if kth is None:
        order = np.argsort(np.where(np.arange(p + 1) < p, angles, np.pi), axis=1, kind="stable")
        held = np.cumsum(index.size[order], axis=1) - index.size[order]
        visits = np.zeros((n, p + 1), bool)
        np.put_along_axis(visits, order, held < k, axis=1)
        return visits & full, angles, np.full(n, np.pi)
    reach = np.where(there, np.arccos(np.clip(kth, -1, 1)) + 1e-7, np.pi)
    bound = np.maximum(0, np.maximum(angles - index.high, index.low - angles))
    visits = bound <= reach[:, None]
    visits[:, p] = kth <= 0  # zero vectors score 0
    return (visits | ~there[:, None]) & full, angles, reach


def _trimmed(scores: np.ndarray, ranks: np.ndarray, k: int) -> np.ndarray:
    """Of one question's candidates, given by cosine and the rank of their key, those that may be among the k best by rounded score and key.

    Of candidates with one score (to nine places) the k least keys are enough, unless the score is at an edge between two rounded ones.
    """
    if len(scores) <= 4 * k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[-k] - 2 * SLACK
    at = np.flatnonzero(scores >= least)
    nine = np.round(scores[at], 9)
    order = np.lexsort((ranks[at], nine))
    first = np.concatenate(([True], nine[order][1:] != nine[order][:-1]))
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    edge = np.abs(np.abs(scores[at][order]) * 1e4 % 1 - 0.5) < 1e-3
    return at[order[(place < k) | edge]]


def _scan(index: PivotIndex, units: np.ndarray, visits: np.ndarray, angles: np.ndarray, reach: np.ndarray, k: int, least: np.ndarray) -> DataFrame:
    """(q, key, cosine): of each task's rows the candidates for the k best of each question, among the groups that it visits and the rows within reach.

    A narrow map: rows of a group meet the questions that visit it in one matrix product, and pairs that do not matter never become rows.
    """
    shared = index.rows.sparkSession.sparkContext.broadcast((units, visits, angles, reach, least))
    wanted = np.flatnonzero(visits.any(0)).tolist()
    rows = index.rows.where(F.col("pivot").isin(wanted)) if len(wanted) < visits.shape[1] else index.rows
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, visits, angles, reach, least = shared.value
        held: dict[int, list[tuple]] = {}

        def best(q: int) -> tuple[np.ndarray, pa.Array]:
            scores = np.concatenate([s for s, _ in held[q]])
            keys = pa.concat_arrays([x for _, x in held[q]])
            ranks = np.empty(len(keys), np.int64)
            ranks[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))
            own = _trimmed(scores, ranks, k)
            held[q] = [(scores[own], keys.take(pa.array(own)))]
            return held[q][0]

        for b in batches:
            pivot, angle = b.column(1).to_numpy(), b.column(2).to_numpy()
            unit, _ = _units(_matrix(b.column(3)))
            for p in np.unique(pivot):
                at, own = np.flatnonzero(pivot == p), np.flatnonzero(visits[:, p])
                if not len(own):
                    continue
                cosine = unit[at] @ units[own].T
                far = np.abs(angle[at][:, None] - angles[own, p]) > reach[own] if p < visits.shape[1] - 1 else False
                cosine[(cosine < least[own]) | far] = -np.inf
                for j in np.flatnonzero((cosine > -np.inf).any(0)):
                    i = np.flatnonzero(cosine[:, j] > -np.inf)
                    q = int(own[j])
                    held.setdefault(q, []).append((cosine[i, j], b.column(0).take(pa.array(at[i]))))
                    if sum(len(s) for s, _ in held[q]) > 64 * k:
                        best(q)
        for q in held:
            scores, keys = best(q)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), q, np.int32)), keys, pa.array(scores)], names=["q", "key", "cosine"])

    return rows.mapInArrow(run, f"q int, key {kind}, cosine double")


def _rescored(few: DataFrame, index: DataFrame, ids: pa.Array, vectors: pa.Array, key: str, k: int) -> DataFrame:
    """Candidates (q, key) with their vectors (index: key, embedding) → the k best of each question, scored as `top_k_batch` does it."""
    names = index.sparkSession.createDataFrame(pa.table({"q": pa.array(range(len(ids)), pa.int32()), "question_id": ids, "question_embedding": vectors}))
    full = few.select("q", "key").join(index, "key").join(F.broadcast(names), "q")
    return _best(full.select("question_id", F.col("key").alias(key), _score("embedding", "question_embedding").alias("score")), key, k)


def _kth(found: DataFrame, n: int, k: int) -> np.ndarray:
    """The k-th greatest of each question's values (q, value); -2 where there are fewer. A row for each question of a block goes to the driver."""
    w = Window.partitionBy("q").orderBy(F.desc("value"))
    out = np.full(n, -2.0)
    for r in found.withColumn("n", F.row_number().over(w)).where(F.col("n") == k).select("q", "value").collect():
        out[r["q"]] = r["value"]
    return out


def top_k_pruned(index: PivotIndex, questions: DataFrame, k: int = 5) -> DataFrame:
    """The k best rows of the index for each question (question_id, question_embedding): question_id, key, score, rank.

    Questions go in blocks, which are broadcast. The nearest groups with k rows give each question of a block a bound; then only groups that may hold as
    good a row are scanned, and of these only rows whose angle to the pivot allows it count. The index is not shuffled, so a group of very many rows is the
    work of many tasks; candidates, a few for each question and task, are scored exactly.
    """
    found = []
    for block in _blocks(questions):
        ids, vectors, units, there = _block(block)
        visits = _visits(index, units, there, k, None)
        first = _scan(index, units, *visits, k, np.full(len(ids), -np.inf))
        kth = _kth(first.select("q", F.col("cosine").alias("value")), len(ids), k) - 2 * SLACK
        few = _scan(index, units, *_visits(index, units, there, k, kth), k, kth)
        found.append(_rescored(few, index.rows.select("key", "embedding"), ids, vectors, index.key, k))
    return _all(found, "pruned-answers")


def _all(found: list[DataFrame], name: str) -> DataFrame:
    """The answers of all blocks; of many blocks they are stored, so that no plan grows with the questions."""
    out = found[0] if len(found) == 1 else stored(found[0], name)
    for more in found[1:]:
        out = out.unionByName(stored(more, name))
    return out


def compared_share(index: PivotIndex, questions: DataFrame, k: int = 5) -> float:
    """Of all pairs of questions and rows, the share in groups that `top_k_pruned` scans (of the first 1,000 questions by hash, if there are more)."""
    ids, _, units, there = _block(next(iter(_blocks(questions))))
    visits = _visits(index, units, there, k, None)
    kth = _kth(_scan(index, units, *visits, k, np.full(len(ids), -np.inf)).select("q", F.col("cosine").alias("value")), len(ids), k) - 2 * SLACK
    n = int((visits[0] * index.size).sum() + (_visits(index, units, there, k, kth)[0] * index.size).sum())
    return n / max(1, int(index.size.sum()) * len(ids))


# Codes


def coded_index(index: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """key, code (a byte for each dimension), scale and off: |x / |x| - scale * code| <= off, a bound proven for each vector. A stored table."""
    rows = index.select(F.col(key).alias("key"), F.col(embedding).alias("embedding"))
    kind = rows.schema["key"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit, _ = _units(_matrix(b.column(1)))
            scale = np.abs(unit).max(1, initial=0) / 127
            codes = np.rint(unit / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8)
            off = np.sqrt(((unit - scale[:, None] * codes) ** 2).sum(1)) + 1e-12
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(off)], names=["key", "code", "scale", "off"])

    return stored(rows.mapInArrow(code, f"key {kind}, code binary, scale double, off double"), "coded-index")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of so few rows that their estimates for a block of questions are 16 MB."""
    for b in batches:
        for at in range(0, b.num_rows, 2_048):
            yield b.slice(at, 2_048)


def _estimates(b: pa.RecordBatch, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(questions × rows) estimates of the cosine, and how far each row's may be off: by Cauchy-Schwarz, as a question has length one."""
    codes = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int8).reshape(b.num_rows, -1).astype(np.float64)
    return (units @ codes.T) * b.column(2).to_numpy(), b.column(3).to_numpy() + 1e-9


def top_k_coded(codes: DataFrame, index: DataFrame, questions: DataFrame, k: int = 5, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The same answers from `coded_index`: codes are scanned twice, a byte a dimension, and few vectors are read in full.

    The first scan finds the k-th best lower bound of each question; rows whose upper bound reaches it are candidates, which are joined with their vectors
    and scored in double precision. Questions (question_id, question_embedding) go in blocks of QUESTIONS, whose vectors are broadcast.
    """
    spark = index.sparkSession
    kind = {f.name: f.dataType.simpleString() for f in codes.schema}
    rows, full = codes.select("key", "code", "scale", "off"), index.select(F.col(key).alias("key"), F.col(embedding).alias("embedding"))
    found = []
    for block in _blocks(questions):
        ids, vectors, units, _ = _block(block)
        shared = spark.sparkContext.broadcast(units)

        def bounds(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = np.full((len(shared.value), 0), 0.0)
            for b in _slices(batches):
                if len(shared.value):
                    estimate, off = _estimates(b, shared.value)
                    best = np.concatenate((best, estimate - off), axis=1)
                    best = np.partition(best, best.shape[1] - k, axis=1)[:, -k:] if best.shape[1] > k else best
            q = np.repeat(np.arange(len(best)), best.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(best.reshape(-1))], names=["q", "value"])

        kth = _kth(rows.mapInArrow(bounds, "q int, value double"), len(ids), k)
        limits = spark.sparkContext.broadcast(kth - 2 * SLACK)

        def candidates(batches: Iterator[pa.RecordBatch], shared=shared, limits=limits) -> Iterator[pa.RecordBatch]:
            for b in _slices(batches):
                if len(shared.value):
                    estimate, off = _estimates(b, shared.value)
                    q, row = np.nonzero(estimate + off >= limits.value[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), b.column(0).take(pa.array(row))], names=["q", "key"])

        found.append(_rescored(rows.mapInArrow(candidates, f"q int, key {kind['key']}"), full, ids, vectors, key, k))
    return _all(found, "coded-answers")
