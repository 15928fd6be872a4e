"""Filtered top-k similarity search with numbered, source-linked results."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import snippet
from ..functions.vectors import cosine, dot, norm
from ..schemas import CHUNK_TYPES
from ..sources.scratch import stored

#: Questions up to this number are broadcast to the index; a larger batch is answered in blocks of so many. Blocks of one plan.
BROADCAST_QUESTIONS, BLOCKS_A_PLAN = 16_384, 16
#: Questions and rows of one matrix product.
CHUNK_QUESTIONS, CHUNK_ROWS = 1_024, 2_048
#: What a cosine may be below the k-th one and still be among the k best when rounded to four decimals, errors of floating point included.
SLACK = 1e-4 + 1e-8


def chunk_type_filter(chunk_type: str | None) -> Column:
    """Exact equality on a known type; nothing or the empty string: no filter."""
    if not chunk_type:
        return F.lit(True)
    if chunk_type not in CHUNK_TYPES:
        raise ValueError(f"chunk_type must be one of {', '.join(CHUNK_TYPES)}")
    return F.col("chunk_type") == chunk_type


def checked_top_k(top_k: int, most: int = 20) -> int:
    if not 1 <= top_k <= most:
        raise ValueError(f"top_k must be from 1 to {most}")
    return top_k


def top_k(index: DataFrame, vector: list[float], k: int = 5, key: str = "chunk_id", embedding: str = "embedding") -> DataFrame:
    """One question: the k best rows of the index with rank and score (4 decimals, ties by key).

    Each task keeps k rows (TakeOrderedAndProject); vectors are not part of the result.
    """
    q = F.array(*(F.lit(float(x)) for x in vector))
    scored = index.withColumn("score", F.round(F.coalesce(cosine(F.col(embedding), q), F.lit(0.0)), 4)).drop(embedding)
    best = scored.orderBy(F.desc("score"), key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of vectors in double precision, shorter ones filled up with zeros; their lengths (-1: null or with a null in it); and their norms, summed from left to right."""
    ends = column.offsets.to_numpy()
    sizes = np.diff(ends)
    if len(sizes) and not column.null_count and (sizes == sizes[0]).all() and not (flat := column.flatten()).null_count:
        m = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)
        sizes = sizes.astype(np.int64)
    else:
        rows = column.to_pylist()
        sizes = np.array([-1 if r is None or None in r else len(r) for r in rows], np.int64)
        m = np.zeros((len(rows), max(sizes, default=0) if len(rows) else 0))
        for i in np.flatnonzero(sizes > 0):
            m[i, : sizes[i]] = rows[i]
    return m, sizes, np.sqrt(_dots(m, m))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of rows, summed as `functions.vectors.dot` does it, to the last bit."""
    out = np.zeros(len(a))
    with np.errstate(all="ignore"):
        for j in range(a.shape[1]):
            out += a[:, j] * b[:, j]
    return out


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _rounded(scores: np.ndarray) -> np.ndarray:
    """To four decimals, halves away from zero, in ten thousandths; what is no number comes before all."""
    at = np.abs(scores) * 1e4
    out = np.sign(scores) * np.floor(at + 0.5)
    for i in np.flatnonzero(np.abs(at % 1 - 0.5) < 1e-6):  # by the decimals of the number, as Spark rounds
        out[i] = float(Decimal(repr(float(scores[i]))).quantize(Decimal("0.0001"), ROUND_HALF_UP)) * 1e4
    return np.where(np.isnan(scores), np.inf, np.rint(out))


class _Best:
    """The k best rows for each of a chunk of questions, of the rows that a task has seen."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, norms: np.ndarray, groups: np.ndarray, k: int):
        self.vectors, self.sizes, self.norms, self.groups, self.k = vectors, sizes, norms, groups, k
        self.odd = (sizes >= 0) & ~np.isfinite(vectors).all(1)
        self.units = np.where(((norms > 0) & np.isfinite(norms))[:, None], vectors, 0) / np.where((norms > 0) & np.isfinite(norms), norms, 1)[:, None]
        self.least = np.full(len(vectors), -1e30)
        self.held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.n = 0

    def see(self, keys: pa.Array, vectors: np.ndarray, sizes: np.ndarray, norms: np.ndarray, units: np.ndarray, odd: np.ndarray, groups: np.ndarray | None) -> None:
        width = max(vectors.shape[1], self.vectors.shape[1])
        cosine = _wide(self.units, width) @ _wide(units, width).T
        if (sizes[0] != self.sizes).any() or (sizes != sizes[0]).any():
            cosine[self.sizes[:, None] != sizes] = 0
        if odd.any() or self.odd.any():  # the score of what is not finite is no number, and comes first
            cosine[(odd | self.odd[:, None]) & (self.sizes[:, None] == sizes) & (sizes >= 0)] = 2
        if groups is not None:
            cosine[self.groups[:, None] != groups] = -np.inf
        if (self.least == -1e30).any() and len(keys) >= self.k:
            self.least = np.maximum(self.least, np.partition(cosine, len(keys) - self.k, axis=1)[:, len(keys) - self.k] - SLACK)
        q, row = np.nonzero(cosine >= np.maximum(self.least, -1e30)[:, None])
        if len(q):
            dots = np.concatenate([_dots(_wide(self.vectors[q[i : i + 65_536]], width), _wide(vectors[row[i : i + 65_536]], width)) for i in range(0, len(q), 65_536)])
            with np.errstate(all="ignore"):
                both = self.norms[q] * norms[row]
                there = (self.sizes[q] == sizes[row]) & (sizes[row] >= 0) & ~(both <= 0)
                scores = np.where(there, dots / both, 0.0)
            self.held.append((q, scores, keys.take(pa.array(row))))
            self.n += len(q)
            if self.n > 8 * self.k * len(self.vectors):
                self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, pa.Array] | None:
        """(question, score, key) of the k best rows of each question by rounded score and key."""
        if not self.held:
            return None
        q, scores, keys = np.concatenate([h[0] for h in self.held]), np.concatenate([h[1] for h in self.held]), pa.concat_arrays([h[2] for h in self.held])
        ranks = np.empty(len(keys), np.int64)
        ranks[pc.sort_indices(pa.table([keys], ["k"]), sort_keys=[("k", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(keys))
        order = np.lexsort((ranks, -_rounded(scores), q))
        first = np.concatenate(([True], q[order][1:] != q[order][:-1]))
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        last = order[place == self.k - 1]
        self.least[q[last]] = np.maximum(self.least[q[last]], np.where(np.isnan(scores[last]), 2.0, scores[last]) - SLACK)
        own = order[place < self.k]
        self.held, self.n = [(q[own], scores[own], keys.take(pa.array(own)))], len(own)
        return self.held[0]


def _answers(index: DataFrame, questions: DataFrame, k: int, key: str, embedding: str, same: tuple[str, str] | None) -> DataFrame:
    """(question_id, key, score) of each task's k best rows for each question of one block, which every task gets.

    Rows meet questions in matrix products; only pairs that may count are scored, as the SQL functions of `functions.vectors` score them.
    """
    own = questions.select("question_id", "question_embedding", *([same[1]] if same else [])).toArrow().combine_chunks()
    cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in own.columns]
    cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
    known = pc.unique(cols[2]).drop_null() if same else None
    # Of a null group are no rows: -1 in questions, -2 in rows.
    groups = pc.fill_null(pc.index_in(cols[2], known), -1).to_numpy() if same else np.zeros(own.num_rows)
    vectors = _vectors(cols[1])
    shared = index.sparkSession.sparkContext.broadcast((cols[0], *vectors, groups, known))
    rows = index.select(F.col(key).alias("key"), F.col(embedding).alias("embedding"), *([same[0]] if same else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, sizes, norms, groups, known = shared.value
        chunks = [slice(i, i + CHUNK_QUESTIONS) for i in range(0, len(ids), CHUNK_QUESTIONS)]
        best = [_Best(vectors[c], sizes[c], norms[c], groups[c], k) for c in chunks]
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK_ROWS):
                b = whole.slice(at, CHUNK_ROWS)
                m, n, norm = _vectors(b.column(1))
                fine = (norm > 0) & np.isfinite(norm)
                units = np.where(fine[:, None], m, 0) / np.where(fine, norm, 1)[:, None]
                odd = (n >= 0) & ~np.isfinite(m).all(1)
                group = pc.fill_null(pc.index_in(b.column(2), known), -2).to_numpy() if known is not None else None
                for x in best:
                    x.see(b.column(0), m, n, norm, units, odd, group)
        for c, x in zip(chunks, best):
            if found := x.best():
                yield pa.RecordBatch.from_arrays([ids[c].take(pa.array(found[0])), found[2], pa.array(found[1])], names=["question_id", key, "score"])

    kinds = questions.schema["question_id"].dataType.simpleString(), index.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"question_id {kinds[0]}, `{key}` {kinds[1]}, score double")


def top_k_batch(index: DataFrame, questions: DataFrame, k: int = 5, key: str = "vec_id", embedding: str = "embedding", on: Column | None = None, same: tuple[str, str] | None = None) -> DataFrame:
    """Many questions (question_id, question_embedding, ...): the k best index rows of each. same: a column of the index and one of the questions that must be equal.

    Every question meets every row, block of questions by block, in matrix products within the tasks that read the index; a question costs k rows a task. With
    another condition (on), pairs are joined and scored by expressions. The answers of very many blocks are written by groups of blocks, so that no plan grows
    with the questions.
    """
    n = questions.count()
    blocks = max(1, -(-n // BROADCAST_QUESTIONS))
    w = Window.partitionBy("question_id").orderBy(F.desc("score"), key)
    if on is not None:
        index = index.withColumn("_norm", norm(F.col(embedding)))  # once a row, not once a pair
        questions = questions.withColumn("question_norm", norm(F.col("question_embedding")))
    both = F.col("_norm") * F.col("question_norm")

    def answers(q: DataFrame) -> DataFrame:
        if on is None:
            pairs, score = _answers(index, q, k, key, embedding, same), F.col("score")
        else:
            pairs = index.join(F.broadcast(q), on)
            score = F.coalesce(F.when(both > 0, dot(F.col(embedding), F.col("question_embedding")) / both), F.lit(0.0))
        return pairs.select("question_id", key, F.round(score, 4).alias("score")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    if blocks == 1:
        return answers(questions)
    done = []
    for first in range(0, blocks, BLOCKS_A_PLAN):
        own = [answers(questions.where(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == b)) for b in range(first, min(blocks, first + BLOCKS_A_PLAN))]
        part = reduce(DataFrame.unionByName, own)
        done.append(part if blocks <= BLOCKS_A_PLAN else stored(part, "answers"))
    return reduce(DataFrame.unionByName, done)


def sources(hits: DataFrame, chars: int = 280, keep: tuple[str, ...] = ()) -> DataFrame:
    """Citation rows: the columns in keep, rank, record, link, score and a snippet of the text (or the hits' own snippet, if they have one)."""
    shown = F.col("snippet") if "snippet" in hits.columns else snippet(F.col("text"), chars).alias("snippet")
    return hits.select(*keep, F.col("rank").alias("citation"), "record_id", "chunk_type", "source_url", "score", shown)


def context_blocks(hits: DataFrame, group: str, rank: str, record: str, kind: str, text: str) -> DataFrame:
    """The numbered excerpts of each group as one string, in order of rank; hits hold k rows a group."""
    block = F.concat(F.lit("["), F.col(rank).cast("string"), F.lit("] Record "), F.col(record).cast("string"), F.lit(" ("), F.col(kind), F.lit(")\n"), F.col(text))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), block.alias("b"))))
    return hits.groupBy(group).agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "\n\n---\n\n").alias("context"))
