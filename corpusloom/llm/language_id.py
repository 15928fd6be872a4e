"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams are summed over all training documents; the matrix of log
probabilities (buckets × languages) is broadcast, and batches of texts are scored as sparse rows
(row pointers and bucket numbers) against it in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, stored, tidy

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Characters that are hashed at once.
BLOCK = 400_000
#: Languages of one broadcast matrix, which has BUCKETS × 4 bytes a language, so at most 128 MB. With more of them texts are scored in several passes.
LANGUAGES_A_PASS = 512
UNDETERMINED = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def hashed_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of the texts, rows ascending within each order; and whether a text has letters.

    Texts are lower-cased, and what is not a letter becomes one space; each text begins and ends with one.
    """
    low = [f" {t.lower()} " for t in texts]
    row = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) for t in low])
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (row[1:] != row[:-1])
    has = np.bincount(row[letter], minlength=len(low)) > 0
    codes, row = np.where(letter, codes, 32)[keep].astype(np.uint32), row[keep]
    rows, buckets = [], []
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint32(0x01000193) + codes[n - 1 :]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            whole = row[:m] == row[n - 1 :]
            rows.append(row[:m][whole])
            buckets.append(((h[whole] + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)) >> np.uint32(16))
    return np.concatenate(rows), np.concatenate(buckets), has


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of about BLOCK characters; a longer text is a block of its own."""
    at, held, size = 0, [], 0
    for t in texts:
        if held and size + len(t or "") > BLOCK:
            yield at, held
            at, held, size = at + len(held), [], 0
        held.append(t or "")
        size += len(held[-1])
    if held:
        yield at, held


@dataclass(frozen=True)
class Model:
    """languages in code-point order; log_prob: BUCKETS × languages. With very many languages log_prob is None, and their counts are a
    stored table (lang, bucket, n), from which `parts` makes models of LANGUAGES_A_PASS of them."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray | None
    counts: DataFrame | None = None

    def parts(self) -> Iterator[Model]:
        if self.log_prob is not None:
            yield self
            return
        for at in range(0, len(self.languages), LANGUAGES_A_PASS):
            own = self.languages[at : at + LANGUAGES_A_PASS]
            yield Model(own, self.log_prior[at : at + len(own)], _log_prob(self.counts, own))


def _log_prob(counts: DataFrame, languages: list[str], smoothing: float = 0.5) -> np.ndarray:
    """Log probabilities of the buckets in each of so many languages at most as fit one broadcast."""
    table = np.zeros((BUCKETS, len(languages)))
    if languages:
        got = counts.where(F.col("lang").between(languages[0], languages[-1]) & (F.col("bucket") < BUCKETS)).toArrow()
        number = {x: k for k, x in enumerate(languages)}
        lang = got.column("lang").combine_chunks().dictionary_encode()
        of = np.array([number[x] for x in lang.dictionary.to_pylist()], np.int64)[lang.indices.to_numpy()] if got.num_rows else np.empty(0, np.int64)
        table[got.column("bucket").to_numpy(), of] = got.column("n").to_numpy()
    return (np.log(table + smoothing) - np.log(table.sum(0) + smoothing * BUCKETS)).astype(np.float32)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all rows with a language, of which there may be any number. Null texts count as empty; rows with a null language are ignored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])
            sums.clear()

        for b in batches:
            langs = b.column(1).to_pylist()
            for first, texts in blocks(b.column(0).to_pylist()):
                of = langs[first : first + len(texts)]
                names = sorted(set(of))
                number = np.array([names.index(x) for x in of])
                row, bucket, _ = hashed_rows(texts)
                got = np.bincount(number[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for k, lang in enumerate(names):
                    n = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    n[:BUCKETS] += got[k]
                    n[BUCKETS] += int((number == k).sum())
                if len(sums) > 64:
                    yield from rows()
        yield from rows()

    counts = small_batches(docs).where(F.col(lang_col).isNotNull()).select(text_col, lang_col).mapInArrow(count, "lang string, bucket int, n long")
    with tidy(docs.sparkSession):
        sums = stored(counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
        got = sums.where(F.col("bucket") == BUCKETS).orderBy("lang").toArrow()  # a row for each language
        languages, n_docs = got.column("lang").to_pylist(), got.column("n").to_numpy()
        log_prior = np.log(n_docs / max(1, n_docs.sum()))
        if len(languages) > LANGUAGES_A_PASS:
            return Model(languages, log_prior, None, sums)
        model = Model(languages, log_prior, _log_prob(sums, languages))
        discard(sums)
    return model


def evidence(model: Model, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """The likeliest of the model's languages for each text (None: no letters), its log evidence and the log of the sum over all of them; the
    evidence of a long text is tempered to 50 n-grams."""
    names, best, every = [], [], []
    for _, block in blocks(texts):
        row, bucket, has = hashed_rows(block)
        order = np.argsort(row, kind="stable")
        row, bucket = row[order], bucket[order]
        n = np.bincount(row, minlength=len(block))
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        if not model.languages:
            names += [None] * len(block)
            best.append(np.zeros(len(block)))
            every.append(np.zeros(len(block)))
            continue
        total = np.add.reduceat(model.log_prob[bucket], first, axis=0, dtype=np.float64) + model.log_prior
        k = total.argmax(1)
        p = total / np.maximum(1, n / 50)[:, None]
        top = p.max(1)
        names += [model.languages[j] if ok else None for j, ok in zip(k, has)]
        best.append(p[np.arange(len(block)), k])
        every.append(top + np.log(np.exp(p - top[:, None]).sum(1)))
    return names, np.concatenate([[], *best]), np.concatenate([[], *every])


def score(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The likeliest language of each text, and its probability."""
    names, best, every = evidence(model, texts)
    return [UNDETERMINED if x is None else x for x in names], [0.0 if x is None else float(p) for x, p in zip(names, np.exp(best - every))]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **extra: Column) -> DataFrame:
    """docs → id, extra columns, lang_pred, score.

    One row per input row. Null texts and texts without a letter are `und` with score 0, as is every text where
    no language was learned. Ties go to the first language in code-point order. Ids may be null or repeat.
    A narrow map: the texts are not shuffled. (Above LANGUAGES_A_PASS languages: a map for each pass, with the same result.)
    """
    rows = small_batches(docs).select(id_col, *(c.alias(k) for k, c in extra.items()), text_col)
    kept = rows.drop(text_col).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    if model.log_prob is None:
        return _predicted_in_passes(rows, model, fields, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, probs = score(shared.value, b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names, pa.string()), pa.array(probs, pa.float64())], names=[*b.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")


def _predicted_in_passes(rows: DataFrame, model: Model, fields: str, text_col: str) -> DataFrame:
    """rows (kept columns, text) with the best language so far, pass by pass; one matrix is broadcast at a time, and the rows are written between."""
    text_field = f"`{text_col}` string"
    rows = rows.withColumns({"_name": F.lit(None).cast("string"), "_best": F.lit(float("-inf")), "_every": F.lit(float("-inf"))})
    spark, before = rows.sparkSession, None
    for part in model.parts():
        shared = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                *kept, texts, name, best, every = b.columns
                names, own, total = evidence(shared.value, texts.to_pylist())
                old = best.to_numpy()
                better = own > old
                name = [x if y or x is None else z for x, y, z in zip(names, better, name.to_pylist())]
                cols = [pa.array(name, pa.string()), pa.array(np.where(better, own, old)), pa.array(np.logaddexp(total, every.to_numpy()))]
                yield pa.RecordBatch.from_arrays([*kept, texts, *cols], names=b.schema.names)

        with tidy(spark):
            rows = stored(rows.mapInArrow(run, f"{fields}, {text_field}, _name string, _best double, _every double"), "language-pass")
        shared.destroy()
        discard(*([before] if before is not None else []))
        before = rows
    found = F.col("_name").isNotNull()
    return rows.drop(text_col).withColumns({"lang_pred": F.coalesce("_name", F.lit(UNDETERMINED)), "score": F.when(found, F.exp(F.col("_best") - F.col("_every"))).otherwise(0.0)}).drop("_name", "_best", "_every")
