"""Toxicity by noisy-channel deobfuscation.

A written token is taken as a word that went through a channel of leetspeak, spacing and repetition.
Its characters form a lattice of what each may stand for; Viterbi decoding under a character trigram model,
counted over the whole corpus, restores the likeliest text. The restored text is scored with word and
word-beginning odds learned from labelled documents, by a logistic model on the document's strongest and total evidence.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, discard, shuffle_partitions, small_batches, stored, tidy

#: Letters that a written character may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
#: Costs, as log probabilities of the channel: writing another sign, putting one between letters, repeating a letter.
SIGN, BETWEEN, REPEAT = -1.0, -1.0, -0.5
#: Signs that hardly stand between letters without standing for one, and the cost of that.
_MEANT, UNMEANT = "0123456789@$!€£", -7.0
_SEPARATORS = "._-~'’,:;/\\"
_EDGE = ".,;:!?\"'()[]{}«»“”„…<>/\\"
_ORNAMENT = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$")
_NOISE = re.compile(r"(\w)\1\1|[0-9@$!|+(€£¡*._~\-]")
_LETTER = re.compile(r"[^\W\d_]")
#: Three or more single characters with white space between.
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t\r\n\f\v]+\S(?!\S)){2,}")
#: Signs that join words, and those that stand for spaces in a token with noise.
_JOINT = re.compile(r"[,;:/\\]")
_DOT = re.compile(r"[._~\-]")
SYMBOLS = 28  # 0: not a letter, 1-26: a-z without accents, 27: another letter
#: Labelled documents that are used (least hash first). They bound the features too.
SAMPLE_DOCS = 20_000
CACHED = 300_000


@lru_cache(1)
def _codes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isalpha():
            base = unicodedata.normalize("NFD", ch.lower())[0]
            table[c] = ord(base) - 96 if "a" <= base <= "z" else 27
    table[0x3000:] = 27
    table[0x2000:0x2C00] = 0
    return table


def code(ch: str) -> int:
    return int(_codes()[ord(ch)])


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of three symbols in a row, runs of other than letters as one 0."""
    s = _codes()[np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
    keep = s > 0
    keep[1:] |= s[:-1] > 0
    s = s[keep]
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3) if len(s) > 2 else np.zeros(SYMBOLS**3, np.int64)


def corpus_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts of all texts: each task sends at most SYMBOLS^3 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for b in batches:
            held, size = [], 0
            for t in b.column(0).to_pylist():
                held.append(t or "")
                size += len(held[-1])
                if size > 1_000_000:
                    total += trigram_counts(held)
                    held, size = [], 0
            total += trigram_counts(held)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    got = small_batches(docs).select(text_col).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(SYMBOLS**3)
    total[got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return total


def log_probs(counts: np.ndarray, weight: float = 50.0) -> np.ndarray:
    """P(c | a, b) smoothed with P(c | b), and that with P(c)."""
    c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1 + 1).sum()
    p2 = (c2 + weight * p1) / (c2.sum(1, keepdims=True) + weight)
    return (c3 + weight * p2) / (c3.sum(2, keepdims=True) + weight)


class Decoder:
    """Restores tokens by Viterbi search under a trigram model."""

    def __init__(self, log_p: np.ndarray):
        self.log_p = log_p.ravel().tolist()

    def lattice(self, chars: str) -> Iterator[list[tuple[str, float]]]:
        i = 0
        while i < len(chars):
            ch, j = chars[i], i
            while j < len(chars) and chars[j] == ch:
                j += 1
            n, i = j - i, j
            inner = 0 < j - n and j < len(chars)
            if _LETTER.match(ch):
                yield [(ch * n, 0.0)] if n < 2 else [(ch, REPEAT if n > 2 else 2 * REPEAT), (ch * 2, REPEAT if n > 2 else 0.0)]
            elif ch == " ":
                yield [("", 0.0), (" ", 0.0)]
            elif ch in LEET:
                options = [(x, SIGN * min(n, 2)) for x in LEET[ch]] + ([(x * 2, SIGN * 2) for x in LEET[ch][:2]] if n == 2 else [])
                yield options + [("", UNMEANT if ch in _MEANT and (inner or n < 3) else BETWEEN if inner else 0.0)]
            elif ch in _SEPARATORS:
                yield [("", BETWEEN), (" ", 0.0)] if inner else [("", 0.0)]
            else:
                yield [(" ", 0.0)]

    def decode(self, chars: str) -> str:
        """The likeliest letters for the lower-case characters; a space where words part. What all paths have is put out at once."""
        log_p = self.log_p
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        done: list[str] = []

        def put(path: tuple) -> None:
            out = []
            while path:
                path, text = path
                out.append(text)
            done.extend(reversed(out))

        for column in self.lattice(chars):
            new: dict[int, tuple[float, tuple]] = {}
            for state, (score, path) in best.items():
                for text, cost in column:
                    s, at = score + cost, state
                    for ch in text:
                        c = code(ch)
                        if c or at % SYMBOLS:
                            s += log_p[at * SYMBOLS + c]
                            at = at % SYMBOLS * SYMBOLS + c
                    if at not in new or s > new[at][0]:
                        new[at] = (s, (path, text) if text else path)
            best = new
            if len(best) == 1:
                ((at, (score, path)),) = best.items()
                put(path)
                best = {at: (score, ())}
        put(max(((s + (log_p[at * SYMBOLS] if at % SYMBOLS else 0.0), p) for at, (s, p) in best.items()), key=lambda x: x[0])[1])
        return "".join(done).strip()

    def restore_token(self, token: str) -> str:
        """The token in lower case, without edge punctuation and ornament, decoded if it shows noise."""
        word = token.strip(_EDGE)
        word = _ORNAMENT.sub("", word).strip(_EDGE).lower()
        if not (_NOISE.search(word) or _JOINT.search(word)) or not _LETTER.search(word):
            return word
        for sign in (_JOINT, _DOT):
            if sign is _DOT and "@" in word and "." in word.partition("@")[2]:
                return word
            parts = sign.split(word)
            if len(parts) > 1 and (len(parts) < 3 or max(map(len, parts)) > 1):
                return " ".join(filter(None, map(self.restore_token, parts)))
        return self.decode(word)

    def restore(self, text: str) -> str:
        """The text in lower case with every token restored, single spaces between."""
        return " ".join(filter(None, map(self.restore_token, WORD.findall(text)))) + "".join(f" {w}" for w in self.spaced(text))

    def spaced(self, text: str) -> list[str]:
        """Words of the runs of single characters."""
        return [w for m in _SPACED.finditer(text) if len(_LETTER.findall(m[0])) > 1 for w in self.decode(" ".join(m[0].lower().split())).split()]


def features(word: str) -> list[str]:
    """The word and its beginnings of 3 to 8 letters."""
    return [word, *(f"^{word[:n]}" for n in range(3, min(8, len(word)) + 1))]


NONE = (0.0, 0.0, 0.0)


@dataclass
class Model:
    odds: dict[str, float]
    log_p: np.ndarray
    weights: tuple[float, ...]


class Scorer(dict):
    """Evidence of a token: the greatest log odds of the features of its restored words, 0 if none is known."""

    def __init__(self, model: Model):
        self.odds, self.decoder, self.weights = model.odds, Decoder(model.log_p), model.weights

    def of_word(self, word: str) -> float:
        odds = self.odds
        return max([odds.get(f, 0.0) for f in features(word)], default=0.0)

    def __missing__(self, token: str) -> float:
        value = max(map(self.of_word, self.decoder.restore_token(token).split()), default=0.0)
        if len(self) >= CACHED:
            self.clear()
        if len(token) <= 64:
            self[token] = value
        return value

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Strongest evidence; logarithms of its sum, and of its sum in 100 words."""
        if not text:
            return NONE
        tokens = WORD.findall(text)
        hits = [v for v in map(self.__getitem__, tokens) if v]
        if _SPACED.search(text):
            hits += [v for v in map(self.of_word, self.decoder.spaced(text)) if v]
        return (max(hits), math.log1p(sum(hits)), math.log1p(100 * sum(hits) / len(tokens))) if hits else NONE

    def score(self, text: str | None) -> float:
        x = sum(w * v for w, v in zip(self.weights, (1.0, *self.evidence(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _odds(sample: DataFrame, min_docs: int = 3, min_odds: float = 2.5) -> dict[str, float]:
    """Log odds of the features of plain tokens by document, for features with clear odds in enough toxic documents.

    Enough by a likelihood-ratio test whose bound grows with the logarithm of the documents only: what a small table
    shows, a larger one of the same kind shows too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = {}

        def rows() -> pa.RecordBatch:
            n = list(sums.values())
            out = pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x[1] for x in n], pa.int64()), pa.array([x[0] for x in n], pa.int64())], names=["feature", "pos", "neg"])
            sums.clear()
            return out

        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = {_ORNAMENT.sub("", t.strip(_EDGE)).strip(_EDGE).lower() for w in WORD.findall(text or "") for t in _JOINT.split(w)}
                for f in {f for w in words if w and not _NOISE.search(w) for f in features(w)}:
                    sums.setdefault(f, [0, 0])[toxic] += 1
                sums.setdefault("", [0, 0])[toxic] += 1
                if len(sums) > 300_000:
                    yield rows()
        if sums:
            yield rows()

    sums = sample.select("text", "toxic").mapInArrow(run, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    sums = stored(sums, "toxicity-features")
    every = sums.where(F.col("feature") == "").head()
    if not every or not every["pos"] or not every["neg"]:
        discard(sums)
        return {}
    odds = F.log((F.col("pos") + 0.5) / (every["pos"] + 1)) - F.log((F.col("neg") + 0.5) / (every["neg"] + 1))
    n_docs = every["pos"] + every["neg"]
    seen = F.col("pos") + F.col("neg")

    def part(n: Column, of: Column, all_of: int) -> Column:
        return F.when(n > 0, n * F.log(n * n_docs / (of * all_of))).otherwise(0.0)

    ratio = sum((part(F.col(c), seen, every[c]) + part(every[c] - F.col(c), n_docs - seen, every[c]) for c in ("pos", "neg")), F.lit(0.0))
    clear = (F.col("pos") >= min_docs) & (ratio >= math.log(n_docs))
    got = sums.where((F.col("feature") != "") & clear).withColumn("odds", odds).where(F.col("odds") >= min_odds)
    rows = got.collect()
    discard(sums)
    most: dict[str, int] = {}  # of a beginning: the documents of its most frequent word
    for r in rows:
        if not r["feature"].startswith("^"):
            for f in features(r["feature"])[1:]:
                most[f] = max(most.get(f, 0), r["pos"])
    #: A beginning counts only where it says more than its most frequent word does.
    return {r["feature"]: r["odds"] for r in rows if r["pos"] >= 1.5 * most.get(r["feature"], 0)}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Newton's method; the ridge keeps separable data finite."""
    z, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> Model:
    """Learn from the given labels (rows with a null id or label are ignored; several of one id count as their greatest).

    The character model counts all documents; the classifier sees at most SAMPLE_DOCS labelled documents, those
    whose ids have the least hashes; where not both labels occur, it scores all alike by their rate (no label: 0).
    """
    with tidy(docs.sparkSession):
        return _fitted(docs, labels, id_col, text_col, toxic_col)


def _fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str) -> Model:
    known = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(toxic_col) != 0).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "_id")
    sample = stored(sample.repartition(shuffle_partitions(docs.sparkSession), "_id"), "toxicity-sample")
    odds = _odds(sample)
    own = trigram_counts([" ".join(f.lstrip("^") for f in odds)]).astype(float)
    corpus, lexicon = log_probs(corpus_counts(docs, text_col)), log_probs(own * 20)
    model = Model(odds, np.log(0.6 * corpus + 0.4 * lexicon), (0.0,) * 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            x = [scorer.evidence(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([v[k] for v in x], pa.float64()) for k in range(3)), b.column(1)], names=["x", "y", "z", "toxic"])

    shared = docs.sparkSession.sparkContext.broadcast(model)
    got = sample.select("text", "toxic").mapInArrow(run, "x double, y double, z double, toxic int").toArrow()
    y = got.column("toxic").to_numpy().astype(float)
    discard(sample)
    if 0 < y.sum() < len(y):
        model.weights = _logistic(np.column_stack([got.column(k).to_numpy() for k in "xyz"]), y)
    else:
        rate = min(max(y.sum() / (len(y) + 1), 1e-6), 1 - 1e-6)
        model.weights = (math.log(rate / (1 - rate)), 0.0, 0.0, 0.0)
    return model


def predict(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", restored: bool = False, **extra: Column) -> DataFrame:
    """docs → id, extra columns, score (0 to 1), predicted and, if asked for, restored_text.

    One row per input row, by a narrow map. Null and empty texts score as texts without evidence. Ids may be null
    or repeat; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = small_batches(docs).select(id_col, *(c.alias(k) for k, c in extra.items()), text_col)
    kept = rows.drop(text_col).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            p = [scorer.score(t) for t in texts]
            cols = [*b.columns[:-1], pa.array(p, pa.float64()), pa.array([int(x >= threshold) for x in p], pa.int32())]
            if restored:
                cols.append(pa.array([scorer.decoder.restore(t or "") for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-1], "score", "predicted", *["restored_text"] * restored])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double, predicted int" + ", restored_text string" * restored)
