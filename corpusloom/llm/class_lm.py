"""Language-model scoring with a class-based bigram model, whose classes exchange clustering finds.

Every word of the training texts is counted. Of the frequent ones, bigrams with all neighbours are counted too, and laid out in blocks, each of which
has all neighbours of its words. Exchange clustering moves a word to the class where the likelihood of the class bigrams gains most: in a round, the
blocks try a part of their words each, in parallel, from the class statistics of the round before, and keep their own moves in mind; the
statistics are then counted anew. Words beyond those clustered belong to classes by shape. A text's probability is the product of smoothed
class transitions and of word emissions; perplexity follows from it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, release, shuffle_partitions, small_batches, stored, tidy

#: The end of a text as a token: no word holds white space.
END = b"\n"
#: Shapes of words that are not clustered.
SHAPES = ("letters", "long letters", "digits", "end mark", "mark", "other script", "with digits", "other")
#: Words whose counts all tasks know, and bytes of the longest of them; all others are joined. Speed only.
HEAD, LONGEST = 1 << 18, 64
#: Words that a task counts before it hands them on; bigrams that it holds.
HELD, PAIRS_HELD = 250_000, 2_000_000
#: Blocks of the table of neighbours. A block has at most 4 * clustered words' pairs of each direction by 1/BLOCKS.
BLOCKS = 128
#: A round tries one word in so many, so that frequent words do not all move by the same statistics.
TURNS = 4


@dataclass(frozen=True)
class Rules:
    """clustered: the most frequent words, which are clustered if they occur min_count times; classes of them; rounds at most; gain: share of the likelihood below which rounds end
    (after TURNS of them, in which each word was tried once)."""

    clustered: int = 1 << 14
    min_count: int = 3
    classes: int = 64
    rounds: int = 16
    gain: float = 2e-4


@dataclass(frozen=True)
class Model:
    """counts: a stored table of every training word (word, c). index: the head's words → number; c, node: their counts and nodes (a node is a
    clustered word, a shape or the end); class_of: node → class;
    transition: log10 P(class | class); emission: log10 of the denominator of a word's emission by class."""

    counts: DataFrame
    n: int
    distinct: int
    head_from: int
    index: dict[bytes, int]
    c: np.ndarray
    node: np.ndarray
    class_of: np.ndarray
    transition: np.ndarray
    emission: np.ndarray

    @property
    def shapes_from(self) -> int:
        return len(self.class_of) - len(SHAPES) - 1


def shape(word: bytes) -> int:
    if word.isalpha():
        return 0 if len(word) <= 8 else 1
    if word.isdigit():
        return 2
    if word[:-1].isalpha():
        if word[-1] < 128:
            return 3 if word[-1] in b".!?" else 4
        return 5
    if max(word) > 127:
        return 5
    return 6 if any(48 <= x < 58 for x in word) else 7


def tokens(text: str | None) -> list[bytes]:
    """The words, A-Z lower-cased; bytes part at ASCII white space only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs → word (bytes), c: all words of all texts, and END once a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], names=["word", "c"])
            sums.clear()
            return got

        handled = 0
        for b in batches:
            handled += b.nbytes
            sums[END] += b.num_rows
            for text in b.column(0):
                sums.update(tokens(text.as_py()))
                if len(sums) > HELD:
                    yield rows()
        yield rows()
        release(handled)

    return small_batches(docs).select(text_col).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _rank(c: Column) -> Column:
    """Sixteen steps for each doubling of a count."""
    return F.floor(F.log2(c) * 16).cast("int")


def head_of(counts: DataFrame, head: int = HEAD) -> tuple[int, pa.Table]:
    """The rank from which on words are known to all tasks, and these words, by count (ties: by bytes): at most `head` of at most LONGEST bytes."""
    short = counts.where(F.length("word") <= LONGEST)
    ranks = sorted(((r["rank"], r["n"]) for r in short.groupBy(_rank(F.col("c")).alias("rank")).agg(F.count("*").alias("n")).collect()), reverse=True)  # a row for each step
    total, first = 0, 1 << 20
    for rank, n in ranks:
        total += n
        if total > head:
            break
        first = rank
    got = short.where(_rank(F.col("c")) >= first).toArrow()
    return first, got.sort_by([("c", "descending"), ("word", "ascending")])


def _nodes(texts: list[list[bytes]], index: dict[bytes, int], node: np.ndarray, shapes_from: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(number in the head or -1, node) of the texts' tokens, one text after the other, END at its end; and the tokens."""
    flat = [t for text in texts for t in (*text, END)]
    number = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, len(flat))
    out = node[number]
    beyond = np.flatnonzero(number < 0)
    if len(beyond):
        out[beyond] = [shapes_from + shape(flat[i]) for i in beyond]
    return number, out, flat


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their sums."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[edges], np.add.reduceat(n[order], edges) if len(edges) else n[:0]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed parts of a block follow each other; they are added up whenever they outgrow what was added up before."""
    none = np.empty(0, np.int64)
    at, held, parts, waiting = None, (none, none), [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        return _sums(*(np.concatenate([x[k] for x in (held, *parts)]) for k in (0, 1)))

    def row() -> pa.RecordBatch:
        keys, n = added()
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([keys.tobytes()]), pa.array([n.tobytes()])], names=["block", "part", "keys", "n"])

    for b in batches:
        for block, part, *cells in zip(*(c.to_pylist() for c in b.columns)):
            if (block, part) != at:
                if at is not None:
                    yield row()
                at, held, parts, waiting = (block, part), (none, none), [], 0
            parts.append(tuple(np.frombuffer(x, np.int64) for x in cells))
            waiting += len(parts[-1][0])
            if waiting > max(PAIRS_HELD, len(held[0])):
                held, parts, waiting = added(), [], 0
    if at is not None:
        yield row()


def neighbours(docs: DataFrame, index: dict[bytes, int], node: np.ndarray, nodes: int, text_col: str = "text") -> DataFrame:
    """docs → block, keys, n: for each node and direction (0: what follows, 1: what precedes) the neighbouring nodes with their counts, as packed
    int64; a key is (node * 2 + direction) * nodes + neighbour. Block b has the nodes that are b modulo BLOCKS. A text is preceded by an end."""
    shared = docs.sparkSession.sparkContext.broadcast((index, node))
    shapes_from = nodes - len(SHAPES) - 1
    n_parts = max(1, round(docs.rdd.getNumPartitions() ** 0.5 / 8))  # with many input partitions a block is merged by neighbours first, in more tasks

    def packed(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        place = keys // (2 * nodes) % BLOCKS * n_parts + keys % nodes % n_parts
        order = np.argsort(place, kind="stable")
        keys, n, place = keys[order], n[order], place[order]
        edges = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1], [True]))) if len(keys) else np.zeros(1, np.int64)
        cols = [pa.array([c[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary()) for c in (keys, n)]
        place = place[edges[:-1]]
        return pa.RecordBatch.from_arrays([pa.array(place // n_parts, pa.int64()), pa.array(place % n_parts, pa.int64()), *cols], names=["block", "part", "keys", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, node = shared.value
        none = np.empty(0, np.int64)
        keys, n, handled = none, none, 0
        for b in batches:
            handled += b.nbytes
            own = [none]
            for text in b.column(0):
                _, seq, _ = _nodes([tokens(text.as_py())], index, node, shapes_from)
                before = np.concatenate(([nodes - 1], seq[:-1]))
                own += [before * 2 * nodes + seq, (seq * 2 + 1) * nodes + before]
            own, m = np.unique(np.concatenate(own), return_counts=True)
            keys, n = _sums(np.concatenate((keys, own)), np.concatenate((n, m)))
            if len(keys) > PAIRS_HELD:
                yield packed(keys, n)
                keys, n = none, none
        yield packed(keys, n)
        release(handled)

    kinds = "block long, part long, keys binary, n binary"
    rows = small_batches(docs).select(text_col).mapInArrow(count, kinds)
    by = ["block", "part"]
    rows = rows.repartition(max(n_parts * 4, shuffle_partitions(docs.sparkSession)), *by).sortWithinPartitions(*by).mapInArrow(_merged, kinds)
    if n_parts > 1:  # what is left has each pair once
        rows = rows.withColumn("part", F.lit(0).cast("long")).repartition(BLOCKS, "block").sortWithinPartitions("block").mapInArrow(_merged, kinds)
    return rows.drop("part")


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(pairs: np.ndarray) -> float:
    """The part of the log likelihood of class bigrams that classes decide."""
    return float(_f(pairs).sum() - 2 * _f(pairs.sum(1)).sum())


def exchanged(keys: np.ndarray, n: np.ndarray, nodes: int, class_of: np.ndarray, pairs: np.ndarray, classes: int, turn: int | None) -> dict[int, int]:
    """Moves of a block's clustered words, in their order: node → its new class, for each that gains by it.

    pairs: class bigrams. turn: which of TURNS parts of the words is tried (None: all). The gain of a move is exact, given the moves of this block so far.
    """
    pairs, class_of = pairs.astype(np.float64), class_of.copy()
    size, fine, total = pairs.sum(1), _f(pairs), pairs.shape[0]
    moves: dict[int, int] = {}
    owner, other = keys // nodes, keys % nodes
    edges = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
    sides: dict[int, list] = defaultdict(lambda: [None, None])
    for x, y in zip(edges, edges[1:]):
        sides[int(owner[x]) // 2][int(owner[x]) % 2] = (other[x:y], n[x:y])
    movable = nodes - len(SHAPES) - 1
    for w, (follow, precede) in sides.items():
        if w >= movable or turn is not None and (w + w // BLOCKS + turn) % TURNS or follow is None or precede is None:
            continue
        a = int(class_of[w])
        right = np.bincount(class_of[follow[0]], follow[1], total)
        left = np.bincount(class_of[precede[0]], precede[1], total)
        own = float(follow[1][follow[0] == w].sum())
        weight = right.sum()
        pairs[a] -= right
        pairs[:, a] -= left
        pairs[a, a] += own
        size[a] -= weight
        fine[a], fine[:, a] = _f(pairs[a]), _f(pairs[:, a])
        right[a] -= own
        left[a] -= own
        r, l = np.flatnonzero(right), np.flatnonzero(left)
        gain = (_f(pairs[:classes, r] + right[r]) - fine[:classes, r]).sum(1) + (_f(pairs[l, :classes] + left[l, None]) - fine[l, :classes]).sum(0)
        diagonal = np.diagonal(pairs)[:classes]
        once = np.diagonal(fine)[:classes]
        gain += _f(diagonal + right[:classes] + left[:classes] + own) + once - _f(diagonal + right[:classes]) - _f(diagonal + left[:classes])
        gain -= 2 * (_f(size[:classes] + weight) - _f(size[:classes]))
        b = int(gain.argmax())
        if gain[b] <= gain[a] + 1e-9 * weight:
            b = a
        if a != b:
            moves[w] = b
        pairs[b] += right
        pairs[:, b] += left
        pairs[b, b] += own
        size[b] += weight
        fine[b], fine[:, b] = _f(pairs[b]), _f(pairs[:, b])
        class_of[w] = b
    return moves


def cluster(blocks: DataFrame, words: int, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """(class of each node, class bigrams) after the exchange. blocks: see `neighbours`; the first `words` nodes are clustered words by frequency."""
    nodes, total = words + len(SHAPES) + 1, rules.classes + len(SHAPES) + 1
    sc = blocks.sparkSession.sparkContext
    class_of = np.concatenate((np.arange(words) % rules.classes, np.arange(rules.classes, total))).astype(np.int64)

    def counted(class_of: np.ndarray) -> np.ndarray:
        shared = sc.broadcast(class_of)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = np.zeros(total * total, np.int64)
            for b in batches:
                for _, keys, n in zip(*(c.to_pylist() for c in b.columns)):
                    keys, n = np.frombuffer(keys, np.int64), np.frombuffer(n, np.int64)
                    follows = keys // nodes % 2 == 0
                    cell = shared.value[keys[follows] // (2 * nodes)] * total + shared.value[keys[follows] % nodes]
                    np.add.at(got, cell, n[follows])
            yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()])], names=["pairs"])

        parts = blocks.mapInArrow(run, "pairs binary").toArrow().column("pairs").to_pylist()  # one for each task, of which there are at most BLOCKS with rows
        shared.destroy()
        return np.sum([np.frombuffer(p, np.int64) for p in parts] or [np.zeros(total * total, np.int64)], axis=0).reshape(total, total)

    pairs = counted(class_of)
    best = before = (likelihood(pairs.astype(float)), class_of, pairs)
    for turn in range(rules.rounds):
        shared = sc.broadcast((class_of, pairs))

        def run(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            moves: dict[int, int] = {}
            for b in batches:
                for _, keys, n in zip(*(c.to_pylist() for c in b.columns)):
                    moves |= exchanged(np.frombuffer(keys, np.int64), np.frombuffer(n, np.int64), nodes, *shared.value, rules.classes, turn)
            yield pa.RecordBatch.from_arrays([pa.array(list(moves), pa.int64()), pa.array(list(moves.values()), pa.int64())], names=["node", "class"])

        moves = blocks.mapInArrow(run, "node long, class long").toArrow()  # at most the clustered words
        shared.destroy()
        class_of = class_of.copy()
        class_of[moves.column("node").to_numpy()] = moves.column("class").to_numpy()
        pairs = counted(class_of)
        now = (likelihood(pairs.astype(float)), class_of, pairs)
        best = max(best, now, key=lambda x: x[0])
        _, class_of, pairs = best  # moves of different blocks may spoil each other: such a round does not count
        if turn % TURNS == TURNS - 1:
            if best[0] - before[0] < rules.gain * abs(best[0]):
                break
            before = best
    return class_of, pairs


def fit(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", head: int = HEAD) -> Model:
    """The model of all texts of docs; head: see HEAD. Null texts are empty ones; an empty table gives a model that knows no word."""
    spark = docs.sparkSession
    with tidy(spark):
        counts = stored(token_counts(docs, text_col), "token-counts")
        n, distinct = counts.where(F.col("c") > 0).agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).head()
        counts = counts.where(F.col("c") > 0)
        first, head = head_of(counts, head)
        ends = (counts.where(F.col("word") == END).head() or (END, 0))[1]
        c = dict(zip(head.column("word").to_pylist(), head.column("c").to_pylist())) | {END: ends}  # the end is known even if it is rare
        found = list(c)
        words = [w for w in found if w != END and c[w] >= rules.min_count][: rules.clustered]
        nodes = len(words) + len(SHAPES) + 1
        index = {w: k for k, w in enumerate(found)}
        number = {w: k for k, w in enumerate(words)}
        node = np.array([number[w] if w in number else nodes - 1 if w == END else len(words) + shape(w) for w in found], np.int64)
        blocks = stored(neighbours(docs, index, node, nodes, text_col), "neighbours")
        class_of, pairs = cluster(blocks, len(words), rules)
        discard(blocks)
        members = np.bincount(class_of, minlength=len(pairs)).astype(float)
        members[rules.classes : rules.classes + len(SHAPES)] = 1 + _shape_members(counts, words)  # and one that stands for all unknown words
    size = pairs.sum(0).astype(float)
    emission = np.log10(np.maximum(size + 0.5 * members, 0.5))
    followers = np.maximum((pairs > 0).sum(1), 1).astype(float)
    prior = (size + 0.5) / (size.sum() + 0.5 * len(size))
    transition = np.log10((pairs + followers[:, None] * prior) / (pairs.sum(1) + followers)[:, None])
    return Model(counts, n or 0, distinct, first, index, np.array(list(c.values())), node, class_of, transition, emission)


def _shape_members(counts: DataFrame, words: list[bytes]) -> np.ndarray:
    """How many different words that are not clustered have each shape."""
    shared = counts.sparkSession.sparkContext.broadcast(frozenset(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(len(SHAPES), np.int64)
        for b in batches:
            for w in b.column(0).to_pylist():
                if w != END and w not in shared.value:
                    got[shape(w)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(SHAPES)), pa.int64()), pa.array(got)], names=["shape", "n"])

    rows = counts.select("word").mapInArrow(run, "shape long, n long").groupBy("shape").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(SHAPES))
    for r in rows:
        out[r["shape"]] = r["n"]
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **extra: Column) -> DataFrame:
    """docs → id, extra columns, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    One row per input row. base_score: a unigram model with 0.5 added to each count; score: log10 of the text's probability by the class model;
    perplexity: 10 to the power of -score / n_tokens. Null and empty texts are their end alone. Ids may be null or repeat; columns that are not named
    are not read. A word of the head is scored where it stands; the others are joined with the counts, once a text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.index, model.c, model.node, model.class_of, model.transition, model.emission))
    shapes_from, unigram = model.shapes_from, float(np.log10(model.n + 0.5 * (model.distinct + 1)))
    rows = small_batches(docs).select(F.col(id_col).alias("id"), *(c.alias(f"x{k}") for k, c in enumerate(extra.values())), F.col(text_col).alias("text"))
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
    names = ["n_tokens", "n_known", "base_score", "score", "beyond", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, c, node, class_of, transition, emission = shared.value
        logs, met = np.log10(c + 0.5), c > 0
        handled = 0
        for b in batches:
            handled += b.nbytes
            out = []
            for text in b.column(b.num_columns - 1):
                number, nodes, flat = _nodes([tokens(text.as_py())], index, node, shapes_from)
                classes = class_of[nodes]
                moves = transition[np.concatenate(([len(transition) - 1], classes[:-1])), classes].sum()
                here = number >= 0
                shown = logs[number[here]].sum()  # the words beyond are added later
                beyond = Counter([flat[i] for i in np.flatnonzero(~here)])
                word = shown - logs[number[-1]] - emission[classes[:-1]].sum()  # the end's emission is certain
                out.append((len(flat), int(met[number[here]].sum()), shown - len(flat) * unigram, moves + word, list(beyond), list(beyond.values())))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, cols, kinds)], names=[*b.schema.names[:-1], *names])
        release(handled)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    made = rows.mapInArrow(run, f"{kept}, n_tokens long, n_known long, base_score double, score double, beyond array<binary>, times array<int>")
    with tidy(spark):
        made = stored(made.withColumn("row", F.monotonically_increasing_id()), "scored")  # written once, so a row keeps its number
        rest = model.counts.where((_rank(F.col("c")) < model.head_from) | (F.length("word") > LONGEST))
        words = made.select("row", F.explode(F.arrays_zip("beyond", "times")).alias("w")).select("row", F.col("w.beyond").alias("word"), F.col("w.times").alias("t"))
        c = F.coalesce("c", F.lit(0))
        sums = words.join(rest, "word", "left").groupBy("row").agg(F.sum(F.log10(c + 0.5) * F.col("t")).alias("more"), F.sum(F.when(c > 0, F.col("t")).otherwise(0)).alias("met"))
        sums = stored(sums.withColumnRenamed("row", "_row"), "scored-beyond")
    all_rows = made.drop("beyond", "times")
    joined = all_rows.join(sums, F.col("row") == F.col("_row"), "left")
    more, met = F.coalesce("more", F.lit(0.0)), F.coalesce("met", F.lit(0))
    score = F.col("score") + more
    return joined.select(
        F.col("id").alias(id_col),
        *(F.col(f"x{k}").alias(name) for k, name in enumerate(extra)),
        "n_tokens",
        (F.col("n_known") + met).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
