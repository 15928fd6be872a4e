"""Greedy packing of the paragraphs of very long texts, by many tasks.

Packing looks like one fold over a text, but where a chunk that begins with paragraph i ends depends on i alone: what it carries over from the chunk before is the
last `overlap` words since the last paragraph that was cut up, whatever chunks these words lay in. So each paragraph has a pointer to the beginning of the next
chunk, and the chunks are the chain of pointers from the first paragraph. Blocks of paragraphs, each with the few paragraphs around it that pointers can
reach, follow the pointers inside; from block to block the chain is resolved by doubling the pointers of the paragraphs at which a block can be entered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import chunk_hash
from ..functions.text import PARAGRAPH_BREAK, paragraphs
from ..sources.scratch import discard, stored, tidy
from .chunking import chunk_texts

#: Paragraphs of a block. Texts with no more of them are packed by one fold, which gives the same.
BLOCK = 4_096
#: Entries of blocks, one each, are broadcast to the paragraphs up to this count.
BROADCAST_ENTRIES = 100_000


def pointers(sizes: np.ndarray, target: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Of paragraphs with so many words: where the chunk that begins with each ends (exclusive), and how many words it carries over.

    What precedes the first one is as if a paragraph had been cut up; what follows the last one as if the text ended.
    """
    n = len(sizes)
    hard = sizes > target
    upto = np.concatenate(([0], np.cumsum(sizes)))
    cut = np.maximum.accumulate(np.where(np.concatenate(([True], hard)), np.arange(n + 1), 0))[:n]  # paragraphs before the first one since the last cut
    carried = np.minimum(overlap, upto[:n] - upto[cut])
    end = np.searchsorted(upto, upto[:n] + target - carried, side="right") - 1
    next_hard = np.minimum.accumulate(np.concatenate((np.where(hard, np.arange(n), n), [n]))[::-1])[::-1][1:]
    end = np.minimum(np.maximum(end, np.arange(n) + 1), np.maximum(next_hard, np.arange(n) + 1))
    return np.where(hard, np.arange(n) + 1, end), np.where(hard, 0, carried)


def _blocked(paras: DataFrame, block: int, target: int, overlap: int) -> DataFrame:
    """paras (row, i, ...) with blk: each in its own block, among the next paragraphs of the block before, and among the last ones of the block after."""
    own = F.floor(F.col("i") / block)
    at = F.col("i") % block
    before = F.when((at <= target) & (own > 0), own - 1)
    after = F.when(at >= block - overlap - 1, own + 1)
    return paras.withColumn("blk", F.explode(F.filter(F.array(own, before, after), lambda b: b.isNotNull())))


def _exits(block: int, target: int, overlap: int):
    """A block's paragraphs (row, blk, i, n) → for those at which it can be entered, where the chain leaves it."""

    def run(table: pa.Table) -> pa.Table:
        row, blk = table.column("row")[0].as_py(), table.column("blk")[0].as_py()
        order = np.argsort(table.column("i").to_numpy())
        i, n = table.column("i").to_numpy()[order], table.column("n").to_numpy()[order]
        end, _ = pointers(n, target, overlap)
        first, last = blk * block, (blk + 1) * block
        own = np.flatnonzero((i >= first) & (i < last))
        leave = i[0] + end  # the numbers are consecutive
        for k in own[::-1]:
            if leave[k] < last and leave[k] - i[0] < len(i):
                leave[k] = leave[leave[k] - i[0]]
        enter = own[i[own] <= first + target] if blk else own[:1]
        return pa.table({"row": pa.array([row] * len(enter), pa.int64()), "i": pa.array(i[enter], pa.int64()), "to": pa.array(leave[enter], pa.int64())})

    return run


def entries(exits: DataFrame) -> DataFrame:
    """exits (row, i, to) → (row, i) that the chain from paragraph 0 meets. A stored table.

    Pointers double: when those of length 2^k are known, what the chain meets within 2^k blocks gives what it meets within twice as many.
    """
    met, jump = stored(exits.where("i = 0").select("row", "i"), "chain"), stored(exits, "jumps")
    while True:
        ahead = stored(met.join(jump, ["row", "i"]).select("row", F.col("to").alias("i")).join(exits.select("row", "i"), ["row", "i"], "left_semi"), "chain")
        if ahead.isEmpty():
            discard(ahead, jump)
            return met
        both = stored(met.union(ahead), "chain")
        further = jump.select("row", F.col("i").alias("_i"), F.col("to").alias("i")).join(jump, ["row", "i"]).select("row", F.col("_i").alias("i"), "to")
        longer = stored(further, "jumps")
        discard(met, ahead, jump)
        met, jump = both, longer


def _chunks(block: int, target: int, overlap: int):
    """A block's paragraphs (row, blk, i, n, text, enter) → its chunks (row, blk, k, text), in order."""
    step = target - overlap

    def run(table: pa.Table) -> pa.Table:
        row, blk = table.column("row")[0].as_py(), table.column("blk")[0].as_py()
        order = np.argsort(table.column("i").to_numpy())
        table = table.take(pa.array(order))
        i, sizes = table.column("i").to_numpy(), table.column("n").to_numpy()
        upto = np.concatenate(([0], np.cumsum(sizes)))
        flat = [w for text in table.column("text").to_pylist() for w in text.split(" ")]
        end, carried = pointers(sizes, target, overlap)
        out: list[str] = []
        entered = np.flatnonzero(table.column("enter").to_numpy(zero_copy_only=False).astype(bool) & (i >= blk * block))
        at = int(entered[0]) if len(entered) else len(i)
        while at < len(i) and i[at] < (blk + 1) * block:
            a, b = int(upto[at]), int(upto[end[at]])
            if sizes[at] > target:
                out += [" ".join(flat[s : min(s + target, b)]) for s in range(a, b, step)]
            else:
                a -= int(carried[at])
                out.append(" ".join(flat[a:b]))
            at = int(end[at])
        n = len(out)
        return pa.table({"row": pa.array([row] * n, pa.int64()), "blk": pa.array([blk] * n, pa.int64()), "k": pa.array(range(n), pa.int64()), "text": pa.array(out, pa.string())})

    return run


def chunk_long_texts(docs: DataFrame, text_col: str, target: int = 380, overlap: int = 60, breaks: str = PARAGRAPH_BREAK, block: int = BLOCK) -> DataFrame:
    """The same rows as `chunking.chunk_texts`, whatever the length of a text: the columns of docs but the text, chunk_index, text, chunk_hash.

    Texts of at most `block` paragraphs are folded; the paragraphs of the others are rows, and blocks of them are packed side by side.
    """
    if not 0 <= overlap < target:
        raise ValueError("overlap must be at least 0 and less than target")
    if block <= target:
        raise ValueError("a block must have more paragraphs than a chunk can")
    keys = [c for c in docs.columns if c != text_col]
    cut = docs.withColumn("_n", F.size(F.split(F.col(text_col), breaks)))
    short = chunk_texts(cut.where(F.coalesce(F.col("_n") <= block, F.lit(False))).drop("_n"), text_col, target, overlap, breaks)
    spark = docs.sparkSession
    with tidy(spark):
        # Written once, so rows keep their numbers; the columns of docs stand at the first paragraph only.
        numbered = cut.where(F.col("_n") > block).select(F.monotonically_increasing_id().alias("row"), F.struct(*keys).alias("own"), paragraphs(F.col(text_col), breaks).alias("paras"))
        every = numbered.select("row", "own", F.posexplode("paras").alias("i", "words"))
        paras = stored(every.select("row", F.when(F.col("i") == 0, F.col("own")).alias("own"), F.col("i").cast("long").alias("i"), F.size("words").cast("long").alias("n"), F.array_join("words", " ").alias("text")), "paragraphs")
        if paras.isEmpty():
            return short
        sizes = _blocked(paras.select("row", "i", "n"), block, target, overlap)
        exits = stored(sizes.groupBy("row", "blk").applyInArrow(_exits(block, target, overlap), "row long, i long, to long"), "exits")
        met = entries(exits)
        entered = met.withColumn("enter", F.lit(True))
        entered = F.broadcast(entered) if met.count() <= BROADCAST_ENTRIES else entered
        marked = paras.select("row", "i", "n", "text").join(entered, ["row", "i"], "left").withColumn("enter", F.coalesce("enter", F.lit(False)))
        chunks = stored(_blocked(marked, block, target, overlap).groupBy("row", "blk").applyInArrow(_chunks(block, target, overlap), "row long, blk long, k long, text string"), "long-chunks")
        before = F.coalesce(F.sum("n").over(Window.partitionBy("row").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each block
        placed = chunks.groupBy("row", "blk").agg(F.count("*").alias("n")).select("row", "blk", before.alias("before"))
        own = stored(paras.where("i = 0").select("row", "own"), "long-texts")
        discard(exits, met, paras)
    rows = chunks.join(placed, ["row", "blk"]).join(own, "row")
    return short.unionByName(rows.select("own.*", (F.col("before") + F.col("k")).cast("int").alias("chunk_index"), "text", chunk_hash(F.col("text")).alias("chunk_hash")))
