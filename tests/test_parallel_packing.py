import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.chunking import chunk_texts
from corpusloom.operators.parallel_packing import chunk_long_texts, pointers


def fold(sizes, target, overlap):
    """Chunks as ranges of words, by the fold."""
    out, cur, at = [], [0, 0], 0
    for n in sizes:
        if n > target:
            if cur[1] > cur[0]:
                out.append(tuple(cur))
            out += [(s, min(s + target, at + n)) for s in range(at, at + n, target - overlap)]
            cur = [at + n, at + n]
        elif cur[1] - cur[0] + n > target:
            out.append(tuple(cur))
            cur = [max(cur[0], cur[1] - overlap), at + n]
        else:
            cur[1] = at + n
        at += n
    return out + [tuple(cur)] * (cur[1] > cur[0])


@pytest.mark.parametrize("seed", range(40))
def test_pointers_give_the_chunks_of_the_fold(seed):
    rng = np.random.default_rng(seed)
    target = int(rng.integers(1, 30))
    overlap = int(rng.integers(0, target))
    sizes = rng.integers(1, rng.integers(2, 2 * target + 3), int(rng.integers(1, 80)))
    end, carried = pointers(sizes, target, overlap)
    upto, got, i = np.concatenate(([0], np.cumsum(sizes))), [], 0
    while i < len(sizes):
        a, b = int(upto[i]), int(upto[end[i]])
        got += [(s, min(s + target, b)) for s in range(a, b, target - overlap)] if sizes[i] > target else [(a - int(carried[i]), b)]
        i = int(end[i])
    assert got == fold(sizes.tolist(), target, overlap)


@pytest.mark.parametrize("target,overlap,block", [(7, 3, 8), (7, 0, 9), (20, 19, 21), (1, 0, 2), (30, 10, 100)])
def test_blocks_give_the_rows_of_the_fold(spark, target, overlap, block):
    rng = np.random.default_rng(target)
    text = lambda n, most: "\n\n".join(" ".join(f"w{x}" for x in rng.integers(0, 99, int(k))) for k in rng.integers(0, most, n))
    rows = [(1, text(900, target + 4)), (1, text(300, 3)), (2, text(5, 9)), (3, ""), (4, None), (None, text(200, 2 * target + 2)), (5, "\n\n" * 500), (6, "a\n\n" * 250)]
    df = spark.createDataFrame(rows, "id long, text string").withColumns({"row": F.lit("x"), "i": F.lit("y")})
    got = chunk_long_texts(df, "text", target, overlap, block=block)
    want = chunk_texts(df, "text", target, overlap)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_huge_text_is_packed_by_several_tasks(spark):
    words, per = 1_000_000, 10
    text = "\n\n".join(" ".join(f"{k}" for k in range(i, i + per)) for i in range(0, words, per))
    df = spark.createDataFrame([(1, text)], "id long, text string")
    got = chunk_long_texts(df, "text", 380, 60).select("chunk_index", F.col("text").alias("t"), F.spark_partition_id().alias("p"))
    rows = sorted(got.collect())
    want = fold([per] * (words // per), 380, 60)
    starts = lambda a: a // per * per + a % per
    assert [r.chunk_index for r in rows] == list(range(len(want)))
    assert all(r.t.split(" ")[0] == str(starts(a)) and len(r.t.split(" ")) == b - a for r, (a, b) in zip(rows, want))


def test_bounds_are_checked(spark):
    df = spark.createDataFrame([(1, "a")], "id long, text string")
    for target, overlap, block in ((5, 5, 10), (5, -1, 10), (5, 1, 5)):
        with pytest.raises(ValueError):
            chunk_long_texts(df, "text", target, overlap, block=block)
