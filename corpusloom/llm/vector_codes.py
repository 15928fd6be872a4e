"""Vector code compression: product quantisation in whole numbers.

Vectors are cut into parts; each part position has a codebook, which rounds of assignment and averaging improve. The vectors are
stored once as columnar blocks (part, dimension, row) of int64. A round is one `treeAggregate` over an RDD of these blocks: in
a task, squared distances accumulate dimension by dimension, `np.add.at` adds the vectors to int64 tensors of sums and counts, and the
tensors merge through a reduction tree, so that the driver receives a few of them whatever the number of tasks. All arithmetic is exact,
so the result depends neither on the order of rows nor on how they are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, stored, tidy

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: A component x becomes floor(SCALE * x).
SCALE = 4096
#: Components of a block (rows by dimensions).
BLOCK = 1 << 18
#: Beyond it, squared distances of a part of up to 512 dimensions, and sums over 2^35 rows, might not fit 63 bits.
LARGEST = 1 << 26
#: Labels, of which there may be any number, are broadcast with their sums up to this count.
BROADCAST_LABELS = 10_000

Book = np.ndarray  # part × entry × dimension within the part


def kept_rows(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Without the rows whose vector is null or holds null or non-finite components; vec becomes an array of doubles."""
    x = F.col(vec).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.withColumn(vec, x).where(x.isNotNull() & finite)


def _columnar(dims: int, parts: int, label_type: pa.DataType, id_type: pa.DataType):
    """Arrow batches of (id, label, vector) → blocks (ids, labels, n, data): data is int64 by part, dimension within the part and row."""

    size = max(1, BLOCK // dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, size):
                own = b.slice(at, size)
                vec = own.column(2)
                flat = vec.flatten().to_numpy(zero_copy_only=False)
                lengths = np.diff(vec.offsets.to_numpy())
                cells = np.zeros((own.num_rows, dims))
                cells[np.arange(dims) < lengths[:, None]] = flat
                whole = np.floor(cells * SCALE)
                if np.abs(whole).max(initial=0) >= LARGEST:
                    raise ValueError(f"components must be below {LARGEST // SCALE} in size to be compared exactly")
                data = whole.astype(np.int64).reshape(own.num_rows, parts, dims // parts).transpose(1, 2, 0)
                cols = [pa.array([own.column(0).to_pylist()], pa.list_(id_type)), pa.array([own.column(1).to_pylist()], pa.list_(label_type))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([own.num_rows], pa.int64()), pa.array([data.tobytes()])], names=["ids", "labels", "n", "data"])

    return run


def block(data: bytes, n: int, parts: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(parts, dims // parts, n)


def nearest(cells: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """(part × row): the nearest entry of each part (ties: the lower index), and its squared distance."""
    distance = np.zeros((cells.shape[0], book.shape[1], cells.shape[2]), np.int64)
    for d in range(cells.shape[1]):
        apart = cells[:, d, None, :] - book[:, :, d, None]
        distance += apart * apart
    code = distance.argmin(1)
    return code, np.take_along_axis(distance, code[:, None, :], 1)[:, 0]


def improved(blocks: RDD, book: Book, partitions: int) -> Book:
    """One round: each entry becomes the floor of the mean of the parts that are nearest to it; unused entries stay.

    blocks: an RDD of (n, data). The merged tensors have the size of the codebooks.
    """
    parts, entries, within = book.shape
    shared = blocks.context.broadcast(book)

    def add(got: tuple[np.ndarray, np.ndarray], row: tuple[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        sums, counts = got
        cells = block(row[1], row[0], parts, parts * within)
        code, _ = nearest(cells, shared.value)
        part = np.broadcast_to(np.arange(parts)[:, None], code.shape)
        np.add.at(counts, (part, code), 1)
        np.add.at(sums, (part, code), cells.transpose(0, 2, 1))
        return sums, counts

    def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return a[0] + b[0], a[1] + b[1]

    zero = (np.zeros(book.shape, np.int64), np.zeros((parts, entries), np.int64))
    depth = 2 if partitions <= 256 else 3
    sums, counts = blocks.treeAggregate(zero, add, merge, depth)
    shared.destroy()
    return np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], book)


def digest(book: Book) -> str:
    """All components as decimal integers by part, entry and position within the part."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def first_book(kept: DataFrame, id_col: str, vec: str, dims: int, parts: int, entries: int) -> Book:
    """The parts of the vectors with the smallest ids (null last; of equal ids the smaller vector first)."""
    rows = kept.orderBy(F.col(id_col).asc_nulls_last(), vec).limit(entries).select(vec).collect()  # as many as a codebook has entries
    cells = np.zeros((len(rows), dims))
    for k, (v,) in enumerate(rows):
        cells[k, : len(v)] = v
    return np.floor(cells * SCALE).astype(np.int64).reshape(len(rows), parts, dims // parts).transpose(1, 0, 2)


def compress(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vectors → id, code, error, label_error, codebooks_sha256, for each row whose vector is neither null nor has null or non-finite components.

    code: the index of the nearest entry of each part, two hex digits each; error: the squared distances, summed over the parts; label_error:
    the errors of all rows with the label (null labels together). Ids may be null or repeat (each row counts by itself). With fewer
    rows than entries codebooks have as many entries as there are rows; an empty table gives an empty one. Vectors that are shorter than the longest
    one, or than the next multiple of `parts`, are taken as if zeros followed (so an empty vector is a zero vector). A component of 16,384 or
    more in size raises a ValueError, as its distances might not be exact. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = kept_rows(vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vec).alias("v")), "v")
    with tidy(spark):
        longest = kept.agg(F.max(F.size("v")).alias("d")).head()["d"]
        dims = max(1, -(-(longest or 0) // parts)) * parts
        book = first_book(kept, "id", "v", dims, parts, entries)
        kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
        arrow = small_batches(kept).limit(0).toArrow().schema
        schema = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, n long, data binary"
        blocks = stored(kept.mapInArrow(_columnar(dims, parts, arrow.field("label").type, arrow.field("id").type), schema), "vector-blocks")
        if book.shape[1]:
            rdd = blocks.select("n", "data").rdd.map(lambda r: (r[0], bytes(r[1])))
            for _ in range(rounds):
                book = improved(rdd, book, rdd.getNumPartitions())
        shared = spark.sparkContext.broadcast(book)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for ids, labels, n, data in zip(b.column(0), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                    code, distance = nearest(block(data, n, parts, dims), shared.value)
                    text = [row.tobytes().hex() for row in np.ascontiguousarray(code.T.astype(np.uint8))]
                    yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(text), pa.array(distance.sum(0))], names=["id", "label", "code", "error"])

        coded = stored(blocks.mapInArrow(assign, f"id {kinds['id']}, label {kinds['label']}, code string, error long"), "vector-codes")
        discard(blocks)
        sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
        n_labels = sums.limit(BROADCAST_LABELS + 1).count()
    if n_labels <= BROADCAST_LABELS:
        sums = F.broadcast(sums.withColumnRenamed("label", "_label"))
        out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    else:  # so many labels that rows with one do not fill a task, or AQE splits those that do; rows without a label have their one sum
        null = sums.where(F.col("label").isNull()).select("label_error")
        out = coded.where(F.col("label").isNotNull()).join(sums, "label").select("id", "code", "error", "label_error")
        out = out.unionByName(coded.where(F.col("label").isNull()).select("id", "code", "error").crossJoin(F.broadcast(null)))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256"))
