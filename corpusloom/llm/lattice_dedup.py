"""Embedding near-duplicates by lattice hashing.

Vectors are rotated at random and cut into pieces of eight coordinates; each piece is decoded to its nearest point of the
E8 lattice, and the points of two pieces name a cell of a table. A vector is filed under its own cell
of every table and looks into the neighbouring lattice cells that it is nearest to. Whoever meets in a cell is
compared by cosine in double precision. Vectors within half the linking angle of a hub are linked with each other
without comparison, so that a group of copies costs one comparison a copy and not one a pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, stored, tidy
from .components import components

#: Tables, pieces of a cell, neighbouring cells that are looked into, and lattice units of a vector of 64 dimensions. With
#: these, a pair at cosine 0.90 is found with probability 0.96, at 0.95 with over 0.999 (measured on random vectors).
TABLES, PIECES, PROBES, SCALE = 16, 2, 3, 4.5
SEED = 7


def _minimal() -> np.ndarray:
    """The 240 lattice points nearest to the origin."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


MINIMAL = _minimal()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum: round, and if the sum is odd, round the worst one the other way."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(1).astype(np.int64) & 1)
    e = x[odd] - f[odd]
    worst = np.abs(e).argmax(1)
    f[odd, worst] += np.where(e[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return f


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of rows of eight: the better of the even-sum integers and their shift by one half."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(4)
def _rotations(dim: int) -> list[np.ndarray]:
    """For each table the projection to its PIECES × 8 coordinates; as many tables share a rotation as have room in it."""
    wide = max(8 * PIECES, -(-dim // (8 * PIECES)) * 8 * PIECES)
    room, out, rng = wide // (8 * PIECES), [], np.random.default_rng(SEED)
    while len(out) < TABLES:
        q = np.linalg.qr(rng.normal(size=(wide, wide)))[0][:dim]
        out += [q[:, 8 * PIECES * k : 8 * PIECES * (k + 1)] for k in range(room)]
    return [q * SCALE * np.sqrt(max(dim, 1) / 64) for q in out[:TABLES]]


def _key(table: int, dim: int, points: np.ndarray) -> np.ndarray:
    h = np.full(len(points), table * 1_000_003 + dim, np.uint64)
    for column in (2 * points).astype(np.int64).astype(np.uint64).T:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + column * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def cells(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own cell, cells to look into) of each unit vector in each table: n × TABLES, n × TABLES × PROBES."""
    n, dim = units.shape
    home, probes = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, PROBES), np.int64)
    for t, q in enumerate(_rotations(dim)):
        y = units @ q
        points = np.hstack([nearest_point(y[:, 8 * i : 8 * i + 8]) for i in range(PIECES)])
        home[:, t] = _key(t, dim, points)
        gain, move = [], []
        for i in range(PIECES):
            toward = (y - points)[:, 8 * i : 8 * i + 8] @ MINIMAL.T
            best = np.argpartition(-toward, PROBES, axis=1)[:, :PROBES]
            gain.append(np.take_along_axis(toward, best, 1))
            move.append(best)
        gain, move = np.hstack(gain), np.hstack(move)
        first = np.argsort(-gain, axis=1, kind="stable")[:, :PROBES]
        for k in range(PROBES):
            other, col = points.copy(), first[:, k]
            for i in range(PIECES):
                rows = np.flatnonzero(col // PROBES == i)
                other[rows, 8 * i : 8 * i + 8] += MINIMAL[move[rows, col[rows]]]
            probes[:, t, k] = _key(t, dim, other)
    return home, probes


def _units(distinct: DataFrame) -> DataFrame:
    """(node, rep, m, v: array<double>) → (node, rep, m, unit: bytes of doubles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column(3):
                x = v.values.to_numpy()
                x = x / np.abs(x).max()  # neither overflow nor underflow
                out.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], names=["node", "rep", "m", "unit"])

    kind = distinct.schema["rep"].dataType.simpleString()
    return distinct.select("node", "rep", "m", "v").mapInArrow(run, f"node long, rep {kind}, m long, unit binary")


def _filed(units: DataFrame) -> DataFrame:
    """units → (key, node, rep, home): a row for the own cell and for each cell looked into."""
    kind = units.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, blobs = b.column(0).to_numpy(), b.column(2).to_pylist()
            sizes = np.array([len(x) for x in blobs])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for part in np.array_split(at, -(-len(at) // 2000)):
                    home, probes = cells(np.frombuffer(b"".join(blobs[i] for i in part), np.float64).reshape(len(part), -1))
                    key = np.hstack([home, probes.reshape(len(part), -1)])
                    own = np.zeros(key.shape, bool)
                    own[:, :TABLES] = True
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(nodes[part], key.shape[1])), b.column(1).take(pa.array(np.repeat(part, key.shape[1]))), pa.array(own.ravel())], names=["key", "node", "rep", "home"])

    return units.select("node", "rep", "unit").mapInArrow(run, f"key long, node long, rep {kind}, home boolean")


#: Pairs that meet in a group, and partners of one vector in it; a task holds the vectors of one group at a time.
GROUP, PARTNERS = 50_000, 10_000


def _cosines(units: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (a, b), a stored table → (a, b, cos); null where the dimensions differ.

    Pairs are dealt into groups of about GROUP, those with one b together unless it has more than PARTNERS; each group gets every
    vector that its pairs need once."""
    groups = max(1, -(-pairs.count() // GROUP))
    many = stored(pairs.groupBy(F.col("b").alias("o")).agg(F.count("*").alias("many")).where(F.col("many") > PARTNERS), "hot-vectors")
    slot = F.when(F.col("many").isNotNull(), F.pmod(F.xxhash64("a"), F.ceil(F.col("many") / PARTNERS).cast("long"))).otherwise(0)
    part = F.pmod(F.xxhash64("b", slot), F.lit(groups)).cast("int")
    pairs = pairs.join(many, F.col("b") == F.col("o"), "left").select("a", "b", part.alias("part"))
    need = pairs.select("part", F.explode(F.array("a", "b")).alias("node")).distinct()
    vectors = units.join(need, "node").select("part", F.lit(0).alias("kind"), F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "unit")
    both = vectors.union(pairs.select("part", F.lit(1), "a", "b", F.lit(None).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = None, {}
        for batch in batches:
            a, b, cos = [], [], []
            for of, kind, x, y, unit in zip(*(c.to_pylist() for c in batch.columns)):
                if of != part:
                    part, known = of, {}
                if not kind:
                    known[x] = np.frombuffer(unit, np.float64)
                    continue
                u, v = known[x], known[y]
                a.append(x)
                b.append(y)
                cos.append(float(u @ v) if len(u) == len(v) else None)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(cos, pa.float64())], names=["a", "b", "cos"])

    return both.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, "a long, b long, cos double")


#: Cells with more hubs, and pairs of cliques with more pairs of vectors, are compared as blocks of at most BLOCK vectors by matrix products:
#: of these groups only the pairs that pass are rows.
HOT_CELL, HOT_CLIQUES, BLOCK = 64, 4_096, 1_024


def _block_pairs(units: DataFrame, rows: DataFrame, angle: float) -> DataFrame:
    """rows (group, side, node, home, far) → (a, b, cos), a < b, each pair once: vectors of one group and different sides (side 2: of one side) of which
    one at least is at home, with an angle of at most `angle` plus the far of both."""
    with_vectors = rows.join(units.select("node", "unit"), "node").select("group", "side", "node", "home", "far", "unit")

    def arrays(rows: list[tuple]) -> tuple[np.ndarray, ...]:
        """Vectors, home and far of rows with vectors of one length."""
        return np.frombuffer(b"".join(x[5] for x in rows)).reshape(len(rows), -1), np.array([x[3] for x in rows]), np.array([x[4] for x in rows])

    def passed(group: list[tuple]) -> Iterator[tuple[int, int, float]]:
        for size in {len(x[5]) for x in group}:
            left, right = ([x for x in group if len(x[5]) == size and x[1] in (side, 2)] for side in (0, 1))
            if not left or not right:
                continue
            (u, home_u, far_u), (v, home_v, far_v) = arrays(left), arrays(right)
            reach = np.minimum(np.pi, angle + far_u[:, None] + far_v[None, :] + 1e-9)
            near = (u @ v.T >= np.cos(reach) - 1e-12) & (home_u[:, None] | home_v[None, :])
            for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
                a, b = left[i][2], right[j][2]
                if left[i][1] != 2 or a < b:
                    yield min(a, b), max(a, b), float(u[i] @ v[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (x for b in batches for x in zip(*(c.to_pylist() for c in b.columns)))
        for _, own in itertools.groupby(stream, key=lambda x: x[0]):
            found = list(passed(list(own)))
            for at in range(0, len(found), 100_000):
                cols = zip(*found[at : at + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "cos"])

    dealt = with_vectors.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "a long, b long, cos double").dropDuplicates(["a", "b"])


def _dealt_cell(met: DataFrame, hot: DataFrame, cliques: DataFrame) -> DataFrame:
    """met (key, hub, home) of the cells in hot (key, n) → rows of `_block_pairs`: each two blocks of a cell are a group."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = met.join(hot, "key").join(cliques.select("hub", F.col("radius").alias("far")), "hub").withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("hub"), blocks).cast("int")})
    rows = rows.select("key", "hub", "home", "far", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return rows.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"), side.alias("side"), F.col("hub").alias("node"), "home", "far")


def _dealt_cliques(pairs: DataFrame, clique: DataFrame, sizes: DataFrame) -> DataFrame:
    """pairs (a, b) of cliques → rows of `_block_pairs`: each block of one and block of the other are a group."""
    blocks = lambda k: F.ceil(F.col(k) / BLOCK).cast("int")
    n = lambda k: sizes.select(F.col("hub").alias(k), F.col("nodes").alias("n" + k))
    both = pairs.join(n("a"), "a").join(n("b"), "b").withColumns({"ia": blocks("na"), "ib": blocks("nb")})

    def side(k: int, own: str, other: str) -> DataFrame:
        rows = both.join(clique.select(F.col("hub").alias(own), "node"), own).withColumn("block", F.pmod(F.xxhash64("node"), F.col("i" + own)).cast("int"))
        rows = rows.select("a", "b", "node", "block", F.explode(F.sequence(F.lit(0), F.col("i" + other) - 1)).alias("against"))
        ends = ("block", "against") if k == 0 else ("against", "block")
        return rows.select(F.xxhash64("a", "b", *ends).alias("group"), F.lit(k).alias("side"), "node", F.lit(True).alias("home"), F.lit(0.0).alias("far"))

    return side(0, "a", "b").union(side(1, "b", "a"))


def near_duplicates(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vectors → id, n_links, component_id, kept.

    One row per input row. n_links: other rows linked directly, that is found with cosine >= least; component_id: the least id
    reachable by links; kept: the row has that id. Null and zero vectors and those with null or non-finite components link with
    nothing: no links, their own component, kept. Vectors of different length do not link. Equal vectors are
    linked and handled as one with a multiplicity. Ids may repeat; null ids are not kept. Other columns are not read.

    Exact on what is found: a pair that is reported linked is, in double precision, or follows from two angles to one hub.
    """
    rows = small_batches(vectors).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(finite, F.lit(False)))
    rows = rows.withColumns({"h": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    kind = rows.schema["id"].dataType.simpleString()
    with tidy(vectors.sparkSession):
        by_node = _linked(rows, least)
    out = rows.select("id", "ok", F.when(F.col("ok"), F.col("h")).alias("h")).join(by_node, "h", "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id")).cast(kind)
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _linked(rows: DataFrame, least: float) -> DataFrame:
    """rows (id, v, ok, h, h2) → (h, component_id, n_links) of each distinct vector, a stored table."""
    angle = float(np.arccos(least))
    inner = float(np.cos(angle / 2)) + 1e-12
    distinct = rows.where("ok").groupBy("h", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("m"), F.first("v").alias("v"))
    units = stored(_units(distinct.withColumnRenamed("h", "node")), "units")
    filed = stored(_filed(units), "cells")

    # Hubs: of those filed in a cell the one with the least (id, node); a vector is near if it is within half the angle.
    lead = stored(filed.where("home").groupBy("key").agg(F.min(F.struct("rep", "node")).alias("lead")), "leads")
    tries = stored(filed.join(lead, "key").select(F.col("lead.node").alias("a"), F.col("node").alias("b")).where("a <> b").distinct(), "tries")
    rep = units.select(F.col("node").alias("n"), F.col("rep").alias("r"))
    close = _cosines(units, tries).where(F.col("cos") >= inner)
    close = close.join(rep.select(F.col("n").alias("a"), F.struct("r", F.col("n").alias("a")).alias("ra")), "a").join(rep.select(F.col("n").alias("b"), F.struct("r", F.col("n").alias("b")).alias("rb")), "b")
    close = stored(close.where(F.col("ra") < F.col("rb")).select("a", "b", "cos", "ra"), "close")
    discard(lead, tries)
    roots = units.select("node").join(close.select(F.col("b").alias("node")), "node", "left_anti")
    joined = close.join(roots.select(F.col("node").alias("a")), "a", "left_semi").groupBy("b").agg(F.min(F.struct("ra", "a", "cos")).alias("x"))
    clique = units.select("node", "rep", "m").join(joined.select(F.col("b").alias("node"), F.col("x.a").alias("hub"), F.col("x.cos").alias("cos")), "node", "left")
    clique = stored(clique.select("node", "rep", "m", F.coalesce("hub", "node").alias("hub"), F.acos(F.least(F.lit(1.0), F.coalesce("cos", F.lit(1.0)))).alias("far")), "cliques")
    discard(close)
    cliques = stored(clique.groupBy("hub").agg(F.sum("m").alias("weight"), F.max("far").alias("radius"), F.min("rep").alias("rep"), F.count("*").alias("nodes")), "hubs")

    # Cliques that meet in a cell: all their vectors are linked, or none, or each pair is compared.
    met = filed.join(clique.select("node", "hub"), "node").groupBy("key", "hub").agg(F.max("home").alias("home"))
    met = stored(met, "met")
    discard(filed)
    hot = stored(met.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("any")).where((F.col("n") > HOT_CELL) & F.col("any")), "hot-cells")
    cold = met.join(hot.select("key"), "key", "left_anti")
    left, right = cold.select("key", F.col("hub").alias("a"), F.col("home").alias("x")), cold.select("key", F.col("hub").alias("b"), F.col("home").alias("y"))
    pairs = stored(left.join(right, "key").where((F.col("a") < F.col("b")) & (F.col("x") | F.col("y"))).select("a", "b").distinct(), "hub-pairs")
    blocks = stored(_block_pairs(units, _dealt_cell(met, hot, cliques), angle), "hub-blocks")
    size = lambda k: cliques.select(F.col("hub").alias(k), F.col("weight").alias("w" + k), F.col("radius").alias("r" + k), F.col("nodes").alias("n" + k))
    between = _cosines(units, pairs).where("cos IS NOT NULL").union(blocks).dropDuplicates(["a", "b"]).join(size("a"), "a").join(size("b"), "b")
    apart, slack = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cos")))), F.col("ra") + F.col("rb")
    verdict = F.when(slack == 0, F.when(F.col("cos") >= least, 1).otherwise(-1)).when(apart + slack < angle - 1e-9, 1).when(apart - slack > angle + 1e-9, -1).otherwise(0)
    between = stored(between.select("a", "b", "wa", "wb", (F.col("na") * F.col("nb")).alias("n"), verdict.alias("verdict")).where("verdict >= 0"), "hub-links")
    discard(met, hot, pairs, blocks)
    whole = between.where("verdict = 1")
    of = lambda k, n: clique.select(F.col("hub").alias(k), F.col("node").alias(n))
    open_ = between.where("verdict = 0")
    few, many = open_.where(F.col("n") <= HOT_CLIQUES), open_.where(F.col("n") > HOT_CLIQUES).select("a", "b")
    single = stored(few.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b")), "single-pairs")
    found = _cosines(units, single).select("a", "b", "cos").union(_block_pairs(units, _dealt_cliques(many, clique, cliques), angle))
    linked = stored(found.where(F.col("cos") >= least).select("a", "b"), "single-links")
    discard(single, units)
    ends = linked.union(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    extra = ends.join(clique.select(F.col("node").alias("b"), "m"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("m").alias("extra"))
    sums = whole.select(F.col("a").alias("hub"), F.col("wb").alias("w")).union(whole.select("b", "wa")).groupBy("hub").agg(F.sum("w").alias("others"))
    hub_of = lambda k: clique.select(F.col("node").alias(k), F.col("hub").alias("h" + k))
    found = components(whole.select("a", "b").union(linked.join(hub_of("a"), "a").join(hub_of("b"), "b").select("ha", "hb")))
    rooted = stored(cliques.join(found, F.col("hub") == F.col("node"), "left").select("hub", "rep", "weight", F.coalesce("root", "hub").alias("root")), "rooted")
    first = stored(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    top = rooted.join(first, "root").join(sums, "hub", "left").select("hub", "component_id", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("own"))
    by_node = clique.select("node", "hub").join(top, "hub").join(extra, "node", "left").select(F.col("node").alias("h"), "component_id", (F.col("own") + F.coalesce("extra", F.lit(0))).alias("n_links"))
    by_node = stored(by_node, "linked")
    discard(clique, cliques, between, linked, found, rooted, first)
    return by_node
