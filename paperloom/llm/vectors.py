"""Embedding near-duplicates: all pairs with a cosine of at least a threshold, by an epsilon grid order join.

Unit vectors have cosine >= c exactly if their distance is at most eps = sqrt(2 - 2c). The
vectors are turned onto their principal axes and sorted by the cells, of width eps, that
they lie in along the leading ones. The sorted sequence is cut into intervals of SPAN
vectors, and the intervals are joined recursively: a pair of intervals whose boxes are
over eps apart is skipped, any other is halved until it is a few rows wide, and is then
compared by a matrix product. The first levels of the recursion are joins of tables of nodes
(fan_out intervals make one of the next level), the last ones run within a task. A pair of
nodes whose balls are far apart, or so near that all their vectors link, is settled where it
is met: its rows are neither compared nor shuffled.

Counts of links are added up in the task, and of the links themselves a spanning forest is
kept: the components need no more, and a group of near copies never becomes all its pairs.

Defined results: a vector that is null, empty, zero, or holds a null or a non-finite
component links with nothing and is its own component; vectors of different lengths do not
link; repeated ids are one vertex, whose link count is that of its vectors; an empty table
gives no rows; a null id has no component and its vector links with nothing; vectors of any
length are compared whole; of equal ones each counts; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import batch_rows, written

@dataclass(frozen=True)
class Grid:
    """Vectors of an interval, intervals or nodes of a node of the next level, and rows that are compared by a product."""

    span: int = 4096
    fan_out: int = 16
    leaf: int = 256


#: The axes are fitted on about so many vectors, chosen by a digest of their id; all are turned onto them. Any axes give the same links.
AXES_SAMPLE = 1 << 16
#: Pairs of intervals are dealt in tiles, which need each interval once: about so many tiles to a side of the sequence, but at most so many bytes of vectors.
TILES, TILE_BYTES = 6, 64 << 20
NODE = ["id", "n", "first", "low", "high", "centre", "radius"]
#: Axes whose cells make the order, and axes that boxes have.
ORDER_AXES, BOX_AXES = 6, 8
#: What rounding may do to a distance or a cosine; nearer to the threshold than this, the plain formula decides.
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key and v of the vectors that can link: floats as they are, other numbers as doubles."""
    v = F.col(f"`{vector}`")
    if vectors.schema[vector].dataType.elementType.typeName() != "float":
        v = v.cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(f"`{key}`").cast("long").alias("key"), v.alias("v")).where(F.col("key").isNotNull() & F.coalesce(good, F.lit(False)))


def _units(payload: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; rows are first divided by their largest component, so that squares neither vanish nor overflow."""
    x = payload.astype("f8")
    return unit(x / np.abs(x).max(1, keepdims=True))


def _axes(usable: DataFrame, size: int) -> np.ndarray:
    """Principal axes of about AXES_SAMPLE unit vectors of one length, by the sum of their outer products over all partitions."""
    part = max(1, usable.count() // AXES_SAMPLE)
    usable = usable.where(F.pmod(F.xxhash64("key"), F.lit(part)) == 0)

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            if batch.num_rows:
                x = _units(_matrix(batch.column(0)))
                total[:-1] += x.T @ x
                total[-1] += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "x"])

    # (size + 1) * size numbers, however many vectors there are
    sums = usable.select("v").mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    total = np.zeros((size + 1) * size)
    total[sums.column("at").to_numpy()] = sums.column("x").to_numpy()
    total = total.reshape(size + 1, size)
    n = max(np.trace(total[:-1]), 1.0)
    mean = total[-1] / n
    _, axes = np.linalg.eigh(total[:-1] / n - np.outer(mean, mean))
    return axes[:, ::-1]


def _intervals(usable: DataFrame, axes: np.ndarray, eps: float, grid: Grid) -> DataFrame:
    """(id, keys, rows, and a node's columns): the sequence in epsilon grid order, cut into numbered intervals."""
    size, n_order, n_box = len(axes), min(ORDER_AXES, len(axes)), min(BOX_AXES, len(axes))
    shown = usable.sparkSession.sparkContext.broadcast(axes)
    kind = usable.schema["v"].dataType.elementType.typeName()
    names = [f"c{k}" for k in range(n_order)]

    def cells(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                grid = np.floor(_units(_matrix(batch.column(1))) @ shown.value[:, :n_order] / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(grid[:, k]) for k in range(n_order))], names=["key", "v", *names])

    placed = written(usable.mapInArrow(cells, f"key long, v array<{kind}>, " + ", ".join(f"{c} int" for c in names)), "cells")
    parts = max(1, int(usable.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = placed.repartitionByRange(parts, *names, "key").sortWithinPartitions(*names, "key")

    def numbered(batches) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(place, place + n))], names=["key", "v", "part", "place"])
            place += n

    sequence = written(ordered.select("key", "v").mapInArrow(numbered, f"key long, v array<{kind}>, part long, place long"), "sequence")
    # a row for each partition of the sort
    before = sequence.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    position = F.col("before") + F.col("place")
    dealt = sequence.join(written(before, "before"), "part").select(F.floor(position / grid.span).cast("long").alias("id"), position.alias("position"), "key", "v")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        held, keys, rows = None, [], []

        def block() -> pa.RecordBatch:
            k, m = np.concatenate(keys), np.concatenate(rows)
            x = _units(m) @ shown.value
            centre = x.mean(0)
            radius = math.sqrt(((x - centre) ** 2).sum(1).max())
            columns = [pa.array([held]), pa.array([k.astype("<i8").tobytes()]), pa.array([m.tobytes()]), pa.array([len(k)]), pa.array([int(k[0])])]
            columns += [*(pa.array([v.tolist()], pa.list_(pa.float64())) for v in (x[:, :n_box].min(0), x[:, :n_box].max(0), centre)), pa.array([radius])]
            return pa.RecordBatch.from_arrays(columns, names=["id", "keys", "rows", *NODE[1:]])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            change = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(change, change[1:], strict=False):
                if a == b:
                    continue
                if ids[a] != held and keys:
                    yield block()
                    keys, rows = [], []
                held = int(ids[a])
                keys.append(batch.column(1).slice(a, b - a).to_numpy())
                rows.append(_matrix(batch.column(2).slice(a, b - a)).reshape(-1, size))
        if keys:
            yield block()

    blocks = dealt.repartition("id").sortWithinPartitions("id", "position").select("id", "key", "v")
    return written(blocks.mapInArrow(cut, "id long, keys binary, rows binary, n long, first long, low array<double>, high array<double>, centre array<double>, radius double"), "intervals")


def _near(a: str, b: str, eps: float):
    """Whether two boxes are within eps of each other."""
    gaps = F.zip_with(F.zip_with(f"{a}_low", f"{b}_high", lambda x, y: x - y), F.zip_with(f"{b}_low", f"{a}_high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= (eps + SLACK) ** 2


def _nodes(below: DataFrame, fan_out: int) -> DataFrame:
    """The next level: a node for fan_out of the level below, with its rows, box, ball and first key."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        centres = np.stack(part.centre.to_list())
        centre = centres.mean(0)
        radius = (np.sqrt(((centres - centre) ** 2).sum(1)) + part.radius.to_numpy()).max()
        low, high = np.stack(part.low.to_list()).min(0), np.stack(part.high.to_list()).max(0)
        return pd.DataFrame([(int(part.id.iloc[0] // fan_out), int(part.n.sum()), int(part["first"].iloc[0]), low.tolist(), high.tolist(), centre.tolist(), float(radius))], columns=NODE)

    # at most fan_out rows of a group
    return written(below.groupBy(F.floor(F.col("id") / fan_out)).applyInPandas(one, below.schema), "nodes")


def _descent(blocks: DataFrame, eps: float, grid: Grid) -> tuple[DataFrame, DataFrame]:
    """(pairs, settled), by a descent from the whole sequence.

    pairs(a, b), a <= b, are the intervals that may hold a link but whose balls don't say
    which; settled(level, a, b, n_a, n_b, first_a, first_b) are nodes so near that all of
    their vectors link, which go no further down.
    """
    levels = [blocks.select(*NODE)]
    while levels[-1].count() > 1:
        levels.append(_nodes(levels[-1], grid.fan_out))
    pairs, done = blocks.sparkSession.createDataFrame([(0, 0)], "a long, b long"), None
    for level in range(len(levels) - 1, -1, -1):
        sides = [levels[level].select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in NODE[1:]]) for s in ("a", "b")]
        both = pairs.join(sides[0], "a").join(sides[1], "b").where(_near("a", "b", eps))
        far = F.sqrt(F.aggregate(F.zip_with("a_centre", "b_centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d))
        width = F.col("a_radius") + F.col("b_radius")
        both = both.select("a", "b", "a_n", "b_n", "a_first", "b_first", (far + width < eps - SLACK).alias("all"), (far - width > eps + SLACK).alias("none"))
        both = written(both.where("all or not none"), "pairs")
        settled = both.where("all").select(F.lit(level).alias("level"), "a", "b", F.col("a_n").alias("n_a"), F.col("b_n").alias("n_b"), F.col("a_first").alias("first_a"), F.col("b_first").alias("first_b"))
        done = settled if done is None else done.unionByName(settled)
        pairs = both.where("not all").select("a", "b")
        if level:
            child = levels[level - 1].select(F.col("id").alias("child"), F.floor(F.col("id") / grid.fan_out).alias("up"))
            left = pairs.join(child.toDF("a_id", "a"), "a").join(child.toDF("b_id", "b"), "b")
            pairs = left.where("a_id <= b_id").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    return pairs, done


def _of_settled(blocks: DataFrame, settled: DataFrame, grid: Grid) -> DataFrame:
    """(a, b, n) of the settled nodes: to every vector in them a link count, and one link to the node's first vector."""
    ends = settled.select("level", F.col("a").alias("node"), F.when(F.col("a") == F.col("b"), F.col("n_a") - 1).otherwise(F.col("n_b")).alias("n"), F.col("first_a").alias("first"))
    ends = ends.unionByName(settled.where("a <> b").select("level", F.col("b").alias("node"), F.col("n_a").alias("n"), F.col("first_b").alias("first")))
    nodes = written(ends.groupBy("level", "node").agg(F.sum("n").alias("n"), F.min("first").alias("first")), "settled")
    levels = sorted(r.level for r in nodes.select("level").distinct().collect())  # one for each level of the tree
    between = settled.where("a <> b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"), F.lit(0).cast("long").alias("n"))
    if not levels:
        return between
    inside = None
    for level in levels:
        mine = nodes.where(F.col("level") == level).select("node", F.col("n").alias("add"), F.col("first").alias("top"))
        one = blocks.select("id", "keys", F.floor(F.col("id") / grid.fan_out**level).alias("node")).join(mine, "node").select("keys", "add", "top")
        inside = one if inside is None else inside.unionByName(one)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, add, top in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                keys = np.frombuffer(held, "<i8")
                a, n = np.concatenate([keys, keys]), np.concatenate([np.full(len(keys), add), np.zeros(len(keys), np.int64)])
                b = pa.concat_arrays([pa.nulls(len(keys), pa.int64()), pa.array(np.full(len(keys), top))])
                yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])

    return between.unionByName(inside.mapInArrow(run, "a long, b long, n long"))


class _Join:
    """Link counts and a spanning forest of two intervals, or of one with itself."""

    def __init__(self, given: tuple[np.ndarray, np.ndarray], axes: np.ndarray, same: bool, cosine: float, eps: float, leaf: int) -> None:
        self.given, self.same, self.cosine, self.eps, self.leaf = given, same, cosine, eps, leaf
        x, y = self.x, self.y = [_units(g) @ axes for g in given]
        self.n_x, self.n_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        self.up = list(range(len(x) + (0 if same else len(y))))
        self.shift = 0 if same else len(x)
        self.links: list[tuple[int, int]] = []

    def run(self) -> None:
        self._pair(0, len(self.x), 0, len(self.y))
        if self.same:
            self.n_x = self.n_x + self.n_y

    def _root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def _link(self, i: int, j: int) -> None:
        a, b = self._root(i), self._root(j + self.shift)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def _pair(self, a: int, b: int, c: int, d: int) -> None:
        """Rows a to b of x with rows c to d of y; of one interval with itself only pairs in order."""
        if self.same and c < a:
            return
        p, q = self.x[a:b], self.y[c:d]
        gap = np.maximum(0, np.maximum(p[:, :BOX_AXES].min(0) - q[:, :BOX_AXES].max(0), q[:, :BOX_AXES].min(0) - p[:, :BOX_AXES].max(0)))
        if gap @ gap > (self.eps + SLACK) ** 2:
            return
        apart = not (self.same and a == c)
        if apart:
            u, v = p.mean(0), q.mean(0)
            r, s = math.sqrt(((p - u) ** 2).sum(1).max()), math.sqrt(((q - v) ** 2).sum(1).max())
            far = math.sqrt(((u - v) ** 2).sum())
            if far - r - s > self.eps + SLACK:
                return
            if far + r + s < self.eps - SLACK:  # all of them link
                self.n_x[a:b] += d - c
                self.n_y[c:d] += b - a
                for i in range(a, b):
                    self._link(i, c)
                for j in range(c + 1, d):
                    self._link(a, j)
                return
        if max(b - a, d - c) > self.leaf:
            m, n = (a + b) // 2 if b - a > self.leaf else b, (c + d) // 2 if d - c > self.leaf else d
            for i, j in ((a, m), (m, b)):
                for k, e in ((c, n), (n, d)):
                    if i < j and k < e:
                        self._pair(i, j, k, e)
            return
        cosines = p @ q.T
        if cosines.max() < self.cosine - SLACK:
            return
        linked = cosines >= self.cosine
        close = np.abs(cosines - self.cosine) < SLACK
        if close.any():
            for i, j in np.argwhere(close):
                linked[i, j] = _exact(self.given[0][a + i], self.given[1][c + j]) >= self.cosine
        if not apart:
            linked = np.triu(linked, 1)
        if linked.any():
            self.n_x[a:b] += linked.sum(1)
            self.n_y[c:d] += linked.sum(0)
            self._forest(linked, a, c)

    def _forest(self, linked: np.ndarray, a: int, c: int) -> None:
        """Each row with its first partner, then partners of partners: enough to connect what the matrix connects."""
        rows = np.flatnonzero(linked.any(1))
        first = linked[rows].argmax(1)
        for i, j in zip(rows.tolist(), first.tolist(), strict=True):
            self._link(a + i, c + j)
        seen = np.array([self._root(c + j + self.shift) for j in range(linked.shape[1])])
        mine = np.array([self._root(a + i) for i in rows])
        for i, j in np.argwhere(linked[rows] & (mine[:, None] != seen[None, :])).tolist():
            self._link(int(a + rows[i]), c + j)


def _exact(p: np.ndarray, q: np.ndarray) -> float:
    """The cosine of two vectors as they are given, but for powers of two."""
    p, q = (v.astype("f8") / 2.0 ** math.frexp(float(np.abs(v).max()))[1] for v in (p, q))
    return math.fsum(p * q) / math.sqrt(math.fsum(p * p) * math.fsum(q * q))


def _tiles(blocks: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(up_a, up_b, a, b, keys, rows) by tile: a row with an interval, whose b is null, for each that the tile's pairs need, then a row for each pair."""
    work = pairs.select(F.floor(F.col("a") / width).alias("up_a"), F.floor(F.col("b") / width).alias("up_b"), "a", "b")
    needed = work.select("up_a", "up_b", F.explode(F.array("a", "b")).alias("id")).distinct()
    held = needed.join(blocks.select("id", "keys", "rows"), "id").select("up_a", "up_b", F.col("id").alias("a"), F.lit(None).cast("long").alias("b"), "keys", "rows")
    both = held.unionByName(work, allowMissingColumns=True)
    return both.repartition("up_a", "up_b").sortWithinPartitions("up_a", "up_b", F.col("b").asc_nulls_first())


def _joined(blocks: DataFrame, pairs: DataFrame, axes: np.ndarray, kind: str, cosine: float, eps: float, grid: Grid) -> DataFrame:
    """(a, b, n): n links of a where b is null, else a link of the forest.

    Near intervals may be most pairs, so no pair has its rows with it: a tile of pairs, width
    intervals by width, gets each of its intervals once, before its pairs, and a task holds one
    tile at a time.
    """
    shown, size, dtype = blocks.sparkSession.sparkContext.broadcast(axes), len(axes), np.dtype("<f4" if kind == "float" else "<f8")
    width = max(1, min(math.ceil(blocks.count() / TILES), TILE_BYTES // (grid.span * size * dtype.itemsize)))

    def run(batches) -> Iterator[pa.RecordBatch]:
        tile, held = None, {}
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for up_a, up_b, a, b, keys, rows in zip(*columns, strict=True):
                if (up_a, up_b) != tile:
                    tile, held = (up_a, up_b), {}
                if b is None:
                    held[a] = np.frombuffer(keys, "<i8"), np.frombuffer(rows, dtype).reshape(-1, size)
                else:
                    yield joined(held[a], held[b], a == b)

    def joined(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], same: bool) -> pa.RecordBatch:
        keys = left[0], right[0]
        join = _Join((left[1], right[1]), shown.value, same, cosine, eps, grid.leaf)
        join.run()
        sides = [(keys[0], join.n_x)] + ([] if same else [(keys[1], join.n_y)])
        a = [k[n > 0] for k, n in sides]
        links = np.array(join.links, np.int64).reshape(-1, 2)
        ends = pa.concat_arrays([pa.nulls(sum(map(len, a)), pa.int64()), pa.array(keys[1][links[:, 1]])])
        numbers = np.concatenate([*(n[n > 0] for _, n in sides), np.zeros(len(links), np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([*a, keys[0][links[:, 0]]])), ends, pa.array(numbers)], names=["a", "b", "n"])

    return _tiles(blocks, pairs, width).mapInArrow(run, "a long, b long, n long")


def cosine_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, grid: Grid = Grid()) -> DataFrame:  # noqa: B008  it is frozen
    """(a, b, n) as above, for all vectors."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    usable = written(_usable(vectors, key, vector), "vectors")
    found = None
    # one join for each length of vectors; a table has one, or a few
    for size in sorted(r[0] for r in usable.select(F.size("v")).distinct().collect()):
        alike = usable.where(F.size("v") == size)
        axes, kind = _axes(alike, size), usable.schema["v"].dataType.elementType.typeName()
        blocks = _intervals(alike, axes, eps, grid)
        pairs, settled = _descent(blocks, eps, grid)
        with batch_rows(vectors.sparkSession, 4):
            one = written(_joined(blocks, pairs, axes, kind, cosine, eps, grid).unionByName(_of_settled(blocks, settled, grid)), "joined")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "a long, b long, n long")
    return found


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, grid: Grid = Grid()) -> DataFrame:  # noqa: B008  it is frozen
    """(key, n_links, component_id, kept) of every vector."""
    found = cosine_links(vectors, key, vector, cosine, grid)
    counts = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    classes = connected_components(found.where("b is not null").select("a", "b"))
    ids = vectors.select(F.col(f"`{key}`").cast("long").alias("key"))
    out = ids.join(counts, "key", "left").join(classes.withColumnRenamed("id", "key"), "key", "left")
    component = F.coalesce("component", "key")
    return out.select(F.col("key").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("key") == component).alias("kept"))


#: The registered query in SQL: all pairs, and what links reach from every vector.
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach(id, near) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.near = l.a),
least AS (SELECT id, min(near) AS component_id FROM reach GROUP BY id)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v LEFT JOIN counts ON a = v.vec_id LEFT JOIN least ON id = v.vec_id
"""
