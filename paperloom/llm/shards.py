"""Sharding by a k-d tree over documents' metadata, with DataFrame operations only.

A document is a point: the logarithm of its characters, its source and its language, these
two as places on a line that a digest gives them. Equal texts are one point, with the least
source and language of the group, and one weight. A node that stands for some shards is cut,
along the axis on which its points spread the most (the first of equal ones), at the weighted
quantile that gives its left child as many bytes as its shards have room for, until every
leaf is a shard. Points that are equal along the axis are ordered by the text's digest, then
by the row's. A cut is found by histograms of that key, refined around the quantile; every
pass is a partial aggregation over all rows, and the driver sees one row for each node.

Groups. What weighs over KEEP of a shard would make cuts uneven. So each such text, one long
document or all copies of one, is a heavy point that goes to a shard before the tree grows, the
heaviest first, to the shard with the most room; there are at most shards / KEEP of them. The tree
then fills the room that is left, as even as can be. Only a group of copies that alone outweighs a
shard is parted: it stays in the tree and is cut by row digest.

The law is `bytes`: the shards' sizes are near equal. Slots are numbered within salted
groups of a shard and shifted by the groups before, so no task sees a whole shard.

Defined results: a null text counts no bytes, has the checksum of an empty one, and all null
texts are one group; repeated rows are put one by one, and rows of one id and one text always
stay together; rows without an id are told apart by their place in the table; very long texts
are heavy points; with fewer rows than shards some shards stay empty; an empty table gives no
rows; source and lang may be null or absent, and other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

ROW_BYTES = 16
#: Bits of the sort key's parts, and of it in each refinement; the first four steps end where a group does.
AXIS_BITS, GROUP_BITS, ROW_BITS = 20, 20, 22
STEPS = (10, 10, 10, 10, 11, 11)
GROUP_STEPS = 4
#: A histogram's cell of at most this part of a shard is cut at its nearer edge.
CLOSE = 0.002
#: What weighs more than this part of a shard is a heavy point.
KEEP = 0.02
#: Rows that share a salted group of slots, about.
SLOT_ROWS = 2048
AXES = ("chars_axis", "source_axis", "lang_axis")


@dataclass
class Node:
    """room: the bytes that each of its shards, from the first on, has room for; a cut node has an axis, a key and two children."""

    number: int
    first: int
    room: list[float]
    axis: int = 0
    cut: int | None = None
    children: list[Node] = field(default_factory=list)
    want: float = 0.0
    before: float = 0.0
    prefix: int = 0

    def open(self) -> list[Node]:
        return [n for c in self.children for n in c.open()] if self.children else [self]


def _key(axis: str) -> Column:
    return F.shiftleft(F.col(axis).cast("long"), GROUP_BITS + ROW_BITS) + F.col("tail")


def _table(points: DataFrame, columns: str, rows: list[tuple]) -> DataFrame:
    """A table of the driver's numbers about nodes or heavy points; it has at most a row for each."""
    values = ", ".join(f"({', '.join(map(str, r))})" for r in rows)
    return F.broadcast(points.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({columns})"))


def _chosen() -> Column:
    """The sort key along the axis whose place in AXES is in column axis."""
    out = F.when(F.col("axis") == 0, _key(AXES[0]))
    for k, a in enumerate(AXES[1:], 1):
        out = out.when(F.col("axis") == k, _key(a))
    return out


def _place(documents: DataFrame, column: str) -> Column:
    """Where a value stands on its axis; a null, or a column that is not there, is at its beginning."""
    if column not in documents.columns:
        return F.lit(0)
    value = F.col(f"`{column}`").cast("string")
    return F.when(value.isNull(), 0).otherwise(F.shiftrightunsigned(F.xxhash64(value), 64 - AXIS_BITS).cast("int"))


def _points(documents: DataFrame) -> DataFrame:
    """A row for each document, without its text; spread is for balance only."""
    text = F.col("text")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    chars = F.log2(F.coalesce(F.length(text), F.lit(0)).cast("double") + 1)
    top = (1 << AXIS_BITS) - 1
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (size + ROW_BYTES).alias("size"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"), F.xxhash64(text).alias("digest"),
        F.least(F.lit(top), F.floor(chars / 32 * top)).cast("int").alias(AXES[0]), _place(documents, "source").alias(AXES[1]), _place(documents, "lang").alias(AXES[2]),
        F.xxhash64(F.monotonically_increasing_id()).alias("spread"),
    )
    row = F.when(F.col("doc_id").isNull(), F.col("spread")).otherwise(F.xxhash64("doc_id")).bitwiseAND((1 << ROW_BITS) - 1)
    group = F.shiftrightunsigned("digest", 64 - GROUP_BITS)
    return written(rows.withColumn("tail", F.shiftleft(group, ROW_BITS) + row), "points")


def _groups(points: DataFrame) -> DataFrame:
    """A row for each text: its rows and bytes, and the source and language that all its rows take where they differ."""
    ends = [f(a).alias(f"{n}_{a}") for a in AXES[1:] for n, f in (("low", F.min), ("high", F.max))]
    return written(points.groupBy("digest").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *ends), "groups")


def _settled(points: DataFrame, groups: DataFrame, heavy: list[tuple[int, int | None]]) -> DataFrame:
    """points with one place for each text, the shard of the heavy ones, and whether they are loose: of a group that may be parted."""
    differ = groups.where(" or ".join(f"low_{a} <> high_{a}" for a in AXES[1:])).select("digest", *[f"low_{a}" for a in AXES[1:]])
    one = points.join(differ, "digest", "left").withColumns({a: F.coalesce(f"low_{a}", a) for a in AXES[1:]}).drop(*[f"low_{a}" for a in AXES[1:]])
    if not heavy:
        return one.withColumns({"shard": F.lit(None).cast("int"), "loose": F.lit(False)})
    known = _table(points, "digest, shard, loose", [(f"{d}L", "CAST(NULL AS INT)" if s is None else s, s is None) for d, s in heavy])
    return one.join(known, "digest", "left").withColumn("loose", F.coalesce("loose", F.lit(False)))


def _heaviest_first(groups: DataFrame, total: int, shards: int, keep: float) -> tuple[list[tuple[int, int | None]], list[float]]:
    """The shards of the heavy points, null for groups that outweigh one, and the bytes that every shard has room for beside them."""
    leaf = total / shards
    found = groups.where(F.col("bytes") > keep * leaf).select("digest", "bytes", "n").collect()  # at most shards / keep
    loose = [r.digest for r in found if r.n > 1 and r.bytes > leaf]
    found = [r for r in found if r.n == 1 or r.bytes <= leaf]
    fills = [(0, s) for s in range(shards)]
    placed = []
    for r in sorted(found, key=lambda r: (-r.bytes, r.digest)):
        fill, s = heapq.heappop(fills)
        placed.append((r.digest, s))
        heapq.heappush(fills, (fill + r.bytes, s))
    # the level up to which the other bytes fill the shards
    left, level = total - sum(r.bytes for r in found), 0.0
    for k, (fill, _) in enumerate(sorted(fills), 1):
        if k > 1 and fill >= level:
            break
        left += fill
        level = left / k
    room = [0.0] * shards
    for fill, s in fills:
        room[s] = max(0.0, level - fill)
    return [*placed, *((d, None) for d in loose)], room


def _grow(points: DataFrame, room: list[float], leaf: float, close: float) -> tuple[DataFrame, Node]:
    """points with the number of the leaf that each is in, and the k-d tree. A level reads them for the spread and for each refinement."""
    root, made, widths = Node(0, 0, room), 1, {}
    points = points.withColumn("node", F.lit(0))
    while cutting := [n for n in root.open() if len(n.room) > 1]:
        spread = points.groupBy("node").agg(F.sum("size").alias("bytes"), *[F.min(a).alias(f"low_{a}") for a in AXES], *[F.max(a).alias(f"high_{a}") for a in AXES]).collect()
        seen = {r.node: r for r in spread}
        if not widths:
            if not seen:
                return points, root
            widths = {a: max(1, seen[0][f"high_{a}"] - seen[0][f"low_{a}"]) for a in AXES}
        for n in cutting:
            half = len(n.room) // 2
            n.children = [Node(made, n.first, n.room[:half]), Node(made + 1, n.first + half, n.room[half:])]
            made += 2
            if n.number not in seen:  # no rows: any cut will do
                n.cut = 0
                continue
            r = seen[n.number]
            n.axis = max(range(len(AXES)), key=lambda k: ((r[f"high_{AXES[k]}"] - r[f"low_{AXES[k]}"]) / widths[AXES[k]], -k))
            all_room = sum(n.room)
            n.want = r.bytes * min(1.0, sum(n.room[:half]) / all_room if all_room else half / len(n.room))
        _refine(points, [n for n in cutting if n.cut is None], close * leaf)
        cuts = _table(points, "node, axis, cut, lower, upper", [(n.number, n.axis, f"{n.cut}L", *(c.number for c in n.children)) for n in cutting])
        child = F.when(F.col("cut").isNull(), F.col("node")).when(_chosen() < F.col("cut"), F.col("lower")).otherwise(F.col("upper"))
        points = written(points.join(cuts, "node", "left").withColumn("node", child).drop("axis", "cut", "lower", "upper"), "points")
    return points, root


def _refine(points: DataFrame, nodes: list[Node], close: float) -> None:
    """Find the cuts of nodes; a cell of at most close bytes isn't looked into."""
    left = AXIS_BITS + GROUP_BITS + ROW_BITS
    for step, bits in enumerate(STEPS, 1):
        if not nodes:
            return
        above, left = left, left - bits
        state = _table(points, "node, axis, prefix, want", [(n.number, n.axis, f"{n.prefix}L", f"{n.want - n.before!r}D") for n in nodes])
        near = points.join(state, "node").withColumn("key", _chosen()).where(F.shiftrightunsigned("key", above) == F.col("prefix"))
        cells = near.groupBy("node", "want", F.shiftrightunsigned("key", left).alias("cell")).agg(F.sum("size").alias("bytes"), F.bool_or("loose").alias("loose"))
        # at most 2**bits cells of each node
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
        reached = cells.withColumn("upto", upto).where("upto >= want")
        found = {r.node: r.at for r in reached.groupBy("node").agg(F.min(F.struct("cell", "bytes", "upto", "loose")).alias("at")).collect()}
        going = []
        for n in nodes:
            at = found[n.number]
            n.before += at.upto - at.bytes
            n.prefix = at.cell
            # a group goes whole to its nearer side, unless it outweighs a shard
            if at.bytes <= close or step == len(STEPS) or step == GROUP_STEPS and not at.loose:
                n.cut = (at.cell + (n.want - n.before > at.bytes / 2)) << left
            else:
                going.append(n)
        nodes = going


def shard_documents(documents: DataFrame, shards: int = 40, keep: float = KEEP, close: float = CLOSE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    points = _points(documents)
    groups = _groups(points)
    sums = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    total, rows = sums.bytes or 0, sums.n or 0
    heavy, room = _heaviest_first(groups, total, shards, keep)
    points = written(_settled(points, groups, heavy), "settled")
    light, tree = _grow(points.where("shard is null").drop("shard"), room, total / shards, close)
    leaves = _table(points, "node, shard", [(n.number, n.first) for n in tree.open()])
    columns = ["doc_id", "size", "text_crc32", "shard", "spread"]
    placed = light.join(leaves, "node").select(*columns).unionByName(points.where("shard is not null").select(*columns))
    salts = max(1, -(-rows // (shards * SLOT_ROWS)))
    salted = placed.withColumn("salt", F.pmod("spread", F.lit(salts)))
    counts = salted.groupBy("shard", "salt").count()
    before = counts.select("shard", "salt", F.coalesce(F.sum("count").over(Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = salted.withColumn("place", F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "text_crc32", "spread")) - 1)
    out = numbered.join(before, ["shard", "salt"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
