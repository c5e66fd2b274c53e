"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Every partition tokenises its documents, cuts those longer than a sequence into full
pieces and a rest, and packs windows of pieces best-fit, the longest first. Nearly full
bins are final. The pieces of all others are open, however many they are, and meet those of
all partitions: as a piece is but a length to a bin, only the number of open pieces by
length goes up, summed on the way, and the root packs at most `capacity` such numbers
best-fit. Its plan, runs of equal lengths that go to runs of bins, is then read off for
every open piece by its rank among those of its length. So memory is bounded by the
number of lengths, and no open piece is kept from another.

Defined results: a null or empty text is the closing id alone; repeated ids are packed row
by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import appended, small_batches, written
from .tokens import Encoder

SEQUENCE, CLOSING_ID = 2048, 0
#: A bin with at most this part of a sequence free is nearly full.
NEARLY = 1 / 128
#: Rows that a task hands on at once.
CARRIED = 4096
#: Pieces that are packed at once in a partition.
WINDOW = 1 << 16


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every item, and the fill of every bin: longest first, each into the fullest bin that has room."""
    n = len(lengths)
    where, offset, fills = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r free
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        where[k], offset[k] = b, fills[b]
        fills[b] += size
        if room > size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return where, offset, np.array(fills, np.int64)


def best_fit_counts(counts: dict[int, int], capacity: int) -> np.ndarray:
    """best_fit over numbers of items by length: rows (length, from rank, to rank, first bin, items to a bin, offset).

    Items of a length from one rank to before another go to consecutive bins, so many to
    each one after the other. Bins that are alike are one entry, so work and memory go by lengths.
    """
    by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins)
    rooms, made, plan = 0, 0, []
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                first, bins = by_room[room].pop()
            else:
                room, first, bins = capacity, made, -(-left // (capacity // size))
                made += bins
            # a bin that has got an item is the fullest that has room, until no more fit
            each = min(room // size, left)
            used = min(bins, left // each)
            plan.append((size, rank, rank + used * each, first, each, capacity - room))
            rank, left = rank + used * each, left - used * each
            for rest, at, n in ((room - each * size, first, used), (room, first + used, bins - used)):
                if rest and n:
                    by_room[rest].append((at, n))
            for changed in (room, room - each * size):
                rooms = rooms | 1 << changed if by_room[changed] else rooms & ~(1 << changed)
    return np.array(plan, np.int64).reshape(-1, 6)


def _pieces(documents: DataFrame, spec: str, capacity: int, closing: int, with_ids: bool) -> DataFrame:
    """Every piece; its bin and offset within the partition if the bin is final, else its rank among the partition's open pieces of its length."""
    shared = documents.sparkSession.sparkContext.broadcast(spec)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, node long, rank long"
    end = np.array([closing], "<u4").tobytes()

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder, node, made = Encoder(shared.value), TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        ids: list[bytes] = []
        opened = np.zeros(capacity + 1, np.int64)

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal made, rows, ids
            lengths = np.array([r[3] for r in rows], np.int64)
            where, offset, fills = best_fit(lengths, capacity)
            open_ = fills[where] < capacity * (1 - NEARLY)
            rank = np.full(len(rows), -1, np.int64)
            order = np.flatnonzero(open_)[np.argsort(lengths[open_], kind="stable")]
            sizes, first, count = np.unique(lengths[order], return_index=True, return_counts=True)
            rank[order] = np.arange(len(order)) + np.repeat(opened[sizes] - first, count)
            opened[sizes] += count
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            columns += [pa.array(x, mask=m) for x, m in (((node << 36) + made + where, open_), (offset, open_), (np.full(len(rows), node, np.int64), None), (rank, ~open_))]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
            made += len(fills)
            rows, ids = [], []
            batch = pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")] + ["ids"] * with_ids)
            yield from (batch.slice(at, CARRIED) for at in range(0, batch.num_rows, CARRIED))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                coded = encoder.encode(text or "") + end
                for piece, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        ids.append(part)
            if len(rows) >= WINDOW:
                yield from packed()
        if rows:
            yield from packed()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)


def _planned(pieces: DataFrame, plan: np.ndarray, first_bin: int) -> DataFrame:
    """Open pieces(..., length, rank) with the bin and the offset that the plan has for them."""
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    shared = pieces.sparkSession.sparkContext.broadcast(plan[order])
    kept = [c for c in pieces.columns if c != "rank"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        starts = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(starts, (length << 48) + rank, side="right") - 1]
            at = rank - row[:, 1]
            bins, offset = first_bin + row[:, 3] + at // row[:, 4], row[:, 5] + at % row[:, 4] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(bins), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return pieces.mapInArrow(run, appended(pieces.select(*kept).schema, "sequence_id long, offset long"))


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE, closing: int = CLOSING_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of documents(doc_id, text) with sequence_id and offset; ids too if they are asked for.

    tokenizer_path names a tokenizer file that the driver can read.
    """
    small_batches(documents.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    pieces = written(_pieces(documents, spec, capacity, closing, with_ids), "pieces")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    closed = pieces.where("rank is null").select(*out, F.col("bin").alias("sequence_id"), "offset")
    opened = pieces.where("rank is not null")
    # one row for each length in a partition, then at most capacity rows
    counts = written(opened.groupBy("length", "node").count(), "counts")
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    if not total:
        return closed
    before = Window.partitionBy("length").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "node", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = opened.join(base, ["length", "node"]).select(*out, (F.col("rank") + F.col("base")).alias("rank"))
    first_bin = (pieces.agg(F.max("node")).first()[0] + 1) << 36
    return closed.unionByName(_planned(ranked, best_fit_counts(total, capacity), first_bin))
