"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming distance by pigeonring filtering.

A text is lower-cased (A-Z only) and cut at ASCII white space into words; each shingle of
consecutive words, repeats included, is hashed with XXH64; a bit of the fingerprint is set
if it is set in over half of the hashes. A text with fewer words is one shingle of all its
words, and one without words has fingerprint zero.

Links. The 64 bits form a ring of segments. If two fingerprints differ in at most t bits,
then some segment begins a chain along the ring in which, for every length l, the first l
segments differ in at most l*t/m bits together. With m = t+1 segments a chain begins with
an equal segment, so fingerprints meet in the bucket of that segment's value; the chain's
other prefixes are tested there before the full distance is.

A bucket may hold any share of all fingerprints. One of over BUCKET fingerprints is first
dealt at random into blocks of about that size, and the links within these are followed, for
all segments together: what hangs together in the bucket, for the most part, then is one
component, and only those outside of it (rest) have links left to find. Buckets that are not settled so are parted, at
most PARTINGS times: since their fingerprints agree in a segment, all differing bits lie in
the others, and the same argument on those makes smaller buckets. What is large after
that is compared block by block, rest against all, each pair of blocks by itself. No pair that
could connect two components is lost, and nothing is capped. A bucket gives a spanning forest
of its links, not all pairs of a group.

Defined results: null and empty texts have fingerprint zero and link like others; equal
fingerprints link; very long texts are hashed whole; of repeated ids the rows stay; a null id
is never a component's name while another is there, but its row links like others; an empty
table gives an empty table; other columns, whatever their names, are not read by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import appended, small_batches, unused, written

BITS, SEED = 64, 42
#: The most fingerprints that are compared with one another in a bucket.
BUCKET = 4096
#: How often a bucket that is too large, and not one component, is parted.
PARTINGS = 1
#: Fingerprints compared at once with all that follow in their bucket.
ROWS_AT_ONCE = 256
#: Bits of the bitmap that tells documents which certainly stay: at most 8 MB to broadcast.
MARKS = 1 << 26
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def spans(text: bytes | None, words: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The words of a text in one line, and where its shingles begin and end."""
    parts = (text or b"").translate(_LOWER).split()
    if not parts:
        return b"", []
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    if len(parts) <= words:
        return line, [(0, len(line))]
    return line, list(zip([0, *(ends[: len(parts) - words] + 1).tolist()], ends[words - 1 :].tolist(), strict=True))


def fingerprint(text: bytes | None, words: int) -> int:
    line, at = spans(text, words)
    if not at:
        return 0
    digest = xxhash.xxh64_intdigest
    return bit_majority(np.array([digest(line[a:b], SEED) for a, b in at], np.uint64))


def bit_majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(documents: DataFrame, words: int, text: str = "text", into: str = "fingerprint", of=fingerprint) -> DataFrame:
    """documents with the fingerprint, or what else of(text, words) gives, as a signed long; the column replaces one of the same name."""
    small_batches(documents.sparkSession)
    kept = [c for c in documents.columns if c != into]
    (held,) = unused(kept, "text")
    plain = documents.select(*[f"`{c}`" for c in kept], F.col(f"`{text}`").cast("binary").alias(held))

    def run(batches):
        for batch in batches:
            prints = np.array([of(t, words) for t in batch.column(len(kept)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))], names=[*kept, into])

    return plain.mapInArrow(run, appended(plain.drop(held).schema, f"`{into}` long"))


def segments(free: int, parts: int) -> list[int]:
    """The set bits of free, as parts masks of consecutive bits of about equal number."""
    bits = [k for k in range(BITS) if free >> k & 1]
    cut = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << k for k in bits[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _chained(difference: np.ndarray, ring: list[int], first: int, most: int) -> np.ndarray:
    """Flat positions of the differences whose chain from segment first keeps, in every prefix, within its share of most; the full check is the last prefix."""
    flat, mask = difference.ravel(), ring[first]
    left = np.arange(flat.size)
    for length in range(2, len(ring) + 1):
        mask |= ring[(first + length - 1) % len(ring)]
        left = left[np.bitwise_count(flat[left] & np.uint64(mask)) <= length * most // len(ring)]
    return left[np.bitwise_count(flat[left]) <= most]


class Forest:
    """Components of n numbered things, and links that connect them."""

    def __init__(self, n: int) -> None:
        self.of, self.links = np.arange(n), []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Take in links: of those between two components one is kept for each that goes into a lower one, until none is left."""
        while True:
            apart = self.of[a] != self.of[b]
            a, b = a[apart], b[apart]
            if not len(a):
                return
            high, low = np.maximum(self.of[a], self.of[b]), np.minimum(self.of[a], self.of[b])
            order = np.lexsort((low, high))
            order = order[np.concatenate([[True], np.diff(high[order]) > 0])]
            self.links.append(np.stack([a[order], b[order]], 1))
            up = np.arange(len(self.of))
            up[high[order]] = low[order]
            while not np.array_equal(further := up[up], up):
                up = further
            self.of = up[self.of]

    def result(self) -> np.ndarray:
        return np.concatenate([np.zeros((0, 2), np.int64), *self.links])


def bucket_links(prints: np.ndarray, ring: list[int], first: int, most: int) -> np.ndarray:
    """A spanning forest, as pairs of positions, of the links among a bucket's fingerprints."""
    forest = Forest(len(prints))
    for at in range(0, len(prints), ROWS_AT_ONCE):
        rest = prints[at:]
        found = _chained(prints[at : at + ROWS_AT_ONCE, None] ^ rest[None, :], ring, first, most)
        forest.join(at + found // len(rest), at + found % len(rest))
    return forest.result()


def cross_links(rest: np.ndarray, others: np.ndarray, most: int) -> np.ndarray:
    """A spanning forest, as positions in either, of the links between two blocks of fingerprints."""
    forest = Forest(len(rest) + len(others))
    for at in range(0, len(rest), ROWS_AT_ONCE):
        rows, columns = np.nonzero(np.bitwise_count(rest[at : at + ROWS_AT_ONCE, None] ^ others[None, :]) <= most)
        forest.join(at + rows, len(rest) + columns)
    return forest.result() - [0, len(rest)]


def _grouped(batches, width: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """Runs of equal keys, the first width columns, from batches that are sorted by key, with the fingerprints that follow; a run is at most a bucket."""
    held_key, held = None, []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(width)]
        prints = batch.column(width).to_numpy().view(np.uint64)
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), len(prints)], strict=True):
            key = tuple(int(k[a]) for k in keys)
            if key != held_key:
                if held:
                    yield held_key, np.concatenate(held)
                held_key, held = key, []
            held.append(prints[a:b])
    if held:
        yield held_key, np.concatenate(held)


def _linked(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x[at[:, k]].view(np.int64)) for k, x in enumerate((a, b))], names=["a", "b"])


def _within(dealt: DataFrame, keys: list[str], rings: dict[int, tuple[list[int], int]], most: int) -> DataFrame:
    """Links among the fingerprints of each group of keys, of which path is the first: by chains from the segment that the path has equal."""

    def run(batches):
        for key, values in _grouped(batches, len(keys)):
            values = np.unique(values)
            ring, first = rings[key[0]]
            yield _linked(values, values, bucket_links(values, ring, first, most))

    return written(dealt.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long"), "links")


def _between(left: DataFrame, bucket: int, most: int) -> DataFrame:
    """Links between the fingerprints of a bucket that are not in its main component (rest) and all others of it, block by block."""
    sizes = left.groupBy("path", "value").agg(F.ceil(F.count("*") / bucket).alias("blocks"), F.ceil(F.sum(F.col("rest").cast("long")) / bucket).alias("rest_blocks"))
    sized = left.join(sizes, ["path", "value"])
    block = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
    every = sized.select("path", "value", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)).alias("i"), block("blocks").alias("j"), F.lit(1).alias("side"), "fp")
    rest = sized.where("rest").select("path", "value", block("rest_blocks").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"), "fp")
    keys = ["path", "value", "i", "j"]

    def run(batches):
        held_key, held = None, None
        for (*key, side), values in _grouped(batches, 5):
            if side == 0:
                held_key, held = key, values
            elif key == held_key:
                yield _linked(held, values, cross_links(held, values, most))

    dealt = rest.unionByName(every).repartition(*keys).sortWithinPartitions(*keys, "side")
    return written(dealt.select(*keys, "side", "fp").mapInArrow(run, "a long, b long"), "links")


def fingerprint_links(prints: DataFrame, most: int, bucket: int = BUCKET, partings: int = PARTINGS) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints of prints(fp) as all pairs within most differing bits would."""
    spark = prints.sparkSession
    small_batches(spark, 10_000)
    parts = most + 1
    rings: dict[int, tuple[list[int], int]] = {}
    free_of = {0: (1 << BITS) - 1}
    level, found = prints.select(F.lit(0).alias("up"), "fp", F.lit(True).alias("rest")), None
    for depth in range(partings + 1):
        # every path of this level is parted into one for each segment of its free bits; a row of the table for each
        choices, next_free = [], {}
        for path, free in free_of.items():
            ring = segments(free, parts)
            for k, mask in enumerate(ring):
                child = path * (parts + 1) + k + 1
                rings[child], next_free[child] = (ring, k), free & ~mask
                choices.append((path, child, _signed(((1 << BITS) - 1) & ~next_free[child])))
        table = F.broadcast(spark.sql("SELECT * FROM VALUES " + ", ".join(f"({p}, {c}, {m}L)" for p, c, m in choices) + " AS t(up, path, mask)"))
        keyed = level.join(table, "up").select("path", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp", "rest")
        sizes = keyed.groupBy("path", "value").agg(F.count("*").alias("n"), F.max("rest").alias("any")).where("n > 1 and any").drop("any")
        sized = keyed.join(sizes, ["path", "value"])
        links = _within(sized.where(F.col("n") <= bucket), ["path", "value"], rings, most)
        found = links if found is None else found.unionByName(links)
        large = written(sized.where(F.col("n") > bucket), "large")
        if large.isEmpty():
            return found
        # a hot bucket is dealt into blocks at random, each path in its own way: what hangs together for the most part becomes one component
        blocks = large.withColumn("block", F.pmod(F.xxhash64("fp", "path"), F.ceil(F.col("n") * 1.1 / bucket)))
        found = found.unionByName(_within(blocks, ["path", "value", "block"], rings, most))
        left = _unsettled(large, found)
        few = F.lit(True) if depth == partings else F.col("n_rest") <= bucket
        found = found.unionByName(_between(left.where(few), bucket, most))
        left = left.where(~few)
        paths = {r.path for r in left.select("path").distinct().collect()}  # at most parts ** (depth + 1)
        if not paths:
            return found
        free_of = {c: free for c, free in next_free.items() if c in paths}
        level = left.select(F.col("path").alias("up"), "fp", "rest")
    return found


def _unsettled(large: DataFrame, links: DataFrame) -> DataFrame:
    """(path, value, fp, rest, n_rest) of the buckets that are not one component by now; rest: not in the bucket's largest one."""
    classes = connected_components(links, stored=True)
    named = large.select("path", "value", "fp").join(classes.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    counts = named.groupBy("path", "value", "component").count()
    main = counts.groupBy("path", "value").agg(F.max_by("component", F.struct("count", "component")).alias("main"), (F.sum("count") - F.max("count")).alias("n_rest")).where("n_rest > 0")
    return written(named.join(main, ["path", "value"]).select("path", "value", "fp", (F.col("component") != F.col("main")).alias("rest"), "n_rest"), "left")


def near_duplicates(documents: DataFrame, words: int = 5, most: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component) of every row; component is the smallest key that links reach, equal fingerprints included."""
    slim = with_fingerprints(documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), words, "text", "fp").select("key", "fp")
    slim = written(slim, "fingerprints")
    distinct = written(slim.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    classes = connected_components(fingerprint_links(distinct.select("fp"), most), stored=True)
    inside = distinct.join(classes.select(F.col("id").alias("fp"), F.col("component").alias("class")), "fp", "left").withColumn("class", F.coalesce("class", "fp"))
    inside = written(inside, "inside")
    named = inside.join(inside.groupBy("class").agg(F.min("first").alias("component")), "class").select("fp", "component")
    return slim.join(named, "fp", "left").select(F.col("key").alias(key), "fp", "component")


def fingerprint_text(column: str = "fp"):
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def simhash_digest(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents, words=3, most=2)
    return found.select("doc_id", fingerprint_text().alias("fingerprint"), F.col("component").alias("component_id"))


def one_of_each(documents: DataFrame, words: int = 5, most: int = 6) -> DataFrame:
    """One document of each group that links within most bits make, in the columns of documents."""
    found = written(near_duplicates(documents, words, most), "found")
    return kept_rows(documents, found.select("doc_id", "fp"), found.select("fp", "component").distinct(), words, fingerprint)


def kept_rows(documents: DataFrame, rows: DataFrame, classes: DataFrame, words: int, of) -> DataFrame:
    """One row of each component of classes(fp, component), where rows(doc_id, fp) has all rows and of(text, words) is a row's fp.

    It is the row with the smallest id, then the smallest fp; a row without an id stays
    only where no other of its component has one. Rows go by id and fp together, so that
    of rows with one id those with other texts are decided on their own.

    Texts stay where they are, but for those whose id may be one to drop, a repeated one
    or none: a bitmap of MARKS bits over hashes of such ids, at most MARKS / 8 bytes however
    many there are, lets all others pass, and only the marked rows are joined with what stays.
    """
    # one row for each fp, so that copies, however many, don't meet in a task
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")).select("fp", "first.*")
    best = first.join(classes, "fp").groupBy("component").agg(F.min(F.struct("none", "doc_id", "fp")).alias("best"))
    stays = written(best.select("best.doc_id", "best.fp"), "stays")
    counts = rows.where("doc_id is not null").groupBy("doc_id").count()
    marked = counts.join(stays.select("doc_id", F.lit(True).alias("one")), "doc_id", "left").where("count > 1 or one is null")
    bitmaps = marked.select(F.bitmap_bucket_number(_mark("doc_id")).alias("bucket"), F.bitmap_bit_position(_mark("doc_id")).alias("bit"))
    bitmaps = written(bitmaps.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "bitmaps")
    columns = [f"`{c}`" for c in documents.columns]
    number, bit, bits = unused(documents.columns, "bucket", "bit", "bits")
    bitmaps = bitmaps.toDF(number, bits)
    seen = documents.select(*columns, F.bitmap_bucket_number(_mark("doc_id")).alias(number), F.bitmap_bit_position(_mark("doc_id")).alias(bit)).join(F.broadcast(bitmaps), number, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    unsure = F.col("doc_id").isNull() | F.coalesce(F.getbit(byte, (F.col(bit) % 8).cast("int")) == 1, F.lit(False))
    tagged = with_fingerprints(seen.where(unsure).select("doc_id", "text", F.struct(*columns).alias("whole")), words, "text", "fp", of)
    same = tagged["doc_id"].eqNullSafe(stays["doc_id"]) & (tagged["fp"] == stays["fp"])
    checked = tagged.join(stays, same, "left_semi").dropDuplicates(["doc_id", "fp"])
    return seen.where(~unsure).select(*columns).unionByName(checked.select("whole.*"))


def _mark(column: str):
    """The bit of an id."""
    return F.pmod(F.xxhash64(column), F.lit(MARKS))
