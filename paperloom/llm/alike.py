"""Near-duplicates of texts by SimHash, made whole: sets of word shingles of Jaccard 0.8 or more are linked, and none of less.

Words are those of simhash; a text's set has the hash of each of its shingles, and a text
without words has one set of its own kind. Equal sets are one vertex, named by the set's hash.

SimHash first. Fingerprints that link within a few bits, found by pigeonring filtering, give
a forest of pairs; those whose sets are similar, by exact count, are links. What follows takes
their components as given, and compares no two sets that are linked so. But sets at 0.8 differ
in up to 17 of 64 bits, and no radius that segments can be cut for finds all of these; two bits
leave segments of 21, which tell many fingerprints apart.

So a join of sets finds the rest. The range of hashes is cut into parts, and the hashes that a
set has in a part make one key. Two sets of sizes x and y of Jaccard 0.8 differ in (x + y) / 9
hashes at most, so in no more parts; they share the keys of all others. Parts without a hash
give no key. Where a set has more keys than the most parts it can differ in (apart), it is
enough that the first apart + 1 keys of both, in one order of all keys, have one in common:
keys of most hashes that aren't frequent come first. Sets with fewer keys could only miss one
another, and meet by a key of their own. How many parts there are goes by the size's power of
two; a set whose larger partner may lie beyond that has keys for the next number of parts too.
Which hashes count as frequent is taken from a sample; it decides the work, not the result.

A large group isn't compared pair by pair: every set is first compared with one of the sets
that are least or greatest of a key they share, and then only with sets that it isn't linked
with by now, and whose sketch differs in few enough places. A key of frequent hashes alone has
its ends found by partial aggregates, and its rows joined with these, so no task needs all.

Defined results: null and empty texts, and those without words, are alike; very long texts are
compared whole; repeated rows and equal sets are one vertex; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import simhash
from .components import connected_components
from .shared import collect_garbage, small_batches, written
from .simhash import SEED, bit_majority, spans

#: One set of so many tells which hashes are frequent: those of at least FREQUENT of them, at most MOST_FREQUENT.
SAMPLED, FREQUENT, MOST_FREQUENT = 16, 4, 1 << 18
#: The range of hashes is cut into so many parts at least; an odd number that keeps the keys of other cuts apart.
LEAST_PARTS, KEY_STEP = 16, 0x9E3779B97F4A7C15
#: Longs of a sketch.
WORDS = 32


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The hashes of a text's shingles, one after another."""
    line, at = spans(text, words)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in at] or [digest(b"", SEED)], np.uint64)


def set_hash(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def text_hash(text: bytes | None, words: int) -> int:
    return set_hash(np.unique(shingles(text, words)))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """For each place of 64 * WORDS, whether the number of a set's hashes there is odd; two sets' sketches differ in no more places than the sets do in hashes."""
    odd = np.bincount((hashes % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def shingle_sets(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp, print, hashes, sketch) of documents(doc_id, text): the set's hash, the SimHash fingerprint, the set in order, and its sketch."""
    small_batches(documents.sparkSession)
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            found = [shingles(t, words) for t in batch.column(1).to_pylist()]
            prints = np.array([bit_majority(x) for x in found], np.uint64).view(np.int64)
            found = [np.unique(x) for x in found]
            names = np.array([set_hash(x) for x in found], np.uint64).view(np.int64)
            hashes, sketches = (pa.array(x, pa.list_(pa.int64())) for x in ([x.view(np.int64) for x in found], [sketch(x) for x in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(prints), hashes, sketches], names=["doc_id", "fp", "print", "hashes", "sketch"])

    return plain.mapInArrow(run, "doc_id long, fp long, print long, hashes array<long>, sketch array<long>")


def parts_of(size: int) -> list[int]:
    """How many parts the range of hashes is cut into for a set: by its size's power of two, and by the next one if a similar set can have it."""
    if size < 4:
        return []  # no other set is similar
    power = 1 << (size - 1).bit_length()
    return sorted({max(LEAST_PARTS, p * 3 // 8) for p in ([power, 2 * power] if size + size // 4 > power else [power])})


def apart(size: int) -> int:
    """The most hashes in which a set and a similar one differ."""
    return (size + size + size // 4) // 9


def set_keys(hashes: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that a set, in unsigned order, meets similar ones by, and whether each is of late hashes alone."""
    keys, often, most = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], apart(len(hashes)) + 1
    for parts in parts_of(len(hashes)):
        cut = np.uint64(parts * KEY_STEP & (1 << 64) - 1)
        part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        found = np.add.reduceat(hashes, first) + cut
        early = np.add.reduceat((~late).astype(np.int64), first)
        if len(found) < most:
            found, early = np.append(found, cut), np.append(early, 0)
        order = np.lexsort((found, -early))[:most]
        keys.append(found[order])
        often.append(early[order] == 0)
    return np.concatenate(keys), np.concatenate(often)


def _keys(sets: DataFrame, frequent: list[int]) -> DataFrame:
    """(key, row, size, often): a row for each key of a set; often: it is of frequent hashes alone."""
    shared = sets.sparkSession.sparkContext.broadcast(np.sort(np.array(frequent, np.int64).view(np.uint64)))

    def run(batches):
        last = shared.value
        for batch in batches:
            keys, rows, sizes, often = [], [], [], []
            for row, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = values.values.to_numpy().view(np.uint64)
                late = last[np.minimum(np.searchsorted(last, values), len(last) - 1)] == values if len(last) else np.zeros(len(values), bool)
                found, alone = set_keys(values, late)
                keys.append(found.view(np.int64))
                rows.append(np.full(len(found), row))
                sizes.append(np.full(len(found), len(values), np.int32))
                often.append(alone)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, rows, sizes, often)], names=["key", "row", "size", "often"])

    return sets.select("row", "hashes").mapInArrow(run, "key long, row long, size int, often boolean")


def _met(sets: DataFrame, frequent: list[int]) -> DataFrame:
    """(key, row, size, low, high): keys that two sets or more share, with the least and the greatest set of the key."""
    keyed = _keys(sets, frequent)
    one = F.struct("row", "size")
    of_key = Window.partitionBy("key")
    rare = keyed.where("not often").withColumns({"low": F.min(one).over(of_key), "high": F.max(one).over(of_key)}).where("low.row <> high.row").drop("often").distinct()
    hot = keyed.where("often").drop("often").distinct()
    ends = hot.groupBy("key").agg(F.min(one).alias("low"), F.max(one).alias("high")).where("low.row <> high.row")
    return written(rare.unionByName(hot.join(ends, "key")), "met")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose sets are similar, by exact count."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "pairs")
    # only sets of such a pair are shuffled
    needed = written(pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct(), "needed")
    slim = sets.join(needed, "row", "left_semi").select("row", "hashes").dropDuplicates(["row"])
    both = pairs.join(slim.toDF("a", "x"), "a").join(slim.toDF("b", "y"), "b")
    return written(both.where(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("a", "b"), "links")


def _fit(x, y):
    """Whether two sets may be similar by their sizes."""
    return 5 * F.least(x, y) >= 4 * F.greatest(x, y)


def _ends(met: DataFrame) -> DataFrame:
    """(a, b), once each: every set with the least and the greatest sets of its keys that it may be similar to."""
    found = None
    for side in ("low", "high"):
        pairs = met.where((F.col("row") != F.col(f"{side}.row")) & _fit(F.col("size"), F.col(f"{side}.size"))).select("row", F.col(f"{side}.row").alias("end"))
        found = pairs if found is None else found.unionByName(pairs)
    return found.select(F.least("row", "end").alias("a"), F.greatest("row", "end").alias("b")).distinct()


def _unlinked(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that aren't linked by now."""
    for end in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("row").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return pairs.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _open_pairs(met: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): pairs that may be similar, by their sketches too, and aren't linked by now."""
    # keys whose sets are all linked by now are done, and of keys that the same sets have one will do;
    # a set without a link is a component of its own, so only sets with links are joined with theirs
    linked = met.select("key", "row").join(classes, "row").groupBy("key").agg(F.count("*").alias("n_linked"), F.min("component").alias("first"), F.max("component").alias("last"))
    done = linked.where("first = last").select("key", "n_linked")
    group = [F.bit_xor(F.xxhash64("row")).alias("rows"), F.count("*").alias("n"), F.min("row").alias("low"), F.max("row").alias("high")]
    open_ = met.groupBy("key").agg(*group).join(done, "key", "left").where("n_linked is null or n_linked < n")
    open_ = open_.groupBy("rows", "n", "low", "high").agg(F.min("key").alias("key")).select("key")
    left = written(met.join(open_, "key", "left_semi").select("key", "row", "size"), "open")
    needed = written(left.select("row").distinct(), "needed")
    sketches = sets.select("row", "sketch").join(needed, "row", "left_semi").dropDuplicates(["row"])
    named = sketches.join(classes, "row", "left").withColumn("component", F.coalesce("component", "row"))
    left = written(left.join(named, "row").select("key", F.struct("row", "size", "component", "sketch").alias("x")), "sketched")
    differ = sum((F.bit_count(F.col("x.sketch")[k].bitwiseXOR(F.col("y.sketch")[k])) for k in range(WORDS)), F.lit(0))
    apart_now = (F.col("x.row") < F.col("y.row")) & (F.col("x.component") != F.col("y.component"))
    similar = apart_now & _fit(F.col("x.size"), F.col("y.size")) & (9 * differ <= F.col("x.size") + F.col("y.size"))
    pairs = left.join(left.withColumnRenamed("x", "y"), "key").where(similar)
    return pairs.select(F.col("x.row").alias("a"), F.col("y.row").alias("b"))


def _classes(links: DataFrame) -> DataFrame:
    return written(connected_components(links, stored=True).withColumnRenamed("id", "row"), "classes")


def similar_components(sets: DataFrame, first: DataFrame | None = None, sampled: int = SAMPLED, often: int = FREQUENT) -> DataFrame:
    """(row, component) of sets(row, hashes, sketch) that have a similar one, from the candidates first(a, b) on; repeated rows are one set."""
    spark = sets.sparkSession
    first = first if first is not None else spark.createDataFrame([], "a long, b long")
    links = _compared(first, sets)
    classes = _classes(links)
    of_sample = sets.where(F.pmod("row", F.lit(sampled)) == 0).dropDuplicates(["row"]).select(F.explode("hashes").alias("hash")).groupBy("hash").count()
    frequent = [r.hash for r in of_sample.where(F.col("count") >= often).orderBy(F.desc("count"), "hash").limit(MOST_FREQUENT).collect()]
    met = _met(sets, frequent)
    collect_garbage(spark)
    links = links.unionByName(_compared(_unlinked(_ends(met), classes), sets))
    classes = _classes(links)
    collect_garbage(spark)
    pairs = _open_pairs(met, sets, classes)
    collect_garbage(spark)
    links = links.unionByName(_compared(pairs, sets))
    collect_garbage(spark)
    return _classes(links)


def print_candidates(prints: DataFrame, most: int) -> DataFrame:
    """(a, b): a forest of the sets of prints(row, print) that SimHash links within most bits."""
    prints = written(prints.distinct(), "prints")
    first = written(prints.groupBy("print").agg(F.min("row").alias("first")), "firsts")
    same = prints.join(first, "print").where("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b"))
    links = simhash.fingerprint_links(first.select(F.col("print").alias("fp")), most)
    ends = [first.select(F.col("print").alias(c), F.col("first").alias(f"{c}_row")) for c in ("a", "b")]
    linked = links.distinct().join(ends[0], "a").join(ends[1], "b").select(F.col("a_row").alias("a"), F.col("b_row").alias("b"))
    return same.unionByName(linked)


def near_duplicates(documents: DataFrame, words: int = 5, most: int | None = 2, sampled: int = SAMPLED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, component) of every set; most None leaves all to the join of sets."""
    collect_garbage(documents.sparkSession)
    sets = written(shingle_sets(documents, words), "sets")
    collect_garbage(documents.sparkSession)
    rows = sets.select(F.col("fp").alias("row"), "print", "hashes", "sketch")
    first = None if most is None else print_candidates(rows.select("row", "print"), most)
    classes = similar_components(rows.select("row", "hashes", "sketch"), first, sampled)
    prints = sets.select("fp").distinct()
    return sets.select("doc_id", "fp"), prints.join(classes.withColumnRenamed("row", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def one_of_each(documents: DataFrame, words: int = 5, most: int | None = 2) -> DataFrame:
    """One document of each group that links make, in the columns of documents; kept_rows says which."""
    rows, classes = near_duplicates(documents, words, most)
    return simhash.kept_rows(documents, rows, classes, words, text_hash)
