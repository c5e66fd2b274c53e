"""Exact top-k search: BM25 over an inverted index in shards, pruned block by block with bounds.

A shard holds up to SHARD documents in an order that keeps languages together, cut into
blocks of BLOCK documents. For a term the index has its postings and, when it is read, the
greatest impact in each block for the DENSE most frequent terms, whose lists are laid out
densely; all other lists are short and are added up as they are.

Queries go through a shard in groups. What the short lists give a document is exact; with
the weighted block maxima of the frequent terms it makes a bound for each query and block.
A block is scored, by one matrix product over its documents, for those queries alone whose
k-th best score so far its bound reaches; for all others the block is skipped whole, since
no document in it can enter. The k-th best scores are carried on from shard to shard within
a task. Scores use the global number of documents, mean length and document frequencies, so
that merging the tasks' best gives exactly the best of all.

Terms are lower-cased runs of letters and digits, held as 64-bit hashes. Queries go
through in blocks of at most BLOCK_TERMS terms, each given to all shards; the frequencies
are collected for a block's terms alone. Ties in score go to the smaller id.

Defined results: a query without a term, null and empty ones among them, has no answers; a
document without terms answers none; one without an id is not indexed, counted or asked; very
long texts are indexed whole; repeated query ids answer as one query with all their
rows' terms; of repeated documents each row answers; a table without documents gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import batch_rows, small_batches, written

K1, B = 1.2, 0.75
SHARD, BLOCK = 4096, 64
BLOCK_TERMS = 1_500_000
#: The frequent terms of a shard whose lists are dense, queries that go through together, and shards of a task.
DENSE, QUERIES_AT_ONCE, SHARDS_OF_TASK = 512, 128, 4
#: Blocks of documents that are scored before the k-th best scores are looked at again.
BLOCKS_AT_ONCE = 8
#: Scores are given to so many digits, and bounds are raised by as much as sums may differ by.
DIGITS, SLACK = 9, 1e-9
_WORD = re.compile(r"[^\W_]+")


def term_hashes(text: str | None) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


# Index


def _index_rows(documents: DataFrame) -> DataFrame:
    """A row for each shard; arrays are bytes."""
    schema = "docs binary, lengths binary, terms binary, at binary, doc binary, tf binary, n long, words long"

    def one(ids: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(f) for f in found], np.int64)
        tokens = np.concatenate(found)
        found.clear()
        terms, term = np.unique(tokens, return_inverse=True)
        del tokens
        # documents of a language stand together: in order of their most frequent term
        pair = term.astype(np.int64) * len(ids) + np.repeat(np.arange(len(ids)), lengths)
        del term
        pair, tf = np.unique(pair, return_counts=True)
        term, doc = (pair // len(ids)).astype(np.int32), (pair % len(ids)).astype(np.int32)
        del pair
        spread = np.bincount(term, minlength=len(terms))
        order = np.lexsort((term, -tf, doc))
        first = order[np.unique(doc[order], return_index=True)[1]]
        main = np.full(len(ids), -1)
        main[doc[first]] = term[first]
        rank = np.empty(len(ids), np.int32)
        rank[np.lexsort((np.array(ids), main, -spread[main]))] = np.arange(len(ids))
        doc = rank[doc]
        order = np.lexsort((doc, term))
        back = np.argsort(rank)
        columns = (np.array(ids, "<i8")[back], lengths[back].astype("<i4"), terms.astype("<u8"), np.concatenate([[0], np.cumsum(spread)]).astype("<i8"), doc[order].astype("<u2"), tf[order].astype("<u4"))
        return pa.RecordBatch.from_arrays([*(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.array([len(ids)]), pa.array([int(lengths.sum())])], names=[c.split()[0] for c in schema.split(", ")])

    def run(batches) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        found: list[np.ndarray] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if doc_id is not None:
                    ids.append(doc_id)
                    found.append(term_hashes(text))
                if len(ids) == SHARD:
                    yield one(ids, found)
                    ids, found = [], []
        if ids:
            yield one(ids, found)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class Shard:
    """A shard's index, ready to be searched with a mean length and the terms that queries have."""

    def __init__(self, row: dict, mean: float, wanted: np.ndarray) -> None:
        self.docs, lengths, terms, at = (np.frombuffer(row[c], t) for c, t in (("docs", "<i8"), ("lengths", "<i4"), ("terms", "<u8"), ("at", "<i8")))
        self.doc, tf = np.frombuffer(row["doc"], "<u2").astype(np.int64), np.frombuffer(row["tf"], "<u4").astype("f8")
        self.impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.doc] / mean))
        n = len(self.docs)
        self.blocks = -(-n // BLOCK)
        place = np.minimum(np.searchsorted(terms, wanted), max(0, len(terms) - 1))
        held = terms[place] == wanted if len(terms) else np.zeros(len(wanted), bool)
        #: of each wanted term: its list, or an empty one
        self.first, self.count = np.where(held, at[place], 0), np.where(held, at[np.minimum(place + 1, len(at) - 1)] - at[place], 0)
        often = np.argsort(-self.count, kind="stable")[:DENSE]
        often = often[self.count[often] > BLOCK]
        #: row of a wanted term in the dense lists, -1 without one
        self.row = np.full(len(wanted), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.blocks * BLOCK))
        posting = _ranges(self.first[often], self.count[often])
        self.dense[np.repeat(np.arange(len(often)), self.count[often]), self.doc[posting]] = self.impact[posting]
        self.block_max = self.dense.reshape(len(often), self.blocks, BLOCK).max(2) if len(often) else np.zeros((0, self.blocks))

    def answers(self, ends: np.ndarray, place: np.ndarray, weights: np.ndarray, k: int, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, position, score) of all that may be among the k best of queries with the given best scores, top, which are brought up to date."""
        queries, width = len(ends) - 1, self.blocks * BLOCK
        who = np.repeat(np.arange(queries), np.diff(ends))
        often = self.row[place] >= 0
        heavy = np.zeros((queries, len(self.dense)))
        heavy[who[often], self.row[place[often]]] = weights[often]
        rare = ~often & (self.count[place] > 0)
        size = self.count[place[rare]]
        posting = _ranges(self.first[place[rare]], size)
        flat = np.repeat(who[rare] * width, size) + self.doc[posting]
        score = np.bincount(flat, np.repeat(weights[rare], size) * self.impact[posting], queries * width).reshape(queries, self.blocks, BLOCK)
        bound = score.max(2) + heavy @ self.block_max
        bound = np.where(bound > 0, bound * (1 + SLACK) + SLACK, -1.0)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.argsort(-bound.sum(0), kind="stable")
        for at in range(0, self.blocks, BLOCKS_AT_ONCE):
            chosen = order[at : at + BLOCKS_AT_ONCE]
            fresh = np.zeros((queries, len(chosen) * BLOCK))
            for j, b in enumerate(chosen):
                mine = np.flatnonzero(bound[:, b] >= top[:, 0])
                if len(mine):
                    exact = score[mine, b] + heavy[mine] @ self.dense[:, b * BLOCK : (b + 1) * BLOCK]
                    fresh[mine, j * BLOCK : (j + 1) * BLOCK] = np.round(exact, DIGITS)
            query, column = np.nonzero((fresh > 0) & (fresh >= top[:, :1]))
            if len(query):
                some = np.unique(query)
                both = np.concatenate([top[some], fresh[some]], axis=1)
                top[some] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                top[some] = np.sort(top[some], axis=1)
                found.append((query, chosen[column // BLOCK] * BLOCK + column % BLOCK, fresh[query, column]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, position, value = (np.concatenate(c) for c in zip(*found, strict=True))
        keep = value >= top[query, 0]
        return query[keep], position[keep], value[keep]


def best_of(query: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of every query, ties to the smaller id."""
    order = np.lexsort((doc, -score, query))
    query, doc, score = query[order], doc[order], score[order]
    start = np.concatenate([[True], query[1:] != query[:-1]]) if len(query) else np.zeros(0, bool)
    place = np.arange(len(query)) - np.maximum.accumulate(np.where(start, np.arange(len(query)), 0)) if len(query) else query
    return query[place < k], doc[place < k], score[place < k]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for count[0] numbers, and so on."""
    total = int(count.sum())
    shift = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else first, count)
    return np.arange(total) + shift


# Queries


def _query_blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, offsets, sorted distinct terms of each) for as many queries at a time as BLOCK_TERMS allows."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.unique(term_hashes(t)).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.binary())], names=["id", "terms"])

    texts = queries.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    hashed = written(texts.mapInArrow(run, "id long, terms binary"), "queries")
    ids, terms, size = [], [], 0
    for row in hashed.toLocalIterator():
        ids.append(row.id)
        terms.append(np.frombuffer(bytes(row.terms), "<u8"))
        size += len(terms[-1])
        if size >= BLOCK_TERMS:
            yield np.array(ids), np.concatenate([[0], np.cumsum([len(t) for t in terms])]), np.concatenate(terms)
            ids, terms, size = [], [], 0
    if ids:
        yield np.array(ids), np.concatenate([[0], np.cumsum([len(t) for t in terms])]), np.concatenate(terms)


def _frequencies(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """In how many documents each wanted term is."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for terms, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, counts = np.frombuffer(terms, "<u8"), np.diff(np.frombuffer(at, "<i8"))
                where = np.searchsorted(shared.value, own)
                held = where < len(shared.value)
                held[held] = shared.value[where[held]] == own[held]
                total[where[held]] += counts[held]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["at", "n"])

    out = np.zeros(len(wanted), np.int64)
    sums = index.select("terms", "at").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return out


def search(documents: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of every query."""
    spark = documents.sparkSession
    small_batches(spark)
    index = written(_index_rows(documents), "index")
    total = index.agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.count("*").alias("shards")).first()
    answers = spark.createDataFrame([], "query_id long, doc_id long, score double")
    if total.n and total.words:
        mean, shards = total.words / total.n, total.shards
        for ids, ends, terms in _query_blocks(queries):
            wanted, place = np.unique(terms, return_inverse=True)
            df = _frequencies(index, wanted)
            weights = np.log1p((total.n - df + 0.5) / (df + 0.5))[place]
            shared = spark.sparkContext.broadcast((ids, ends, wanted, place.astype(np.int32), weights))

            def run(batches, shared=shared, mean=mean) -> Iterator[pa.RecordBatch]:
                ids, ends, wanted, place, weights = shared.value
                top = np.zeros((len(ids), k))
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                for batch in batches:
                    for row in batch.to_pylist():
                        shard = Shard(row, mean, wanted)
                        for a in range(0, len(ids), QUERIES_AT_ONCE):
                            b = min(len(ids), a + QUERIES_AT_ONCE)
                            mine = slice(ends[a], ends[b])
                            query, position, score = shard.answers(ends[a : b + 1] - ends[a], place[mine], weights[mine], k, top[a:b])
                            held = tuple(np.concatenate(c) for c in zip(held, (query + a, shard.docs[position], score), strict=True))
                        held = best_of(*held, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[held[0]].astype(np.int64)), pa.array(held[1]), pa.array(held[2])], names=["query_id", "doc_id", "score"])

            columns = index.select("docs", "lengths", "terms", "at", "doc", "tf").coalesce(max(1, -(-shards // SHARDS_OF_TASK)))
            with batch_rows(spark, 1):
                answers = answers.unionByName(written(columns.mapInArrow(run, "query_id long, doc_id long, score double"), "answers"))
            shared.unpersist()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def search_digest(documents: DataFrame) -> DataFrame:
    """Every hundredth document, by id, as a query against all documents."""
    return search(documents, documents.where(F.col("doc_id") % 100 == 0).select("doc_id", "text"))


#: The registered query in SQL: every pair of a query and a document that share a term.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), []) AS words FROM documents WHERE doc_id IS NOT NULL),
stats AS (SELECT count(*) AS n, sum(len(words)) / CAST(count(*) AS DOUBLE) AS mean FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scores AS (
  SELECT q.doc_id AS query_id, x.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * x.tf * 2.2 / (x.tf + 1.2 * (0.25 + 0.75 * len(d.words) / mean))), 9) AS score
  FROM tf q JOIN tf x ON q.term = x.term JOIN df ON df.term = x.term JOIN d ON d.doc_id = x.doc_id CROSS JOIN stats WHERE q.doc_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 10
"""
