"""Toxicity, quality, SentencePiece, packing, sharding, search and SimHash: rules, brute force and odd tables."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm import alike, packing, pieces, quality, queries, search, shards, simhash, toxicity
from paperloom.llm.components import connected_components

SF = "/root/testdata/sf0.001"
LONG = "the and of " * 30_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, toxicity string, fp string, key string, component string, __text string, shard int, size int, score double, ids string"
ODD = [
    (1, "Some plain words, an idiot among them."), (2, None), (3, ""), (4, LONG), (5, "Same text here."), (6, "Same text here."), (6, "Same text here."), (7, "é ß 日本 \U0001f600 ▁ <|endoftext|>"),
    (8, " \n\t "), (None, "No id."), (9, "Don't  stop\x1cnow\x85ok İ ſ ŒÀ"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, None, None, "x", "y", "z", "c", "t", 1, 2, 0.5, "i") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k == 1)) for k in range(1, 9)], "doc_id long, quality int, toxic int")


# Toxicity


def lexicon():
    return toxicity.Lexicon({w: 1.0 for w in toxicity.SEED_WORDS}, {"lowei": 0.9})


@pytest.mark.parametrize(
    ("text", "hits"),
    [
        ("you idiot", 1), ("IDIOT!!", 1), ("іdіоt", 1), ("1d10t 1diot", 2), ("ｉｄｉｏｔ", 1), ("lo5er 10ser", 2), ("scum$$$ $cum", 2), ("idiotic idiots", 0), ("the trash can", 0), ("trash in the trash can", 1),
        ("loweischaft loweix alowei", 2), ("pathway worthy", 0), ("id​iot", 1), ("", 0), (None, 0),
    ],
)
def test_lexicon_hits(text, hits):
    assert toxicity.density(text, lexicon().automaton())[1] == hits


def test_folding_leaves_plain_text_alone():
    assert toxicity.fold("Costs $5 in 2024, at 3! C++ and 10%") == "costs $5 in 2024, at 3! c++ and 10%"


def test_learns_words_and_stems_and_not_held_out_rows(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choices(["ba", "do", "ki", "lu"], k=3))
    rows, marks = [], []
    for k in range(400):
        text = [word() for _ in range(30)]
        if k % 4 == 0:
            text[r.randrange(30)] = r.choice(["grob", "zukk" + word()])
        if zlib.crc32(str(k).encode()) % 5 == 0:
            text.append("secret")
        rows.append((k, " ".join(text)))
        marks.append((k, 0, int(k % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    learnt = toxicity.fitted(docs, marks)
    assert "grob" in learnt.words and any(s.startswith("zukk"[:4]) for s in learnt.stems) and "secret" not in learnt.words
    out = toxicity.toxicity_digest(docs, marks).join(marks, "doc_id").collect()
    assert all(x.predicted == x.toxic and (x.score >= 0.5) == x.predicted for x in out)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out)


def plain_hits(folded, lexicon):
    """Spans of the lexicon's forms, looked for one by one at every place."""
    forms = {}
    for kind, entries in (("word", lexicon.words), ("stem", lexicon.stems)):
        for w, weight in entries.items():
            for form in {toxicity.fold(w), toxicity.fold(w).replace("l", "i")}:
                forms.setdefault(form, (kind, weight))
    for phrase in lexicon.exceptions:
        forms[toxicity.fold(phrase)] = ("exception", 0.0)
    found, safe = [], []
    for at in range(len(folded)):
        if at and folded[at - 1].isalpha():
            continue
        for form, (kind, weight) in forms.items():
            end = at + len(form)
            if folded.startswith(form, at) and (kind == "stem" or end >= len(folded) or not folded[end].isalpha()):
                (safe if kind == "exception" else found).append((at, end, weight))
    best = {}
    for at, end, weight in found:
        best[at] = max(best.get(at, (-1.0, 0)), (weight, end))
    return sorted((at, end, w) for at, (w, end) in best.items() if not any(a <= at and end <= b for a, b, _ in safe))


def test_toxic_hits_equal_a_naive_matcher(spark):
    r, lex = random.Random(4), lexicon()
    parts = [*toxicity.SEED_WORDS, *toxicity.EXCEPTIONS, "loweix", "lowei", "trash", "can", "1d10t", "$cum", "a", "и", "idi", "ot", "-", " ", " ", ".", "2", "Clown", "fish"]
    texts = ["".join(r.choices(parts, k=r.randint(1, 25))) for _ in range(400)] + ["x" + "idiot" * 3, "trash can trash", "sore loser loser"]
    machine = lex.automaton()
    for text in texts:
        folded = toxicity.fold(text)
        assert list(toxicity.hits(folded, machine)) == plain_hits(folded, lex)
    docs = spark.createDataFrame([(k, t, "keep") for k, t in enumerate(texts)], "doc_id long, text string, note string")
    for x in toxicity.score_toxicity(docs, lex).collect():
        spans = plain_hits(toxicity.fold(texts[x.doc_id]), lex)
        d = sum(w for *_, w in spans) / max(1, len(texts[x.doc_id].split()))
        assert x.toxic_hits == len(spans) and x.toxicity == pytest.approx(d / (d + lex.limit)) and x.note == "keep"


def test_toxicity_of_very_long_texts_takes_linear_time():
    import time

    machine, began = lexicon().automaton(), time.perf_counter()
    assert toxicity.density("a" * 1_000_000 + " $", machine) == (0.0, 0) and toxicity.density("trash can " * 100_000, machine) == (0.0, 0)
    assert time.perf_counter() - began < 10


# Quality


def test_quality_scores_equal_plain_sums(spark):
    net, r = quality.Network.fresh(), random.Random(3)
    texts = [None, "", "a", "some words here", "é" * 50, *("".join(r.choices("abc xyz.", k=r.randint(1, 900))) for _ in range(30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for x in quality.score_quality(docs, net).collect():
        raw = (texts[x.doc_id] or "").encode()
        chunks = [raw[k : k + quality.WIDTH].ljust(quality.WIDTH, b"\0") for k in range(0, max(1, len(raw)), quality.STRIDE)]
        best = np.max([sum(net.embed[c[w]].astype(float) @ net.filters[w] for w in range(quality.WIDTH)) for c in chunks], axis=0)
        want = 1 / (1 + math.exp(-(np.maximum(best + net.bias, 0) @ net.out + net.prior)))
        assert x.quality_score == pytest.approx(want, abs=1e-4)


def test_pooling_in_pieces_is_that_of_whole_texts(monkeypatch):
    net, r = quality.Network.fresh(), np.random.default_rng(0)
    texts = [r.integers(1, 255, n).astype(np.uint8) for n in (0, 1, 3, 4, 5, 8, 100, 5000, 64, 63)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = quality.pooled(net, np.concatenate(texts), ends)
    monkeypatch.setattr(quality, "PIECE", 64)
    assert np.allclose(quality.pooled(net, np.concatenate(texts), ends), whole, atol=1e-5)
    for t, row in zip(texts, whole, strict=True):  # window by window
        n = max(1, -(-len(t) // quality.STRIDE))
        padded = np.zeros(n * quality.STRIDE + quality.WIDTH, np.uint8)
        padded[: len(t)] = t
        windows = np.stack([padded[k * quality.STRIDE : k * quality.STRIDE + quality.WIDTH] for k in range(n)])
        assert np.allclose(np.einsum("nwd,wdf->nf", net.embed[windows], net.filters).max(0), row, atol=1e-4)


def test_quality_on_held_out_rows(spark):
    docs, marks = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.quality_digest(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert sum(x.predicted == x.quality for x in out) >= 0.93 * len(out) and len(out) > 50


def test_one_class_gives_its_share():
    assert quality.fit([("a", 1), ("b", 1)]).constant == 1.0 and quality.fit([]).constant == 0.5


# SentencePiece


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model")))


def test_best_segmentation_and_round_trip(codec):
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    scores = {p: s for p, s in zip(vocabulary.pieces, vocabulary.scores, strict=True) if p}
    longest, inverse = max(map(len, scores)), {i: p for i, p in enumerate(vocabulary.pieces) if p}

    def best(text):
        top = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - longest), end):
                if text[start:end] in scores:
                    top[end] = max(top[end], top[start] + scores[text[start:end]])
            if text[end - 1] not in codec.single:
                top[end] = max(top[end], top[end - 1] + codec.unknown)
        return top[-1]

    r = random.Random(2)
    for _ in range(150):
        text = "".join(r.choices(["the", "and", " ", "  ", "\n", "é", "x", "日", "\U0001f600", "ing", "."], k=r.randint(1, 12)))
        ids = np.frombuffer(codec.encode(text), np.int32)
        assert codec.decode(ids) == text
        total, at, marked = 0.0, 0, "▁" + text.replace(" ", "▁")
        ids = ids.tolist()
        while ids:
            i = ids.pop(0)
            if i in inverse:
                total, at = total + scores[inverse[i]], at + len(inverse[i])
            else:
                total, at = total + codec.unknown, at + 1
                del ids[: len(marked[at - 1].encode()) - 1]
        assert total == pytest.approx(best(marked), abs=1e-3)


def test_blank_signs_and_odd_texts_round_trip(codec):
    for text in ("", " ", "▁", "▁ ▁▁", "a\n\n b", "\n", LONG, "  \x00"):
        assert codec.decode(np.frombuffer(codec.encode(text), np.int32)) == text


def test_pieces_query(spark):
    out = queries.op2_sentencepiece(spark, SF)
    assert out.where("not round_trip").isEmpty() and out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    back = pieces.decode_pieces(out.limit(5), public_tokenizers.path("piece_bpe_32k.model")).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("was")), "doc_id")
    assert back.where("text <> was").isEmpty()


# Packing


def packed_rows(rows):
    whole = collections.defaultdict(list)
    for r in rows:
        whole[r.sequence_id].append((r.offset, r.length))
    for parts in whole.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    return whole


def test_packing_is_whole_and_tight(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(11)
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    whole = packed_rows(rows)
    assert len(whole) <= math.ceil(sum(r.length for r in rows) / packing.SEQUENCE) + 2
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for d in docs.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(d.text, add_special_tokens=False).ids, 0], "<u4")
        assert sorted(by[d.doc_id]) == [(k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]


def test_fast_and_plain_tokens_agree():
    from paperloom.llm.tokens import Encoder

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        encoder = Encoder(f.read())
    assert encoder.words is not None
    tokenizer, r = Tokenizer.from_file(path), random.Random(5)
    signs = [chr(c) for c in [*range(33, 127), *range(161, 256)]] + [" ", "\n", "\t", "'s", "'LL", "don't", "²³", "ª", "ABC"]
    for text in ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(1500)] + [t for _, t in ODD if t]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, capacity):
    """Longest first, each into the fullest bin that has room."""
    fills = []
    for size in sorted(lengths, reverse=True):
        rooms = [(capacity - f, b) for b, f in enumerate(fills) if f + size <= capacity]
        if rooms:
            fills[min(rooms)[1]] += size
        else:
            fills.append(size)
    return sorted(fills)


def test_best_fit_equals_plain_best_fit(spark):
    r = random.Random(6)
    for capacity in (10, 100):
        lengths = np.array([r.randint(1, capacity) for _ in range(500)])
        where, offset, fills = packing.best_fit(lengths, capacity)
        assert sorted(fills.tolist()) == plain_best_fit(lengths.tolist(), capacity)
        for b in range(len(fills)):
            mine = np.flatnonzero(where == b)
            order = mine[np.argsort(offset[mine])]
            assert (offset[order] == np.concatenate([[0], np.cumsum(lengths[order])[:-1]])).all()
    # texts of a little over half a sequence: nothing merges, and no bin is lost between partitions
    docs = spark.createDataFrame([(k, "a " * (1100 + k)) for k in range(60)], "doc_id long, text string").repartition(20)
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert len(rows) == 60 and len(packed_rows(rows)) == 60


def test_sequences_are_as_few_as_plain_best_fit_has(spark):
    # no bin of a partition is nearly full by itself, so all pieces meet, and the result is that of one best fit over all
    r = random.Random(8)
    texts = [(k, "a " * r.choice([300, 500, 700, 900, 1100, 1300])) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(40)
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    whole = packed_rows(rows)
    want = plain_best_fit([len(t.split()) + 1 for _, t in texts], packing.SEQUENCE)
    assert abs(len(whole) - len(want)) <= 1 and sum(size for parts in whole.values() for _, size in parts) == sum(want)


def test_all_underfull_bins_meet(spark):
    # one partition has long texts only, the other short ones only, and each has far more bins than a window's share
    texts = [(k, "a " * (1050 + k % 150)) for k in range(5500)] + [(k, "a " * (800 + k % 40)) for k in range(5500, 11_000)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(texts, 2), "doc_id long, text string")
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert len(rows) == 11_000 and len({r.doc_id for r in rows}) == 11_000 and len(packed_rows(rows)) == 5500


def test_best_fit_by_counts_is_best_fit():
    r = random.Random(7)
    for capacity, n in [(1, 3), (10, 40), (100, 500), (2048, 3000)]:
        lengths = [r.randint(1, capacity) if r.random() < 0.7 else max(1, capacity // 3) for _ in range(n)]
        whole = collections.defaultdict(list)
        for size, a, b, first, each, offset in packing.best_fit_counts(collections.Counter(lengths), capacity).tolist():
            for k in range(b - a):
                whole[first + k // each].append((offset + k % each * size, size))
        assert sorted(size for parts in whole.values() for _, size in parts) == sorted(lengths)
        for parts in whole.values():
            parts.sort()
            assert [at for at, _ in parts] == [0, *np.cumsum([size for _, size in parts])[:-1].tolist()] and sum(size for _, size in parts) <= capacity
        fills = packing.best_fit(np.array(lengths), capacity)[2]
        assert sorted(sum(size for _, size in parts) for parts in whole.values()) == sorted(fills.tolist())


# Sharding


def test_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shards.shard_documents(docs, 7).collect()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    sizes, slots, groups = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) < 1.03 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())


def plain_shards(rows, n, keep):
    """shard of every doc_id of rows(doc_id, text, lang, source), by whole sorts instead of histograms."""
    digest = lambda x: xxhash.xxh64_intdigest(x, 42)
    place = lambda v: 0 if v is None else digest(v.encode()) >> 44
    size, points = {}, []
    texts = collections.defaultdict(list)
    for d, t, lang, source in rows:
        size[d] = len(t.encode()) + 16
        texts[t].append((d, place(source), place(lang)))
    leaf = sum(size.values()) / n
    out, fills, heavy = {}, [[0, s] for s in range(n)], []
    for t, held in texts.items():
        total, dig = sum(size[d] for d, *_ in held), digest(t.encode())
        if total > keep * leaf and (len(held) == 1 or total <= leaf):
            heavy.append((-total, dig - (1 << 64) if dig >> 63 else dig, held))
            continue
        chars = math.floor(math.log2(len(t) + 1) / 32 * ((1 << 20) - 1))
        axes = (chars, min(p for _, p, _ in held), min(p for *_, p in held))
        for d, *_ in held:
            row = digest(d.to_bytes(8, "little")) & ((1 << 22) - 1)
            points.append((d, size[d], axes, ((dig >> 44) << 22) + row, total > leaf))
    for total, _, held in sorted(heavy, key=lambda h: h[:2]):
        best = min(fills)
        best[0] -= total
        out.update({d: best[1] for d, *_ in held})
    left, level = sum(p[1] for p in points), 0.0
    for k, (fill, _) in enumerate(sorted(fills), 1):
        if k > 1 and fill >= level:
            break
        left += fill
        level = left / k
    room = [max(0.0, level - fill) for fill, _ in fills]
    widths = [max(1, max(p[2][k] for p in points) - min(p[2][k] for p in points)) for k in range(3)]

    def grow(mine, first, room):
        if len(room) == 1:
            out.update({p[0]: first for p in mine})
            return
        half, cut, axis = len(room) // 2, 0, 0
        if mine:
            spread = [(max(p[2][k] for p in mine) - min(p[2][k] for p in mine)) / widths[k] for k in range(3)]
            axis = spread.index(max(spread))
            want = sum(p[1] for p in mine) * min(1.0, sum(room[:half]) / sum(room) if sum(room) else half / len(room))
            cut = cut_of(mine, axis, want)
        low = [p for p in mine if (p[2][axis] << 42) + p[3] < cut]
        high = [p for p in mine if (p[2][axis] << 42) + p[3] >= cut]
        grow(low, first, room[:half])
        grow(high, first + half, room[half:])

    def cut_of(mine, axis, want):
        for bits in (22, 0):
            cells, loose = collections.Counter(), set()
            for p in mine:
                cells[((p[2][axis] << 42) + p[3]) >> bits] += p[1]
                if p[4]:
                    loose.add(((p[2][axis] << 42) + p[3]) >> bits)
            before = 0
            for cell in sorted(cells):
                if before + cells[cell] >= want:
                    break
                before += cells[cell]
            if cell not in loose or bits == 0:
                return (cell + (want - before > cells[cell] / 2)) << bits

    grow(points, 0, room)
    return out


@pytest.mark.parametrize(("n", "keep"), [(7, 0.05), (40, 0.3)])
def test_shards_equal_whole_sorts(spark, n, keep):
    r = random.Random(n)
    rows = []
    for k in range(600):
        text = r.choice(["one text that many share", f"text {k} " * r.randint(1, 60), "x" * r.randint(1, 3000)])
        rows.append((k, text, r.choice(["en", "de", None]), r.choice(["web", "web", "web", f"s{k % 20}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    got = {x.doc_id: x.shard for x in shards.shard_documents(docs, n, keep, close=0.0).collect()}
    assert got == plain_shards(rows, n, keep)


def test_only_groups_over_a_shard_are_parted(spark):
    # a group of 0.9 of a shard stays whole, one of three shards is parted
    rows = [(k, "copy of one text") for k in range(300)] + [(k, "b" * 84) for k in range(300, 327)] + [(k, f"text {k} " * 10) for k in range(327, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, groups = collections.Counter(), collections.defaultdict(set)
    for x in shards.shard_documents(docs, 10).collect():
        sizes[x.shard] += x.size
        groups[rows[x.doc_id][1]].add(x.shard)
    assert len(sizes) == 10 and max(sizes.values()) < 1.1 * min(sizes.values())
    assert len(groups["b" * 84]) == 1 and len(groups["copy of one text"]) > 2


# Search


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(search, "SHARD", 64)
        monkeypatch.setattr(search, "BLOCK", 8)
        monkeypatch.setattr(search, "DENSE", 20)
        monkeypatch.setattr(search, "QUERIES_AT_ONCE", 1)
        monkeypatch.setattr(search, "BLOCK_TERMS", 300)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    words = {r.doc_id: collections.Counter(re.findall(r"[^\W_]+", r.text.lower())) for r in docs.collect()}
    df, n = collections.Counter(w for c in words.values() for w in c), len(words)
    mean = sum(sum(c.values()) for c in words.values()) / n
    got = collections.defaultdict(list)
    for r in search.search(docs, docs.where("doc_id % 20 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, round(r.score, 6)))
    for q in (q for q in words if q % 20 == 0):
        scores = {d: sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in words[q] if w in c) for d, c in words.items()}
        want = sorted((-round(s, 7), d) for d, s in scores.items() if s > 0)[:5]
        assert [d for _, d in want] == [d for d, _ in got[q]] and all(abs(-s - t) < 1e-5 for (s, _), (_, t) in zip(want, got[q], strict=True))


# SimHash


def plain_print(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not parts:
        return 0
    shingles = [" ".join(parts[k : k + words]) for k in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", " \t", "One", "one TWO", "a b c", "a b c d", "É b\x0bc\x1cd e", "x y z " * 50]:
        assert simhash.fingerprint(None if text is None else text.encode(), 3) == plain_print(text, 3)


@pytest.mark.parametrize(("most", "bucket"), [(2, 4096), (2, 16), (6, 4096), (6, 64)])
def test_links_equal_brute_force(spark, most, bucket):
    r = random.Random(most * bucket)
    prints = set()
    for _ in range(12):
        base = r.getrandbits(64)
        for _ in range(25):
            prints.add(base ^ sum({1 << r.randrange(64) for _ in range(r.randint(0, most + 3))}))
    prints = sorted(prints)
    a = np.array(prints, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= most
    label = np.arange(len(a))
    while (new := np.where(near, label[None, :], len(a)).min(1)).tolist() != label.tolist():
        label = new
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(df, most, bucket)
    number = {int(x): k for k, x in enumerate(a.view(np.int64))}
    pairs = [(number[r.a], number[r.b]) for r in links.collect()]
    assert all(near[i, j] for i, j in pairs)
    found = {r.id: r.component for r in connected_components(spark.createDataFrame([*pairs, (0, 0)], "a long, b long")).collect()}
    assert [found.get(k, k) for k in range(len(a))] == label.tolist()


def test_components(spark):
    r = random.Random(9)
    path = list(range(300))
    r.shuffle(path)
    links = list(zip(path, path[1:], strict=False)) + [(1000, k) for k in range(1001, 1100)] + [(2000, 2000), (2001, None), (3, 3)]
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(300)} | {k: 1000 for k in range(1000, 1100)} | {2000: 2000}


# Similar sets


def plain_set(text, words=5):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))}


def edited(r, count):
    """Texts of which many are near the limit: copies of some bases with a few words replaced, and a passage that most share."""
    vocabulary, passage = [f"w{k}" for k in range(3000)], " ".join(f"p{k}" for k in range(30))
    texts = ["", None, " ", "One", "one", "two words"]
    for _ in range(count):
        base = r.choices(vocabulary, k=r.choice([8, 60, 300]))
        for _ in range(12):
            copy = base[:]
            for _ in range(r.randint(0, max(1, len(base) // 30))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(" ".join(copy) + (" " + passage if r.random() < 0.6 else ""))
    return texts


@pytest.mark.parametrize("sampled", [2, 16])
def test_no_similar_pair_is_missed(spark, sampled):
    texts = edited(random.Random(11), 25)
    sets = [plain_set(t) for t in texts]
    label = list(range(len(texts)))
    near = [[j for j in range(len(texts)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(texts))]
    while (new := [min(label[j] for j in near[i]) for i in range(len(texts))]) != label:
        label = new
    far = [(i, j) for i in range(len(texts)) for j in near[i] if (simhash.fingerprint((texts[i] or "").encode(), 5) ^ simhash.fingerprint((texts[j] or "").encode(), 5)).bit_count() > 6]
    assert len(far) > 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows, classes = alike.near_duplicates(docs, 5, sampled=sampled)
    found = collections.defaultdict(set)
    for r in rows.join(classes, "fp").collect():
        found[r.component].add(r.doc_id)
    want = collections.defaultdict(set)
    for k, c in enumerate(label):
        want[c].add(k)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    assert sorted(r.doc_id for r in alike.one_of_each(docs, 5).collect()) == sorted(set(label))


@pytest.mark.parametrize("spread", [1 << 64, 1 << 30])
def test_similar_sets_share_a_key(spread):
    # pairs at the limit; hashes of a narrow range fall into one part, so that there are fewer keys than parts to differ in
    r = np.random.default_rng(3)
    for _ in range(2000):
        a = np.unique(r.integers(0, spread, int(np.exp(r.uniform(np.log(4), np.log(900)))), dtype=np.uint64))
        kept = a[r.permutation(len(a))[r.integers(0, len(a) // 5 + 1) :]]
        more = (9 * len(kept) - 4 * len(a)) // 4 - len(kept)
        b = np.unique(np.concatenate([kept, r.integers(0, spread, max(0, more), dtype=np.uint64)]))
        if 9 * len(np.intersect1d(a, b)) < 4 * (len(a) + len(b)) or np.array_equal(a, b):
            continue
        keys = [alike.set_keys(x, x % np.uint64(3) == 0)[0] for x in (a, b)]
        assert len(np.intersect1d(*keys))
        places = int(np.bitwise_count((alike.sketch(a) ^ alike.sketch(b)).view(np.uint64)).sum())
        assert places <= len(np.setxor1d(a, b)) and 9 * places <= len(a) + len(b)


def test_what_simhash_links_is_not_compared_again(spark, monkeypatch):
    import corpus_pipeline as C

    compared, plain = [], alike._compared

    def counted(pairs, sets):
        compared.append({(min(p), max(p)) for p in pairs.collect()})
        return plain(pairs, sets)

    monkeypatch.setattr(alike, "_compared", counted)
    base = " ".join(f"w{k}" for k in range(2000))
    docs = spark.createDataFrame([(k, f"{base} x{k}") for k in range(6)] + [(9, "another text of a few words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in C.drop_near_duplicates(spark, docs, SF).collect()) == [0, 9]
    # the six texts hang together by pairs of the SimHash step, and no pair is left for the join of sets
    assert len(compared) == 3 and len(compared[0]) == 5 and not compared[1] and not compared[2]


def test_sets_that_share_many_keys_are_one_pair(spark):
    rows = [(k, row, size, (1, 100), (9, size_of_9)) for k in range(50) for row, size, size_of_9 in ((1, 100, 110), (9, 110, 110), (5, 200, 110))]
    met = spark.createDataFrame(rows, "key long, row long, size int, low struct<row: long, size: int>, high struct<row: long, size: int>")
    assert [tuple(r) for r in alike._ends(met).collect()] == [(1, 9)]
    none = spark.createDataFrame([], "row long, component long")
    assert alike._unlinked(alike._ends(met), none).count() == 1
    assert alike._unlinked(alike._ends(met), spark.createDataFrame([(1, 0), (9, 0)], none.schema)).count() == 0
    assert alike._unlinked(alike._ends(met), spark.createDataFrame([(9, 5), (5, 5)], none.schema)).count() == 1


def test_near_duplicates_give_the_heap_back(spark):
    def collections_so_far():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    docs = spark.createDataFrame([(k, f"some words of text number {k % 3}") for k in range(9)], "doc_id long, text string")
    before = collections_so_far()
    assert sorted(r.doc_id for r in alike.one_of_each(docs).collect()) == [0, 1, 2]
    assert collections_so_far() >= before + 6


def test_similar_sets_of_one_large_group(spark):
    # every copy differs from every other, and all share nearly all hashes, which are then the frequent ones
    r = random.Random(12)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(600):
        copy = base[:]
        copy[r.randrange(120)] = f"x{k}"
        texts.append(" ".join(copy))
    texts += [" ".join(base[:70] + [f"y{k}-{j}" for j in range(50)]) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    kept = sorted(x.doc_id for x in alike.one_of_each(docs, 5).collect())
    assert kept == [0, *range(600, 640)]


def test_rows_with_one_id_go_by_their_own_text(spark):
    import corpus_pipeline as C

    one, two, three = ("a b c d e f g", "h i j k l m n", "o p q r s t u")
    rows = [(1, one), (2, one), (2, two), (2, two), (None, one), (None, three), (None, three), (3, "v w x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for kept in (C.drop_near_duplicates(spark, docs, SF), simhash.one_of_each(docs)):
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, one), (2, two), (3, "v w x y z"), (None, three)], key=str)


def test_a_hot_bucket_becomes_one_component(spark):
    # two clusters in one bucket, of which a few links alone connect some stragglers
    r, near = random.Random(2), 0x0123456789ABCDEF
    prints = {near ^ sum({1 << r.randrange(64) for _ in range(r.randint(0, 2))}) for _ in range(900)}
    prints |= {near ^ (0xFFFF << 40) ^ (1 << k) for k in range(30)} | {near ^ (0xFF << 50)}
    a = np.array(sorted(prints), np.uint64)
    label = np.arange(len(a))
    close = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    while (new := np.where(close, label[None, :], len(a)).min(1)).tolist() != label.tolist():
        label = new
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    found = {x.id: x.component for x in connected_components(simhash.fingerprint_links(df, 2, bucket=32)).collect()}
    got = collections.defaultdict(set)
    for x in a.view(np.int64).tolist():
        got[found.get(x, x)].add(x)
    want = collections.defaultdict(set)
    for x, c in zip(a.view(np.int64).tolist(), label.tolist(), strict=True):
        want[c].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


# Odd tables


HIDDEN = ("score", "hits", "_score", "__quality", "__toxicity", "__toxic_hits", "__text", "__html", "bucket", "bit", "bits", "__bucket", "__bit", "whole")


def test_hidden_names_are_not_taken(spark, labels):
    rows = [(k, f"some words number {k} of a text", *(f"{c}{k}" for c in HIDDEN)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in HIDDEN))
    want = {r[0]: r[1:] for r in rows}
    for out in (toxicity.drop_toxic(docs, labels), quality.keep_good(docs, labels), simhash.one_of_each(docs), alike.one_of_each(docs)):
        assert out.columns == docs.columns and all(tuple(r)[1:] == want[r.doc_id] for r in out.collect())
    with_prints = simhash.with_fingerprints(docs, 3)
    assert with_prints.columns == [*docs.columns, "fingerprint"] and all(tuple(r)[1:-1] == want[r.doc_id] for r in with_prints.collect())


def test_rows_without_an_id_still_link(spark):
    # a and c differ in two bits or fewer from the row without an id, and not from each other
    found = simhash.near_duplicates(spark.createDataFrame([(5, "a b c"), (None, "a b c"), (None, "x y z"), (9, None)], "doc_id long, text string"), 3, 2).collect()
    assert sorted(((r.doc_id, r.component) for r in found), key=str) == sorted([(5, 5), (None, 5), (None, None), (9, 9)], key=str)


def test_odd_rows(spark, odd, labels):
    n = len(ODD)
    model = public_tokenizers.path("piece_bpe_32k.model")
    assert toxicity.score_toxicity(odd, lexicon()).columns[-2:] == ["toxicity", "toxic_hits"]
    scores = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(odd, lexicon()).collect()}
    assert scores[2] == scores[3] == scores[8] == 0 and scores[1] >= 0.5
    assert toxicity.toxicity_digest(odd, labels).count() == n and quality.quality_digest(odd, labels).count() == n
    kept = toxicity.drop_toxic(odd, labels)
    assert kept.columns == odd.columns and {r.doc_id for r in odd.collect()} - {r.doc_id for r in kept.collect()} == {1}
    assert quality.score_quality(odd, quality.Network.fresh(), into="score").columns.count("score") == 1
    assert pieces.encode_pieces(odd, model, check="ok").where("not ok").isEmpty() and pieces.piece_digest(odd, model).count() == n
    placed = shards.shard_documents(odd, 3).collect()
    assert len(placed) == n and {r.text_crc32 for r in placed if r.doc_id in (2, 3)} == {0}
    found = {}
    for r in simhash.near_duplicates(odd, 3, 2).collect():
        found.setdefault(r.doc_id, r.component)
    assert found[3] == found[8] == found[2] == 2 and found[5] == found[6] == 5
    alone = [r.doc_id for r in simhash.one_of_each(odd).collect()]
    assert sorted(alone, key=str) == sorted([1, 2, 4, 5, 7, 9, None], key=str)
    packed_rows(packing.pack_documents(odd, public_tokenizers.path("word_bpe_49k.json"), with_ids=True).collect())
    answers = search.search(odd, odd.where("doc_id in (2, 3, 5, 8)"), 3).collect()
    assert [(r.query_id, r.rank, r.doc_id) for r in sorted(answers, key=lambda r: (r.query_id, r.rank))] == [(5, 1, 5), (5, 2, 6), (5, 3, 6)]


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_digest(none, labels).count() == 0 and quality.quality_digest(none, labels).count() == 0
    assert toxicity.drop_toxic(none, labels).count() == 0 and quality.keep_good(none, labels).count() == 0
    assert pieces.piece_digest(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert shards.shard_documents(none, 4).count() == 0 and simhash.simhash_digest(none).count() == 0
    assert simhash.one_of_each(none).count() == 0 and search.search_digest(none).count() == 0
