"""Embeddings, URL rules, page texts and the pipeline: rules, brute force and odd tables."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import dom, pages, queries, urls, vectors

SF = "/root/testdata/sf0.001"


# Embeddings


def brute(ids, rows, cosine):
    """(links, component) of every id."""
    x = np.array(rows, float)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= cosine
    label = np.arange(len(ids))
    while (new := np.where(near, label[None, :], len(ids)).min(1)).tolist() != label.tolist():
        label = new
    return {i: (int(n) - 1, ids[k]) for i, n, k in zip(ids, near.sum(1), label, strict=True)}


def groups(n, size, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n // 8, size))
    rows = centres[r.integers(len(centres), size=n)] + r.normal(size=(n, size)) * r.choice([0.001, 0.1, 0.35], size=(n, 1))
    return rows.astype("f4").astype(float).tolist()


@pytest.mark.parametrize(("span", "leaf", "kind", "size"), [(4096, 256, "float", 16), (64, 8, "float", 16), (64, 8, "double", 3), (50, 16, "float", 1)])
def test_links_equal_brute_force(spark, span, leaf, kind, size):
    rows = groups(700, size, span)
    df = spark.createDataFrame(list(enumerate(rows)), f"vec_id long, embedding array<{kind}>").repartition(7)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df, grid=vectors.Grid(span, 3, leaf)).collect()}
    assert got == brute(list(range(700)), rows, 0.95)


def test_hot_vectors(spark):
    rows = [[1.0, 0.0, 0.001 * (k % 5)] for k in range(600)] + groups(100, 3, 1)
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    want = brute(list(range(700)), np.array(rows, "f4").astype(float), 0.95)
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df, grid=vectors.Grid(32, 2, 8)).collect()} == want


def test_intervals_are_not_copied_for_each_pair(spark):
    n = 36
    blocks = spark.createDataFrame([(k, b"k", b"v") for k in range(n)], "id long, keys binary, rows binary")
    pairs = [(a, b) for a in range(n) for b in range(a, n)]
    rows = vectors._tiles(blocks, spark.createDataFrame(pairs, "a long, b long"), n // vectors.TILES).collect()
    assert sorted((r.a, r.b) for r in rows if r.b is not None) == pairs
    assert sum(r.rows is not None for r in rows) == n * vectors.TILES


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (8, [1.0, 0.0, 0.0]), (9, [1e-200, 0.0]), (10, [1e200, 1e190]), (None, [1.0, 0.0]), (11, [None, 1.0])]
    df = spark.createDataFrame([(*r, "l", 1) for r in rows], "vec_id long, embedding array<double>, component string, n int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect() if r.vec_id is not None}
    linked = {1, 2, 9, 10}
    assert got == {k: (3, 1, k == 1) if k in linked else (0, k, True) for k in range(1, 12)}
    assert vectors.near_vectors(df.limit(0)).count() == 0


# URLs


def test_urls_equal_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = [tuple(r) for r in queries.op8_url_filters(spark, SF).select("page_id", "host", "path", "rule", "verdict").orderBy("page_id").collect()]
    assert got == duck.sql(f"SELECT page_id, host, path, rule, verdict FROM ({urls.ORACLE}) ORDER BY page_id").fetchall()


def test_nested_rules_and_odd_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("example.com", "/", "block"), ("a.b.example.com", "/x", "allow"), ("com", "/en/deep/path/", "allow")]
    r, hosts = random.Random(3), ["com", "example.com", "www.example.com", "x.www.example.com", "notexample.com", "example.com.net", "a.b.example.com", "EXAMPLE.com", "net", "b.net", "", "example.community", "example.com."]
    rows = [(k, f"http://{r.choice(hosts)}{r.choice(['', '/', '/en/', '/en/deep/path/1', '/es/a', '/x', '?q=/en/'])}{r.choice(['', '#t', '?a://b'])}") for k in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "no scheme"), (1003, "a://b://c/d"), (1004, "x://"), (1004, "x://"), (1005, "http://example.com\n/en/"), (None, "http://example.com/en/"), (1006, "http://" + "a." * 3000 + "com/")]
    df = spark.createDataFrame([(*row, "h", "p") for row in rows], "page_id long, url string, host string, path string")

    def plain(url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h, p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: f[0], default=None)
        return host, path, best and best[1] + best[2], best[3] if best else "allow"

    want = sorted((str(k), *map(str, plain(u))) for k, u in rows)
    for ranges in (1, 5, 40):
        got = urls.judge_urls(df, urls.rule_table(spark, rules), ranges=ranges)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(tuple(map(str, r)) for r in got.collect()) == want
    assert urls.url_digest(df.limit(0)).count() == 0
    assert urls.judge_urls(df, urls.rule_table(spark, rules).limit(0)).where("rule is not null").count() == 0


# Pages


def texts(html):
    return [b.text for b in dom.blocks(html)]


def test_blocks():
    assert texts("<p>a<p>b <b>c\n d</b><br>e</p>f") == ["a", "b c d e", "f"]
    assert texts('<script>var t="</p>";<p></script><style>p{}</style><!-- <p>x</p> --><p title="a>b">&lt;x&gt;&nbsp;&amp;amp;</p>') == ["<x> &amp;"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("a < b <p>c <p") == ["a < b", "c"] and texts(None) == texts("") == texts("<p> </p>") == []
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"] and texts("<script>x") == []
    (one,) = dom.blocks('<article class="big postBody"><p><a href=x>link</a></article>')
    assert one.path == (("article", ("big", "post", "body")), ("p", ())) and one.linked == 4


def parsed_texts(page):
    """The text of a page by the standard parser, without white space."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        held, out = 0, ""

        def handle_starttag(self, tag, attrs):
            self.held += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.held -= tag in ("script", "style")

        def handle_data(self, data):
            self.out += "" if self.held else data

    reader = Reader(convert_charrefs=True)
    reader.feed(page)
    reader.close()
    return "".join(reader.out.split())


def test_no_text_is_lost_on_broken_pages():
    r = random.Random(8)
    parts = ["<p>", "</p>", "<div class=a'b>", "<p title=\"x>y\">", "</div>", "<b id='q'>", "</b>", "<a href=x\"y>", "</a>", "it's", "one", " two ", "&amp;", "&lt;b&gt;", "5 < 6 ", "<br>", "<ul><li>", "</ul>", "<noscript>", "</noscript>", "<math><mi>", "</math>", "<svg>", "</svg>", "<object>", "</object>", "<!-- c -->", "<script>var a='<p>';</script>", "<style>p{}</style>", "<td>", "<tr data-x='1' y>", "é"]
    for _ in range(600):
        page = "".join(r.choices(parts, k=r.randint(1, 30)))
        assert "".join("".join(texts(page)).split()) == parsed_texts(page), page


def test_blocks_of_broken_tags():
    assert texts("<article><p class=a'b>one</p><p>it's two</p><p>three</p></article>") == ["one", "it's two", "three"]
    assert texts("<p>a <math><mi>x</mi></math><svg><title>no</title><text>y</text></svg><object>o</object> <noscript>n</noscript><textarea>no</textarea></p>") == ["a xyo n"]
    assert texts("<title>open<p>read on") == ["open", "read on"] and texts("<style>open<p>not read") == [] and texts("a<!-->b<!-- c --!>d") == ["abd"]
    assert len(texts("<div>x" * 20_000)) == 20_000


def test_query_equals_field_by_field(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    field = pages.trained_field()
    want = {}
    for row in df.collect():
        found = list(dom.blocks(row.html))
        want[row.page_id] = "\n".join(b.text for b, s in zip(found, field.decode(found), strict=True) if s)
    assert {r.page_id: r.text for r in pages.page_digest(df).collect()} == want


def test_field_on_new_layouts():
    field, right, total = pages.trained_field(), 0, 0
    for page, states in pages.labelled_pages(150, seed=77):
        decoded = field.decode(page)
        right, total = right + sum(a == b for a, b in zip(decoded, states, strict=True)), total + len(states)
    assert right >= 0.99 * total


def test_viterbi_is_the_best_path():
    field, r = pages.trained_field(), random.Random(1)
    for page, _ in pages.labelled_pages(30, seed=5):
        page = page[: r.randint(1, 9)]
        if not page:
            continue
        emit = [[sum(field.weights.get(f, (0, 0))[y] for f in names) for y in (0, 1)] for names in pages.features(page)]
        tie = pages.ties(page)

        def score(states, emit=emit, tie=tie):
            return sum(e[s] for e, s in zip(emit, states, strict=True)) + sum(field.steps[t][a][b] for t, a, b in zip(tie, states, states[1:], strict=False))

        best = max(([n >> k & 1 for k in range(len(page))] for n in range(1 << len(page))), key=score)
        assert score(field.decode(page)) == pytest.approx(score(best))


PAGE = """<html><head><title>T</title></head><body><header><div class=logo>Site</div></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies on this site.</p></div>
<article><h1>A &amp; B</h1><p>First   para&shy;graph.</p><div class="ad">Buy now</div><p>Second.</p><section class="comments"><h3>Comments</h3><p>Nice article!</p></section></article>
<aside><h3>More</h3><ul><li><a href=/x>Other</a></li></ul></aside><form><label>Mail</label><button>Go</button></form><footer>&copy; us</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<html><nav><a href=/>Home</a></nav></html>", "x"), (None, "u", PAGE, "x"), (1, "u", PAGE, "x"), (5, "u", "<article>" + "<p>word word.</p>" * 20_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = pages.page_digest(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == "A & B\nFirst para\xadgraph.\nSecond." and by[1].n_chars == len(by[1].text) and by[None].text == by[1].text
    assert [by[k].text for k in (2, 3, 4)] == ["", "", ""] and by[5].n_chars == 20_000 * 11 - 1
    assert pages.page_digest(df.limit(0)).count() == 0


# Pipeline


def shingle_set(text, words=5):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))}


def test_pipeline(spark):
    import corpus_pipeline as C

    from paperloom.llm import packing, quality, toxicity
    from paperloom.llm.shared import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids, now = [], docs
    for name, stage in C.STAGES[:-1]:
        now = written(stage(spark, now, SF), name)
        assert now.columns == docs.columns
        ids.append({r.doc_id for r in now.select("doc_id").collect()})
    assert ids[0] > ids[1] >= ids[2]
    # near-duplicates by brute force over the rows that the stage read
    read = docs.where(F.col("doc_id").isin(list(ids[1]))).select("doc_id", "text").collect()
    sets = [shingle_set(r.text) for r in read]
    near, order = np.array([[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]), np.array([r.doc_id for r in read])
    label = order.copy()
    while (new := np.where(near, label[None, :], label.max() + 1).min(1)).tolist() != label.tolist():
        label = new
    assert ids[2] == set(label.tolist())
    # toxicity and quality by their models over every row, one by one
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lexicon, net = toxicity.fitted(docs, labels), quality.fitted(docs.where(F.col("doc_id").isin(list(ids[0]))), labels)
    texts_of = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    density = {d: toxicity.density(t, lexicon.automaton())[0] for d, t in texts_of.items()}
    assert ids[0] == {d for d, x in density.items() if x / (x + lexicon.limit) < 0.5}
    import pyarrow as pa

    kept = sorted(ids[0])
    good = quality.probabilities(net, pa.array([texts_of[d] for d in kept])) >= quality.LEAST_GOOD
    assert ids[1] == {d for d, g in zip(kept, good.tolist(), strict=True) if g}
    rows = C.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == ids[2] and all(r.length <= packing.SEQUENCE for r in rows)
    assert C.ORACLE_SQL is None


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


def test_intermediate_tables_can_be_cleared(spark):
    import os

    from paperloom.llm import shared

    held = shared.written(spark.range(3).toDF("n"), "three")
    assert held.count() == 3 and os.path.isdir(shared._session_dir(spark))
    shared.clear(spark)
    assert not os.path.exists(shared._session_dir(spark))
    shared.clear(spark)
