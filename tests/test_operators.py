"""Operators against cases and against plain Python statements of their rules."""

import json
import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions import geometry as G
from paperloom.operators import assemble, correct, evals, infer, layout, reason, route, rules, score


# Rules


def failing(spark, rule, **data):
    schema = ", ".join(f"`{k}` " + ("array<struct<item_number:int,result:string>>" if isinstance(v, list) or k == "items" else "string") for k, v in data.items())
    df = spark.createDataFrame([tuple(data.values())], schema)
    return df.select(rules.fails(rule, lambda p, kind="string": F.col(f"`{p}`") if p in data else F.lit(None).cast("string")).alias("f")).first().f


@pytest.mark.parametrize(
    ("rule", "data", "fails"),
    [
        ({"type": "REGEX_MATCH", "field": "a", "pattern": r"\d{2}$"}, {"a": "12"}, False), ({"type": "REGEX_MATCH", "field": "a", "pattern": r"\d{2}$"}, {"a": "x"}, True),
        ({"type": "REGEX_MATCH", "field": "a", "pattern": r"\d{2}$"}, {"a": " "}, False), ({"type": "NOT_EMPTY", "field": "a"}, {"a": " "}, True), ({"type": "NOT_EMPTY", "field": "b"}, {"a": "x"}, True),
        ({"type": "DATE_ORDER", "fields": ["a", "b"]}, {"a": "2024-02-01", "b": "2024년 1월 1일"}, True), ({"type": "DATE_ORDER", "fields": ["a", "b"]}, {"a": "2024-01-01", "b": "2024-01-01"}, False),
        ({"type": "DATE_ORDER", "fields": ["a", "b"]}, {"a": "2024-01-01", "b": "?"}, False),
        ({"type": "ARITHMETIC", "result_field": "t", "operands": ["q", "p"], "operator": "multiply"}, {"t": "1,000", "q": "10", "p": "100"}, False),
        ({"type": "ARITHMETIC", "result_field": "t", "operands": ["q", "p"], "operator": "multiply"}, {"t": "1001", "q": "10", "p": "100"}, True),
        ({"type": "ARITHMETIC", "result_field": "t", "operands": ["q", "p"], "operator": "add"}, {"t": "110", "q": "10", "p": None}, False),
        ({"type": "NAME_MATCH", "fields": ["a", "b"]}, {"a": "홍 길동", "b": "홍길동 대표"}, False), ({"type": "NAME_MATCH", "fields": ["a", "b"]}, {"a": "홍길동", "b": "김철수"}, True),
        ({"type": "NAME_MATCH", "fields": ["a", "b"]}, {"a": None, "b": "김철수"}, False), ({"type": "ADDR_CONTAINS", "field_value": "a", "field_contained": "b"}, {"a": "서울 특별시 1", "b": "서울특별시"}, False),
        ({"type": "ADDR_CONTAINS", "field_value": "a", "field_contained": "b"}, {"a": "부산", "b": "서울"}, True), ({"type": "UNKNOWN"}, {"a": "x"}, False),
        ({"type": "ARRAY_LENGTH", "field": "items", "expected_length": 2}, {"items": [(1, "O"), (2, "X")]}, False), ({"type": "ARRAY_LENGTH", "field": "items", "expected_length": 2}, {"items": None}, True),
        ({"type": "ARRAY_SEQUENCE", "field": "items", "key": "item_number", "expected_sequence": [1, 2]}, {"items": [(2, "O"), (1, "X")]}, True),
        ({"type": "ARRAY_ENUM", "field": "items", "key": "result", "allowed_values": ["O", "X"]}, {"items": [(1, "O"), (2, "Z")]}, True),
        ({"type": "ARRAY_ENUM", "field": "items", "key": "result", "allowed_values": ["O", "X"]}, {"items": [(1, "O"), (2, "X")]}, False),
    ],
)
def test_rules(spark, rule, data, fails):
    assert failing(spark, rule, **data) is fails


def test_rules_of_forms_on_json(spark):
    docs = spark.createDataFrame([("a", "f", '{"w": {"name": " "}, "items": [{"item_number": 1, "result": "O"}]}'), ("b", "g", "{}")], "doc_id string, form_type string, j string")
    docs = docs.withColumn("v", F.try_parse_json("j"))
    made = {"f": [{"rule_id": "n", "type": "NOT_EMPTY", "field": "w.name", "severity": "low"}, {"rule_id": "l", "type": "ARRAY_LENGTH", "field": "items", "expected_length": 1}]}
    rows = rules.error_rows(rules.with_form_errors(docs, made, rules.variant_getter("v"))).collect()
    assert [(r.doc_id, r.error_id, r.rule_id, r.error_type) for r in rows] == [("a", "ve_0001", "n", "missing_field")]


def test_patterns(spark):
    types = [{"data_type": "date", "pattern": r"\d{4}년 \d{1,2}월 \d{1,2}일$", "normalize": {"regex": r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", "template": "{1}년 {2:02d}월 {3:02d}일"}}, {"data_type": "phone", "pattern": r"\d{2,3}-\d{3,4}-\d{4}$", "normalize": {"strip_chars": " "}}]
    keys = [{"field_key": "nsn", "pattern": r"\d{4}-\d{2}-\d{3}-\d{4}$"}]
    cases = [("d", "date", "2024년5월20일", "2024년 05월 20일", 0), ("d", "date", "2024-05-20", "2024-05-20", 1), ("p", "phone", "02 -123-4567", "02-123-4567", 0), ("nsn", "code", "1-2", "1-2", 1), ("nsn", "code", "None", "None", 0), ("x", "text", None, None, 0)]
    df = spark.createDataFrame([(k, t, v) for k, t, v, _, _ in cases], "field_key string, data_type string, corrected_value string")
    got = rules.pattern_errors(df, types, keys).collect()
    assert [(r.corrected_value, len(r.pattern_errors)) for r in got] == [(v, n) for *_, v, n in cases]


# Scores


def test_penalties(spark):
    errors = spark.createDataFrame([("d", "format", "a.name, b.name"), ("d", "arithmetic", "items[0].total"), ("d", "odd", "total"), ("d", "format", "")], "doc_id string, error_type string, field_ref string")
    got = {r.field_key: r.penalty for r in score.penalty_map(errors).collect()}
    assert got == pytest.approx({"a.name": 0.1, "b.name": 0.1, "name": 0.2, "items.total": 0.3, "total": 0.35})


def test_decision(spark):
    docs = spark.createDataFrame([("a", "bid", "vlm"), ("b", "bid", "fallback"), ("c", "other", "fallback"), ("d", "bid", "vlm")], "doc_id string, form_type string, processing_path string")
    fields = spark.createDataFrame([("a", 0, "x", "text", 0.95), ("b", 0, "x", "text", 0.99), ("c", 0, "x", "text", 0.1), ("d", 0, "x", "text", 0.95)], "doc_id string, pos int, field_key string, data_type string, confidence double")
    errors = spark.createDataFrame([("d", "format", "low", "x")], "doc_id string, error_type string, severity string, field_ref string")
    got = {r.doc_id: (round(r.overall, 4), r.flagged_fields, r.review_required) for r in score.decided(docs, fields, errors).collect()}
    # on the fallback path a text needs a confidence of 1, and the document's is capped
    assert got == {"a": (0.95, [], False), "b": (0.7, ["x"], True), "c": (0.1, ["x"], False), "d": (0.85, ["x"], True)}


def test_deciding_at_once_equals_deciding_by_joins(spark):
    r = random.Random(5)
    documents = [(d, r.choice(["bid", "other"]), r.choice(["vlm", "fallback"])) for d in range(40)]
    fields, errors = [], []
    for d, *_ in documents:
        for k in range(r.randint(1, 5)):
            held = [(r.choice(["arithmetic", "format", "odd"]), r.choice(["low", "critical"]), r.choice(["f0", "f1", "a.f1,f2", "items[0].f0"])) for _ in range(r.randint(0, 2))]
            fields.append((d, k, f"f{k}", r.choice(["text", "amount", "date"]), round(r.random(), 3), held))
            errors += [(d, *e) for e in held]
    docs = spark.createDataFrame(documents, "doc_id int, form_type string, processing_path string")
    whole = spark.createDataFrame(fields, "doc_id int, pos int, field_key string, data_type string, confidence double, errors array<struct<error_type:string,severity:string,field_ref:string>>")
    want = score.decided(docs, whole.drop("errors"), spark.createDataFrame(errors, "doc_id int, error_type string, severity string, field_ref string"))
    got = score.decided_at_once(whole.join(docs, "doc_id"))
    rows = lambda df: {x.doc_id: (x.flagged_fields, x.n_errors, x.critical, round(x.overall, 6), x.review_required) for x in df.collect()}
    assert rows(got) == rows(want) and len(rows(got)) == 40


def test_leaf_confidences(spark):
    leaves = spark.createDataFrame([("d", "a.b_date", "x", None), ("d", "items[0]", "O", 0.8), ("d", "total", "1", None)], "doc_id string, path string, value string, stated double")
    fields = spark.createDataFrame([("d", 0, "total", 0.9), ("d", 1, "b_date", 0.7)], "doc_id string, pos int, field_key string, confidence double")
    got = lambda strict: {r.path: (r.kind, r.confidence) for r in score.leaf_confidences(leaves, fields, strict=strict).collect()}
    assert got(True) == {"a.b_date": ("date", 0.5), "items[0]": ("handwritten", 0.8), "total": ("amount", 0.9)}
    assert got(False)["a.b_date"] == ("date", 0.7)


# Layout


def pages(n, seed):
    r = random.Random(seed)
    for doc in range(n):
        for pos in range(r.randint(1, 9)):
            x, y = r.randint(0, 60), r.randint(0, 200)
            yield (doc, pos, f"r{pos}", r.choice(["text", "text", "seal", "header", "footer"]), (x, y, x + r.randint(1, 60), y + r.randint(1, 40)), r.choice([0.5, 0.7, 0.7, 0.9]))


REGION = "doc_id int, pos int, region_id string, region_type string, box struct<x1:int,y1:int,x2:int,y2:int>, confidence double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    size = lambda c: (c[2] - c[0]) * (c[3] - c[1])
    return both / (size(a) + size(b) - both)


def by_page(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_suppression(spark):
    rows = list(pages(60, 1))
    df = spark.createDataFrame(rows, REGION)
    want = set()
    for doc, page in by_page(rows).items():
        kept = []
        for r in sorted(page, key=lambda r: -r[5]):
            if not any(iou(r[4], k[4]) > (0.5 if "seal" in (r[3], k[3]) else 0.7) for k in kept):
                kept.append(r)
        want |= {(doc, r[1]) for r in kept}
    done = layout.refined(df)
    assert {(r.doc_id, r.pos) for r in done.collect()} == want
    again = layout.refined(done.drop("rank"))
    assert {(r.doc_id, r.pos) for r in again.collect()} == want


def test_merging(spark):
    rows = list(pages(60, 2))
    want = set()
    for doc, page in by_page(rows).items():
        done = []
        for r in sorted((r for r in page if r[3] == "text"), key=lambda r: (r[4][1], r[4][0], r[1])):
            if done:
                p, c = done[-1][0], r[4]
                if abs((p[0] + p[2]) // 2 - (c[0] + c[2]) // 2) <= 20 and 0 <= c[1] - p[3] <= 15:
                    done[-1] = ((min(p[0], c[0]), p[1], max(p[2], c[2]), c[3]), done[-1][1], [*done[-1][2], r[2]])
                    continue
            done.append((r[4], r[2], []))
        want |= {(doc, rid, box, tuple(members)) for box, rid, members in done}
    got = layout.merged_texts(spark.createDataFrame(rows, REGION)).where("region_type = 'text'").collect()
    assert {(r.doc_id, r.region_id, tuple(r.box), tuple(r.members)) for r in got} == want


def test_reading_order(spark):
    rows = list(pages(60, 3))
    want = {}
    for doc, page in by_page(rows).items():
        body = sorted((r for r in page if r[3] not in ("header", "footer")), key=lambda r: ((r[4][0] + r[4][2]) // 2, r[1]))
        columns = []
        for r in body:
            if columns and (r[4][0] + r[4][2]) // 2 - max(c[4][2] for c in columns[-1]) <= 100 * 0.03:
                columns[-1].append(r)
            else:
                columns.append([r])
        ends = lambda kind: sorted((r for r in page if r[3] == kind), key=lambda r: (r[4][1], r[1]))  # noqa: E731,B023
        order = ends("header") + [r for c in columns for r in sorted(c, key=lambda r: (r[4][1], r[4][0], r[1]))] + ends("footer")
        want |= {(doc, r[1]): k for k, r in enumerate(order)}
    got = layout.reading_order(spark.createDataFrame(rows, REGION), F.lit(100)).collect()
    assert {(r.doc_id, r.pos): r.order_idx for r in got} == want


def test_order_after_merge(spark):
    order = spark.createDataFrame([("d", "a", 0), ("d", "b", 1), ("d", "c", 2)], "doc_id string, region_id string, order_idx int")
    kept = spark.createDataFrame([("d", "c", 0), ("d", "z", 1), ("d", "x", 2)], "doc_id string, region_id string, pos int")
    taken = spark.createDataFrame([("d", "a", "x")], "doc_id string, region_id string, into string")
    assert {r.region_id: r.order_idx for r in layout.order_after_merge(order, kept, taken).collect()} == {"x": 0, "c": 1, "z": 2}


def test_template(spark):
    found = spark.createDataFrame([("d", 0, "r1", "text", (0, 0, 10, 10), 0.8), ("d", 1, "r2", "text", (12, 0, 20, 10), 0.8), ("d", 2, "r3", "seal", (0, 0, 10, 10), 0.8), ("d", 3, "r4", "text", (50, 50, 60, 60), 0.8), ("d", 4, "r5", "text", (0, 0, 500, 500), 0.8)], REGION.replace("doc_id int", "doc_id string"))
    template = spark.createDataFrame([("d", 0, "k0", "text", (0, 0, 20, 10)), ("d", 1, "k1", "text", (49, 49, 61, 61)), ("d", 2, "k2", "text", (80, 80, 90, 90))], "doc_id string, ord int, field_key string, region_type string, box struct<x1:int,y1:int,x2:int,y2:int>")
    got = {r.region_id: (r.field_key, tuple(r.box), r.source) for r in layout.templated(found, template).collect()}
    assert got["t_0001"] == ("k0", (0, 0, 20, 10), "template") and got["r4"] == ("k1", (50, 50, 60, 60), "template_matched") and got["t_0002"][0] == "k2"
    assert got["r3"] == (None, (0, 0, 10, 10), None) and "r5" in got and "r1" not in got


def test_fixed_texts_and_fusion(spark):
    regions = spark.createDataFrame([("d", 0, "a", "text", (0, 0, 10, 10), 0.8, None), ("d", 1, "b", "text", (0, 0, 10, 10), 0.8, "k"), ("d", 2, "c", "text", (0, 5, 10, 15), 0.8, None)], REGION.replace("doc_id int", "doc_id string") + ", field_key string")
    fixed = spark.createDataFrame([("d", "f", (0, 0, 10, 10)), ("d", "g", None)], "doc_id string, field_key string, box struct<x1:int,y1:int,x2:int,y2:int>")
    assert {r.region_id for r in layout.unlike_fixed(regions, fixed).collect()} == {"b", "c"}
    assert {(r.region_id, r.source) for r in layout.fused(regions.where("pos = 0"), regions.where("pos = 2")).collect()} == {("a", "v3")}


# Corrections


def test_nearest(spark):
    df = spark.createDataFrame([("262",), ("26x",), ("999",), (None,), ("62",)], "v string")
    assert [r.o for r in df.select(correct.nearest(F.col("v"), ("262", "263", "620")).alias("o")).collect()] == ["262", "262", None, None, "262"]


def test_nearest_rows_equals_nearest(spark):
    r = random.Random(4)
    words = ["".join(r.choices("abc", k=r.randint(1, 9))) for _ in range(40)]
    entries = list(dict.fromkeys(words[:25]))
    values = spark.createDataFrame([(w,) for w in {*words[25:], *("".join(r.choices("abc", k=r.randint(1, 9))) for _ in range(60))}], "value string")
    got = {x.value: x.entry for x in correct.nearest_rows(values, spark.createDataFrame(list(enumerate(entries)), "ord int, entry string")).collect()}
    want = {x.value: x.e for x in values.select("value", correct.nearest(F.col("value"), entries).alias("e")).where("e is not null").collect()}
    assert got == want


def test_ranks_and_places(spark):
    df = spark.createDataFrame([("중렁",), ("대위",), ("",), (None,), ("육군대령입니다",)], "v string")
    assert [r.o for r in df.select(correct.rank_normalized(F.col("v")).alias("o")).collect()] == ["중사", "대위", "", None, "육군대령입니다"]
    aliases, cities = {"서울시": "서울특별시", "서울": "서울특별시"}, ("서울특별시", "부산광역시")
    place = lambda location, address: spark.range(1).select(correct.location_corrected(F.lit(location), F.lit(address), cities, aliases).alias("o")).first().o
    assert place("서울시", "알 수 없음") == "서울특별시" and place("서울시", "부산광역시 1") == "부산광역시" and place("x", "서울 2") == "서울특별시" and place("x", "y") == "x"


# Assembly


def test_assembly(spark):
    made = spark.createDataFrame([("s", 0, "name", "a.name"), ("s", 1, "n", "a.n"), ("s", 2, "note", "note"), ("s", 3, "gone", "gone")], "schema_id string, ord int, field_key string, path string")
    fields = spark.createDataFrame(
        [("d", "s", 0, "name", " x ", "", 0.5), ("d", "s", 1, "name", "y", "z", 0.5), ("d", "s", 2, "n", "007", "", 0.9), ("d", "s", 3, "gone", "None", "", 0.9), ("d", "s", 4, "ghost", "v", "", 0.9)],
        "doc_id string, schema_id string, pos int, field_key string, raw_value string, corrected_value string, confidence double",
    )
    fixed = spark.createDataFrame([("s", "note", "printed"), ("s", "name", "unused")], "schema_id string, field_key string, value string")
    rows = assemble.leaves(fields, made, fixed)
    assert {r.path: r.value for r in rows.collect()} == {"a.name": "z", "a.n": "7", "note": "printed"}
    assert assemble.nested(rows).first().assembled == '{"a":{"name":"z","n":"7"},"note":"printed"}'
    assert [r.field_key for r in assemble.ghosts(fields, made).collect()] == ["ghost"]


def test_unwrapping(spark):
    cases = [('{"k": {"a": 1}}', "k", "s.t", '{"a":1}'), ('{"t": false}', "k", "s.t", "false"), ('{"k": {"t": 2}}', "k", "s.t", "2"), ('{"k": 1, "j": 2}', "k", "s.t", '{"j":2,"k":1}'), ("[1]", "k", "s.t", "[1]")]
    df = spark.createDataFrame([c[:3] for c in cases], "j string, k string, p string")
    got = [r.o for r in df.select(F.to_json(assemble.unwrapped(F.try_parse_json("j"), F.col("k"), F.col("p"))).alias("o")).collect()]
    assert got == [c[3] for c in cases]


def test_json_leaves(spark):
    df = spark.createDataFrame([("d", '{"a": {"b": "x", "c": null, "d": true}, "l": [{"result": "O", "result_confidence": 0.4}, 5], "analysis": "no", "e": ""}'), ("e", "broken")], "doc_id string, assembled string")
    got = {(r.doc_id, r.path): (r.value, r.stated) for r in assemble.json_leaves(df).collect()}
    assert got == {("d", "a.b"): ("x", None), ("d", "l[0]"): ("O", 0.4), ("d", "l[1]"): ("5", None)}
    deep = spark.createDataFrame([("d", '{"a":{"b":{"c":{"d":{"e":{"f":{"g":7}}}}}},"r":[{"result":null,"result_confidence":"0.3"},{"result":"","result_confidence":null},{"result":"X"}]}')], "doc_id string, assembled string")
    got = {r.path: (r.value, r.stated) for r in assemble.json_leaves(deep).collect()}
    assert got == {"a.b.c.d.e.f.g": ("7", None), "r[0]": (None, 0.3), "r[1]": ("", 0.5), "r[2].result": ("X", None)}


def test_completed_items(spark):
    items = F.parse_json(F.lit('{"1": {"item_result": "X"}, "2": [{"item_number": "x", "result": null, "item_result": "O", "note": [1]}], "3": "plain", "4": {"item_number": 9, "result_confidence": 0.7}}'))
    got = json.loads(spark.range(1).select(assemble.completed_items(items, 5).alias("o")).first().o)
    first, second, third, fourth, fifth = got
    assert first == {"item_number": 1, "result": "?", "result_confidence": 0.0} and second == {"item_result": "X", "item_number": 2, "result": "X", "result_confidence": 0.0}
    # a result that is null has its key, so no alias takes its place
    assert third == {"result": None, "item_result": "O", "note": [1], "item_number": 3, "result_confidence": 0.0}
    assert fourth == "plain" and fifth == {"item_number": 9, "result_confidence": 0.7, "result": "?"}


def test_assembled_documents(spark):
    made = spark.createDataFrame([("s", k, f, p) for k, (f, p) in enumerate([("a", "x.y.z"), ("b", "x.q"), ("c", "flag"), ("d", "x.y.w"), ("item_2", "checklist_items.1"), ("e", "n"), ("f", "last")])], "schema_id string, ord int, field_key string, path string")
    values = [("a", '{"a": {"z": [1, {"k": "é"}]}}'), ("b", '"quoted"'), ("c", "true"), ("d", "-007"), ("item_2", '{"result": "O"}'), ("e", "None"), ("unknown", "u")]
    fields = spark.createDataFrame([("d", "s", f, k, 0.5, "", v) for k, (f, v) in enumerate(values)], "doc_id string, schema_id string, field_key string, pos int, confidence double, raw_value string, corrected_value string")
    fixed = spark.createDataFrame([("s", "f", "printed"), ("s", "a", "not used")], "schema_id string, field_key string, value string")
    text = assemble.assembled(fields, made, fixed).first().assembled
    items = [{"item_number": k, "result": "?", "result_confidence": 0.0} for k in range(1, 7)]
    items[1] = {"result": "O", "item_number": 2, "result_confidence": 0.0}
    assert json.loads(text) == {"x": {"y": {"z": [1, {"k": "é"}], "w": -7}, "q": '"quoted"'}, "flag": True, "checklist_items": items, "last": "printed"}
    assert list(json.loads(text)) == ["x", "flag", "checklist_items", "last"]
    old = spark.createDataFrame([("d", "{}"), ("k", '{"kept":1}')], "doc_id string, assembled string")
    got = {r.doc_id: r.assembled for r in assemble.reassembled(old, fields, made, old.where("doc_id = 'd'"), fixed).collect()}
    assert got == {"d": text, "k": '{"kept":1}'}
    assert {r.field_key for r in assemble.known(fields, made, fixed).collect()} == {v for v, _ in values} - {"unknown"}


# Routing, evaluation, re-reading


def test_routing(spark):
    path = lambda *flags: spark.range(1).select(route.processing_path(*[F.lit(f) for f in flags]).alias("o")).first().o
    assert [path(True, False, False), path(False, True, True), path(False, True, False), path(False, False, True)] == ["vlm", "fallback", "review_queue", "review_queue"]
    status = lambda found, **k: spark.range(1).select(route.pages_status(F.array(*[F.lit(s) for s in found]).cast("array<string>"), **k).alias("o")).first().o
    assert [status(["success", "success"]), status(["success", "failed"]), status([]), status(["review"])] == ["success", "partial", "failed", "partial"]
    assert status(["success"], strict=False, expected=F.lit(2)) == "partial"


def test_evaluation(spark):
    schema = "doc_id string, overall_confidence double, validation_error_count int, review_queued boolean, augmented_count int"
    after = spark.createDataFrame([("a", 0.9, 1, False, 5), ("b", 0.5, 2, True, 5), ("c", 0.5, 0, False, 1)], schema)
    before = spark.createDataFrame([("a", 0.8, 1, True, 4), ("b", 0.6, 2, True, 4), ("z", 1.0, 0, False, 1)], schema)
    rows = evals.deltas(after, before)
    assert {(r.metric, r.sign) for r in rows.where("doc_id = 'a'").collect()} == {("overall_confidence", "positive"), ("validation_error_count", "neutral"), ("review_queued", "positive"), ("augmented_count", "warning")}
    assert {r.doc_id: r.verdict for r in evals.verdict(rows, "doc_id").collect()} == {"a": "IMPROVED", "b": "REGRESSED", "c": "NEUTRAL"}


def test_targets(spark):
    fields = spark.createDataFrame([("d", k, f, v, c, False) for k, (f, v, c) in enumerate([("address", "x", 0.3), ("phone", "02", 0.9), ("bid_name", "y", 0.2), ("agent_name", "z", 0.95)])], "doc_id string, pos int, field_key string, corrected_value string, confidence double, was_retried boolean")
    regions = fields.select("doc_id", "field_key")
    errors = spark.createDataFrame([("d", 0, "date_logic", "agent.name", "m")], "doc_id string, pos int, error_type string, field_ref string, message string")
    got = {r.field_key: (r.turn, r.hints) for r in reason.targets(fields, errors, regions, reason.edges(spark)).collect()}
    assert got == {"agent_name": (1, None), "address": (2, {"phone": "02"})}


def fake_provider():
    class Fake:
        def run(self, task):
            if task["region_id"] == "bad":
                raise ValueError("no")
            return {"content": task["region_id"].upper(), "logprobs": [-0.1], "confidence": 0.9}

    return lambda: Fake()


def test_inference(spark):
    work = spark.createDataFrame([("d", "a", 140), ("d", "bad", 560)], "doc_id string, region_id string, pixel_budget int")
    got = {r.region_id: (r.content, r.content_type, r.confidence) for r in infer.answered(work, fake_provider()).collect()}
    assert got == {"a": ("A", "text", 0.9), "bad": ("", "error", 0.0)}
    seen = spark.createDataFrame([("d", "a", 0, "x", [-0.1])], "doc_id string, region_id string, attempt int, content string, logprobs array<double>")
    assert {r.region_id: r.content_type for r in infer.replayed(work, seen).collect()} == {"a": "text", "bad": "error"}


def test_classification_and_cells(spark):
    answers = spark.createDataFrame([("a", '{"form_type": "bid", "confidence": 0.7, "form_identifier": " "}', None), ("b", "this is a CHECKLIST", [-0.5, -0.5]), ("c", "?", None)], "doc_id string, content string, logprobs array<double>")
    got = {r.doc_id: tuple(r)[1:] for r in infer.classification(answers, ["bid", "checklist"]).collect()}
    assert got == {"a": ("bid", 0.7, None), "b": ("checklist", 0.6065, None), "c": ("unknown", 0.5, None)}
    tables = spark.createDataFrame([("d", "t", '{"cells": [{"r": 0, "c": 1, "type": "Printed"}, {"row": 0, "col": 0, "content_type": "empty"}]}')], "doc_id string, region_id string, content string")
    cells = infer.table_cells(tables)
    assert [(r.row, r.col, r.content_type) for r in cells.orderBy("pos").collect()] == [(0, 1, "printed"), (0, 0, "empty")]
    results = spark.createDataFrame([], "doc_id string, region_id string, content string")
    assert infer.table_context(cells, results).first().matrix == " | (printed)"


def test_retry(spark):
    schema = "doc_id string, field_key string, corrected_value string, confidence double"
    first = spark.createDataFrame([("d", "a", "x", 0.5), ("d", "b", "y", 0.5), ("d", "c", "z", 0.5)], schema).withColumn("was_retried", F.lit(False))
    again = spark.createDataFrame([("d", "a", "X", 0.6), ("d", "b", "Y", 0.4)], schema)
    got = {r.field_key: (r.corrected_value, r.confidence, r.was_retried) for r in route.retry_merged(first, again).collect()}
    assert got == {"a": ("X", 0.6, True), "b": ("y", 0.5, True), "c": ("z", 0.5, False)}


def test_boxes_within(spark):
    df = spark.createDataFrame([("d", 0, "a", "text", (0, 0, 5, 50), 0.9)], REGION.replace("doc_id int", "doc_id string"))
    assert layout.without_micro(df).count() == 0 and layout.large_enough(df, F.lit(100_000)).count() == 1
    assert G.area(F.col("box")) is not None
