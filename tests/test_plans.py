"""Whole stages on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from paperloom.operators import assemble, evals, reason
from paperloom.plans import documents as P
from paperloom.plans import steps
from paperloom.sources import readers

RULES = {"bid": [{"rule_id": "addr", "type": "ADDR_CONTAINS", "field_value": "applicant.address", "field_contained": "applicant.business_location", "severity": "low"}, {"rule_id": "sub", "type": "NOT_EMPTY", "field": "submission.submitter_name", "severity": "medium"}]}
KEYS = [{"field_key": "business_reg_number", "pattern": r"\d{3}-\d{2}-\d{5}$", "severity": "medium"}]
WORDS = {"cities": ("서울특별시",), "aliases": {"서울시": "서울특별시"}, "codes": ("262",), "offices": ("방위사업청",)}


@pytest.fixture(scope="module")
def made(spark):
    docs = spark.createDataFrame([("a", "bid", "vlm"), ("b", "other", "vlm"), ("c", "bid", "vlm")], "doc_id string, form_type string, processing_path string")
    fields = spark.createDataFrame(
        [(d, k, f, v, v, "text", 0.95, False, f"r{k}") for d in "abc" for k, (f, v) in enumerate([("business_reg_number", "123-45-67890" if d == "a" else "12"), ("address", "서울특별시 강남구")])],
        "doc_id string, pos int, field_key string, raw_value string, corrected_value string, data_type string, confidence double, was_retried boolean, region_id string",
    )
    text = json.dumps({"applicant": {"address": "서울특별시 강남구", "business_location": "서울시"}, "submission": {"submitter_name": "홍길동"}}, ensure_ascii=False)
    bare = json.dumps({"applicant": {"address": "부산", "business_location": "대구"}}, ensure_ascii=False)
    leaves = assemble.json_leaves(spark.createDataFrame([("a", text), ("b", bare), ("c", bare)], "doc_id string, assembled string"))
    return docs, fields, leaves


def test_validation(spark, made):
    done, fields, errors = P.validated(*made, RULES, (), KEYS, WORDS)
    # the alias is put right before the rule looks; documents of other kinds have no errors
    assert {(r.doc_id, r.error_id, r.rule_id) for r in errors.collect()} == {("c", "ve_0001", "pat_business_reg_number"), ("c", "ve_0002", "addr"), ("c", "ve_0003", "sub")}
    got = {r.doc_id: (r.n_errors, r.flagged_fields, r.review_required, round(r.overall, 4)) for r in done.collect()}
    # nested leaves come from no field: 0.5
    assert got == {"a": (0, [], True, 0.5), "b": (0, [], False, 0.5), "c": (3, ["business_reg_number", "address"], True, 0.5)}
    assert {(r.doc_id, r.field_key): r.confidence for r in fields.where("doc_id = 'c'").collect()} == {("c", "business_reg_number"): 0.8, ("c", "address"): 0.85}
    table, queue = P.loaded(spark.createDataFrame([], "doc_id string, form_type string, processing_path string, confidence double, review_required boolean, processed_at timestamp"), done, F.lit("2024-05-06 07:08:09").cast("timestamp"))
    assert table.count() == 3 and {(r.doc_id, r.reason, r.priority) for r in queue.collect()} == {("a", "validation_failed", "normal"), ("c", "low_confidence", "normal")}
    assert all(r.queue_id.startswith(f"RQ-20240506-070809-{r.doc_id}-") for r in queue.collect())


def test_second_readings(spark):
    fields = spark.createDataFrame([("d", 0, "address", "x", "text", 0.3, False, "r0"), ("d", 1, "phone", "02", "text", 0.9, False, "r1")], "doc_id string, pos int, field_key string, corrected_value string, data_type string, confidence double, was_retried boolean, region_id string")
    regions = spark.createDataFrame([("d", 0, "r0", "address", 560), ("d", 1, "r1", "phone", 560)], "doc_id string, pos int, region_id string, field_key string, pixel_budget int")
    seen = []

    def answers(tasks):
        seen.append({r.region_id: r.asDict() for r in tasks.collect()})
        return tasks.select("doc_id", "region_id", F.lit("Y").alias("content"), F.lit(None).cast("array<double>").alias("logprobs"), F.lit("text").alias("content_type"), F.lit(0.8).alias("confidence"))

    again = {r.field_key: (r.corrected_value, r.confidence, r.was_retried) for r in P.read_again(fields, regions, answers).collect()}
    assert again == {"address": ("Y", 0.8, True), "phone": ("02", 0.9, False)} and seen[0]["r0"]["pixel_budget"] == 1120
    errors = spark.createDataFrame([], "doc_id string, pos int, error_type string, field_ref string, message string")
    thought = {r.field_key: r.corrected_value for r in P.reasoned_again(fields, errors, regions, reason.edges(spark), answers).collect()}
    assert thought == {"address": "Y", "phone": "02"} and "phone: 02" in seen[1]["r0"]["prompt"]


def test_refined_layout(spark):
    box = lambda *c: tuple(c)
    rows = [("d", 0, "a", "text", box(0, 0, 50, 10), 0.9), ("d", 1, "b", "text", box(0, 15, 50, 25), 0.8), ("d", 2, "c", "text", box(0, 1, 50, 11), 0.5), ("d", 3, "m", "text", box(0, 0, 3, 3), 0.9), ("d", 4, "t", "table", box(100, 0, 200, 90), 0.9)]
    regions = spark.createDataFrame(rows, "doc_id string, pos int, region_id string, region_type string, box struct<x1:int,y1:int,x2:int,y2:int>, confidence double")
    order = spark.createDataFrame([("d", r, k) for k, r in enumerate(["t", "m", "b", "a", "c"])], "doc_id string, region_id string, order_idx int")
    got = {r.region_id: (tuple(r.box), list(r.members), r.order_idx) for r in P.refined_layout(regions, order).collect()}
    assert got == {"t": ((100, 0, 200, 90), [], 0), "a": ((0, 0, 50, 25), ["b"], 1)}


def test_small_ones(spark):
    value = lambda c: spark.range(1).select(c.alias("o")).first().o
    assert json.loads(value(P.ranks_synced(F.lit('{"team": "1", "rank": "대워", "name": "x"}')))) == {"team": "1", "rank": "대위", "name": "x"}
    assert value(P.ranks_synced(F.lit("plain"))) == "plain"
    assert [value(P.reader_of(F.lit(t), F.lit(h), F.lit(s))) for t, h, s in (("text", True, True), ("text", False, True), ("text", False, False))] == ["S3", "guided", "S2"]
    regions = spark.createDataFrame([("s", "k", 1), ("s", None, 2), ("free", None, 3)], "schema_id string, field_key string, n int")
    known = spark.createDataFrame([("s",)], "schema_id string")
    assert {r.n for r in P.keyed_regions(regions, known).collect()} == {1, 3}


def test_steps_keep_times_warnings_and_errors():
    run = steps.Steps()

    class Output:
        warnings = ("few regions", "few regions")

    assert run.run("P2", Output, "low resolution").warnings and run.run("P3", lambda: 1 // 0) is None
    assert run.warnings == ["[P2] low resolution", "[P2] few regions"] and run.errors[0].startswith("[P3] ZeroDivisionError") and set(run.timings) == {"P2", "P3"}


def test_rule_and_pattern_files(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "bid.yaml").write_text("rules:\n- {rule_id: r1, type: NOT_EMPTY, field: a}\n")
    (tmp_path / "common.yaml").write_text("field_type_patterns:\n- {data_type: amount, pattern: '^\\d+$'}\nfield_key_patterns:\n- {field_key: nsn, pattern: x}\n")
    (tmp_path / "empty.yaml").write_text("other: 1\n")
    assert readers.rule_files(spark, {"bid": str(tmp_path / "bid.yaml"), "none": str(tmp_path / "empty.yaml")}) == {"bid": [{"rule_id": "r1", "type": "NOT_EMPTY", "field": "a"}], "none": []}
    kinds, keys = readers.pattern_file(spark, str(tmp_path / "common.yaml"))
    assert kinds[0]["data_type"] == "amount" and keys[0]["field_key"] == "nsn" and readers.pattern_file(spark, str(tmp_path / "empty.yaml")) == ([], [])


def test_sub_schemas():
    schema = {"properties": {"a": {"type": "object", "properties": {"b": {"type": "string"}}}, "n": {"type": "integer"}, "checklist_items": {"items": {"type": "object", "properties": {"result": {}}}}}, "x-assembly-rules": {"f": "a.b", "g": "n"}}
    assert readers.sub_schema(schema, "f") == {"type": "object", "properties": {"b": {"type": "string"}}, "required": ["b"]}
    assert readers.sub_schema(schema, "g") == {"type": "integer"} and readers.sub_schema(schema, "unknown") == schema
    assert readers.sub_schema(schema, "result_item_2")["properties"]["item_number"] == {"type": "integer", "const": 2}


def test_evaluation_of_a_trial(spark):
    columns = "doc_id string, overall_confidence double, validation_error_count int, review_queued boolean"
    before = spark.createDataFrame([("a", 0.5, 2, True), ("gone", 0.1, 1, True)], columns)
    after = spark.createDataFrame([("a", 0.75, 1, False), ("new", 0.25, 0, True)], columns)
    rows, means, verdict = evals.evaluated(after, before)
    assert {(r.doc_id, r.metric): r.sign for r in rows.collect()}[("a", "overall_confidence")] == "positive" and {r.doc_id for r in rows.collect()} == {"a", "new"}
    assert means.first().overall_confidence == 0.5 and verdict.first().verdict == "IMPROVED"
