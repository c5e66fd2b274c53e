"""Registered queries of records: reading, assembly, inference by replay, and what is written. Each maps the domain onto the provided tables, as the catalogue does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import forms, model
from ..functions import geometry as G
from ..functions import text as X
from ..operators import assemble, correct, evals, infer, layout, route, rules
from ..sources import readers, sinks
from . import documents as P
from . import steps
from .catalogue import _NOW, _SQL_FIELDS, _SQL_LINES, _SQL_QUEUE, _SQL_REGIONS, _fields, _flat, _lines, _queue, _regions, _table, query


def _pick(values: tuple[str, ...], at) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def _sql_pick(values: tuple[str, ...], at: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST({at} AS INTEGER) + 1]"


# Sources

_NAMES = (".JPG", ".pdf", ".txt", "", ".tiff", ".a.png")


@query(f"""SELECT page_id, CASE lower(regexp_extract('scan' || page_id || {_sql_pick(_NAMES, "page_id % 6")}, '\\.([A-Za-z0-9]+)$', 1)) WHEN 'jpg' THEN 'jpg' WHEN 'pdf' THEN 'pdf' WHEN 'tiff' THEN 'tiff' ELSE 'png' END AS file_ext,
       starts_with(CASE WHEN page_id % 2 = 0 THEN '%PDF-1' ELSE '%pdf' END, '%PDF') AS is_pdf FROM pages""")
def scan_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of files by their names, and whether they are PDF by their first bytes."""
    p = _table(spark, sf_dir, "pages")
    name = F.concat(F.lit("scan"), F.col("page_id").cast("string"), _pick(_NAMES, F.col("page_id") % 6))
    head = F.when(F.col("page_id") % 2 == 0, "%PDF-1").otherwise("%pdf").cast("binary")
    return p.select("page_id", X.extension_of(name).alias("file_ext"), readers.is_pdf(head).alias("is_pdf"))


@query("""WITH p AS (SELECT doc_id, string_split(text, '. ') AS parts FROM documents)
SELECT printf('%d_p%02d', doc_id, k) AS doc_id, CAST(k AS INTEGER) AS page_number, CAST(len(parts) AS INTEGER) AS total_pages, CAST(strlen(parts[k]) AS INTEGER) AS n_bytes FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS k FROM p)""")
def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of documents as a renderer gives them; here a page ends with a sentence."""
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.encode("text", "UTF-8").alias("content"))
    pages = readers.pdf_pages(d, lambda content: bytes(content).split(b". "))
    return pages.select("doc_id", "page_number", "total_pages", F.octet_length("content").alias("n_bytes"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN n_chars < 50 THEN 'little text: ' || n_chars END, CASE WHEN doc_id % 300 < 150 THEN 'low resolution: ' || (doc_id % 300) || ' dpi' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM documents""")
def scan_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents")
    return d.select("doc_id", F.array_join(readers.scan_warnings(F.col("n_chars"), F.col("doc_id") % 300), "; ").alias("warnings"))


@query("""WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN substr(props, 1, 4) WHEN 1 THEN '' ELSE props END AS value FROM events)
SELECT event_id, CASE WHEN value <> '' AND json_valid(value) THEN CAST(json_extract(value, '$.k') AS INTEGER) END AS k FROM v""")
def tolerant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records, null where they are cut off or empty."""
    value = F.when(F.col("event_id") % 4 == 0, F.substring("props", 1, 4)).when(F.col("event_id") % 4 == 1, "").otherwise(F.col("props"))
    e = _table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return readers.tolerant(e).select("event_id", X.json_at(F.col("parsed"), "k", "int").alias("k"))


_SQL_SCHEMAS = "schemas AS (SELECT 'n' || n_regionkey AS schema_id, n_nationkey || '.0.1' AS version, n_nationkey % 3 = 0 AS deprecated, n_name AS schema, n_nationkey AS load_pos FROM nation)"


def _schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("n"), F.col("n_regionkey").cast("string")).alias("schema_id"), F.concat(F.col("n_nationkey").cast("string"), F.lit(".0.1")).alias("version"), (F.col("n_nationkey") % 3 == 0).alias("deprecated"), F.col("n_name").alias("schema"), F.col("n_nationkey").alias("load_pos"))


@query(f"""WITH {_SQL_SCHEMAS}, a AS (SELECT * FROM schemas WHERE NOT deprecated)
SELECT 'latest' AS way, schema_id, arg_max(version, load_pos) AS version, arg_max(schema, load_pos) AS schema FROM a GROUP BY schema_id
UNION ALL SELECT 'v1', schema_id, arg_max(version, load_pos), arg_max(schema, load_pos) FROM a WHERE starts_with(version, '1') GROUP BY schema_id
UNION ALL SELECT 'listed', schema_id, version, CAST(deprecated AS VARCHAR) FROM schemas""")
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last active schema of each id, the one of a version's beginning, and all that there are."""
    s = _schemas(spark, sf_dir)
    out = readers.latest_schemas(s).withColumn("way", F.lit("latest"))
    for k in range(5):
        out = out.unionByName(readers.schema_of(s, f"n{k}:v1").withColumn("way", F.lit("v1")))
    listed = readers.listed_schemas(s).select("schema_id", "version", F.col("deprecated").cast("string").alias("schema"), F.lit("listed").alias("way"))
    return out.unionByName(listed).select("way", "schema_id", "version", "schema")


TEMPLATES = [
    {"form_type": "supply", "page_size": [600, 800], "versions": [{"version": 1, "form_identifier": "A", "fields": [{"field_key": "nsn", "bbox": [10, 20, 110, 60]}]}, {"version": 2, "form_identifier": "B", "page_size": [1200, 1600], "fields": [{"field_key": "nsn", "bbox": [20, 40, 220, 120]}, {"field_key": "total", "region_type": "table", "bbox": [0, 0, 50, 50]}]}]},
    {"form_type": "bid", "version": "7", "fields": [{"field_key": "name", "bbox": [1, 2, 3, 4]}]},
]


@query("""WITH v(form_type, version, form_identifier, ord) AS (VALUES ('supply', '1', 'A', 0), ('supply', '2', 'B', 1), ('bid', '7', NULL, 0)),
f(form_type, version, page_w, field_key, region_type, x2) AS (VALUES ('supply', '1', 600, 'nsn', 'text', 110), ('supply', '2', 1200, 'nsn', 'text', 220), ('supply', '2', 1200, 'total', 'table', 50), ('bid', '7', 0, 'name', 'text', 3)),
d AS (SELECT o_orderkey AS doc_id, CASE o_orderkey % 3 WHEN 0 THEN 'supply' WHEN 1 THEN 'bid' ELSE 'other' END AS form_type, CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' END AS form_identifier FROM orders),
c AS (SELECT d.doc_id, d.form_type, (SELECT arg_min(v.version, CASE WHEN v.form_identifier = d.form_identifier THEN 0 ELSE 100 END + v.ord) FROM v WHERE v.form_type = d.form_type) AS version FROM d)
SELECT doc_id, c.version, page_w, field_key, region_type, x2 FROM c JOIN f ON c.form_type = f.form_type AND c.version = f.version""")
def template_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the template's version that has a document's identifier, else of the first, with the version's page size or the file's."""
    rows = readers.template_rows(spark, TEMPLATES)
    versions = rows.groupBy("form_type", "version", "form_identifier").agg(F.min("version_ord").alias("ord"))
    o = _table(spark, sf_dir, "orders")
    form, mark = _pick(("supply", "bid", "other"), F.col("o_orderkey") % 3), F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B")
    docs = layout.template_version(versions, o.select(F.col("o_orderkey").alias("doc_id"), form.alias("form_type"), mark.alias("form_identifier")))
    return docs.join(rows.drop("form_identifier"), ["form_type", "version"]).select("doc_id", "version", "page_w", "field_key", "region_type", "x2")


@query("""SELECT page_id, 'doc' || (page_id // 3) || CASE WHEN page_id % 2 = 0 THEN '/p' || (page_id % 3) ELSE '' END AS document FROM pages""")
def output_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document that a run's output belongs to, by its path."""
    n = F.col("page_id")
    page = F.when(n % 2 == 0, F.concat(F.lit("/p"), (n % 3).cast("string"))).otherwise("")
    path = F.concat(F.lit("file:/data/runs/r1/doc"), F.floor(n / 3).cast("string"), page, F.lit("/out.json"))
    return _table(spark, sf_dir, "pages").select("page_id", readers.document_of_path(path, "/runs/r1").alias("document"))


@query("""SELECT strftime(ts, '%Y-%m-%d %H') AS folder FROM events WHERE event_type <> 'view' EXCEPT SELECT strftime(ts, '%Y-%m-%d %H') FROM events WHERE event_type = 'view'""")
def new_run_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").withColumn("folder", F.date_format("ts", "yyyy-MM-dd HH"))
    return readers.new_folders(e.where("event_type <> 'view'"), e.where("event_type = 'view'"))


EXAMPLES = {"bid": {"common_rules": " be exact ", "examples": [{"field_key": "a", "example_description": "first", "example_response": "1"}, {"field_key": "b", "example_response": "2"}, "broken"]}, "supply": {"example_description": "whole", "example_response": "3"}}


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CASE p_size % 3 WHEN 1 THEN '2' ELSE '1' END WHEN 1 THEN '3' END AS response, CASE WHEN p_partkey % 3 = 0 AND p_size % 3 < 2 THEN 'be exact' END AS common_rules FROM part""")
def prompt_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The example that a field's prompt shows: its own, else its form's."""
    p = _table(spark, sf_dir, "part")
    regions = p.select("p_partkey", _pick(("bid", "supply", "none"), F.col("p_partkey") % 3).alias("form_type"), _pick(("a", "b", "c"), F.col("p_size") % 3).alias("field_key"))
    return readers.example_of(regions, readers.prompt_examples(spark, EXAMPLES)).select("p_partkey", "example.response", "common_rules")


# Sinks


@query("""SELECT o_orderkey, '<document>' || chr(10) || '    <o_orderkey>' || o_orderkey || '</o_orderkey>' || chr(10) || '    <o_orderstatus>' || o_orderstatus || '</o_orderstatus>' || chr(10) || '</document>' AS xml_output, o_orderkey || ',' || o_orderstatus AS csv_output FROM orders""")
def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the formats asked for."""
    o = sinks.serialized(_table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus"], ("xml", "csv"))
    return o.select("o_orderkey", F.trim("xml_output").alias("xml_output"), "csv_output")


@query(f"""WITH {_SQL_FIELDS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(pos AS VARCHAR) AS pos, field_key, CAST(confidence AS VARCHAR) AS confidence, CAST(was_retried AS VARCHAR) AS was_retried FROM fields""")
def csv_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of strings for each field."""
    return sinks.csv_rows(_fields(spark, sf_dir).select("doc_id", "pos", "field_key", "confidence", "was_retried"))


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '{{"doc":' || doc_id || '}}' ELSE '[' || string_agg('{{"key":"' || field_key || '","value":"' || l_returnflag || '"}}', ',' ORDER BY pos) || ']' END AS result FROM fields GROUP BY doc_id""")
def final_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled object of a document, else its flat fields without a title that was read."""
    f = _fields(spark, sf_dir)
    titles = f.select("doc_id", F.lit(-1).alias("pos"), F.lit("document_title").alias("field_key"), F.lit("T").alias("l_returnflag")).distinct()
    rows = sinks.without_title(f.select("doc_id", "pos", "field_key", "l_returnflag").unionByName(titles))
    listed = rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "field_key", "l_returnflag"))), lambda x: F.struct(x["field_key"].alias("key"), x["l_returnflag"].alias("value"))).alias("fields"))
    made = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('{"doc":'), F.col("doc_id").cast("string"), F.lit("}")))
    return listed.select("doc_id", sinks.final_output(made, F.col("fields")).alias("result"))


@query("""WITH t AS (SELECT strftime(ts, '%Y%m%d') AS trial, count(*) AS documents FROM events GROUP BY 1), m AS (SELECT max(trial) AS last FROM t)
SELECT trial, CASE WHEN trial = last THEN -documents ELSE documents END AS documents FROM t, m""")
def trial_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of trials with the last one's entry made anew; the limit is that trial."""
    t = _table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("trial")).agg(F.count("*").alias("documents"))
    last = t.agg(F.max("trial")).first()[0]
    return evals.history(t, t.where(F.col("trial") == last).withColumn("documents", -F.col("documents")), last)


@query(f"""SELECT o_orderkey AS doc_id, 'RQ-20240601-000000-' || o_orderkey || '-' || substr(sha256(o_orderkey || '|2024-06-01 00:00:00'), 1, 6) AS queue_id, 'critical' AS priority, 'total_failure' AS reason, 'review_queue' AS processing_path, 'pending' AS status FROM orders WHERE o_orderstatus = 'P'""")
def failed_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows of documents that no path could read."""
    o = _table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("doc_id"))
    return route.failed_rows(o, F.lit(_NOW).cast("timestamp")).select("doc_id", "queue_id", "priority", "reason", "processing_path", "status")


_SQL_ANSWERED = "SELECT conv_id, turn, text, lead(text) OVER w AS answer, lead(role) OVER w AS next_role, role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"


@query(f"""WITH i AS ({_SQL_ANSWERED}) SELECT conv_id, turn, 'sft' AS format, '이 서식에서 모든 필드를 추출하세요.' AS instruction, answer AS response FROM i WHERE role = 'user' AND next_role = 'assistant' AND answer <> ''
UNION ALL SELECT conv_id, turn, 'classify', '', 'bid' FROM i WHERE role = 'user' AND next_role = 'assistant' AND answer <> ''""")
def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected items as instruction and response, and as forms to classify."""


    w = Window.partitionBy("conv_id").orderBy("turn")
    c = _table(spark, sf_dir, "conversations")
    status = F.when((F.col("role") == "user") & (F.lead("role").over(w) == "assistant"), "approved").otherwise("pending")
    items = c.select("conv_id", "turn", F.struct("conv_id", "turn").alias("doc_id"), status.alias("status"), F.lead("text").over(w).alias("corrected_json"), F.col("text").alias("errors_json"), F.lit("").alias("image_path"), F.lit("").alias("processing_path"), F.lit("bid").alias("form_type"))
    sft = route.training_pairs(items, "sft").select("doc_id.conv_id", "doc_id.turn", F.lit("sft").alias("format"), "instruction", "response")
    return sft.unionByName(route.training_pairs(items, "classify").select("doc_id.conv_id", "doc_id.turn", F.lit("classify").alias("format"), F.lit("").alias("instruction"), F.col("form_type").alias("response")))


@query("""SELECT 'c' || o_custkey AS doc_id, count(*) AS n_pages, round(sum(o_totalprice), 2) AS processing_ms FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1
UNION ALL SELECT 'o' || o_orderkey, 0, round(o_totalprice, 2) FROM orders WHERE o_custkey % 2 = 1""")
def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a service answers: documents, with their pages if they have any."""
    o = _table(spark, sf_dir, "orders")
    parent = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    rows = o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("doc_id"), parent.alias("parent_doc_id"), F.lit(1).alias("page_number"), F.lit("success").alias("status"), F.col("o_totalprice").cast("double").alias("processing_ms"))
    out = sinks.response(rows)
    return out.select("doc_id", F.coalesce(F.size("pages"), F.lit(0)).cast("long").alias("n_pages"), F.round("processing_ms", 2).alias("processing_ms")).withColumn("n_pages", F.greatest("n_pages", F.lit(0)))


@query("""WITH t AS (SELECT r_regionkey, r_name FROM region ORDER BY r_regionkey LIMIT 3)
SELECT '# regions' || chr(10) || chr(10) || '| r_regionkey | r_name |' || chr(10) || '| --- | --- |' || chr(10) || (SELECT string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) FROM t) AS report""")
def region_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the first rows as Markdown: a top-k feature."""
    rows = _table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    return spark.createDataFrame([(sinks.markdown(rows, "regions", most=3),)], "report string")


# Projections and filters

_LABELS = ("doc_title", "Paragraph_Title", "seal", "chart", "formula", "vision_footnote", "unheard", "aside_text", "header_image")
_TYPES = ("header", "header", "seal", "chart", "formula", "footer", "text", "text", "figure")


@query(f"""SELECT p_partkey, {_sql_pick(_TYPES, "p_partkey % 9")} AS region_type, CAST(CASE WHEN p_size * 30 <= 350 THEN 140 WHEN p_size * 30 <= 840 THEN 560 ELSE 1120 END AS INTEGER) AS bucket FROM part""")
def region_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region types of a detector's labels, and the dispatch budget next to a budget."""
    return _table(spark, sf_dir, "part").select("p_partkey", model.region_type(_pick(_LABELS, F.col("p_partkey") % 9)).alias("region_type"), model.nearest_budget((F.col("p_size") * 30).cast("int")).alias("bucket"))


_CONTENTS = ("printed", "handwritten", "signature", "seal", "empty")
_SQL_CELLS = _SQL_LINES + f""", cells AS (SELECT doc_id, 'r_0001' AS region_id, CAST(pos // 2 AS INTEGER) AS "row", CAST(pos % 2 AS INTEGER) AS col, {_sql_pick(_CONTENTS, "l_partkey % 5")} AS content_type,
  CASE WHEN l_suppkey % 3 = 0 THEN 'text ' || l_linenumber END AS text, CASE WHEN l_suppkey % 7 = 0 THEN '결재란' END AS role, pos, l_partkey FROM lines)"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        "doc_id", F.lit("r_0001").alias("region_id"), F.floor(F.col("pos") / 2).cast("int").alias("row"), (F.col("pos") % 2).cast("int").alias("col"), _pick(_CONTENTS, F.col("l_partkey") % 5).alias("content_type"),
        F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("text "), F.col("l_linenumber").cast("string"))).alias("text"), F.when(F.col("l_suppkey") % 7 == 0, "결재란").alias("role"), "pos", "l_partkey",
    )


@query(f"""WITH {_SQL_CELLS} SELECT doc_id, printf('r_0001_r%dc%d', "row", col) AS region_id, CASE content_type WHEN 'printed' THEN 'text' WHEN 'handwritten' THEN 'handwritten_field' WHEN 'signature' THEN 'signature' ELSE 'seal' END AS region_type,
       CASE content_type WHEN 'handwritten' THEN 1120 WHEN 'signature' THEN 140 ELSE 560 END AS pixel_budget FROM cells WHERE content_type <> 'empty'""")
def cell_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full cells of tables as tasks."""
    return infer.cell_tasks(_cells(spark, sf_dir)).select("doc_id", "region_id", "region_type", "pixel_budget")


@query(f"""WITH {_SQL_CELLS}, t AS (SELECT *, CASE WHEN pos % 3 = 0 THEN 'read ' || pos ELSE coalesce(text, CASE WHEN content_type <> 'empty' THEN '(' || content_type || ')' ELSE '' END) END AS shown FROM cells),
r AS (SELECT doc_id, region_id, "row", string_agg(shown, ' | ' ORDER BY col, shown) AS line FROM t GROUP BY ALL)
SELECT r.doc_id, string_agg(line, chr(10) ORDER BY "row", line) AS matrix, (SELECT bool_or(coalesce(contains(role, '결재'), false)) FROM cells c WHERE c.doc_id = r.doc_id) AS approval FROM r GROUP BY r.doc_id""")
def table_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of a table's cells, row by row, and whether it has a role in an approval."""
    cells = _cells(spark, sf_dir)
    read = cells.where("pos % 3 = 0").select("doc_id", F.format_string("%s_r%dc%d", "region_id", "row", "col").alias("region_id"), F.concat(F.lit("read "), F.col("pos").cast("string")).alias("content"))
    return infer.table_context(cells, read).join(infer.approval_tables(cells), ["doc_id", "region_id"]).select("doc_id", "matrix", "approval")


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, 'text_line_' || (pos + 1) AS field_key, round(confidence * 0.7, 4) AS confidence, round(confidence * 0.7, 4) < 0.5 AS is_flagged FROM fields""")
def fallback_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the fallback reader's lines."""
    lines = _fields(spark, sf_dir).select("doc_id", "pos", F.col("confidence").alias("score"), F.lit("x").alias("text"))
    return infer.fallback_fields(lines).select("doc_id", "field_key", "confidence", "is_flagged")


_KEYS = ("issue_date", "date", "nsn", "quantity", "unit_price", "grand_total", "name", "stock_qty", "dated")


@query(f"""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'number' ELSE {_sql_pick(("date", "date", "code", "quantity", "amount", "amount", "text", "quantity", "text"), "p_partkey % 9")} END AS data_type FROM part""")
def property_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data types of a schema's properties."""
    kind = F.when(F.col("p_size") % 4 == 0, "integer").otherwise("string")
    return _table(spark, sf_dir, "part").select("p_partkey", model.property_type(_pick(_KEYS, F.col("p_partkey") % 9), kind).alias("data_type"))


@query(f"""WITH {_SQL_REGIONS}, p AS (SELECT doc_id, region_id, pos, CASE region_type WHEN 'text' THEN 'read' || chr(10) || 'plain' || chr(10) || '{{}}' WHEN 'seal' THEN 'read' || chr(10) || 'red' ELSE '' END AS base,
  CASE WHEN pos % 2 = 0 THEN repeat('ab', 120) ELSE ' ' END AS hint, {"CASE region_type WHEN 'table' THEN 1120 WHEN 'header' THEN 140 WHEN 'footer' THEN 140 ELSE 560 END"} AS pixel_budget FROM regions)
SELECT doc_id, region_id, CASE WHEN pos % 2 = 0 THEN base || chr(10) || chr(10) || 'OCR: ' || repeat('ab', 100) || '…' ELSE base END AS prompt, pixel_budget FROM p""")
def prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of regions from templates, with a hint that is cut."""
    t = spark.createDataFrame([("f", "text", "read", "plain", None, "{}"), ("f", "seal", "read", "red", None, None)], "form_type string, region_type string, system string, hint string, example string, schema string")
    r = _regions(spark, sf_dir).withColumns({"form_type": F.lit("f"), "order_idx": F.col("pos")})
    made = infer.prompts(r, t)
    hint = F.when(F.col("order_idx") % 2 == 0, F.repeat(F.lit("ab"), F.lit(120))).otherwise(" ")
    return made.select("doc_id", "region_id", infer.with_hint(F.col("prompt"), hint).alias("prompt"), "pixel_budget")


@query(f"""WITH {_SQL_LINES}, r AS (SELECT doc_id, pos, 'r' || pos AS region_id, CASE WHEN l_partkey % 4 = 0 THEN 'S6' ELSE 'S2' END AS skill_name, l_returnflag AS content, round(1 - l_discount, 4) AS confidence, pos % 2 = 0 AS is_cell FROM lines),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY is_cell, pos) - 1 AS INTEGER) AS place FROM r)
SELECT doc_id, place AS pos, region_id AS field_key, content AS raw_value, CASE skill_name WHEN 'S6' THEN 'flag' ELSE 'text' END AS data_type, confidence FROM o""")
def skill_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the readers, then those of cells, as fields."""
    r = _lines(spark, sf_dir).select("doc_id", "pos", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("region_id"), F.when(F.col("l_partkey") % 4 == 0, "S6").otherwise("S2").alias("skill_name"), F.col("l_returnflag").alias("content"), F.round(1 - F.col("l_discount"), 4).alias("confidence"))
    both = infer.with_cells(r.where("pos % 2 = 1"), r.where("pos % 2 = 0"))
    return infer.skill_fields(both).select("doc_id", "pos", "field_key", "raw_value", "data_type", "confidence")


@query(f"""WITH {_SQL_REGIONS} SELECT doc_id, printf('r_%04d', row_number() OVER (PARTITION BY doc_id ORDER BY pos)) AS region_id, CASE WHEN y2 <= 48 THEN 'header' WHEN y1 >= 552 THEN 'footer' ELSE 'text' END AS placed
FROM regions WHERE confidence >= 0.9 AND (x2 - x1) * (y2 - y1) >= 360 AND x2 - x1 >= 30 AND y2 - y1 >= 30""")
def region_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections that are sure, large and wide enough, numbered anew, with their type by place."""
    r = layout.without_micro(layout.large_enough(layout.scored(_regions(spark, sf_dir), 0.9), F.lit(360_000)), 30)
    return layout.renumbered(r).select("doc_id", "region_id", layout.position_type(F.col("box"), F.lit(600)).alias("placed"))


@query(f"""WITH {_SQL_REGIONS}, r AS (SELECT doc_id, region_id, region_type, doc_id % 3 AS schema, CASE WHEN pos % 2 = 0 THEN 'k' END AS field_key FROM regions)
SELECT doc_id, region_id, CASE WHEN doc_id % 4 = 0 THEN 'S3' WHEN schema = 0 THEN 'guided' ELSE 'S2' END AS reader FROM r WHERE schema <> 0 OR field_key IS NOT NULL""")
def region_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions to read where a schema has rules, and who reads them."""
    r = _regions(spark, sf_dir).withColumns({"schema_id": (F.col("doc_id") % 3).cast("string"), "field_key": F.when(F.col("pos") % 2 == 0, "k")})
    ruled = spark.createDataFrame([("0", "k")], "schema_id string, field_key string")
    return P.keyed_regions(r, ruled).select("doc_id", "region_id", P.reader_of(F.col("region_type"), F.col("doc_id") % 4 == 0, F.col("schema_id") == "0").alias("reader"))


@query("""SELECT o_orderkey, path, value, stated FROM (SELECT o_orderkey, unnest([{'path': 'head.a.b.c.d.e', 'value': o_orderpriority, 'stated': CAST(NULL AS DOUBLE)}, {'path': 'items[0]', 'value': CASE WHEN o_orderkey % 2 = 0 THEN 'O' END, 'stated': 0.25}, {'path': 'items[1].note', 'value': CAST(o_custkey AS VARCHAR), 'stated': NULL}]) AS u FROM orders) t, LATERAL (SELECT u.path AS path, u.value AS value, u.stated AS stated)""")
def nested_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of nested objects at any depth, of which some state their own confidence."""
    o = _table(spark, sf_dir, "orders")
    mark = F.when(F.col("o_orderkey") % 2 == 0, '"O"').otherwise("null")
    text = F.concat(F.lit('{"analysis":{"x":1},"flag":true,"empty":"","head":{"a":{"b":{"c":{"d":{"e":"'), "o_orderpriority", F.lit('"}}}},"gone":null},"items":[{"result":'), mark, F.lit(',"result_confidence":0.25},{"note":'), F.col("o_custkey").cast("string"), F.lit("}]}"))
    return assemble.json_leaves(o.select("o_orderkey", text.alias("assembled")), key="o_orderkey")


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, field_key FROM fields WHERE confidence < 0.95 AND NOT was_retried AND pos % 2 = 0""")
def retry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak fields that were read once and have a region."""
    f = _fields(spark, sf_dir).withColumn("region_id", F.concat(F.lit("r"), F.col("pos").cast("string")))
    return route.retry_candidates(f, f.where("pos % 2 = 0").select("doc_id", "region_id"), 0.95).select("doc_id", "field_key")


@query(f"""WITH {_SQL_FIELDS}, a AS (SELECT *, confidence < 0.95 AND NOT was_retried AND pos % 2 = 0 AS weak, round(0.9 + (l_suppkey % 10) / 100.0, 4)::DOUBLE AS again FROM fields)
SELECT doc_id, field_key, CASE WHEN weak AND again > confidence THEN 'budget 1120' ELSE 'first' END AS corrected_value, CASE WHEN weak THEN greatest(confidence, again) ELSE confidence END AS confidence, was_retried OR weak AS was_retried FROM a""")
def second_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields after a second reading, with the next budget, of the weak ones; the answers are replayed."""
    f = _fields(spark, sf_dir).withColumns({"region_id": F.concat(F.lit("r"), F.col("pos").cast("string")), "corrected_value": F.lit("first")})
    regions = f.where("pos % 2 = 0").select("doc_id", "region_id", F.lit(560).alias("pixel_budget"))
    said = f.select("doc_id", "region_id", F.round(0.9 + (F.col("l_suppkey") % 10) / 100, 4).cast("double").alias("confidence"))

    def answers(tasks: DataFrame) -> DataFrame:
        return tasks.join(said, ["doc_id", "region_id"]).select("doc_id", "region_id", F.concat(F.lit("budget "), F.col("pixel_budget").cast("string")).alias("content"), F.array().cast("array<double>").alias("logprobs"), F.lit("text").alias("content_type"), "confidence")

    return P.read_again(f, regions, answers, 0.95).select("doc_id", "field_key", "corrected_value", "confidence", "was_retried")


# Joins


@query(f"""WITH {_SQL_REGIONS} SELECT doc_id, region_id, 'read ' || region_type AS said, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos DESC) AS INTEGER) AS turn FROM regions WHERE region_type <> 'seal'
UNION ALL SELECT doc_id, region_id, 'no instruction: ' || region_id, NULL FROM regions WHERE region_type = 'seal'""")
def instructed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions in reading order with their instruction, and a warning for each without one."""
    r = _regions(spark, sf_dir).withColumn("order_idx", -F.col("pos"))
    made = r.where("region_type <> 'seal'").select("doc_id", "region_id", F.concat(F.lit("read "), "region_type").alias("said"))
    found, missing = route.instructed(r, made)
    return found.select("doc_id", "region_id", "said", "turn").unionByName(missing.select("doc_id", "region_id", F.col("warning").alias("said"), F.lit(None).cast("int").alias("turn")))


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, pos, CASE WHEN pos % 3 = 0 THEN 'region_' || pos ELSE field_key END AS field_key FROM fields""")
def resolved_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by the key of their region, where it has one."""
    f = _fields(spark, sf_dir).select("doc_id", "pos", "field_key", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("region_id"))
    keys = f.where("pos % 3 = 0").select("doc_id", "region_id", F.concat(F.lit("region_"), F.col("pos").cast("string")).alias("field_key"))
    return assemble.resolved(f, keys).select("doc_id", "pos", "field_key")


_SQL_RANKS = ", ".join(f"({k}, '{r}')" for k, r in enumerate(model.RANKS))


@query(f"""WITH d(ord, entry) AS (VALUES {_SQL_RANKS}), v AS (SELECT c_custkey, (SELECT entry FROM d WHERE ord = c_custkey % 19) || CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '님' WHEN 2 THEN ' 계급입니다' ELSE 'abc' END AS raw FROM customer),
r AS (SELECT c_custkey, raw, entry, ord, length(raw) - length(entry) AS distance FROM v JOIN d ON starts_with(raw, entry))
SELECT c_custkey, CASE WHEN min(distance) <= 2 THEN arg_min(entry, distance * 100 + ord) ELSE any_value(raw) END AS rank FROM r GROUP BY c_custkey""")
def rank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks with a few signs too many put right. What begins with an entry is as many edits from it as it has signs more, and no entry is nearer."""
    n = F.col("c_custkey")
    tail = F.when(n % 4 == 0, "").when(n % 4 == 1, "님").when(n % 4 == 2, " 계급입니다").otherwise("abc")
    return _table(spark, sf_dir, "customer").select("c_custkey", correct.rank_normalized(F.concat(_pick(model.RANKS, n % 19), tail)).alias("rank"))


@query(f"""WITH d(ord, entry) AS (VALUES (0, '261'), (1, '262'), (2, '4771')), o(ord, entry) AS (VALUES (0, 'BUILDING'), (1, 'MACHINES')),
v AS (SELECT c_custkey, CAST(c_custkey % 300 AS VARCHAR) AS code, c_mktsegment AS office FROM customer),
r AS (SELECT *, (SELECT arg_min(entry, levenshtein(code, entry) * 100 + ord) FROM d) AS e, (SELECT min(levenshtein(code, entry)) FROM d) AS x, (SELECT arg_min(entry, levenshtein(office, entry) * 100 + ord) FROM o) AS f, (SELECT min(levenshtein(office, entry)) FROM o) AS y FROM v)
SELECT c_custkey, CASE WHEN x <= 2 THEN e ELSE code END AS industry_class_number, CASE WHEN y <= 2 THEN f ELSE office END AS issuing_office, CASE WHEN c_custkey % 2 = 0 THEN 'HOME' ELSE 'there' END AS business_location FROM r""")
def dictionary_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, offices and places put right by dictionaries; what is far from all entries stays."""
    n = F.col("c_custkey")
    d = _table(spark, sf_dir, "customer").select("c_custkey", (n % 300).cast("string").alias("industry_class_number"), F.col("c_mktsegment").alias("issuing_office"), F.lit("there").alias("business_location"), F.when(n % 2 == 0, "home street").otherwise("road").alias("address"))
    out = correct.corrected(d, {"cities": (), "aliases": {"home": "HOME"}, "codes": ("261", "262", "4771"), "offices": ("BUILDING", "MACHINES")})
    return out.select("c_custkey", "industry_class_number", "issuing_office", "business_location")


@query(f"""WITH {_SQL_LINES} SELECT doc_id, pos, CASE WHEN pos % 2 = 0 THEN CAST(l_quantity AS INTEGER) END AS "row", CASE WHEN pos % 2 = 0 THEN CAST(l_linenumber AS INTEGER) END AS col FROM lines""")
def cell_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of cells by their region ids; ids of another table have none."""
    table = F.when(F.col("pos") % 2 == 0, "t_1").otherwise("t_2")
    region = F.format_string("t_1_r%dc%d", F.col("l_quantity").cast("int"), F.col("l_linenumber").cast("int"))
    return _lines(spark, sf_dir).select("doc_id", "pos", X.cell_place(region, table).alias("p")).select("doc_id", "pos", "p.row", "p.col")


@query("""SELECT o_orderkey AS doc_id, CAST(o_custkey % 3 AS INTEGER) AS retry_stats FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey * 10, 7 FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of documents and of the pages nested in them."""
    o = _table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0")
    page = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.struct((F.col("o_orderkey") * 10).alias("doc_id"), F.lit(7).cast("int").alias("retry_stats"))))
    return evals.run_metric(o.select(F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 3).cast("int").alias("retry_stats"), page.alias("pdf_pages")))


@query("""WITH t AS (SELECT DISTINCT strftime(ts, '%Y%m%d%H') AS trial FROM events) SELECT max(trial) AS trial FROM t WHERE trial < '2024010900' AND substr(trial, 10, 1) <> '3'""")
def previous_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest trial before a given one that can be read."""
    t = _table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMddHH").alias("trial")).distinct().withColumn("readable", F.substring("trial", 10, 1) != "3")
    return evals.previous_trial(t, "2024010900")


# Scores, geometry and images


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, count(confidence) AS sub_confidence_count, round(min(confidence), 4) AS confidence_min, round(avg(confidence) + 1e-9, 3) AS confidence_mean, count(*) FILTER (confidence < 0.75) AS low_conf_count
FROM (SELECT doc_id, CASE WHEN pos % 2 = 0 THEN confidence - 0.2 ELSE confidence END AS confidence FROM fields) GROUP BY doc_id""")
def leaf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fields(spark, sf_dir).withColumn("confidence", F.when(F.col("pos") % 2 == 0, F.col("confidence") - 0.2).otherwise(F.col("confidence")))
    means = f.groupBy("doc_id").agg(F.round(F.avg("confidence") + 1e-9, 3).alias("confidence_mean"))
    return evals.leaf_metrics(f).drop("confidence_mean").join(means, "doc_id")


@query("""WITH p AS (SELECT p_partkey AS id, CAST(200 + p_partkey * 37 % 3000 AS INTEGER) AS w, CAST(300 + p_partkey * 53 % 4000 AS INTEGER) AS h, p_size AS s, CASE WHEN p_size % 3 = 0 THEN p_size * 9 ELSE 0 END AS hint FROM part),
d AS (SELECT *, CAST(CASE WHEN hint > 0 THEN hint ELSE least(600, greatest(72, (CAST(trunc(h / (297 / 25.4)) AS INTEGER) + CAST(trunc(w / (210 / 25.4)) AS INTEGER)) // 2)) END AS INTEGER) AS dpi FROM p),
b AS (SELECT *, CASE WHEN dpi < 150 THEN 'low' WHEN dpi < 250 THEN 'mid' ELSE 'high' END AS band, CAST(trunc(dpi / 25.4 * 2.5) AS INTEGER) AS side FROM d)
SELECT id, dpi, band, greatest(7, side + CASE WHEN side % 2 = 0 THEN 1 ELSE 0 END) AS side, CASE WHEN s * 5 < 80 THEN 'dark' WHEN s * 5 > 200 THEN 'bright' ELSE 'normal' END AS light, dpi < 150 AS fusion,
       greatest(1, CAST(trunc(w * CASE WHEN greatest(w, h) > 1000 THEN 1000.0::DOUBLE / greatest(w, h) ELSE 1.0::DOUBLE END) AS INTEGER)) AS width, CAST(trunc(sqrt(s * 784.0)) AS INTEGER) AS longest FROM b""")
def page_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution, its band, the binarising window, the light's band and the sizes of page images."""
    n, s = F.col("p_partkey"), F.col("p_size")
    p = _table(spark, sf_dir, "part").select(n.alias("id"), (200 + n * 37 % 3000).cast("int").alias("w"), (300 + n * 53 % 4000).cast("int").alias("h"), s.alias("s"), F.when(s % 3 == 0, s * 9).otherwise(0).alias("hint"))
    p = p.withColumn("dpi", G.estimated_dpi(F.col("w"), F.col("h"), F.col("hint").cast("int")))
    size = G.fitted(F.col("w"), F.col("h"), F.lit(1000))
    return p.select("id", "dpi", G.dpi_band(F.col("dpi")).alias("band"), G.sauvola_window(F.col("dpi")).alias("side"), G.brightness_band(F.col("s") * 5).alias("light"), layout.uses_fusion(F.col("dpi")).alias("fusion"), size["width"].alias("width"), G.longest_side(F.col("s")).alias("longest"))


@query(f"""WITH {_SQL_LINES}, s AS (SELECT doc_id, pos, l_partkey % 256 AS brightness, CAST(l_quantity AS DOUBLE) AS contrast, (l_suppkey * 13 % 900)::DOUBLE AS sharpness, l_discount::DOUBLE AS ink, CASE WHEN pos % 2 = 0 THEN 'low' ELSE 'mid' END AS band FROM lines)
SELECT doc_id, pos, CAST(round(CAST(CAST((CASE WHEN brightness < 50 THEN 0.3 WHEN brightness > 220 THEN 0.6 ELSE 1.0 END::DOUBLE + least(1.0, contrast / 60) + least(1.0, sharpness / CASE WHEN band = 'low' THEN 200 ELSE 500 END) + CASE WHEN ink < 0.01 THEN 0.1 WHEN ink > 0.8 THEN 0.4 ELSE 1.0 END::DOUBLE) / 4 * CASE WHEN band = 'low' THEN 0.85 ELSE 1.0 END::DOUBLE AS VARCHAR) AS DECIMAL(30, 20)), 4) AS DOUBLE) AS quality FROM s""")
def image_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of page images by their statistics."""
    band = F.when(F.col("pos") % 2 == 0, "low").otherwise("mid")
    score_ = G.quality_score(F.col("l_partkey") % 256, F.col("l_quantity").cast("double"), (F.col("l_suppkey") * 13 % 900).cast("double"), F.col("l_discount").cast("double"), band)
    return _lines(spark, sf_dir).select("doc_id", "pos", score_.alias("quality"))


@query(f"""WITH {_SQL_REGIONS}, t AS (SELECT doc_id, pos, (x2 - x1) * (y2 - y1) AS area, CASE WHEN pos % 2 = 0 THEN 4 ELSE 5 END AS n_points, row_number() OVER (PARTITION BY doc_id ORDER BY (x2 - x1) * (y2 - y1) DESC, pos) AS turn FROM regions)
SELECT doc_id, arg_min(pos, turn) AS pos, min(turn)::INTEGER AS turn FROM t WHERE turn <= 3 AND n_points = 4 GROUP BY doc_id""")
def page_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest contour with four corners among a page's three largest."""
    r = _regions(spark, sf_dir)
    contours = r.select("doc_id", "pos", G.area(F.col("box")).alias("area"), F.when(F.col("pos") % 2 == 0, 4).otherwise(5).alias("n_points"))
    return evals.page_outline(contours, most=3).select("doc_id", "pos", "turn")


@query(f"""WITH {_SQL_FIELDS}, p AS (SELECT doc_id, pos, field_key, data_type, confidence, [-(CAST(l_quantity AS INTEGER) % 5) / 10.0, -0.25, -0.5, -0.125, -0.0625][1:pos + 1] AS lps FROM fields),
c AS (SELECT *, CASE data_type WHEN 'amount' THEN 4 WHEN 'code' THEN 5 WHEN 'date' THEN 3 ELSE 5 END AS expected, len(lps) AS n FROM p),
s AS (SELECT *, round(least(1.0, greatest(0.0, exp(greatest(CAST(list_sum(lps) AS DOUBLE) / n, -20)) * least(1.0, sqrt(expected / CAST(n AS DOUBLE))))), 4) AS score FROM c)
SELECT doc_id, pos, score AS confidence, ({"CASE data_type WHEN 'amount' THEN 0.99 WHEN 'date' THEN 0.95 WHEN 'code' THEN 0.97 ELSE 0.90 END"})::DOUBLE AS least, score < ({"CASE data_type WHEN 'amount' THEN 0.99 WHEN 'date' THEN 0.95 WHEN 'code' THEN 0.97 ELSE 0.90 END"})::DOUBLE AS is_flagged, CAST(n AS INTEGER) AS n_tokens, round(CAST(list_sum(lps) AS DOUBLE) / n, 4) AS logprob FROM s""")
def scored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with the confidence of their tokens, the least of their type, and the mean that a run's snapshot has."""
    f = _fields(spark, sf_dir)
    first = -(F.col("l_quantity").cast("int") % 5) / 10
    lps = F.slice(F.array(first, *[F.lit(x) for x in (-0.25, -0.5, -0.125, -0.0625)]), F.lit(1), F.col("pos") + 1)
    scored = infer.scored_fields(f.withColumns({"token_logprobs": lps, "corrected_value": F.lit("x")}))
    means = evals.snapshot(scored, F.lit(1)).select("doc_id", "field_key", "logprob")
    return scored.join(means, ["doc_id", "field_key"]).select("doc_id", "pos", "confidence", "least", "is_flagged", "n_tokens", "logprob")


# Answers of models, replayed


_SQL_ANSWERS = """SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN 'Here: ```json' || chr(10) || props || chr(10) || '``` done' WHEN 2 THEN 'so {"k": ' || (event_id % 50) || '} it is' WHEN 3 THEN '[' || props || ']' WHEN 4 THEN 'no object' ELSE '{"value": {"k": 1}' END AS content FROM events"""


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    text = F.when(n % 6 == 0, F.col("props")).when(n % 6 == 1, F.concat(F.lit("Here: ```json\n"), "props", F.lit("\n``` done"))).when(n % 6 == 2, F.concat(F.lit('so {"k": '), (n % 50).cast("string"), F.lit("} it is")))
    text = text.when(n % 6 == 3, F.concat(F.lit("["), "props", F.lit("]"))).when(n % 6 == 4, "no object").otherwise('{"value": {"k": 1}')
    return _table(spark, sf_dir, "events").select("event_id", text.alias("content"))


@query(f"""WITH a AS ({_SQL_ANSWERS}), t AS (SELECT event_id, content, regexp_extract(content, '(?s)```(?:json)?\\s*\\n?(.*?)\\n?```', 1) AS fence, regexp_extract(content, '\\{{[^{{}}]*\\}}', 0) AS part FROM a),
f AS (SELECT event_id, content, CASE WHEN json_valid(content) THEN content WHEN fence <> '' AND json_valid(fence) THEN fence WHEN event_id % 6 <> 5 AND part <> '' AND json_valid(part) THEN part END AS parsed FROM t)
SELECT event_id, CASE WHEN json_type(parsed) = 'OBJECT' THEN CAST(json_extract(parsed, '$.k') AS INTEGER) END AS k, parsed IS NOT NULL AS any_parsed,
       CASE WHEN parsed IS NULL THEN content WHEN json_type(parsed) = 'OBJECT' THEN json_extract_string(parsed, '$.k') ELSE replace(parsed, ' ', '') END AS unwrapped FROM f""")
def tolerant_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in answers, by the first way that parses: whole, fenced, or within braces; lists count only where any value may; and the plain value without wrappers."""
    a = _answers(spark, sf_dir)
    c = F.col("content")
    return a.select("event_id", X.json_at(X.tolerant_json(c), "k", "int").alias("k"), X.tolerant_json(c, objects_only=False).isNotNull().alias("any_parsed"), X.any_unwrapped(c, F.lit("value")).alias("unwrapped"))


@query("""SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'bid' WHEN 1 THEN 'supply' ELSE 'unknown' END AS form_type, CASE o_orderkey % 4 WHEN 0 THEN 0.75 WHEN 1 THEN 0.7788 ELSE 0.5 END::DOUBLE AS form_confidence, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 = 0 THEN 'F-7' END AS form_identifier FROM orders""")
def classified_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of documents by a model's answers: stated, named in plain words with the tokens' confidence, or unknown."""
    n = F.col("o_orderkey")
    mark = F.when(n % 8 == 0, " F-7 ").otherwise(" ")
    text = F.when(n % 4 == 0, F.concat(F.lit('{"form_type": " BID ", "confidence": 0.75, "form_identifier": "'), mark, F.lit('"}'))).when(n % 4 == 1, "this is a supply form").otherwise("who knows")
    logprobs = F.when(n % 4 == 1, F.array(F.lit(-0.5), F.lit(0.0))).otherwise(F.array().cast("array<double>"))
    a = _table(spark, sf_dir, "orders").select(n.alias("doc_id"), text.alias("content"), logprobs.alias("logprobs"))
    return infer.classification(a, ["bid", "supply"])


@query(f"""WITH {_SQL_LINES} SELECT doc_id, pos, CASE pos % 3 WHEN 0 THEN 'stamp' WHEN 1 THEN 'plain ' || pos ELSE '{{"confidence": 7}}' END AS seal, CASE pos % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS seal_confidence, pos % 3 = 0 AS signed, CASE pos % 3 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS sure,
       CASE WHEN pos % 3 = 0 THEN 0.5 WHEN pos % 3 = 2 THEN 7.0 END::DOUBLE AS stated FROM lines""")
def seal_and_signature_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of seals, signs of signatures, and confidences between 0 and 1, as answers state them."""
    n = F.col("pos") % 3
    text = F.when(n == 0, '{"text": "stamp", "signature_present": true, "confidence": 0.5}').when(n == 1, F.concat(F.lit("plain "), F.col("pos").cast("string"))).otherwise('{"confidence": 7}')
    rows = _lines(spark, sf_dir).select("doc_id", "pos", text.alias("content"))
    s, g = infer.seal_answer(F.col("content")), infer.signature_answer(F.col("content"))
    return rows.select("doc_id", "pos", s["text"].alias("seal"), s["confidence"].alias("seal_confidence"), g["present"].alias("signed"), g["confidence"].alias("sure"), evals.sub_confidence(F.try_parse_json("content")).alias("stated"))


@query(f"""WITH {_SQL_LINES}, f AS (SELECT doc_id, 'r' || pos AS region_id, round(0.6 + l_discount, 4)::DOUBLE AS one, round(0.6 + l_tax * 2, 4)::DOUBLE AS two FROM lines)
SELECT doc_id, region_id, CASE WHEN one < 0.66 AND two > one THEN 'second' ELSE 'first' END AS content, CASE WHEN one < 0.66 THEN greatest(one, two) ELSE one END AS confidence, CASE WHEN one < 0.66 THEN 2 ELSE 1 END AS n_reads FROM f""")
def handwriting_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handwriting that is read once more where the first reading isn't sure; the surer one counts."""
    work = _lines(spark, sf_dir).select("doc_id", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("region_id"), F.round(0.6 + F.col("l_discount"), 4).cast("double").alias("one"), F.round(0.6 + F.col("l_tax") * 2, 4).cast("double").alias("two"))
    turn = iter(("first", "second"))

    def answers(tasks: DataFrame) -> DataFrame:
        name = next(turn)
        return tasks.select("doc_id", "region_id", F.lit(name).alias("content"), F.col("one" if name == "first" else "two").alias("confidence"))

    return infer.read_twice(work, answers, 0.66)


@query(f"""WITH {_SQL_LINES}, t AS (SELECT doc_id, list({{'i': pos, 'kind': CASE WHEN pos % 4 = 3 THEN 'empty' ELSE 'printed' END}} ORDER BY pos) AS cells FROM lines GROUP BY doc_id)
SELECT doc_id, 't1_r' || c.i || 'c0' AS region_id, 'cell ' || c.i AS content, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c.i) AS INTEGER) AS turn FROM (SELECT doc_id, unnest(cells) AS c FROM t) WHERE c.kind <> 'empty'""")
def two_pass_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in two passes: the structure, then what stands in the full cells, in their order."""
    parts = F.transform(F.array_sort(F.collect_list("pos")), lambda p: F.concat(F.lit('{"row_index": '), p.cast("string"), F.lit(', "c": 0, "type": "'), F.when(p % 4 == 3, "Empty").otherwise("printed"), F.lit('"}')))
    tables = _lines(spark, sf_dir).groupBy("doc_id").agg(F.concat(F.lit('{"cells": ['), F.array_join(parts, ", "), F.lit("]}")).alias("content")).withColumn("region_id", F.lit("t1"))

    def second(tasks: DataFrame) -> DataFrame:
        return tasks.select("doc_id", "region_id", F.concat(F.lit("cell "), F.col("row").cast("string")).alias("content"))

    cells, results = infer.two_pass_tables(tables, lambda t: t, second)
    work = infer.cell_tasks(cells).select("doc_id", "region_id", "pos")
    return infer.in_order(results, work).select("doc_id", "region_id", "content", "turn")


@query(f"""WITH {_SQL_LINES}, h AS (SELECT doc_id, string_agg('<tr><td>' || l_returnflag || '</td><td> ' || l_linestatus || ' </td></tr>', '' ORDER BY pos) AS x, count(*) AS n FROM lines GROUP BY doc_id)
SELECT doc_id, CAST(k AS INTEGER) AS "row", col, CASE col WHEN 0 THEN l_returnflag ELSE l_linestatus END AS text, CASE WHEN doc_id % 2 = 0 THEN 0.5 ELSE 0.6065 END::DOUBLE AS confidence
FROM (SELECT doc_id, pos AS k, l_returnflag, l_linestatus, unnest([0, 1]) AS col FROM lines)""")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of tables that a model reads as HTML."""
    cells = F.transform(F.array_sort(F.collect_list(F.struct("pos", "l_returnflag", "l_linestatus"))), lambda x: F.concat(F.lit("<tr><td>"), x["l_returnflag"], F.lit("</td><td> "), x["l_linestatus"], F.lit(" </td></tr>")))
    logprobs = F.when(F.col("doc_id") % 2 == 0, F.array().cast("array<double>")).otherwise(F.array(F.lit(-0.5)))
    a = _lines(spark, sf_dir).groupBy("doc_id").agg(F.array_join(cells, "").alias("content")).withColumns({"region_id": F.lit("t"), "logprobs": logprobs})
    return infer.table_rows(a).select("doc_id", "row", "col", "text", "confidence")


@query(f"""WITH {_SQL_LINES}, d AS (SELECT DISTINCT doc_id FROM lines), a AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'no answer' WHEN 1 THEN 'none' WHEN 2 THEN 'list' ELSE 'object' END AS kind FROM d)
SELECT doc_id, CASE kind WHEN 'object' THEN '{{"header":' || doc_id || '}}' END AS assembled, CASE kind WHEN 'no answer' THEN 'vlm_call_failed' WHEN 'none' THEN 'vlm_call_failed' WHEN 'list' THEN '집계 JSON 파싱 실패' END AS warning,
       (SELECT count(*) FROM lines l WHERE l.doc_id = a.doc_id) + CASE WHEN kind = 'object' THEN 1 ELSE 0 END AS n_fields, CASE WHEN kind = 'object' THEN 'aggregator_blob' ELSE 'r' || (SELECT max(pos) FROM lines l WHERE l.doc_id = a.doc_id) END AS last_field FROM a""")
def official_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The official object that a model makes of what was read, as a field after all others; flat fields and a warning without one."""
    results = _lines(spark, sf_dir).select("doc_id", "pos", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("region_id"), F.lit("S2").alias("skill_name"), F.col("l_returnflag").alias("content"), F.round(1 - F.col("l_discount"), 4).alias("confidence"))
    n = F.col("doc_id")
    text = F.when(n % 4 == 2, "[1]").when(n % 4 == 3, F.concat(F.lit('{"header": '), n.cast("string"), F.lit("}")))
    answers = results.select("doc_id").distinct().where("doc_id % 4 <> 0").select("doc_id", text.alias("content"), F.array(F.lit(-0.1)).alias("logprobs"))
    documents, fields = infer.aggregated(results, answers)
    counts = fields.groupBy("doc_id").agg(F.count("*").alias("n_fields"), F.max_by("field_key", "pos").alias("last_field"))
    return documents.join(counts, "doc_id").select("doc_id", "assembled", "warning", "n_fields", "last_field")


@query(f"""WITH {_SQL_LINES}, r AS (SELECT doc_id, string_agg('[HANDWRITTEN] ' || l_returnflag || ' (r' || pos || ')', chr(10) ORDER BY pos) AS context FROM lines WHERE l_linestatus = 'F' GROUP BY doc_id)
SELECT d.doc_id, coalesce(context, '(no text was read)') AS context FROM (SELECT DISTINCT doc_id FROM lines) d LEFT JOIN r ON d.doc_id = r.doc_id""")
def skill_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the readers read of a document, for one prompt; a placeholder where that is nothing."""
    lines = _lines(spark, sf_dir)
    results = lines.where("l_linestatus = 'F'").select("doc_id", "pos", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("region_id"), F.lit("S3").alias("skill_name"), F.col("l_returnflag").alias("content"))
    tables = spark.createDataFrame([], "doc_id bigint, region_id string, matrix string")
    return infer.context_or_placeholder(lines.select("doc_id").distinct(), infer.skill_context(results, tables))


@query(f"""WITH {_SQL_LINES} SELECT doc_id, pos, CAST(CASE WHEN pos % 2 = 0 THEN greatest(1, least(4, length(l_returnflag || l_linenumber))) ELSE 4 END AS INTEGER) AS n FROM lines""")
def field_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of an answer's tokens are a field's: as many as a scalar has signs, else all."""
    value = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
    lps = F.array(*[F.lit(-x / 10) for x in range(4)])
    return _lines(spark, sf_dir).select("doc_id", "pos", F.size(infer.field_logprobs(value, lps, F.col("pos") % 2 == 0)).alias("n"))


# Assembly and validation


_SQL_VALUES = """CASE pos WHEN 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) WHEN 1 THEN CASE WHEN l_linestatus = 'F' THEN 'true' END WHEN 2 THEN '"' || l_returnflag || '"' WHEN 3 THEN '{"n":' || l_linenumber || '}' END"""
_SQL_ASSEMBLED = f"""v AS (SELECT doc_id, max(CASE pos WHEN 0 THEN j END) AS a, max(CASE pos WHEN 1 THEN j END) AS b, max(CASE pos WHEN 2 THEN j END) AS c, max(CASE pos WHEN 3 THEN j END) AS d FROM (SELECT doc_id, pos, {_SQL_VALUES} AS j FROM lines) GROUP BY doc_id),
made AS (SELECT doc_id, '{{' || array_to_string(list_filter(['"head":{{' || array_to_string(list_filter(['"deep":{{"a":' || a || '}}', '"b":' || b], lambda x: x IS NOT NULL), ',') || '}}', '"c":' || c, '"d":' || d, '"last":"printed"'], lambda x: x IS NOT NULL), ',') || '}}' AS assembled FROM v)"""


def _assembly(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rules_ = spark.createDataFrame([("s", k, f"line_{k}", p) for k, p in enumerate(("head.deep.a", "head.b", "c", "d"))] + [("s", 9, "last", "last")], "schema_id string, ord int, field_key string, path string")
    fixed = spark.createDataFrame([("s", "last", "printed"), ("s", "line_0", "unused")], "schema_id string, field_key string, value string")
    k = F.col("pos")
    value = F.when(k == 0, F.lpad(F.col("l_quantity").cast("int").cast("string"), 4, "0")).when(k == 1, F.when(F.col("l_linestatus") == "F", "true").otherwise("None")).when(k == 2, F.col("l_returnflag")).when(k == 3, F.concat(F.lit('{"line_3": {"d": {"n": '), F.col("l_linenumber").cast("string"), F.lit("}}}"))).otherwise("x")
    fields = _fields(spark, sf_dir).join(_lines(spark, sf_dir).select("doc_id", "pos", "l_linestatus", "l_linenumber"), ["doc_id", "pos"])
    fields = fields.select("doc_id", F.lit("s").alias("schema_id"), "field_key", "pos", "confidence", F.lit("raw").alias("raw_value"), value.alias("corrected_value"))
    return fields, rules_, fixed


@query(f"""WITH {_SQL_LINES}, {_SQL_ASSEMBLED} SELECT doc_id, assembled FROM made""")
def assembled_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields put together as a nested object: numbers, truth values, texts and unwrapped objects, and fixed texts where nothing was read."""
    return assemble.assembled(*_assembly(spark, sf_dir))


@query(f"""WITH {_SQL_LINES}, {_SQL_ASSEMBLED} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN assembled ELSE '{{}}' END AS assembled FROM made""")
def reassembled_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects made again for the documents whose fields have changed."""
    fields, made, fixed = _assembly(spark, sf_dir)
    old = fields.select("doc_id").distinct().withColumn("assembled", F.lit("{}"))
    return assemble.reassembled(old, fields, made, old.where("doc_id % 3 = 0"), fixed)


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, field_key FROM fields WHERE field_key IN ('line_0', 'line_2') UNION ALL SELECT doc_id, field_key || ' is unknown' FROM fields WHERE field_key NOT IN ('line_0', 'line_2', 'line_4')""")
def valid_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that a schema's rules or fixed texts name, but for keys that are no fields, and those that nothing names."""
    f = _fields(spark, sf_dir).withColumns({"schema_id": F.lit("s")})
    f = f.withColumn("field_key", F.when(F.col("field_key") == "line_4", "analysis").otherwise(F.col("field_key")))
    made = spark.createDataFrame([("s", "line_0"), ("s", "analysis")], "schema_id string, field_key string")
    fixed = spark.createDataFrame([("s", "line_2")], "schema_id string, field_key string")
    good = assemble.without_meta(assemble.known(f, made, fixed)).select("doc_id", "field_key")
    return good.unionByName(assemble.ghosts(f, made, fixed).select("doc_id", F.concat("field_key", F.lit(" is unknown")).alias("field_key")))


@query(f"""WITH {_SQL_LINES}, d AS (SELECT doc_id, pos, CAST(l_quantity AS INTEGER) AS q, CAST(l_quantity AS INTEGER) * 3 + l_partkey % 3 AS total, CASE WHEN l_suppkey % 2 = 0 THEN '1234-56-789-0123' ELSE '12-34' END AS nsn, CASE WHEN l_partkey % 5 = 0 THEN ' ' ELSE 'u' END AS unit FROM lines)
SELECT doc_id, pos, 'arith_001' AS rule_id, 'arithmetic' AS error_type, 'high' AS severity, 'total' AS field_ref, '합계 ≠ 수량 × 단가' AS message FROM d WHERE abs(total - q * 3) >= 1
UNION ALL SELECT doc_id, pos, 'code_001', 'code_format', 'medium', 'nsn', 'NSN 형식 불일치 (NNNN-NN-NNN-NNNN)' FROM d WHERE nsn = '12-34'
UNION ALL SELECT doc_id, pos, 'miss_001', 'missing_field', 'high', 'unit_code', '필수 필드 누락: unit_code' FROM d WHERE unit = ' '""")
def form_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by the rules of the supply form, of lines as such forms."""
    d = _lines(spark, sf_dir).select(
        "doc_id", "pos", F.lit("supply_request").alias("form_type"), F.col("l_quantity").cast("int").alias("quantity"), F.lit(3).alias("unit_price"), (F.col("l_quantity").cast("int") * 3 + F.col("l_partkey") % 3).alias("total"),
        F.when(F.col("l_suppkey") % 2 == 0, "1234-56-789-0123").otherwise("12-34").alias("nsn"), F.lit(None).cast("string").alias("k_nsn"), F.when(F.col("l_partkey") % 5 == 0, " ").otherwise("u").alias("unit_code"), F.lit("2024-01-01").alias("request_date"),
    )
    found = rules.with_form_errors(d, {"supply_request": forms.RULES_OF_FORM["supply_request"]}, rules.columns_getter())
    return found.select("doc_id", "pos", F.explode("errors").alias("e")).select("doc_id", "pos", "e.rule_id", "e.error_type", "e.severity", "e.field_ref", "e.message")


@query(f"""WITH {_SQL_LINES}, v AS (SELECT doc_id, pos, CASE l_partkey % 3 WHEN 0 THEN '02 -123-4567' WHEN 1 THEN '12a' ELSE '2024년5월2일' END AS value, ['phone', 'amount', 'date'][CAST(l_partkey % 3 AS INTEGER) + 1] AS data_type, CASE WHEN pos % 2 = 0 THEN 'unit_code' ELSE 'other' END AS field_key FROM lines),
n AS (SELECT *, CASE data_type WHEN 'phone' THEN replace(value, ' ', '') WHEN 'date' THEN '2024년 05월 02일' ELSE value END AS new FROM v)
SELECT doc_id, pos, new AS corrected_value, array_to_string(list_filter([CASE WHEN data_type = 'amount' THEN 'pat_' || field_key || '_amount:arithmetic:12a' END, CASE WHEN field_key = 'unit_code' AND NOT regexp_matches(new, '^\\d{{2,4}}$') THEN 'pat_unit_code:code_format:' || new END], lambda x: x IS NOT NULL), ',') AS errors FROM n""")
def common_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The common patterns on fields: put in form by type, then tested by key."""
    k = (F.col("l_partkey") % 3).cast("int")
    f = _lines(spark, sf_dir).select("doc_id", "pos", _pick(("02 -123-4567", "12a", "2024년5월2일"), k).alias("corrected_value"), _pick(("phone", "amount", "date"), k).alias("data_type"), F.when(F.col("pos") % 2 == 0, "unit_code").otherwise("other").alias("field_key"))
    done = rules.pattern_errors(f, forms.TYPE_PATTERNS, forms.KEY_PATTERNS)
    return done.select("doc_id", "pos", "corrected_value", F.array_join(F.transform("pattern_errors", lambda e: F.concat_ws(":", e["rule_id"], e["error_type"], e["actual"])), ",").alias("errors"))


@query(f"""WITH {_SQL_LINES}, d AS (SELECT doc_id, pos, CAST(l_quantity AS INTEGER) AS q, l_linestatus FROM lines), docs AS (SELECT DISTINCT doc_id, doc_id % 5 = 0 AS other FROM lines),
e AS (SELECT d.doc_id, 1 AS layer, pos, 'pat_nsn' AS rule_id, 'nsn_' || pos AS ref FROM d JOIN docs USING (doc_id) WHERE NOT other AND pos = 0 AND q % 2 = 1
      UNION ALL SELECT doc_id, 2, 0, 'writer', 'writer.name' FROM docs WHERE NOT other AND doc_id % 2 = 0)
SELECT doc_id, 've_' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY layer, pos) AS VARCHAR), 4, '0') AS error_id, rule_id FROM e""")
def numbered_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of whole documents: those of patterns first, then those of rules, numbered by document; other documents have none."""
    lines = _lines(spark, sf_dir)
    value = F.when(F.col("l_quantity").cast("int") % 2 == 1, "bad").otherwise("1234-56-789-0123")
    fields = lines.select("doc_id", "pos", F.when(F.col("pos") == 0, "nsn").otherwise("note").alias("field_key"), value.alias("corrected_value"), F.lit("text").alias("data_type"), F.lit(0.95).alias("confidence"))
    documents = lines.select("doc_id", F.when(F.col("doc_id") % 5 == 0, "other").otherwise("bid").alias("form_type"), F.lit("vlm").alias("processing_path")).distinct()
    leaves = documents.select("doc_id", F.lit("writer.name").alias("path"), F.when(F.col("doc_id") % 2 == 0, " ").otherwise("n").alias("value"), F.lit(None).cast("double").alias("stated"))
    made = {"bid": [{"rule_id": "writer", "type": "NOT_EMPTY", "field": "writer.name"}]}
    _, _, errors = P.validated(documents, fields, leaves, made, (), forms.KEY_PATTERNS)
    return errors.select("doc_id", "error_id", "rule_id")


@query(f"""WITH {_SQL_LINES} SELECT doc_id, pos, CASE WHEN pos % 2 = 0 THEN '{{"team":"t","rank":"대위","name":"n"}}' ELSE 'plain' END AS value FROM lines""")
def synced_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in fields' values with their rank put right."""
    value = F.when(F.col("pos") % 2 == 0, '{"team":"t","rank":"대위님","name":"n"}').otherwise("plain")
    return _lines(spark, sf_dir).select("doc_id", "pos", P.ranks_synced(value).alias("value"))


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, field_key, CASE WHEN pos % 2 = 0 AND l_suppkey % 2 = 0 THEN 'new ' || pos ELSE 'old' END AS corrected_value, CASE WHEN pos % 2 = 0 AND l_suppkey % 2 = 0 THEN 0.8 ELSE 0.5 END::DOUBLE AS confidence, pos % 2 = 0 AS was_retried FROM fields WHERE pos < 6""")
def reasoned_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields after the targets of errors were read once more; an answer counts only if it is surer."""
    f = _fields(spark, sf_dir).where("pos < 6").select("doc_id", "pos", "field_key", F.lit("old").alias("corrected_value"), F.lit(0.5).alias("confidence"), F.lit(False).alias("was_retried"), "l_suppkey")
    errors = f.where("pos % 2 = 0").select("doc_id", "pos", F.lit("arithmetic").alias("error_type"), F.col("field_key").alias("field_ref"), F.lit("m").alias("message"))
    regions = f.select("doc_id", "pos", "field_key", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("region_id"))
    sure = f.select("doc_id", "field_key", (F.col("l_suppkey") % 2 == 0).alias("good"))

    def answers(tasks: DataFrame) -> DataFrame:
        said = F.concat(F.lit('{"'), "field_key", F.lit('": {"v": "new '), F.substring("region_id", 2, 9), F.lit('"}}'))
        return tasks.join(sure, ["doc_id", "field_key"]).select("doc_id", "region_id", said.alias("content"), F.when(F.col("good"), 0.8).otherwise(0.4).alias("confidence"))

    none = spark.createDataFrame([], "field_key string, related_key string, ord int")
    return P.reasoned_again(f.drop("l_suppkey"), errors, regions, none, answers).select("doc_id", "field_key", "corrected_value", "confidence", "was_retried")


# Runs


@query(f"""WITH {_SQL_REGIONS}, w AS (SELECT doc_id, count(*) AS n_before, count(*) FILTER (x2 - x1 < 6 OR y2 - y1 < 6) AS n_micro FROM regions GROUP BY doc_id) SELECT doc_id, n_before, n_micro FROM w""")
def refinement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many regions a page had before its layout was refined, and how many of these were too small."""
    r = _regions(spark, sf_dir)
    order = r.select("doc_id", "region_id", F.col("pos").alias("order_idx"))
    return P.refinement_counts(r, P.refined_layout(r, order)).select("doc_id", "n_before", "n_micro")


_SQL_OUTPUTS = "outputs AS (SELECT o_orderpriority AS form_type, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'review' ELSE 'failed' END AS status, (o_custkey % 100) / 100.0 AS overall_confidence, o_totalprice AS processing_ms, o_custkey % 3 AS validation_error_count, o_custkey % 2 = 0 AS review_queued FROM orders)"


@query(f"""WITH {_SQL_OUTPUTS} SELECT form_type, count(*) AS documents, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'failed') AS failed, round(avg(overall_confidence) + 1e-9, 3) AS overall_confidence,
       CAST(sum(validation_error_count) AS BIGINT) AS validation_errors, count(*) FILTER (review_queued) AS queued FROM outputs GROUP BY form_type""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a run by form type."""
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "review").otherwise("failed")
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("form_type"), status.alias("status"), ((F.col("o_custkey") % 100) / 100).alias("overall_confidence"), F.col("o_totalprice").alias("processing_ms"), (F.col("o_custkey") % 3).alias("validation_error_count"), (F.col("o_custkey") % 2 == 0).alias("review_queued"))
    out = steps.run_summary(rows, "form_type")
    means = rows.groupBy("form_type").agg(F.round(F.avg("overall_confidence") + 1e-9, 3).alias("overall_confidence"))
    return out.drop("overall_confidence", "partial", "processing_ms").join(means, "form_type")


@query("""SELECT o_orderkey, array_to_string(list_distinct(list_filter([CASE WHEN o_custkey % 2 = 0 THEN '[P2] few regions' END, CASE WHEN o_custkey % 3 = 0 THEN '[P2] low resolution' END], lambda x: x IS NOT NULL)).list_sort(), ',') AS warnings FROM orders""")
def warned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of a step, once each, with its name."""
    few = F.when(F.col("o_custkey") % 2 == 0, "few regions")
    made = steps.step_warnings("P2", few, F.when(F.col("o_custkey") % 3 == 0, "low resolution"), few)
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.array_sort(made), ",").alias("warnings"))


_SQL_RUNS = "runs AS (SELECT user_id AS doc_id, hour(ts) % 4 AS run_idx, value AS total_ms, CASE WHEN value > 10 THEN 'vlm' ELSE 'fallback' END AS processing_path, event_type AS form_type, user_id % 2 = 0 AS review_required FROM events)"


@query(f"""WITH {_SQL_RUNS}, c AS (SELECT doc_id, run_idx, count(form_type) AS n, count(DISTINCT form_type) AS k FROM runs GROUP BY ALL), d AS (SELECT doc_id, count(*) FILTER (k = 1) AS n_consistent, count(*) AS n_fields, round(count(*) FILTER (k = 1) / greatest(count(*), 1), 4) AS determinism FROM c GROUP BY doc_id)
SELECT doc_id, count(total_ms) AS n, min(total_ms) AS min, max(total_ms) AS max, count(DISTINCT processing_path) = 1 AS processing_path_consistent, count(DISTINCT form_type) = 1 AS form_type_consistent, count(DISTINCT review_required) = 1 AS review_required_consistent, any_value(n_consistent) AS n_consistent, any_value(n_fields) AS n_fields, any_value(determinism) AS determinism
FROM runs JOIN d USING (doc_id) GROUP BY doc_id""")
def variance_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole variance report of repeated runs, one row for each document."""
    runs = _table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), (F.hour("ts") % 4).alias("run_idx"), F.col("value").alias("total_ms"), F.when(F.col("value") > 10, "vlm").otherwise("fallback").alias("processing_path"), F.col("event_type").alias("form_type"), (F.col("user_id") % 2 == 0).alias("review_required"))
    values = runs.select("doc_id", "run_idx", F.col("run_idx").cast("string").alias("key"), F.col("form_type").alias("value"))
    times, flags, _, score_ = evals.variance(runs, values)
    return times.drop("mean", "std").join(flags, "doc_id").join(score_, "doc_id")


_SQL_DOMAIN_QUEUE = f"q AS (SELECT *, CASE queue_id % 3 WHEN 0 THEN 'bid' WHEN 1 THEN 'supply' ELSE 'other' END AS form_type FROM ({_SQL_QUEUE}))"


@query(f"""WITH {_SQL_DOMAIN_QUEUE} SELECT queue_id, priority, status FROM q WHERE form_type = 'bid' AND status = 'pending' AND CAST(enqueued_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def queue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending items of a form type within some days."""
    q = _queue(spark, sf_dir).withColumns({"form_type": _pick(("bid", "supply", "other"), F.col("queue_id") % 3), "processing_path": F.lit("vlm")})
    return route.queue_search(q, form_type="bid", status="pending", first="2024-01-05", last="2024-01-20").select("queue_id", "priority", "status")


@query(f"""WITH {_SQL_DOMAIN_QUEUE} SELECT form_type, status, count(*) AS n, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (priority = 'critical') AS critical, round(avg(CASE WHEN status IN ('pending', 'in_review') THEN (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(enqueued_at)) / 6e7 END), 2) AS mean_wait_minutes FROM q GROUP BY ROLLUP (form_type, status)""")
def queue_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and waits by form type and status, with totals."""
    q = _queue(spark, sf_dir).withColumn("form_type", _pick(("bid", "supply", "other"), F.col("queue_id") % 3))
    return route.queue_distribution(q, F.lit(_NOW).cast("timestamp"))
