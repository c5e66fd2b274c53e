"""The engine's queries on the provided tables, and the SQL that gives the same rows.

The tables hold no scanned forms, so each query maps the domain onto them: an order is a
document and its lines are fields or regions; events are runs, checks or trials; pages and
documents are texts to read codes, cells and leaves from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import model
from ..functions import geometry as G
from ..functions import scoring as S
from ..functions import text as X
from ..operators import assemble, correct, evals, infer, layout, reason, route, rules, score
from ..sources import sinks
from ..streaming import queues

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Domain tables from the provided ones, in both languages

_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their place in the order, from 0."""
    order = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER.split(", "))
    return _table(spark, sf_dir, "lineitem").withColumn("pos", F.row_number().over(order) - 1).withColumn("doc_id", F.col("l_orderkey"))


_SQL_LINES = f"lines AS (SELECT *, l_orderkey AS doc_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS INTEGER) AS pos FROM lineitem)"


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("l_partkey") % 400, (F.col("l_suppkey") * 7 + F.col("pos") * 31) % 600
    w, h = 20 + F.col("l_quantity").cast("int") * 6, 10 + F.col("l_partkey") % 90
    kind = F.get(F.array(*[F.lit(t) for t in ("header", "footer", "seal", "table", "text", "text", "text")]), (F.col("l_partkey") % 7).cast("int"))
    box = G.box(x.cast("int"), y.cast("int"), (x + w).cast("int"), (y + h).cast("int"))
    return _lines(spark, sf_dir).select("doc_id", "pos", F.format_string("r_%04d", F.col("pos") + 1).alias("region_id"), kind.alias("region_type"), box.alias("box"), (1 - F.col("l_discount") - F.col("l_tax")).alias("confidence"))


_SQL_REGIONS = (
    _SQL_LINES
    + """, regions AS (
  SELECT doc_id, pos, printf('r_%04d', pos + 1) AS region_id, ['header', 'footer', 'seal', 'table', 'text', 'text', 'text'][CAST(l_partkey % 7 AS INTEGER) + 1] AS region_type,
         CAST(l_partkey % 400 AS INTEGER) AS x1, CAST((l_suppkey * 7 + pos * 31) % 600 AS INTEGER) AS y1,
         CAST(l_partkey % 400 + 20 + CAST(l_quantity AS INTEGER) * 6 AS INTEGER) AS x2, CAST((l_suppkey * 7 + pos * 31) % 600 + 10 + l_partkey % 90 AS INTEGER) AS y2,
         1 - l_discount - l_tax AS confidence
  FROM lines)"""
)


def _flat(df: DataFrame) -> DataFrame:
    """Box corners as columns."""
    return df.select(*[c for c in df.columns if c != "box"], *[F.col("box")[c].alias(c) for c in ("x1", "y1", "x2", "y2")])


def _sql_iou(a: str, b: str) -> str:
    both = f"(greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0) * greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0))"
    return f"({both} / CAST(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1) - {both} AS DOUBLE))"


def _sql_covered(a: str, b: str) -> str:
    both = f"(greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0) * greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0))"
    return f"({both} / CAST(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) AS DOUBLE))"


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as fields of an order."""
    kind = F.get(F.array(*[F.lit(t) for t in ("amount", "date", "text", "code", "flag")]), (F.col("l_partkey") % 5).cast("int"))
    return _lines(spark, sf_dir).select("doc_id", "pos", F.concat(F.lit("line_"), F.col("pos").cast("string")).alias("field_key"), kind.alias("data_type"), F.round(1 - F.col("l_discount"), 4).alias("confidence"), (F.col("l_linestatus") == "F").alias("was_retried"), "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag", "l_suppkey")


_SQL_FIELDS = (
    _SQL_LINES
    + """, fields AS (
  SELECT doc_id, pos, 'line_' || pos AS field_key, ['amount', 'date', 'text', 'code', 'flag'][CAST(l_partkey % 5 AS INTEGER) + 1] AS data_type,
         round(1 - l_discount, 4) AS confidence, l_linestatus = 'F' AS was_retried, l_quantity, l_extendedprice, l_shipdate, l_returnflag, l_suppkey
  FROM lines)"""
)

# Rules of a line of an order; the arithmetic one says that a unit costs about 3000.
LINE_RULES = (
    {"rule_id": "arith", "type": "ARITHMETIC", "result_field": "price", "operands": ["quantity", "unit"], "operator": "multiply", "tolerance": 60000, "severity": "high"},
    {"rule_id": "dates", "type": "DATE_ORDER", "fields": ["ordered", "shipped"], "severity": "medium"},
    {"rule_id": "flag", "type": "REGEX_MATCH", "field": "returnflag", "pattern": "[AN]$", "severity": "low"},
    {"rule_id": "priority", "type": "NOT_EMPTY", "field": "priority", "severity": "critical"},
)
_LINE_COLUMNS = {"price": "l_extendedprice", "quantity": "l_quantity", "returnflag": "l_returnflag"}


def _ruled_fields(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, rules.Getter]:
    """Fields with what the rules read of their order, and how they read it."""
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate", "o_orderpriority", "o_orderstatus")
    joined = _fields(spark, sf_dir).join(orders, "doc_id")
    return joined, rules.columns_getter({k: F.col(v) for k, v in _LINE_COLUMNS.items()} | {
        "unit": F.lit(3000), "ordered": F.date_format("o_orderdate", "yyyy-MM-dd"), "shipped": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "priority": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", " ").otherwise(F.col("o_orderpriority")),
    })


def _line_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, field_key, rule_id, error_type, severity, field_ref) of the fields of orders."""
    joined, get = _ruled_fields(spark, sf_dir)
    found = rules.failures(joined, LINE_RULES, get, "doc_id", "field_key")
    # an error of a line refers to that line
    return found.select("doc_id", "field_key", "rule_id", "error_type", "severity", F.col("field_key").alias("field_ref"))


_SQL_ERRORS = (
    _SQL_FIELDS
    + """, joined AS (SELECT f.*, o_orderdate, o_orderpriority FROM fields f JOIN orders ON doc_id = o_orderkey),
errors AS (
  SELECT doc_id, field_key, 'arith' AS rule_id, 'arithmetic' AS error_type, 'high' AS severity, 0.30 AS penalty FROM joined WHERE abs(l_extendedprice - l_quantity * 3000) >= 60000
  UNION ALL SELECT doc_id, field_key, 'dates', 'date_logic', 'medium', 0.10 FROM joined WHERE CAST(o_orderdate AS DATE) > CAST(l_shipdate AS DATE)
  UNION ALL SELECT doc_id, field_key, 'flag', 'code_format', 'low', 0.15 FROM joined WHERE NOT regexp_matches(l_returnflag, '^[AN]$')
  UNION ALL SELECT doc_id, field_key, 'priority', 'missing_field', 'critical', 0.20 FROM joined WHERE o_orderpriority = '4-NOT SPECIFIED')"""
)
_SQL_LEAST = "CASE data_type WHEN 'amount' THEN 0.99 WHEN 'date' THEN 0.95 WHEN 'code' THEN 0.97 ELSE 0.90 END"


@query(
    f"""WITH {_SQL_ERRORS},
penalties AS (SELECT doc_id, field_key, sum(penalty) AS penalty FROM errors GROUP BY ALL),
done AS (
  SELECT f.doc_id, f.pos, f.field_key, greatest(0, f.confidence - coalesce(CAST(p.penalty AS DOUBLE), 0)) AS less,
         {_SQL_LEAST} + CASE WHEN o_orderpriority = '5-LOW' THEN 0.10 ELSE 0 END AS least, o_orderpriority = '5-LOW' AS fallback, o_orderstatus = 'P' AS other
  FROM fields f JOIN orders ON f.doc_id = o_orderkey LEFT JOIN penalties p ON f.doc_id = p.doc_id AND f.field_key = p.field_key),
docs AS (
  SELECT doc_id, any_value(fallback) AS fallback, any_value(other) AS other, count(*) FILTER (less < CAST(least AS DOUBLE)) AS n_flagged,
         CASE WHEN any_value(fallback) THEN least(avg(CAST(less AS DECIMAL(10, 4))), 0.70) ELSE avg(CAST(less AS DECIMAL(10, 4))) END AS overall
  FROM done GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_errors, bool_or(severity = 'critical') AS critical FROM errors GROUP BY doc_id)
SELECT d.doc_id, round(overall + 1e-9, 3) AS overall, n_flagged, coalesce(n_errors, 0) AS n_errors,
       NOT other AND (coalesce(critical, false) OR n_flagged > 0 OR overall < 0.85 OR fallback) AS review_required,
       CASE WHEN other THEN 'other_document' WHEN coalesce(critical, false) OR n_flagged > 0 OR overall < 0.85 OR fallback THEN 'review' ELSE 'success' END AS status,
       CASE WHEN fallback THEN 'fallback' WHEN n_flagged > 0 THEN 'low_confidence' ELSE 'validation_failed' END AS reason,
       CASE WHEN coalesce(critical, false) THEN 'critical' ELSE 'normal' END AS priority
FROM docs d LEFT JOIN counts c ON d.doc_id = c.doc_id"""
)
def review_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, penalties, confidence, decision, status and reason of every order with lines, end to end."""
    joined, get = _ruled_fields(spark, sf_dir)
    path, form = F.when(F.col("o_orderpriority") == "5-LOW", "fallback").otherwise("vlm"), F.when(F.col("o_orderstatus") == "P", "other").otherwise("bid")
    # an error of a line refers to that line
    errors = F.transform(rules.failed_rules(LINE_RULES, get), lambda k: rules.described(LINE_RULES, k).withField("field_ref", F.col("field_key")))
    fields = joined.select("doc_id", "pos", "field_key", "data_type", "confidence", path.alias("processing_path"), form.alias("form_type"), errors.alias("errors"))
    done = score.decided_at_once(fields)
    fallback, n_flagged = F.col("processing_path") == "fallback", F.size("flagged_fields")
    reason_ = route.review_reason(fallback, n_flagged > 0)
    return done.select("doc_id", F.round(F.col("overall") + 1e-9, 3).alias("overall"), n_flagged.cast("long").alias("n_flagged"), "n_errors", "review_required", route.final_status(F.col("form_type") == "other", F.col("review_required"), fallback).alias("status"), reason_.alias("reason"), route.review_priority(F.col("critical"), reason_).alias("priority"))


@query(f"WITH {_SQL_ERRORS} SELECT doc_id, field_key, rule_id, error_type, severity FROM errors")
def rule_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_errors(spark, sf_dir).select("doc_id", "field_key", "rule_id", "error_type", "severity")


ARRAY_RULES = (
    {"rule_id": "length", "type": "ARRAY_LENGTH", "field": "items", "expected_length": 4},
    {"rule_id": "sequence", "type": "ARRAY_SEQUENCE", "field": "items", "key": "number", "expected_sequence": [1, 2, 3, 4]},
    {"rule_id": "enum", "type": "ARRAY_ENUM", "field": "items", "key": "mark", "allowed_values": ["A", "N"]},
)


@query(
    f"""WITH {_SQL_LINES},
docs AS (SELECT doc_id, list(l_linenumber ORDER BY pos) AS numbers, bool_and(l_returnflag IN ('A', 'N')) AS good FROM lines GROUP BY doc_id)
SELECT doc_id, 1 AS place, 'length' AS rule_id, 'missing_field' AS error_type FROM docs WHERE len(numbers) <> 4
UNION ALL SELECT doc_id, 2, 'sequence', 'format' FROM docs WHERE numbers <> [1, 2, 3, 4]
UNION ALL SELECT doc_id, 3, 'enum', 'format' FROM docs WHERE NOT good"""
)
def array_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, sequence and enum rules on the lines of an order."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("mark")))), lambda x: x)
    docs = _lines(spark, sf_dir).groupBy("doc_id").agg(items.alias("items"))
    found = rules.with_rule_errors(docs, ARRAY_RULES).select("doc_id", F.explode("errors").alias("e"))
    place = model.looked_up(F.col("e.rule_id"), {"length": 1, "sequence": 2, "enum": 3})
    return found.select("doc_id", place.alias("place"), "e.rule_id", "e.error_type")


@query(
    """WITH n AS (SELECT c_custkey, c_name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, contains(replace(c_name, ' ', ''), replace(n_name, ' ', '')) OR contains(replace(n_name, ' ', ''), replace(c_name, ' ', '')) AS name_holds,
       contains(replace(r_name || ' ' || n_name, ' ', ''), replace(n_name, ' ', '')) AS address_holds,
       regexp_matches(c_name, '^Customer#[0-9]{9}') AS pattern_holds
FROM n"""
)
def name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, address and pattern rules on customers."""
    c, n, r = (_table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    get = rules.columns_getter({"name": F.col("c_name"), "other": F.col("n_name"), "address": F.concat_ws(" ", "r_name", "n_name"), "place": F.col("n_name")})
    made = ({"type": "NAME_MATCH", "fields": ["name", "other"]}, {"type": "ADDR_CONTAINS", "field_value": "address", "field_contained": "place"}, {"type": "REGEX_MATCH", "field": "name", "pattern": r"Customer#\d{9}"})
    return joined.select("c_custkey", *[(~rules.fails(rule, get)).alias(a) for rule, a in zip(made, ("name_holds", "address_holds", "pattern_holds"), strict=True)])


@query(f"WITH {_SQL_ERRORS} SELECT doc_id, field_key, round(sum(CAST(penalty AS DOUBLE)), 4) AS penalty FROM errors GROUP BY ALL")
def penalty_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.penalty_map(_line_errors(spark, sf_dir))


@query(
    """SELECT vec_id, label, round(least(1.0, greatest(0.0, exp(greatest(list_sum(list_transform(embedding, lambda x: -abs(CAST(x AS DOUBLE)))) / len(embedding), -20)) *
       least(1.0, sqrt(CASE label % 4 WHEN 0 THEN 4 WHEN 1 THEN 5 WHEN 2 THEN 3 ELSE 5 END / CAST(len(embedding) AS DOUBLE))))), 4) AS confidence
FROM embeddings"""
)
def token_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence of token log-probabilities, here the negative sizes of vector components."""
    kind = F.get(F.array(*[F.lit(k) for k in ("amount", "code", "date", "text")]), (F.col("label") % 4).cast("int"))
    logprobs = F.transform("embedding", lambda x: -F.abs(x.cast("double")))
    return _table(spark, sf_dir, "embeddings").select("vec_id", "label", S.token_confidence(logprobs, kind).alias("confidence"))


@query(
    f"""WITH {_SQL_FIELDS}
SELECT doc_id, round(sum(confidence * w) / sum(w) + 1e-9, 3) AS scorer_mean, round(sum(confidence * v) / sum(v) + 1e-9, 3) AS leaf_mean
FROM (SELECT *, CASE data_type WHEN 'amount' THEN 2.0 WHEN 'code' THEN 1.5 WHEN 'date' THEN 1.2 ELSE 1.0 END::DOUBLE AS w,
             CASE data_type WHEN 'amount' THEN 3.0 WHEN 'code' THEN 2.5 WHEN 'date' THEN 2.0 ELSE 1.0 END::DOUBLE AS v FROM fields)
GROUP BY doc_id"""
)
def weighted_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two weighted means of a document's confidence."""
    w, v = S.field_weight(F.col("data_type")), S.leaf_weight(F.col("data_type"))
    return _fields(spark, sf_dir).groupBy("doc_id").agg(F.round(S.weighted_mean(F.col("confidence"), w, None) + 1e-9, 3).alias("scorer_mean"), F.round(S.weighted_mean(F.col("confidence"), v, None) + 1e-9, 3).alias("leaf_mean"))


@query(f"WITH {_SQL_FIELDS} SELECT doc_id, field_key, data_type, CAST({_SQL_LEAST} AS DOUBLE) AS least, confidence < CAST({_SQL_LEAST} AS DOUBLE) AS flagged FROM fields")
def threshold_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = model.least_confidence(F.col("data_type"))
    return _fields(spark, sf_dir).select("doc_id", "field_key", "data_type", least.alias("least"), (F.col("confidence") < least).alias("flagged"))


_WORDS = ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE")
_SQL_WORDS = ", ".join(f"({k}, '{w}')" for k, w in enumerate(_WORDS))


@query(
    f"""WITH d(ord, entry) AS (VALUES {_SQL_WORDS}),
v AS (SELECT DISTINCT c_custkey, substr(c_mktsegment, 1, CAST(c_custkey % 4 AS INTEGER) + 5) || substr(c_mktsegment, CAST(c_custkey % 4 AS INTEGER) + 7) AS value FROM customer),
s AS (SELECT c_custkey, value, entry, ord, levenshtein(value, entry) AS distance FROM v, d)
SELECT c_custkey, value, arg_min(entry, distance * 100 + ord) FILTER (distance <= 2) AS entry FROM s GROUP BY ALL"""
)
def nearest_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with a letter missing, put right by the nearest dictionary entry."""
    c = _table(spark, sf_dir, "customer")
    at = (F.col("c_custkey") % 4).cast("int")
    value = F.concat(F.substring(F.col("c_mktsegment"), F.lit(1), at + 5), F.substring(F.col("c_mktsegment"), at + 7, F.length("c_mktsegment")))
    broken = c.select("c_custkey", value.alias("value"))
    return broken.select("c_custkey", "value", correct.nearest(F.col("value"), _WORDS).alias("entry"))


@query(
    f"""WITH d(ord, entry) AS (VALUES {_SQL_WORDS}),
v AS (SELECT DISTINCT substr(c_mktsegment, 1, CAST(c_custkey % 4 AS INTEGER) + 5) || substr(c_mktsegment, CAST(c_custkey % 4 AS INTEGER) + 7) AS value FROM customer),
s AS (SELECT value, entry, ord, levenshtein(value, entry) AS distance FROM v, d)
SELECT value, arg_min(entry, distance * 100 + ord) AS entry, CAST(min(distance) AS INTEGER) AS distance FROM s WHERE distance <= 2 GROUP BY value"""
)
def nearest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as an equi-join on parts of the entries, for dictionaries of any size."""
    broken = nearest_dictionary(spark, sf_dir).select("value")
    entries = spark.createDataFrame(list(enumerate(_WORDS)), "ord int, entry string")
    return correct.nearest_rows(broken, entries)


_PREFIXES = (("small", "S"), ("red", "R"), ("blue w", "B1"), ("blue", "B2"), ("large r", "L"))
_SQL_PREFIXES = ", ".join(f"({k}, '{p}', '{t}')" for k, (p, t) in enumerate(_PREFIXES))


@query(
    f"""WITH d(ord, prefix, target) AS (VALUES {_SQL_PREFIXES}), v AS (SELECT DISTINCT p_name AS value FROM part)
SELECT p_partkey, p_name AS value, (SELECT arg_min(target, ord) FROM d WHERE starts_with(p_name, prefix)) AS target FROM part"""
)
def prefix_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(_PREFIXES)], "ord int, prefix string, target string")
    return correct.first_prefix(_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("value")), prefixes).select("p_partkey", "value", "target")


@query(
    f"""WITH {_SQL_REGIONS}
SELECT s.doc_id, s.pos, s.region_id FROM regions s
WHERE s.region_type = 'text' AND s.pos % 2 = 1 AND NOT EXISTS (
  SELECT 1 FROM regions p WHERE p.doc_id = s.doc_id AND p.pos % 2 = 0 AND {_sql_covered("s", "p")} >= 0.5)"""
)
def overlap_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secondary texts that no primary box covers half."""
    r = _regions(spark, sf_dir)
    return layout.uncovered(r.where("pos % 2 = 1 and region_type = 'text'"), r.where("pos % 2 = 0")).select("doc_id", "pos", "region_id")


@query(
    f"""WITH {_SQL_REGIONS}, t AS (SELECT doc_id, pos AS ord, x1 - 15 AS x1, y1 - 15 AS y1, x1 + 200 AS x2, y1 + 110 AS y2 FROM regions WHERE pos % 3 = 0)
SELECT r.doc_id, r.pos, min(ord) AS field_ord FROM regions r JOIN t ON r.doc_id = t.doc_id
WHERE r.region_type NOT IN ('seal', 'signature', 'figure', 'table') AND {_sql_covered("r", "t")} > 0.7 AND {_sql_covered("t", "r")} <= 0.9 GROUP BY r.doc_id, r.pos"""
)
def template_match_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each detected box with the first template field that takes it."""
    r = _regions(spark, sf_dir)
    b = F.col("box")
    template = r.where("pos % 3 = 0").select("doc_id", F.col("pos").alias("ord"), G.box(b["x1"] - 15, b["y1"] - 15, b["x1"] + 200, b["y1"] + 110).alias("box"))
    return layout.template_matches(r, template)


def _sql_nms(limit: str) -> str:
    iou = _sql_iou("k", "r")
    return f"""WITH RECURSIVE {_SQL_REGIONS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, pos) AS turn FROM regions),
f(doc_id, turn, kept) AS (
  SELECT doc_id, turn, [{{'pos': pos, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 't': region_type}}] FROM ranked WHERE turn = 1
  UNION ALL
  SELECT f.doc_id, r.turn, CASE WHEN len(list_filter(f.kept, lambda k: {iou} > {limit})) > 0 THEN f.kept
         ELSE list_append(f.kept, {{'pos': r.pos, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2, 't': r.region_type}}) END
  FROM f JOIN ranked r ON f.doc_id = r.doc_id AND r.turn = f.turn + 1),
last AS (SELECT doc_id, arg_max(kept, turn) AS kept FROM f GROUP BY doc_id)
SELECT doc_id, k.pos AS pos FROM (SELECT doc_id, unnest(kept) AS k FROM last)"""


@query(_sql_nms("0.3"))
def nms_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.suppressed(_regions(spark, sf_dir), 0.3).select("doc_id", "pos")


@query(_sql_nms("(CASE WHEN k.t = 'seal' OR r.region_type = 'seal' THEN 0.5 ELSE 0.7 END)"))
def overlap_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refinement's suppression, stricter for seals."""
    return layout.refined(_regions(spark, sf_dir)).select("doc_id", "pos")


@query(
    f"""WITH RECURSIVE {_SQL_REGIONS}, texts AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY y1, x1, pos) AS turn FROM regions WHERE region_type = 'text'),
f(doc_id, turn, blk, pos, x1, y1, x2, y2) AS (
  SELECT doc_id, turn, pos, pos, x1, y1, x2, y2 FROM texts WHERE turn = 1
  UNION ALL
  SELECT f.doc_id, r.turn, CASE WHEN near THEN f.blk ELSE r.pos END, r.pos, CASE WHEN near THEN least(f.x1, r.x1) ELSE r.x1 END, CASE WHEN near THEN f.y1 ELSE r.y1 END,
         CASE WHEN near THEN greatest(f.x2, r.x2) ELSE r.x2 END, r.y2
  FROM f JOIN texts r ON f.doc_id = r.doc_id AND r.turn = f.turn + 1,
       LATERAL (SELECT abs((r.x1 + r.x2) // 2 - (f.x1 + f.x2) // 2) <= 120 AND r.y1 - f.y2 BETWEEN 0 AND 90 AS near))
SELECT doc_id, blk AS pos, arg_max(x1, turn) AS x1, arg_max(y1, turn) AS y1, arg_max(x2, turn) AS x2, arg_max(y2, turn) AS y2, count(*) - 1 AS n_members FROM f GROUP BY doc_id, blk"""
)
def merge_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text blocks merged downwards; tolerances as wide as these made-up pages need."""
    done = layout.merged_texts(_regions(spark, sf_dir), across=120, down=90).where("region_type = 'text'")
    return _flat(done.select("doc_id", "pos", F.size("members").cast("long").alias("n_members"), "box"))


@query(
    f"""WITH {_SQL_REGIONS},
body AS (
  SELECT *, (x1 + x2) // 2 AS cx, max(x2) OVER (PARTITION BY doc_id ORDER BY (x1 + x2) // 2, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far
  FROM regions WHERE region_type NOT IN ('header', 'footer')),
cols AS (SELECT doc_id, pos, region_type, x1, y1, CAST(sum(CASE WHEN cx - far > 18 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY cx, pos ROWS UNBOUNDED PRECEDING) AS INTEGER) AS col FROM body),
together AS (SELECT *, 1 AS kind FROM cols UNION ALL SELECT doc_id, pos, region_type, 0, y1, 0, CASE region_type WHEN 'header' THEN 0 ELSE 2 END FROM regions WHERE region_type IN ('header', 'footer'))
SELECT doc_id, pos, col AS "column", CAST(row_number() OVER (PARTITION BY doc_id ORDER BY kind, col, y1, x1, pos) - 1 AS INTEGER) AS order_idx FROM together"""
)
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(_regions(spark, sf_dir), F.lit(600)).select("doc_id", "pos", "column", "order_idx")


_SQL_BUDGET = "CASE region_type WHEN 'table' THEN 1120 WHEN 'seal' THEN 560 WHEN 'text' THEN 560 WHEN 'header' THEN 140 WHEN 'footer' THEN 140 ELSE 560 END"


@query(
    f"""WITH {_SQL_REGIONS}, g AS (SELECT doc_id, {_SQL_BUDGET} AS pixel_budget, string_agg(region_id, ',' ORDER BY pos, region_id) AS ids, count(*) AS n FROM regions GROUP BY ALL)
SELECT doc_id, pixel_budget, ids, n, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pixel_budget DESC) AS INTEGER) AS turn FROM g"""
)
def budget_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir).select("doc_id", "region_id", F.col("pos").alias("order_idx"), model.pixel_budget(F.col("region_type")).alias("pixel_budget"))
    return route.budget_groups(r).select("doc_id", "pixel_budget", F.array_join("region_ids", ",").alias("ids"), F.size("region_ids").cast("long").alias("n"), "turn")


@query(
    f"""WITH {_SQL_REGIONS}, t AS (SELECT *, greatest(3, CAST(trunc((x2 - x1) * r) AS INTEGER)) AS px, greatest(3, CAST(trunc((y2 - y1) * r) AS INTEGER)) AS py
  FROM (SELECT *, CASE region_type WHEN 'seal' THEN 0.10::DOUBLE ELSE 0.05::DOUBLE END AS r FROM regions WHERE region_type <> 'table'))
SELECT doc_id, region_id, CASE region_type WHEN 'seal' THEN 'S4' ELSE 'S2' END AS skill, {_SQL_BUDGET} AS pixel_budget, greatest(0, x1 - px) AS x1, greatest(0, y1 - py) AS y1, least(600, x2 + px) AS x2, least(800, y2 + py) AS y2
FROM t WHERE least(600, x2 + px) > greatest(0, x1 - px) AND least(800, y2 + py) > greatest(0, y1 - py)"""
)
def skill_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks for the readers of regions, with padded crops."""
    r = _regions(spark, sf_dir).withColumns({"page_width": F.lit(600), "page_height": F.lit(800)})
    return _flat(infer.tasks(r).select("doc_id", "region_id", "skill", "pixel_budget", F.col("crop").alias("box")))


@query(
    f"""WITH {_SQL_FIELDS}, again AS (SELECT doc_id, field_key, round(1 - l_quantity / 500, 4) AS c, 'second' AS v FROM fields WHERE pos % 2 = 0)
SELECT f.doc_id, f.field_key, CASE WHEN c > confidence THEN v ELSE 'first' END AS corrected_value, greatest(confidence, coalesce(c, confidence)) AS confidence, was_retried OR c IS NOT NULL AS was_retried
FROM fields f LEFT JOIN again a ON f.doc_id = a.doc_id AND f.field_key = a.field_key"""
)
def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fields(spark, sf_dir)
    again = f.where("pos % 2 = 0").select("doc_id", "field_key", F.round(1 - F.col("l_quantity") / 500, 4).alias("confidence"), F.lit("second").alias("corrected_value"))
    first = f.select("doc_id", "field_key", "confidence", "was_retried", F.lit("first").alias("corrected_value"))
    return route.retry_merged(first, again).select("doc_id", "field_key", "corrected_value", "confidence", "was_retried")


@query(
    f"""WITH {_SQL_FIELDS}, w AS (SELECT doc_id, field_key, CASE WHEN pos % 2 = 0 THEN 0 ELSE 1 END AS kind, confidence, pos FROM fields WHERE NOT was_retried)
SELECT doc_id, field_key, turn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY kind, confidence, pos) AS INTEGER) AS turn FROM w) WHERE turn <= 5"""
)
def top5_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five fields of a document to read again."""
    f = _fields(spark, sf_dir).withColumn("corrected_value", F.lit("x"))
    # an error refers to every second field; all others are weak, and related to a field that is sure
    errors = f.where("pos % 2 = 0").select("doc_id", "pos", F.lit("arithmetic").alias("error_type"), F.col("field_key").alias("field_ref"), F.lit("m").alias("message"))
    weak = f.withColumn("confidence", F.col("confidence") / 2)
    sure = f.select("doc_id").distinct().select("doc_id", F.lit(-1).alias("pos"), F.lit("sure").alias("field_key"), F.lit(0.9).alias("confidence"), F.lit(True).alias("was_retried"), F.lit("y").alias("corrected_value"))
    both = weak.select(*sure.columns).unionByName(sure)
    # a row for each place in the longest order
    longest = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").count().agg(F.max("count").cast("int").alias("n"))
    places = longest.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pos"))
    related = places.select(F.concat(F.lit("line_"), F.col("pos").cast("string")).alias("field_key"), F.lit("sure").alias("related_key"), F.lit(0).alias("ord"))
    return reason.targets(both, errors, f.select("doc_id", "field_key"), related).select("doc_id", "field_key", "turn")


_SQL_CODES = r"""WITH t AS (SELECT event_id, printf('%04d-%02d-%03d-%04d KN-%05d-%04d ', user_id % 10000, event_id % 100, event_id % 1000, event_id % 10000, event_id % 100000, user_id % 10000) || strftime(ts, '%Y-%m-%d') AS text FROM events),
f AS (
  SELECT event_id, 0 AS ord, 'nsn' AS code_type, unnest(list_distinct(regexp_extract_all(text, '[0-9]{4}-[0-9]{2}-[0-9]{3}-[0-9]{4}'))) AS raw FROM t
  UNION ALL SELECT event_id, 1, 'k_nsn', unnest(list_distinct(regexp_extract_all(text, 'KN-[0-9]{5}-[0-9]{4}'))) FROM t
  UNION ALL SELECT event_id, 3, 'date', unnest(list_distinct(regexp_extract_all(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}'))) FROM t)
SELECT event_id, raw, arg_min(code_type, ord) AS code_type FROM f GROUP BY event_id, raw"""


@query(_SQL_CODES)
def domain_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in texts made of the events' numbers and days."""
    e = _table(spark, sf_dir, "events")
    text = F.concat(F.format_string("%04d-%02d-%03d-%04d KN-%05d-%04d ", F.col("user_id") % 10000, F.col("event_id") % 100, F.col("event_id") % 1000, F.col("event_id") % 10000, F.col("event_id") % 100000, F.col("user_id") % 10000), F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", F.explode(X.codes_in(text, model.CODE_PATTERNS)).alias("c")).select("event_id", "c.raw", "c.code_type")


@query(
    r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS item, generate_subscripts(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), 1) AS k FROM pages),
t AS (SELECT page_id, '<table>' || string_agg('<tr><td>' || item || '</td><th>' || k || '</th></tr>', '' ORDER BY k) || '</table>' AS html FROM l GROUP BY page_id),
r AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>', 1)) AS tr, generate_subscripts(regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>', 1), 1) - 1 AS row FROM t)
SELECT page_id, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, trim(regexp_replace(cell, '<[^>]+>', '', 'g')) AS text
FROM (SELECT page_id, row, unnest(regexp_extract_all(tr, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1)) AS cell, generate_subscripts(regexp_extract_all(tr, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1), 1) - 1 AS col FROM r)"""
)
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of tables made of each page's menu."""
    p = _table(spark, sf_dir, "pages")
    items = F.regexp_extract_all("html", F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1))
    rows = F.transform(items, lambda x, k: F.concat(F.lit("<tr><td>"), x, F.lit("</td><th>"), (k + 1).cast("string"), F.lit("</th></tr>")))
    table = F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>"))
    return p.select("page_id", F.explode(X.html_cells(table)).alias("c")).select("page_id", "c.row", "c.col", "c.text")


@query("SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS value, 'text' AS kind, 0.5::DOUBLE AS confidence FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of the events' properties, with their confidences as those of unknown fields."""
    e = _table(spark, sf_dir, "events").select("event_id", F.col("props").alias("assembled"))
    found = assemble.json_leaves(e, key="event_id", depth=1)
    return found.select("event_id", "path", "value", X.leaf_type(F.col("path")).alias("kind"), F.coalesce("stated", F.lit(0.5)).alias("confidence"))


_SQL_SPELT = "CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y.%m.%d') WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%y.%m.%d') WHEN 4 THEN year(o_orderdate) || '년 ' || month(o_orderdate) || '월 ' || day(o_orderdate) || '일' ELSE 'no date' END"


@query(
    rf"""WITH t AS (SELECT o_orderkey, {_SQL_SPELT} AS text FROM orders),
k AS (SELECT *, regexp_extract_all(text, '([0-9]{{4}})\s*년\s*([0-9]{{1,2}})\s*월\s*([0-9]{{1,2}})\s*일', 0) AS m FROM t)
SELECT o_orderkey, text, CAST(CASE WHEN len(m) > 0 THEN try_strptime(regexp_replace(text, '([0-9]{{4}})\s*년\s*([0-9]{{1,2}})\s*월\s*([0-9]{{1,2}})\s*일', '\1-\2-\3'), '%Y-%m-%d')
  WHEN regexp_matches(text, '^[0-9]{{2}}[.]') THEN try_strptime(CASE WHEN CAST(left(text, 2) AS INTEGER) >= 69 THEN '19' ELSE '20' END || text, '%Y.%m.%d')
  ELSE coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%Y.%m.%d'), try_strptime(text, '%Y/%m/%d')) END AS DATE) AS parsed FROM k"""
)
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in six ways, and read."""
    d, way = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = F.when(way == 0, F.date_format(d, "yyyy-MM-dd")).when(way == 1, F.date_format(d, "yyyy.MM.dd")).when(way == 2, F.date_format(d, "yyyy/MM/dd")).when(way == 3, F.date_format(d, "yy.MM.dd"))
    text = text.when(way == 4, F.concat(F.year(d), F.lit("년 "), F.month(d), F.lit("월 "), F.dayofmonth(d), F.lit("일"))).otherwise("no date")
    return _table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")).select("o_orderkey", "text", X.parsed_date(F.col("text")).alias("parsed"))


@query(
    """WITH s AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'success' ELSE 'failed' END AS status FROM orders),
g AS (SELECT o_custkey, count(*) AS n, count(DISTINCT status) AS k, min(status) AS one FROM s GROUP BY o_custkey)
SELECT o_custkey, n, CASE WHEN k = 1 THEN one ELSE 'partial' END AS status FROM g"""
)
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of a customer as of a document whose pages are the orders."""
    status = F.when(F.col("o_orderstatus").isin("F", "O"), "success").otherwise("failed")
    g = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.collect_set(status).alias("found"))
    return g.select("o_custkey", "n", route.pages_status(F.col("found")).alias("status"))


_NOW = "2024-06-01 00:00:00"
_SQL_QUEUE = "SELECT event_id AS queue_id, ts AS enqueued_at, CASE event_type WHEN 'error' THEN 'pending' WHEN 'click' THEN 'in_review' WHEN 'view' THEN 'approved' ELSE 'rejected' END AS status, CASE WHEN value > 50 THEN 'critical' ELSE 'normal' END AS priority FROM events"


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.coalesce(model.looked_up(F.col("event_type"), {"error": "pending", "click": "in_review", "view": "approved"}), F.lit("rejected"))
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("queue_id"), F.col("ts").cast("timestamp").alias("enqueued_at"), status.alias("status"), F.when(F.col("value") > 50, "critical").otherwise("normal").alias("priority"))


@query(
    f"""WITH q AS ({_SQL_QUEUE}), m AS (SELECT *, status IN ('pending', 'in_review') AS open, (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(enqueued_at)) / 6e7 AS minutes FROM q)
SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'in_review') AS in_review, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected,
       count(*) FILTER (open AND priority = 'critical') AS critical_open, round(max(minutes) FILTER (open), 2) AS oldest_wait_minutes, round(avg(minutes) FILTER (open), 2) AS mean_wait_minutes FROM m"""
)
def queue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.queue_stats(_queue(spark, sf_dir), F.lit(_NOW).cast("timestamp"))


@query(f"WITH q AS ({_SQL_QUEUE}) SELECT queue_id, priority, enqueued_at, row_number() OVER (ORDER BY CASE priority WHEN 'critical' THEN 0 ELSE 1 END, enqueued_at, queue_id) AS place FROM q WHERE status = 'pending' QUALIFY place <= 100")
def queue_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of the pending items: a top-k report."""
    order = Window.orderBy(F.when(F.col("priority") == "critical", 0).otherwise(1), "enqueued_at", "queue_id")
    first = route.queue_page(_queue(spark, sf_dir), status="pending").limit(100)
    return first.withColumn("place", F.row_number().over(order).cast("long")).select("queue_id", "priority", F.col("enqueued_at").cast("timestamp_ntz").alias("enqueued_at"), "place")


@query(
    """WITH g AS (SELECT event_id, user_id, ts, event_type <> 'error' AS ok, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events),
s AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM g)
SELECT event_id, CAST(streak AS BIGINT) AS streak, streak < 2 AS healthy FROM s"""
)
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures in a row of each user's service; two make it unhealthy here."""
    e = _table(spark, sf_dir, "events").withColumn("ok", F.col("event_type") != "error")
    return evals.failure_streaks(e, "user_id", "ts", "event_id", failures=2).select("event_id", "streak", "healthy")


_SQL_ITEMS = """SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations"""


@query(
    f"""WITH i AS ({_SQL_ITEMS})
SELECT conv_id, turn, '이 서식에서 모든 필드를 추출하세요.' AS instruction, answer AS chosen, CASE WHEN text = '' THEN '{{}}' ELSE text END AS rejected FROM i WHERE role = 'user' AND next_role = 'assistant' AND answer <> ''"""
)
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs: an answer against the question it corrects."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = _table(spark, sf_dir, "conversations")
    items = c.select("conv_id", "turn", F.struct("conv_id", "turn").alias("doc_id"), F.when((F.col("role") == "user") & (F.lead("role").over(w) == "assistant"), "approved").otherwise("pending").alias("status"), F.lead("text").over(w).alias("corrected_json"), F.col("text").alias("errors_json"), F.lit("").alias("image_path"), F.lit("").alias("processing_path"))
    return route.training_pairs(items, "dpo").select("doc_id.conv_id", "doc_id.turn", "instruction", "chosen", "rejected")


_SQL_TRIALS = """trials AS (SELECT user_id AS doc_id, CASE WHEN dayofyear(ts) % 2 = 0 THEN 'before' ELSE 'after' END AS trial, round(avg(value) / 100 + 1e-9, 4) AS overall_confidence,
  count(*) FILTER (event_type = 'error') AS validation_error_count, bool_or(event_type = 'error') AS review_queued, round(sum(value), 2) AS processing_ms FROM events GROUP BY ALL)"""


def _trials(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = _table(spark, sf_dir, "events").withColumn("trial", F.when(F.dayofyear("ts") % 2 == 0, "before").otherwise("after"))
    m = e.groupBy(F.col("user_id").alias("doc_id"), "trial").agg(F.round(F.avg("value") / 100 + 1e-9, 4).alias("overall_confidence"), F.count_if(F.col("event_type") == "error").alias("validation_error_count"), F.bool_or(F.col("event_type") == "error").alias("review_queued"), F.round(F.sum("value"), 2).alias("processing_ms"))
    return m.where("trial = 'after'").drop("trial"), m.where("trial = 'before'").drop("trial")


_SQL_DELTAS = (
    _SQL_TRIALS
    + """, pairs AS (SELECT a.doc_id, unnest([{'metric': 'overall_confidence', 'up': true, 'a': a.overall_confidence, 'b': b.overall_confidence},
    {'metric': 'validation_error_count', 'up': false, 'a': CAST(a.validation_error_count AS DOUBLE), 'b': CAST(b.validation_error_count AS DOUBLE)},
    {'metric': 'review_queued', 'up': false, 'a': CAST(CAST(a.review_queued AS INTEGER) AS DOUBLE), 'b': CAST(CAST(b.review_queued AS INTEGER) AS DOUBLE)},
    {'metric': 'processing_ms', 'up': false, 'a': a.processing_ms, 'b': b.processing_ms}]) AS m
  FROM (SELECT * FROM trials WHERE trial = 'after') a LEFT JOIN (SELECT * FROM trials WHERE trial = 'before') b ON a.doc_id = b.doc_id),
deltas AS (SELECT doc_id, m.metric AS metric, m.b AS before, m.a AS after, round(m.a - m.b, 4) AS delta,
  CASE WHEN m.a - m.b IS NULL THEN 'unknown' WHEN m.a - m.b = 0 THEN 'neutral' WHEN (m.a - m.b > 0) = m.up THEN 'positive' ELSE 'negative' END AS sign FROM pairs)"""
)


@query(f"WITH {_SQL_DELTAS} SELECT * FROM deltas")
def trial_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of users on odd days against even days."""
    return evals.deltas(*_trials(spark, sf_dir))


@query(
    f"""WITH {_SQL_DELTAS} SELECT doc_id, CASE WHEN p AND n THEN 'MIXED' WHEN n THEN 'REGRESSED' WHEN p THEN 'IMPROVED' ELSE 'NEUTRAL' END AS verdict
FROM (SELECT doc_id, coalesce(bool_or(sign = 'positive') FILTER (metric <> 'processing_ms'), false) AS p, coalesce(bool_or(sign = 'negative') FILTER (metric <> 'processing_ms'), false) AS n FROM deltas GROUP BY doc_id)"""
)
def trial_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evals.verdict(evals.deltas(*_trials(spark, sf_dir)), "doc_id")


@query(f"WITH {_SQL_TRIALS} SELECT trial, round(avg(overall_confidence), 3) AS overall_confidence, round(avg(validation_error_count), 4) AS validation_error_count, round(avg(CAST(review_queued AS INTEGER)), 4) AS review_queued FROM trials GROUP BY trial")
def trial_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = _trials(spark, sf_dir)
    both = after.withColumn("trial", F.lit("after")).unionByName(before.withColumn("trial", F.lit("before")))
    return evals.mean_metrics(both, "trial").select("trial", F.round("overall_confidence", 3).alias("overall_confidence"), "validation_error_count", "review_queued")


@query(
    """SELECT user_id, event_type, count(value) AS n, CAST(round(CAST(avg(CAST(value AS DECIMAL(12, 2))) AS DECIMAL(18, 8)), 4) AS DOUBLE) AS mean, round(round(coalesce(stddev_samp(value), 0), 4), 3) AS std, min(value) AS min, max(value) AS max FROM events GROUP BY ALL"""
)
def variance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of repeated runs: events of a type and a user."""
    exact = _table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(12,2)"))
    stats = evals.timing_stats(exact, "user_id", "event_type", value="value")
    return stats.withColumns({c: F.col(c).cast("double") for c in ("mean", "min", "max")}).withColumn("std", F.round("std", 3))


@query(
    """WITH v AS (SELECT user_id, hour(ts) AS slot, event_type FROM events), c AS (SELECT user_id, slot, count(event_type) AS n_runs, count(DISTINCT event_type) AS n_values FROM v GROUP BY ALL)
SELECT user_id, count(*) FILTER (n_values = 1) AS n_consistent, count(*) AS n_fields, round(count(*) FILTER (n_values = 1) / greatest(count(*), 1), 4) AS determinism FROM c GROUP BY user_id"""
)
def determinism(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a user's hours in which all runs gave one value."""
    v = _table(spark, sf_dir, "events").select("user_id", F.hour("ts").alias("slot"), F.col("event_type").alias("value"))
    return evals.determinism(evals.consistency(v, "user_id", "slot"), "user_id")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after all events have been upserted by user."""
    e = _table(spark, sf_dir, "events")
    return sinks.latest(e, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query(f"""WITH {_SQL_FIELDS} SELECT doc_id, field_key FROM fields f WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = f.pos AND p_size % 2 = 0)""")
def ghost_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the schema doesn't name: it has the places of parts of an even size."""
    known = _table(spark, sf_dir, "part").where("p_size % 2 = 0").select(F.lit("s").alias("schema_id"), F.concat(F.lit("line_"), F.col("p_partkey").cast("string")).alias("field_key"))
    fields = _fields(spark, sf_dir).withColumn("schema_id", F.lit("s"))
    return assemble.ghosts(fields, known).select("doc_id", "field_key")


@query("SELECT doc_id, 'labels' AS side FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') UNION ALL SELECT doc_id, 'documents' FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def form_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What only one of two sets has, with its side."""
    a, b = _table(spark, sf_dir, "labels").select("doc_id"), _table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id")
    return evals.only_in_one(a, b, "doc_id", ("labels", "documents"))


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def events_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of the queue's arrivals."""
    e = _table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    g = queues.queue_windows(e, "ts", "10 minutes", "5 minutes", "event_type", total="value")
    return g.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))


@query(
    f"""WITH {_SQL_LINES}, r AS (SELECT unnest([{{'f': 'line_0', 'p': 'head.first', 'o': 0}}, {{'f': 'line_1', 'p': 'head.second', 'o': 1}}, {{'f': 'line_2', 'p': 'third', 'o': 2}}]) AS u)
SELECT doc_id, u.p AS path, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS value, round(1 - l_discount, 4) AS confidence FROM lines JOIN r ON u.f = 'line_' || pos"""
)
def assembled_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at the paths that assembly rules give the first three lines."""
    made = spark.createDataFrame([("s", k, f"line_{k}", p) for k, p in enumerate(("head.first", "head.second", "third"))], "schema_id string, ord int, field_key string, path string")
    value = F.lpad(F.col("l_quantity").cast("int").cast("string"), 4, "0")
    fields = _fields(spark, sf_dir).select("doc_id", F.lit("s").alias("schema_id"), "field_key", "pos", "confidence", value.alias("raw_value"), F.lit("").alias("corrected_value"))
    return assemble.leaves(fields, made).select("doc_id", "path", "value", "confidence")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'vlm' WHEN o_orderpriority <> '1-URGENT' THEN 'fallback' ELSE 'review_queue' END AS path,
       CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 0 THEN 280 WHEN 1 THEN 560 WHEN 2 THEN 1120 ELSE 1120 END AS retry_budget,
       greatest(48, CAST(round_even(o_custkey % 1000 / 48, 0) * 48 AS INTEGER)) AS aligned FROM orders"""
)
def path_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing path, budget of a second attempt and aligned size."""
    budget = F.get(F.array(*[F.lit(b) for b in (140, 280, 560, 1120)]), (F.col("o_orderkey") % 4).cast("int"))
    path = route.processing_path(F.col("o_orderstatus") == "F", F.col("o_orderpriority") != "1-URGENT", F.lit(True))
    return _table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"), route.retry_budget(budget).alias("retry_budget"), G.aligned(F.col("o_custkey") % 1000).alias("aligned"))


@query(f"WITH {_SQL_FIELDS} SELECT doc_id, string_agg(field_key || '=' || CAST(l_quantity AS INTEGER), ';' ORDER BY pos) AS context, round(min(confidence), 4) AS confidence_min, round(avg(confidence), 3) AS confidence_mean, count(*) FILTER (confidence < 0.95) AS weak FROM fields GROUP BY doc_id")
def document_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's fields in one line, and what its confidences come to."""
    f = _fields(spark, sf_dir).withColumn("line", F.concat_ws("=", "field_key", F.col("l_quantity").cast("int").cast("string")))
    return f.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), ";").alias("context"), F.round(F.min("confidence"), 4).alias("confidence_min"), F.round(F.avg("confidence"), 3).alias("confidence_mean"), F.count_if(F.col("confidence") < 0.95).alias("weak"))


# Further operators


def _flat_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regions(spark, sf_dir).withColumn("model_idx", F.when(F.col("pos") % 3 == 0, (F.col("pos") * 7) % 11)).withColumn("source", F.when(F.col("pos") % 2 == 1, "plus_l").otherwise("v3"))


_SQL_MODEL = _SQL_REGIONS + ", m AS (SELECT *, CASE WHEN pos % 3 = 0 THEN (pos * 7) % 11 END AS model_idx, CASE WHEN pos % 2 = 1 THEN 'plus_l' ELSE 'v3' END AS source FROM regions)"


@query(f"WITH {_SQL_MODEL} SELECT doc_id, pos, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY model_idx IS NULL, model_idx, pos) - 1 AS INTEGER) AS order_idx FROM m")
def model_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout model's own order, closed up."""
    return layout.model_order(_flat_regions(spark, sf_dir)).select("doc_id", "pos", "order_idx")


@query(
    f"""WITH {_SQL_MODEL} SELECT doc_id, pos, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN source = 'plus_l' THEN 2 WHEN model_idx IS NULL THEN 1 ELSE 0 END,
  CASE WHEN source = 'plus_l' THEN 0 ELSE coalesce(model_idx, 0) END, CASE WHEN source = 'plus_l' THEN y1 ELSE 0 END, CASE WHEN source = 'plus_l' THEN x1 ELSE 0 END, pos) - 1 AS INTEGER) AS order_idx FROM m"""
)
def fusion_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.fusion_order(_flat_regions(spark, sf_dir)).select("doc_id", "pos", "order_idx")


@query(
    f"""WITH {_SQL_REGIONS} SELECT doc_id, region_id, 'v3' AS source FROM regions WHERE pos % 2 = 0
UNION ALL SELECT s.doc_id, s.region_id, 'plus_l' FROM regions s WHERE pos % 2 = 1 AND region_type = 'text' AND NOT EXISTS (SELECT 1 FROM regions p WHERE p.doc_id = s.doc_id AND p.pos % 2 = 0 AND {_sql_covered("s", "p")} >= 0.5)"""
)
def fused_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary regions and what the second model adds."""
    r = _regions(spark, sf_dir)
    return layout.fused(r.where("pos % 2 = 0"), r.where("pos % 2 = 1")).select("doc_id", "region_id", "source")


@query(
    f"""WITH {_SQL_REGIONS}, fixed AS (SELECT doc_id, x1 - 4 AS x1, y1 - 3 AS y1, x2 + 2 AS x2, y2 + 1 AS y2 FROM regions WHERE pos = 1)
SELECT r.doc_id, r.region_id FROM regions r WHERE r.pos % 4 = 0 OR NOT EXISTS (SELECT 1 FROM fixed f WHERE f.doc_id = r.doc_id AND {_sql_iou("r", "f")} > 0.5)"""
)
def fixed_text_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions without a field go where a fixed text is printed."""
    r = _regions(spark, sf_dir)
    b = F.col("box")
    fixed = r.where("pos = 1").select("doc_id", G.box(b["x1"] - 4, b["y1"] - 3, b["x2"] + 2, b["y2"] + 1).alias("box"))
    return layout.unlike_fixed(r.withColumn("field_key", F.when(F.col("pos") % 4 == 0, "k")), fixed).select("doc_id", "region_id")


@query(
    f"""WITH {_SQL_REGIONS}, o AS (SELECT doc_id, region_id, row_number() OVER (PARTITION BY doc_id ORDER BY y1, x1, pos) - 1 AS order_idx FROM regions),
t AS (SELECT doc_id, region_id, lag(region_id) OVER (PARTITION BY doc_id ORDER BY pos) AS into_, pos FROM regions),
led AS (SELECT o.doc_id, CASE WHEN t.pos % 3 = 1 THEN t.into_ ELSE o.region_id END AS region_id, order_idx FROM o JOIN t USING (doc_id, region_id)),
f AS (SELECT doc_id, region_id, min(order_idx) AS at_ FROM led GROUP BY ALL)
SELECT r.doc_id, r.region_id, CAST(row_number() OVER (PARTITION BY r.doc_id ORDER BY at_ IS NULL, at_, r.pos) - 1 AS INTEGER) AS order_idx FROM regions r LEFT JOIN f ON r.doc_id = f.doc_id AND r.region_id = f.region_id WHERE r.pos % 3 <> 1"""
)
def order_after_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading order when every third region has been taken in by the one before it."""
    r = _regions(spark, sf_dir)
    b = F.col("box")
    order = r.select("doc_id", "region_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy(b["y1"], b["x1"], "pos")) - 1).alias("order_idx"))
    into = r.select("doc_id", "pos", "region_id", F.lag("region_id").over(Window.partitionBy("doc_id").orderBy("pos")).alias("into")).where("pos % 3 = 1").drop("pos")
    return layout.order_after_merge(order, r.where("pos % 3 <> 1"), into)


@query(
    f"""WITH {_SQL_LINES}, s AS (SELECT doc_id, pos, CASE WHEN l_partkey % 3 = 0 THEN 'error' ELSE 'ok' END AS status, CASE l_partkey % 4 WHEN 0 THEN 140 WHEN 1 THEN 560 ELSE 1120 END AS pixel_budget, CAST(l_quantity AS INTEGER) AS ms FROM lines)
SELECT doc_id, pixel_budget, count(*) AS n, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'error') AS error, CAST(sum(ms) AS DOUBLE) AS total_ms, round(sum(ms) / CAST(count(*) AS DOUBLE) + 1e-9, 1) AS avg_ms FROM s GROUP BY ALL"""
)
def call_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and times by pixel budget."""
    budget = F.when(F.col("l_partkey") % 4 == 0, 140).when(F.col("l_partkey") % 4 == 1, 560).otherwise(1120)
    t = _lines(spark, sf_dir).select("doc_id", budget.alias("pixel_budget"), F.when(F.col("l_partkey") % 3 == 0, "error").otherwise("ok").alias("status"), F.col("l_quantity").cast("int").cast("double").alias("elapsed_ms"))
    done = evals.traces(t, "doc_id", "pixel_budget")
    return done.withColumn("avg_ms", F.round(F.col("total_ms") / F.col("n") + 1e-9, 1))


@query(f"WITH {_SQL_LINES} SELECT doc_id, step, round(CAST(sum(ms) AS DOUBLE), 1) AS ms FROM (SELECT doc_id, unnest(['P1', 'P2']) AS step, unnest([CAST(l_quantity AS INTEGER), CAST(l_partkey % 100 AS INTEGER)]) AS ms FROM lines) GROUP BY ALL")
def stage_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time by stage over the pages of a document."""
    pages = _lines(spark, sf_dir).select("doc_id", F.create_map(F.lit("P1"), F.col("l_quantity").cast("int").cast("double"), F.lit("P2"), (F.col("l_partkey") % 100).cast("double")).alias("timings"))
    return evals.stage_times(pages, "doc_id")


@query(
    f"""WITH {_SQL_REGIONS}, a AS (SELECT doc_id, degrees(atan2(y2 - y1, x2 - x1)) AS angle FROM regions WHERE x1 <> x2)
SELECT doc_id, round(median(angle), 6) AS angle FROM a WHERE abs(angle) < 25 GROUP BY doc_id"""
)
def skew_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median angle of a page's lines, here the diagonals of its regions."""
    found = evals.skew_angle(_flat(_regions(spark, sf_dir)), 25.0)
    return found.select("doc_id", F.round("angle", 6).alias("angle"))


@query(f"WITH {_SQL_REGIONS} SELECT doc_id, pos, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (x2 - x1) * (y2 - y1) DESC, pos) AS turn FROM regions) WHERE turn <= 2")
def largest_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest candidates of a page: a top-k operator."""
    r = _regions(spark, sf_dir).withColumn("area", G.area(F.col("box")))
    return evals.largest(r, "area", most=2).select("doc_id", "pos", "turn")


@query(
    f"""WITH {_SQL_FIELDS}, v AS (SELECT doc_id, pos, CASE WHEN data_type = 'date' THEN CASE WHEN pos % 2 = 0 THEN strftime(l_shipdate, '%Y') || '년' || month(l_shipdate) || '월' || day(l_shipdate) || '일' ELSE strftime(l_shipdate, '%Y-%m-%d') END
   WHEN data_type = 'amount' THEN CASE WHEN pos % 3 = 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) ELSE '12 won' END ELSE 'x' END AS v, data_type, l_shipdate FROM fields)
SELECT doc_id, pos, CASE WHEN data_type = 'date' AND pos % 2 = 0 THEN strftime(l_shipdate, '%Y년 %m월 %d일') ELSE v END AS corrected_value,
       CASE WHEN data_type = 'date' AND pos % 2 = 1 THEN 1 WHEN data_type = 'amount' AND pos % 3 <> 0 THEN 1 ELSE 0 END AS n_errors FROM v"""
)
def field_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and amounts that fit their type's pattern, can be put in form, or are errors."""
    d = F.col("l_shipdate")
    korean = F.concat(F.date_format(d, "yyyy"), F.lit("년"), F.month(d), F.lit("월"), F.dayofmonth(d), F.lit("일"))
    value = F.when(F.col("data_type") == "date", F.when(F.col("pos") % 2 == 0, korean).otherwise(F.date_format(d, "yyyy-MM-dd"))).when(F.col("data_type") == "amount", F.when(F.col("pos") % 3 == 0, F.col("l_quantity").cast("int").cast("string")).otherwise("12 won")).otherwise("x")
    types = ({"data_type": "date", "pattern": r"^\d{4}년 \d{1,2}월 \d{1,2}일$", "normalize": {"regex": r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일", "template": "{1}년 {2:02d}월 {3:02d}일"}}, {"data_type": "amount", "pattern": r"^\d+$"})
    done = rules.pattern_errors(_fields(spark, sf_dir).withColumn("corrected_value", value), types, ())
    return done.select("doc_id", "pos", "corrected_value", F.size("pattern_errors").alias("n_errors"))


@query(
    f"""WITH {_SQL_ERRORS}, keyed AS (SELECT DISTINCT doc_id, field_key, rule_id FROM errors WHERE rule_id IN ('arith', 'dates', 'flag')),
first AS (SELECT doc_id, field_key, min(CASE rule_id WHEN 'arith' THEN 0 WHEN 'dates' THEN 1 ELSE 2 END) AS k FROM keyed GROUP BY ALL)
SELECT f.doc_id, f.field_key, k AS first_rule, confidence FROM first JOIN fields f ON first.doc_id = f.doc_id AND first.field_key = f.field_key WHERE NOT was_retried"""
)
def consistency_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields to read again because an error says how."""
    place = model.looked_up(F.col("rule_id"), {"arith": 0, "dates": 1, "flag": 2, "priority": 3})
    errors = _line_errors(spark, sf_dir).select("doc_id", place.alias("pos"), "error_type", "field_ref", place.cast("string").alias("message"))
    fields = _fields(spark, sf_dir)
    found = reason.consistency_targets(fields, errors, fields.select("doc_id", "field_key"))
    return found.select("doc_id", "field_key", F.regexp_extract("demand", r"오류: (\d)", 1).cast("int").alias("first_rule"), "confidence")


@query(
    f"""WITH {_SQL_FIELDS}, e(field_key, related_key, ord) AS (VALUES ('line_0', 'line_1', 0), ('line_0', 'line_2', 1), ('line_1', 'line_0', 0)),
h AS (SELECT w.doc_id, w.field_key, ord, e.related_key, CAST(CAST(s.l_quantity AS INTEGER) AS VARCHAR) AS hint FROM fields w JOIN e ON w.field_key = e.field_key JOIN fields s ON s.doc_id = w.doc_id AND s.field_key = e.related_key
      WHERE w.confidence < 0.95 AND NOT w.was_retried AND s.confidence >= 0.95)
SELECT doc_id, field_key, string_agg(related_key || ':' || hint, ',' ORDER BY ord) AS hints FROM h GROUP BY ALL"""
)
def context_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak fields with the sure values of related ones; weak and sure are set for these confidences."""
    f = _fields(spark, sf_dir).withColumn("corrected_value", F.col("l_quantity").cast("int").cast("string"))
    # the tables' confidences lie between 0.9 and 1; spread them so that the operator's limits part them
    f = f.withColumn("confidence", F.when(F.col("confidence") < 0.95, 0.5).otherwise(0.9))
    found = reason.context_targets(f, f.select("doc_id", "field_key"), reason.edges(spark, {"line_0": ("line_1", "line_2"), "line_1": ("line_0",)}))
    return found.select("doc_id", "field_key", F.array_join(F.transform(F.map_entries("hints"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("hints"))


@query(
    f"""WITH {_SQL_FIELDS}, l AS (SELECT doc_id, CASE data_type WHEN 'amount' THEN 'unit_price_' || pos WHEN 'date' THEN 'head.date' || pos WHEN 'code' THEN 'nsn_' || pos ELSE 'note_' || pos END AS path, pos, confidence, data_type FROM fields)
SELECT doc_id, path, CASE data_type WHEN 'amount' THEN 'amount' WHEN 'date' THEN 'date' WHEN 'code' THEN 'code' ELSE 'text' END AS kind, CASE WHEN data_type = 'date' THEN 0.5 ELSE confidence END AS confidence FROM l"""
)
def leaf_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and confidences of assembled leaves; nested paths come from no field."""
    n = F.col("pos").cast("string")
    path = F.when(F.col("data_type") == "amount", F.concat(F.lit("unit_price_"), n)).when(F.col("data_type") == "date", F.concat(F.lit("head.date"), n)).when(F.col("data_type") == "code", F.concat(F.lit("nsn_"), n)).otherwise(F.concat(F.lit("note_"), n))
    f = _fields(spark, sf_dir).withColumn("path", path)
    leaves = f.select("doc_id", "path", F.lit("x").alias("value"), F.lit(None).cast("double").alias("stated"))
    return score.leaf_confidences(leaves, f.select("doc_id", "pos", F.col("path").alias("field_key"), "confidence"))


@query(
    """SELECT c_custkey, CASE WHEN starts_with(address, 'NATION_1') THEN 'ONE' WHEN starts_with(address, 'NATION_2') THEN 'TWO' WHEN starts_with(address, 'NAT') THEN 'REST' ELSE coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSES' END, c_mktsegment) END AS location
FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE 'NATION_' || c_nationkey || ' street' END AS address FROM customer)"""
)
def location_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location by its address's city, else by its alias."""
    c = _table(spark, sf_dir, "customer")
    address = F.when(F.col("c_custkey") % 3 == 0, "unknown").otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"), F.lit(" street")))
    aliases = {"NATION_1": "ONE", "NATION_2": "TWO", "NAT": "REST", "BUILDING": "HOUSES"}
    return c.select("c_custkey", correct.location_corrected(F.col("c_mktsegment"), address, (), aliases).alias("location"))


@query(
    f"""WITH q AS ({_SQL_QUEUE}), s AS (SELECT queue_id % 500 AS item, status, enqueued_at, queue_id FROM q)
SELECT item AS queue_id, arg_max(status, (enqueued_at, status)) AS status FROM s GROUP BY item"""
)
def queue_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of every item from its changes."""
    changes = _queue(spark, sf_dir).select((F.col("queue_id") % 500).alias("queue_id"), "status", F.col("enqueued_at").alias("at"))
    return route.latest_status(changes).select("queue_id", "status")


@query(
    f"""WITH {_SQL_TRIALS} SELECT trial, CASE WHEN validation_error_count > 7 THEN 'many' ELSE 'few' END AS errors, count(*) AS documents, round(avg(validation_error_count), 4) AS validation_error_count FROM trials GROUP BY ROLLUP (trial, errors)"""
)
def trial_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of trials by form, by trial and in all."""
    after, before = _trials(spark, sf_dir)
    both = after.withColumn("trial", F.lit("after")).unionByName(before.withColumn("trial", F.lit("before")))
    rows = both.withColumn("errors", F.when(F.col("validation_error_count") > 7, "many").otherwise("few"))
    return evals.trial_report(rows, "trial", "errors").select("trial", "errors", "documents", "validation_error_count")


@query(
    """SELECT user_id, event_type, array_to_string(list_slice(list_sort(list(DISTINCT CAST(json_extract(props, '$.k') AS INTEGER))), 1, 4), ',') AS shown, count(DISTINCT CAST(json_extract(props, '$.k') AS INTEGER)) = 1 AS consistent FROM events GROUP BY ALL"""
)
def value_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first distinct values of repeated runs, and whether there is one only; a report's limit."""
    v = _table(spark, sf_dir, "events").select("user_id", "event_type", X.json_at(F.try_parse_json("props"), "k", "int").alias("value"))
    shown = evals.distinct_values(v, "user_id", "event_type")
    one = evals.consistency(v, "user_id", "event_type")
    return shown.join(one, ["user_id", "event_type"]).select("user_id", "event_type", F.array_join(F.transform("values", lambda x: x.cast("string")), ",").alias("shown"), "consistent")


@query("""SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '","note":null}' AS json_output FROM orders""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON, nulls kept."""
    o = _table(spark, sf_dir, "orders").withColumn("note", F.lit(None).cast("string"))
    return sinks.serialized(o, ["o_orderkey", "o_orderpriority", "note"], ("json",)).select("o_orderkey", "json_output")


@query(
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'supply_request' ELSE 'unknown' END AS form, CASE p_size % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'seal' ELSE 'printed_text' END AS region,
       CASE WHEN p_size % 3 = 0 THEN '보급청구서' ELSE '군수 서식 유형 불명' END AS title, p_size < 20 OR (p_size % 2 = 0 AND p_retailprice < 950) AS hinted FROM part"""
)
def fallback_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types as the fallback reader has them, titles, and which regions get a hint."""
    p = _table(spark, sf_dir, "part")
    form = model.form_of_fallback(F.when(F.col("p_size") % 3 == 0, "supply_request").otherwise("receipt"))
    region = model.region_of_fallback(F.when(F.col("p_size") % 4 == 0, "text").when(F.col("p_size") % 4 == 1, "seal").otherwise("signature"))
    previous = F.when(F.col("p_size") % 2 == 0, F.when(F.col("p_retailprice") < 950, 0.79).otherwise(0.8))
    return p.select("p_partkey", form.alias("form"), region.alias("region"), model.title_of(form).alias("title"), model.wants_hint(previous, F.col("p_size") < 20).alias("hinted"))
from . import records  # noqa: E402, F401  it registers its own queries
