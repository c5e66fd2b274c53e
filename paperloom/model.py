"""Fixed tables of the domain, and lookups in them as column expressions.

Values that decide results are stated here once; a lookup is a literal map, so that it
stays within code generation and never joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Detector labels and the region type of each; any other label is text.
REGION_OF_LABEL = {
    "paragraph_title": "header", "doc_title": "header", "text": "text", "content": "text", "aside_text": "text", "number": "text", "abstract": "text",
    "table": "table", "chart": "chart", "image": "figure", "figure_title": "figure", "formula": "formula", "formula_number": "formula", "header": "header",
    "footer": "footer", "footnote": "footer", "reference": "footer", "reference_content": "footer", "seal": "seal", "algorithm": "text",
    "vertical_text": "text", "inline_formula": "formula", "display_formula": "formula", "header_image": "figure", "footer_image": "figure", "vision_footnote": "footer",
}
# Pixel budget of a region type.
BUDGET_OF_REGION = {"table": 1120, "seal": 560, "text": 560, "formula": 280, "chart": 280, "figure": 140, "header": 140, "footer": 140, "handwritten_field": 1120, "signature": 140}
DEFAULT_BUDGET, DISPATCH_BUDGETS = 560, (140, 560, 1120)
# The budget of a second attempt.
NEXT_BUDGET = {140: 280, 280: 560, 560: 1120, 1120: 1120}
# The skill that reads a region type; others are not read.
SKILL_OF_REGION = {"text": "S2", "header": "S2", "footer": "S2", "handwritten_field": "S3", "seal": "S4", "table": "S5", "signature": "S6"}
# Content type of a table cell to region type.
REGION_OF_CONTENT = {"printed": "text", "handwritten": "handwritten_field", "signature": "signature", "seal": "seal"}
BUDGET_OF_CONTENT = {"printed": 560, "handwritten": 1120, "signature": 140, "seal": 560}
# Class of a data type, least confidence and expected tokens of a class.
CLASS_OF_TYPE = {
    "number": "number", "integer": "number", "amount": "amount", "currency": "amount", "code": "code", "nsn": "code", "k_nsn": "code", "unit_code": "code",
    "equipment_id": "code", "date": "date", "quantity": "quantity", "text": "text", "string": "text", "signature": "signature", "rank": "text",
}
LEAST_CONFIDENCE = {"amount": 0.99, "code": 0.97, "date": 0.95, "quantity": 0.95, "number": 0.95, "text": 0.90, "signature": 0.70}
DEFAULT_LEAST = 0.90
EXPECTED_TOKENS = {"amount": 4, "code": 5, "date": 3, "quantity": 2, "number": 3, "text": 5, "signature": 2}
DEFAULT_TOKENS = 5
# Weight of a leaf's type in the document's confidence.
LEAF_WEIGHT = {"amount": 3.0, "code": 2.5, "date": 2.0, "quantity": 2.0, "text": 1.0, "handwritten": 1.0, "seal": 0.8, "signature": 0.5}
# Weight of a field's class in the scorer's own mean.
FIELD_WEIGHT = {"amount": 2.0, "code": 1.5, "quantity": 1.5, "number": 1.5, "date": 1.2, "text": 1.0, "signature": 0.5}
# What an error of a type takes off a field; an unknown type takes OTHER_PENALTY.
PENALTY = {"arithmetic": 0.30, "code_format": 0.15, "date_logic": 0.10, "missing_field": 0.20, "format": 0.10}
OTHER_PENALTY = 0.05
# Error type of a rule type that states none.
ERROR_OF_RULE = {
    "REGEX_MATCH": "code_format", "NOT_EMPTY": "missing_field", "DATE_ORDER": "date_logic", "ARITHMETIC": "arithmetic", "NAME_MATCH": "format",
    "ADDR_CONTAINS": "format", "ARRAY_LENGTH": "missing_field", "ARRAY_SEQUENCE": "format", "ARRAY_ENUM": "format",
}
# Keys that a walk over an assembled result passes by.
SKIPPED_KEYS = ("analysis", "result_confidence", "aggregator_blob", "low_confidence_fields", "overall_confidence", "fixed_content")
# The ranks, in the order in which the nearest is looked for.
RANKS = ("이병", "일병", "상병", "병장", "하사", "중사", "상사", "원사", "준위", "소위", "중위", "대위", "소령", "중령", "대령", "준장", "소장", "중장", "대장")
# Code patterns in the order in which they claim a string.
CODE_PATTERNS = ((r"\d{4}-\d{2}-\d{3}-\d{4}", "nsn"), (r"KN-\d{5}-\d{4}", "k_nsn"), (r"\d{2,4}부대", "unit_code"), (r"\d{4}-\d{2}-\d{2}", "date"))
# The direction in which a metric is better.
METRIC_DIRECTION = {
    "overall_confidence": "up", "confidence_mean": "up", "validation_error_count": "down", "review_queued": "down", "retry_count": "down",
    "warning_count": "down", "s7_fallback": "down", "processing_ms": "down", "low_conf_count": "down", "augmented_count": "stable",
}
PRIMARY_METRICS = ("overall_confidence", "validation_error_count", "review_queued")
FALLBACK_FACTOR, FALLBACK_EXTRA, FALLBACK_CAP, LEAST_OVERALL = 0.7, 0.10, 0.70, 0.85
# Official titles of forms; documents of other kinds have none.
TITLE_OF_FORM = {
    "supply_request": "보급청구서", "maintenance_record": "정비기록서", "inventory_sheet": "물자현황표", "handover_doc": "인수인계서",
    "inspection_report": "검사보고서", "equipment_checklist": "전비품 확인서 작성 점검표", "bid_application": "입찰참가신청서", "unknown": "군수 서식 유형 불명",
}
# Form types that the fallback reader shares; its others are unknown here.
FALLBACK_FORMS = ("supply_request", "maintenance_record", "inventory_sheet", "handover_doc", "inspection_report")
#: Region types that the fallback reader knows; any other is printed text to it.
FALLBACK_REGIONS = ("text", "table", "figure", "header", "footer", "seal", "formula", "chart")
#: Below this confidence a region's next reading is given a hint.
HINT_BELOW = 0.80
#: Literals that stand for nothing, besides null.
EMPTY_TOKENS = ("", "None", "{}", "[]")

#: Columns of the fact tables.
FIELDS = (
    "doc_id string, pos int, field_key string, raw_value string, corrected_value string, data_type string, confidence double, token_logprobs array<double>, is_flagged boolean, region_id string, was_retried boolean"
)
REGIONS = "doc_id string, pos int, region_id string, region_type string, x1 int, y1 int, x2 int, y2 int, confidence double, source string, field_key string, order_idx int"


def looked_up(key: Column, table: Mapping, default=None) -> Column:
    """The table's value for key; default (or null) where it has none."""
    found = F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def region_type(label: Column) -> Column:
    return looked_up(F.lower(label), REGION_OF_LABEL, "text")


def pixel_budget(region: Column) -> Column:
    return looked_up(region, BUDGET_OF_REGION, DEFAULT_BUDGET)


def skill(region: Column) -> Column:
    return looked_up(region, SKILL_OF_REGION)


def nearest_budget(budget: Column) -> Column:
    """The dispatch budget next to budget; of two at the same distance the smaller."""
    return F.array_min(F.array(*[F.struct(F.abs(budget - b).alias("d"), F.lit(b).alias("b")) for b in DISPATCH_BUDGETS]))["b"]


def least_confidence(data_type: Column) -> Column:
    return looked_up(looked_up(data_type, CLASS_OF_TYPE, "text"), LEAST_CONFIDENCE, DEFAULT_LEAST)


def form_of_fallback(form: Column) -> Column:
    return F.when(form.isin(*FALLBACK_FORMS), form).otherwise("unknown")


def region_of_fallback(region: Column) -> Column:
    return F.when(region.isin(*FALLBACK_REGIONS), region).otherwise("printed_text")


def title_of(form: Column) -> Column:
    return looked_up(form, TITLE_OF_FORM)


def wants_hint(previous: Column, forced: Column) -> Column:
    """First readings go without a hint unless it is forced."""
    return forced | F.coalesce(previous < HINT_BELOW, F.lit(False))


def property_type(key: Column, json_type: Column) -> Column:
    """Data type of a schema's property, by its JSON type and then by its key."""
    return (
        F.when(json_type.isin("integer", "number"), "number").when(key.endswith("_date") | (key == "date"), "date").when(key.isin("nsn", "unit_code", "equipment_id"), "code")
        .when(key.isin("quantity", "stock_qty", "disposal_qty"), "quantity").when(key.isin("unit_price", "total", "grand_total"), "amount").otherwise("text")
    )
