"""Which fields are read again, with what hints and constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import empty_token, last_step

WEAK, SURE, TARGETS = 0.60, 0.70, 5
# Fields that are hints for a field, in the order in which they are named.
RELATED = {
    "address": ("phone", "business_location", "business_reg_number"), "business_location": ("address",), "phone": ("address",),
    "company_name": ("representative", "corporate_reg_number", "business_reg_number"), "representative": ("company_name", "submitter_name"),
    "representative_dob": ("representative",), "corporate_reg_number": ("company_name", "business_reg_number"), "business_reg_number": ("company_name", "corporate_reg_number"),
    "bid_name": ("announcement_number", "bid_date"), "announcement_number": ("bid_date", "bid_name"), "bid_date": ("announcement_number", "acquisition_date"),
    "acquisition_date": ("bid_date", "submission_date"), "agent_name": ("agent_dob",), "agent_dob": ("agent_name",), "submission_date": ("bid_date", "seal_issue_date"),
    "submitter_name": ("representative",), "seal_issuing_office": ("seal_issue_number", "seal_issue_date"), "seal_issue_number": ("seal_issuing_office", "seal_issue_date"),
    "seal_issue_date": ("seal_issuing_office", "seal_issue_number", "submission_date"),
}
# How a prompt states an error.
_ERROR = "(오류: %s)"
# What a prompt demands after an error of a type.
DEMANDS = (
    (("DATE_ORDER", "DATE_LOGIC"), "이 필드의 날짜는 다른 관련 날짜와 논리적 순서가 맞아야 합니다. "),
    (("NAME_MATCH",), "이 필드의 이름은 다른 필드의 이름과 동일인이어야 합니다. "),
    (("ADDR_CONTAINS", "FORMAT"), "사업장소재지는 주소의 앞부분(시/구)과 일치해야 합니다. "),
    (("ARITHMETIC",), "이 필드 값은 다른 필드들의 산술 결과와 일치해야 합니다. "),
    (("REGEX_MATCH", "CODE_FORMAT"), "이 필드 값은 정해진 형식을 따라야 합니다. "),
)


def edges(spark, related: dict[str, tuple[str, ...]] = RELATED) -> DataFrame:
    return spark.createDataFrame([(k, v, n) for k, vs in related.items() for n, v in enumerate(vs)], "field_key string, related_key string, ord int")


def constraint(error_type: Column, message: Column) -> Column:
    """What the prompt demands; null for errors that say nothing of how to read."""
    kind, out = F.upper(error_type), F.lit(None).cast("string")
    for kinds, text in reversed(DEMANDS):
        fits = kind.isin(*kinds) & (message.contains("주소") if "FORMAT" in kinds else F.lit(True))
        out = F.when(fits, F.concat(F.lit(text), F.format_string(_ERROR, message))).otherwise(out)
    return out


def related_keys(ref: Column) -> Column:
    """Field keys that a reference may mean: each part's last step, and the part with its steps joined."""
    parts = F.filter(F.transform(F.split(ref, ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(F.flatten(F.transform(parts, lambda p: F.when(p.contains("."), F.array(last_step(p), F.replace(p, F.lit("."), F.lit("_")))).otherwise(F.array(p)))))


def sure_values(fields: DataFrame, least: float = SURE) -> DataFrame:
    return fields.where((F.col("confidence") >= least) & ~empty_token(F.col("corrected_value"))).select("doc_id", F.col("field_key").alias("related_key"), F.col("corrected_value").alias("hint"))


def context_targets(fields: DataFrame, regions: DataFrame, edge_rows: DataFrame) -> DataFrame:
    """Weak fields with a region and at least one sure related value, and these values by name."""
    weak = fields.where((F.col("confidence") < WEAK) & ~F.col("was_retried")).join(regions.select("doc_id", "field_key").distinct(), ["doc_id", "field_key"], "left_semi")
    hints = weak.join(edge_rows, "field_key").join(sure_values(fields), ["doc_id", "related_key"])
    found = hints.groupBy("doc_id", "field_key", "pos", "confidence").agg(F.array_sort(F.collect_list(F.struct("ord", "related_key", "hint"))).alias("h"))
    return found.select("doc_id", "field_key", "pos", "confidence", F.map_from_entries(F.transform("h", lambda x: F.struct(x["related_key"], x["hint"]))).alias("hints"))


def consistency_targets(fields: DataFrame, errors: DataFrame, regions: DataFrame) -> DataFrame:
    """Fields that an error with a demand refers to, once each, with the first demand."""
    demand = errors.withColumn("demand", constraint(F.col("error_type"), F.col("message"))).where("demand is not null")
    keyed = demand.select("doc_id", F.col("pos").alias("error_pos"), "demand", F.explode(related_keys(F.col("field_ref"))).alias("field_key"))
    first = keyed.groupBy("doc_id", "field_key").agg(F.min_by("demand", "error_pos").alias("demand"))
    free = fields.where(~F.col("was_retried")).select("doc_id", "field_key", "pos", "confidence")
    return first.join(free, ["doc_id", "field_key"]).join(regions.select("doc_id", "field_key").distinct(), ["doc_id", "field_key"], "left_semi")


def targets(fields: DataFrame, errors: DataFrame, regions: DataFrame, edge_rows: DataFrame, most: int = TARGETS) -> DataFrame:
    """At most so many fields of a document to read again: those of errors first, then the least sure."""
    first = consistency_targets(fields, errors, regions).withColumn("kind", F.lit(0))
    second = context_targets(fields, regions, edge_rows).withColumn("kind", F.lit(1)).join(first.select("doc_id", "field_key"), ["doc_id", "field_key"], "left_anti")
    both = first.unionByName(second, allowMissingColumns=True)
    return both.withColumn("turn", F.row_number().over(Window.partitionBy("doc_id").orderBy("kind", "confidence", "pos"))).where(F.col("turn") <= most)


def prompt(field_key: Column, demand: Column, hints: Column) -> Column:
    lines = F.transform(F.map_entries(hints), lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"]))
    return F.concat_ws("\n", F.concat(F.lit("필드: "), field_key), demand, F.array_join(lines, "\n"))
