"""Path, status, queue and export decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import NEXT_BUDGET, looked_up

# What a training example asks for.
INSTRUCTION = "이 서식에서 모든 필드를 추출하세요."


def processing_path(model_healthy: Column, fallback_enabled: Column, fallback_healthy: Column) -> Column:
    return F.when(model_healthy, "vlm").when(fallback_enabled & fallback_healthy, "fallback").otherwise("review_queue")


def final_status(other: Column, review: Column, fallback: Column) -> Column:
    return F.when(other, "other_document").when(review, "review").when(fallback, "partial").otherwise("success")


def review_reason(fallback: Column, any_flagged: Column) -> Column:
    return F.when(fallback, "fallback").when(any_flagged, "low_confidence").otherwise("validation_failed")


def review_priority(critical: Column, reason: Column) -> Column:
    return F.when(critical | (reason == "total_failure"), "critical").otherwise("normal")


def queue_id(doc_id: Column, at: Column) -> Column:
    """RQ-day-time-document-digest; the digest depends on document and time alone, so that a retried task makes it again."""
    digest = F.substring(F.sha2(F.concat_ws("|", doc_id, at.cast("string")), 256), 1, 6)
    return F.concat_ws("-", F.lit("RQ"), F.date_format(at, "yyyyMMdd"), F.date_format(at, "HHmmss"), doc_id, digest)


def retry_budget(budget: Column) -> Column:
    return F.coalesce(looked_up(budget, NEXT_BUDGET), budget)


def enqueued(validated: DataFrame, now: Column) -> DataFrame:
    """Queue rows of the validated documents that need a review."""
    fallback = F.col("processing_path") == "fallback"
    rows = validated.where("review_required").withColumn("reason", review_reason(fallback, F.size("flagged_fields") > 0))
    return rows.select(queue_id(F.col("doc_id").cast("string"), now).alias("queue_id"), "doc_id", now.alias("enqueued_at"), review_priority(F.col("critical"), F.col("reason")).alias("priority"), "reason", "processing_path", "flagged_fields", F.lit("pending").alias("status"))


def failed_rows(documents: DataFrame, now: Column) -> DataFrame:
    """Queue rows of documents that no path could read."""
    reason = F.lit("total_failure")
    return documents.select(queue_id(F.col("doc_id").cast("string"), now).alias("queue_id"), "doc_id", now.alias("enqueued_at"), review_priority(F.lit(False), reason).alias("priority"), reason.alias("reason"), F.lit("review_queue").alias("processing_path"), F.array().cast("array<string>").alias("flagged_fields"), F.lit("pending").alias("status"))


def pages_status(statuses: Column, strict: bool = True, expected: Column | None = None) -> Column:
    """Status of a document from the set of its pages'. Not strictly, pages without an output count as failed."""
    found = F.array_distinct(statuses)
    if not strict and expected is not None:
        found = F.when(F.size(statuses) < expected, F.array_distinct(F.concat(found, F.array(F.lit("failed"))))).otherwise(found)
    alone = F.when(F.size(found) == 1, F.get(found, F.lit(0)))
    return F.when(F.size(found) == 0, "failed").when(alone.isin("success", "failed", "other_document"), alone).otherwise("partial")


def queue_stats(queue: DataFrame, now: Column) -> DataFrame:
    """Counts by status and priority, and minutes since the oldest open item came, and since open items came on average."""
    open_item = F.col("status").isin("pending", "in_review")
    minutes = (F.unix_micros(now) - F.unix_micros("enqueued_at")) / 6e7
    return queue.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "in_review").alias("in_review"),
        F.count_if(F.col("status") == "approved").alias("approved"), F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.count_if(open_item & (F.col("priority") == "critical")).alias("critical_open"),
        F.round(F.max(F.when(open_item, minutes)), 2).alias("oldest_wait_minutes"), F.round(F.avg(F.when(open_item, minutes)), 2).alias("mean_wait_minutes"),
    )


def queue_page(queue: DataFrame, status: str | None = None, priority: str | None = None) -> DataFrame:
    """Items to list: critical ones first, then the longest waiting."""
    out = queue
    for column, value in (("status", status), ("priority", priority)):
        out = out if value is None else out.where(F.col(column) == value)
    return out.orderBy(F.when(F.col("priority") == "critical", 0).otherwise(1), "enqueued_at", "queue_id")


def latest_status(events: DataFrame) -> DataFrame:
    """The last state of every queue item from its status changes(queue_id, status, at)."""
    return events.groupBy("queue_id").agg(F.max_by(F.struct("status", "at"), F.struct("at", "status")).alias("s")).select("queue_id", "s.status", "s.at")


def training_pairs(queue: DataFrame, output_format: str = "sft", status: str = "approved") -> DataFrame:
    """Corrected items as instruction and response, or as chosen and rejected, or as a form to classify."""
    rows = queue.where((F.col("status") == status) & (F.coalesce(F.col("corrected_json"), F.lit("")) != ""))
    base = ["doc_id", F.coalesce("image_path", F.lit("")).alias("image_path"), F.coalesce("processing_path", F.lit("")).alias("processing_path"), F.lit(INSTRUCTION).alias("instruction")]
    if output_format == "dpo":
        rejected = F.coalesce(F.nullif(F.col("errors_json"), F.lit("")), F.lit("{}"))
        return rows.select(*base, F.col("corrected_json").alias("chosen"), rejected.alias("rejected"))
    if output_format == "classify":
        return rows.select("doc_id", base[1], "form_type")
    if output_format != "sft":
        raise ValueError(f"no such format: {output_format}")
    return rows.select(*base, F.col("corrected_json").alias("response"))


def budget_groups(regions: DataFrame) -> DataFrame:
    """Regions of a document by pixel budget, the largest first."""
    groups = regions.groupBy("doc_id", "pixel_budget").agg(F.transform(F.array_sort(F.collect_list(F.struct("order_idx", "region_id"))), lambda x: x["region_id"]).alias("region_ids"))
    return groups.withColumn("turn", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("pixel_budget"))))


def retry_merged(fields: DataFrame, retried: DataFrame) -> DataFrame:
    """fields with a second answer where its confidence is greater; any field with a second answer counts as retried."""
    again = retried.select("doc_id", "field_key", F.col("corrected_value").alias("__value"), F.col("confidence").alias("__confidence"))
    better = F.col("__confidence") > F.col("confidence")
    out = fields.join(again, ["doc_id", "field_key"], "left")
    return out.withColumns({"corrected_value": F.when(better, F.col("__value")).otherwise(F.col("corrected_value")), "was_retried": F.col("was_retried") | F.col("__confidence").isNotNull(), "confidence": F.greatest("confidence", F.coalesce("__confidence", "confidence"))}).drop("__value", "__confidence")


def retry_candidates(fields: DataFrame, regions: DataFrame, below: float = 0.60) -> DataFrame:
    weak = fields.where((F.col("confidence") < below) & ~F.col("was_retried"))
    return weak.join(regions.select("doc_id", "region_id"), ["doc_id", "region_id"], "left_semi")


def instructed(regions: DataFrame, instructions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(regions in reading order with their instruction, a warning for each region without one)."""
    made = instructions.select("doc_id", "region_id", *[c for c in instructions.columns if c not in regions.columns])
    found = regions.join(made, ["doc_id", "region_id"])
    missing = regions.join(made, ["doc_id", "region_id"], "left_anti")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("order_idx", "region_id"))
    return found.withColumn("turn", turn), missing.select("doc_id", "region_id", F.concat(F.lit("no instruction: "), F.col("region_id")).alias("warning"))


def is_domain(form_type: Column) -> Column:
    """Whether a document is of the domain; others take the path without rules."""
    return form_type != "other"


def queue_search(queue: DataFrame, *, form_type: str | None = None, path: str | None = None, first: str | None = None, last: str | None = None, status: str | None = None, priority: str | None = None) -> DataFrame:
    """Items of documents of the domain to list, by form type, path and days (both included), in the order of queue_page."""
    out = queue.where(is_domain(F.col("form_type")))
    for column, value in (("form_type", form_type), ("processing_path", path)):
        out = out if value is None else out.where(F.col(column) == value)
    day = F.to_date("enqueued_at")
    out = out if first is None else out.where(day >= F.lit(first).cast("date"))
    out = out if last is None else out.where(day <= F.lit(last).cast("date"))
    return queue_page(out, status, priority)


def queue_distribution(queue: DataFrame, now: Column) -> DataFrame:
    """Items, pending and critical ones, and the mean wait in minutes, by form type and status, with totals."""
    minutes = (F.unix_micros(now) - F.unix_micros("enqueued_at")) / 6e7
    open_item = F.col("status").isin("pending", "in_review")
    return queue.rollup("form_type", "status").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("priority") == "critical").alias("critical"), F.round(F.avg(F.when(open_item, minutes)), 2).alias("mean_wait_minutes"))
