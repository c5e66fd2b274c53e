"""Penalties, adjusted confidences and the review decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import clamped, leaf_weight, weighted_mean
from ..functions.text import field_of_path, last_step, leaf_type
from ..model import FALLBACK_CAP, FALLBACK_EXTRA, LEAST_OVERALL, OTHER_PENALTY, PENALTY, least_confidence, looked_up


def penalty_of(error_type: Column) -> Column:
    return looked_up(error_type, PENALTY, OTHER_PENALTY)


def penalty_keys(ref: Column) -> Column:
    """Of each part of a reference: the path without places, and its last step if that differs."""
    parts = F.transform(F.split(ref, ","), lambda p: F.regexp_replace(F.trim(p), r"\[\d+\]", ""))
    return F.flatten(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.when(p.contains("."), F.array(p, last_step(p))).otherwise(F.array(p))))


def penalty_map(errors: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, field_key, penalty): penalties add up over errors(key, error_type, field_ref)."""
    keyed = errors.select(key, penalty_of(F.col("error_type")).alias("penalty"), F.explode(penalty_keys(F.col("field_ref"))).alias("field_key"))
    return keyed.groupBy(key, "field_key").agg(F.round(F.sum("penalty"), 4).alias("penalty"))


def adjusted(fields: DataFrame, penalties: DataFrame, fallback: Column | None = None, key: str = "doc_id") -> DataFrame:
    """fields with the confidence less its penalty, and flagged by its type's least confidence (more of it on the fallback path)."""
    less = F.greatest(F.lit(0.0), F.col("confidence") - F.coalesce(F.col("penalty"), F.lit(0.0)))
    least = least_confidence(F.col("data_type")) + (F.lit(0.0) if fallback is None else F.when(fallback, FALLBACK_EXTRA).otherwise(0.0))
    joined = fields.join(penalties, [key, "field_key"], "left")
    return joined.withColumns({"is_flagged": less < least, "confidence": F.round(less, 4)}).drop("penalty")


def leaf_confidences(leaves: DataFrame, fields: DataFrame, key: str = "doc_id", strict: bool = True) -> DataFrame:
    """(key, path, kind, confidence) of the leaves (key, path, value, stated) of assembled results.

    A stated confidence wins; else that of the field the path comes from, else 0.5. Strictly,
    nested paths come from no field; otherwise a leaf's last step names one.
    """
    named = field_of_path(F.col("path"))
    if not strict:
        named = F.coalesce(named, last_step(F.col("path")))
    best = fields.groupBy(key, F.col("field_key").alias("__field")).agg(F.max_by("confidence", "pos").alias("__confidence"))
    joined = leaves.withColumn("__field", named).join(best, [key, "__field"], "left")
    stated = F.col("stated")
    return joined.select(key, "path", F.when(stated.isNotNull(), F.lit("handwritten")).otherwise(leaf_type(F.col("path"))).alias("kind"), clamped(F.coalesce(stated, "__confidence", F.lit(0.5))).alias("confidence"))


def overall_of_leaves(leaves: DataFrame, key: str = "doc_id") -> DataFrame:
    return leaves.groupBy(key).agg(weighted_mean(F.col("confidence"), leaf_weight(F.col("kind"))).alias("overall"))


def overall_of_fields(fields: DataFrame, key: str = "doc_id") -> DataFrame:
    return fields.groupBy(key).agg(F.avg("confidence").alias("overall"))


def capped(overall: Column, fallback: Column) -> Column:
    return F.when(fallback, F.least(overall, F.lit(FALLBACK_CAP))).otherwise(overall)


def review_required(other: Column, critical: Column, flagged: Column, overall: Column, fallback: Column) -> Column:
    """Documents outside the domain are never reviewed."""
    return ~other & (critical | flagged | (overall < LEAST_OVERALL) | fallback)


def decided(documents: DataFrame, fields: DataFrame, errors: DataFrame, leaves: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """documents(key, form_type, processing_path) with overall, flagged fields, error counts and review_required."""
    with_fallback = fields.join(documents.select(key, (F.col("processing_path") == "fallback").alias("__fallback")), key)
    done = adjusted(with_fallback, penalty_map(errors, key), F.col("__fallback"), key)
    per_field = done.groupBy(key).agg(
        # in decimals, a mean doesn't depend on the order of its rows
        F.avg(F.col("confidence").cast("decimal(10,4)")).cast("double").alias("mean_confidence"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("is_flagged"), F.struct("pos", "field_key")))), lambda x: x["field_key"]).alias("flagged_fields"),
    )
    per_error = errors.groupBy(key).agg(F.count("*").alias("n_errors"), F.bool_or(F.col("severity") == "critical").alias("critical"))
    out = documents.join(per_field, key, "left").join(per_error, key, "left")
    mean = F.coalesce("mean_confidence", F.lit(0.0))
    if leaves is not None:
        out = out.join(overall_of_leaves(leaf_confidences(leaves, done, key), key).withColumnRenamed("overall", "leaf_overall"), key, "left")
        mean = F.coalesce("leaf_overall", mean)
    fallback = F.col("processing_path") == "fallback"
    flagged = F.coalesce("flagged_fields", F.array().cast("array<string>"))
    out = out.withColumns({"flagged_fields": flagged, "n_errors": F.coalesce("n_errors", F.lit(0)), "critical": F.coalesce("critical", F.lit(False)), "overall": capped(mean, fallback)})
    return out.withColumn("review_required", review_required(F.col("form_type") == "other", F.col("critical"), F.size("flagged_fields") > 0, F.col("overall"), fallback)).drop("mean_confidence", "leaf_overall")


def decided_at_once(fields: DataFrame, key: str = "doc_id") -> DataFrame:
    """What decided gives, from fields that have their errors beside them, in one grouping by document.

    fields(key, form_type, processing_path, pos, field_key, data_type, confidence, errors):
    errors are structs with error_type, severity and field_ref, and may refer to any field of
    the document. Where fields are dealt by document already, nothing is shuffled.
    """
    one = F.struct("pos", "field_key", "data_type", "confidence")
    docs = fields.groupBy(key, "form_type", "processing_path").agg(F.array_sort(F.collect_list(one)).alias("__fields"), F.flatten(F.collect_list("errors")).alias("__errors"))
    fallback = F.col("processing_path") == "fallback"
    charges = F.flatten(F.transform("__errors", lambda e: F.transform(penalty_keys(e["field_ref"]), lambda k: F.struct(k.alias("field_key"), penalty_of(e["error_type"]).alias("penalty")))))
    docs = docs.withColumn("__charges", charges)

    def charged(f: Column) -> Column:
        mine = F.filter("__charges", lambda c: c["field_key"] == f["field_key"])
        penalty = F.round(F.aggregate(mine, F.lit(0.0), lambda s, c: s + c["penalty"]), 4)
        less = F.greatest(F.lit(0.0), f["confidence"] - penalty)
        least = least_confidence(f["data_type"]) + F.when(fallback, FALLBACK_EXTRA).otherwise(0.0)
        return F.struct(f["field_key"].alias("field_key"), F.round(less, 4).cast("decimal(10,4)").alias("confidence"), (less < least).alias("is_flagged"))

    docs = docs.withColumn("__done", F.transform("__fields", charged))
    total = F.aggregate("__done", F.lit(0).cast("decimal(20,4)"), lambda s, f: (s + f["confidence"]).cast("decimal(20,4)"))
    mean = (total.cast("decimal(24,8)") / F.size("__done")).cast("double")
    docs = docs.select(
        key, "form_type", "processing_path", F.transform(F.filter("__done", lambda f: f["is_flagged"]), lambda f: f["field_key"]).alias("flagged_fields"),
        F.size("__errors").cast("long").alias("n_errors"), F.exists("__errors", lambda e: e["severity"] == "critical").alias("critical"), capped(mean, fallback).alias("overall"),
    )
    return docs.withColumn("review_required", review_required(F.col("form_type") == "other", F.col("critical"), F.size("flagged_fields") > 0, F.col("overall"), fallback))
