"""Whole stages: layout refinement, validation of extracted documents, second readings, and loading."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import correct, infer, layout, reason, route, rules, score
from ..sources import sinks

#: Where the dictionaries' fields are in an assembled result.
PLACES = {"business_location": "applicant.business_location", "address": "applicant.address", "industry_class_number": "bid_info.industry_class_number", "issuing_office": "seal_verification.issuing_office"}


def refined_layout(regions: DataFrame, order: DataFrame) -> DataFrame:
    """Regions without micro and doubled boxes, with merged texts, in the order that is left of order(doc_id, region_id, order_idx)."""
    kept = layout.refined(layout.without_micro(regions)).drop("rank")
    merged = layout.merged_texts(kept)
    taken = merged.select("doc_id", F.col("region_id").alias("into"), F.explode("members").alias("region_id"))
    survivors = order.join(kept.select("doc_id", "region_id"), ["doc_id", "region_id"], "left_semi")
    places = layout.order_after_merge(survivors, merged, taken)
    return merged.join(places, ["doc_id", "region_id"], "left")


def map_getter(values: str, items: str | None = None) -> rules.Getter:
    """Values of rules from a map of path to text; lists from a column of checklist items."""

    def get(path: str, kind: str = "string") -> Column:
        if kind == "array":
            return F.col(items) if items else F.lit(None).cast("array<struct<item_number:int,result:string>>")
        return F.try_element_at(F.col(values), F.lit(path))

    return get


def path_values(leaves: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, values): a document's leaves as a map of path to text."""
    return leaves.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("path", "value"))).alias("values"))


def corrected_values(values: Column, dictionaries: dict) -> Column:
    """The map with the dictionaries' fields put right where they are."""
    at = {k: F.try_element_at(values, F.lit(p)) for k, p in PLACES.items()}
    new = {
        "business_location": correct.location_corrected(at["business_location"], at["address"], dictionaries["cities"], dictionaries["aliases"]),
        "industry_class_number": F.coalesce(correct.nearest(F.trim(at["industry_class_number"]), dictionaries["codes"]), at["industry_class_number"]),
        "issuing_office": F.coalesce(correct.nearest(F.trim(at["issuing_office"]), dictionaries["offices"]), at["issuing_office"]),
    }
    entries = F.filter(F.array(*[F.struct(F.lit(PLACES[k]).alias("key"), v.alias("value")) for k, v in new.items()]), lambda e: e["value"].isNotNull())
    rest = F.map_filter(values, lambda k, _: ~k.isin(*[PLACES[n] for n in new]))
    return F.map_concat(rest, F.map_from_entries(entries))


def validated(documents: DataFrame, fields: DataFrame, leaves: DataFrame, rules_of_form: dict[str, Sequence[dict]], type_patterns: Sequence[dict], key_patterns: Sequence[dict], dictionaries: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their decision, fields as adjusted, errors numbered by document).

    Patterns of fields come first, then dictionaries on the assembled values, then the
    form's rules on what these made of it; documents of other kinds have no errors.
    """
    checked = rules.pattern_errors(fields, type_patterns, key_patterns)
    military = documents.where(route.is_domain(F.col("form_type"))).select("doc_id", "form_type")
    first = checked.join(military, "doc_id").select("doc_id", F.lit(1).alias("layer"), "pos", F.posexplode("pattern_errors").alias("place", "e")).select("doc_id", "layer", "pos", "place", "e.rule_id", "e.error_type", "e.severity", "e.field_ref", F.col("e.rule_id").alias("message"))
    values = path_values(leaves)
    if dictionaries:
        values = values.withColumn("values", corrected_values(F.col("values"), dictionaries))
    ruled = rules.with_form_errors(military.join(values, "doc_id"), rules_of_form, map_getter("values"))
    second = ruled.select("doc_id", F.lit(2).alias("layer"), F.lit(0).alias("pos"), F.posexplode("errors").alias("place", "e")).select("doc_id", "layer", "pos", "place", "e.rule_id", "e.error_type", "e.severity", "e.field_ref", "e.message")
    both = first.unionByName(second)
    numbered = both.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in both.columns if c != "doc_id"]))).alias("errors"))
    errors = numbered.select("doc_id", F.posexplode("errors").alias("at", "e")).select("doc_id", F.format_string("ve_%04d", F.col("at") + 1).alias("error_id"), F.col("at").alias("pos"), "e.rule_id", "e.error_type", "e.severity", "e.field_ref", "e.message")
    plain = checked.drop("pattern_errors")
    done = score.decided(documents, plain, errors, leaves.select("doc_id", "path", "value", "stated"))
    adjusted = score.adjusted(plain.join(documents.select("doc_id", (F.col("processing_path") == "fallback").alias("__fallback")), "doc_id"), score.penalty_map(errors), F.col("__fallback")).drop("__fallback")
    return done, adjusted, errors


def read_again(fields: DataFrame, regions: DataFrame, answers: Callable[[DataFrame], DataFrame], below: float = 0.60) -> DataFrame:
    """fields after a second reading, with the next budget, of those that are weak; answers(tasks) reads them."""
    weak = route.retry_candidates(fields, regions, below)
    tasks = weak.select("doc_id", "region_id", "field_key", "data_type").join(regions.select("doc_id", "region_id", "pixel_budget"), ["doc_id", "region_id"]).withColumn("pixel_budget", route.retry_budget(F.col("pixel_budget")))
    found = answers(tasks).join(tasks.select("doc_id", "region_id", "field_key", "data_type"), ["doc_id", "region_id"])
    scored = infer.scored_answers(found, F.col("data_type")).where("content_type <> 'error'")
    return route.retry_merged(fields, scored.select("doc_id", "field_key", F.col("content").alias("corrected_value"), "confidence"))


def reasoned_again(fields: DataFrame, errors: DataFrame, regions: DataFrame, edges: DataFrame, answers: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """fields after the targets of errors and contexts were read once more; an answer counts only if it is surer."""
    chosen = reason.targets(fields, errors, regions, edges)
    place = regions.where("field_key is not null").groupBy("doc_id", "field_key").agg(F.min_by("region_id", "pos").alias("region_id"))
    tasks = chosen.join(place, ["doc_id", "field_key"]).withColumn("prompt", reason.prompt(F.col("field_key"), F.col("demand"), F.col("hints")))
    found = answers(tasks.select("doc_id", "region_id", "field_key", "prompt")).join(tasks.select("doc_id", "region_id", "field_key"), ["doc_id", "region_id"])
    parsed = X.any_unwrapped(F.col("content"), F.col("field_key"))
    return route.retry_merged(fields, found.select("doc_id", "field_key", parsed.alias("corrected_value"), "confidence"))


def refinement_counts(regions: DataFrame, refined: DataFrame) -> DataFrame:
    """(doc_id, n_before, n_micro, n_after, n_taken_in): what refined_layout did to every page."""
    before = regions.groupBy("doc_id").agg(F.count("*").alias("n_before"))
    wide = layout.without_micro(regions).groupBy("doc_id").agg(F.count("*").alias("__wide"))
    after = refined.groupBy("doc_id").agg(F.count("*").alias("n_after"), F.sum(F.size("members")).alias("n_taken_in"))
    out = before.join(wide, "doc_id", "left").join(after, "doc_id", "left")
    return out.select("doc_id", "n_before", (F.col("n_before") - F.coalesce("__wide", F.lit(0))).alias("n_micro"), F.coalesce("n_after", F.lit(0)).alias("n_after"), F.coalesce("n_taken_in", F.lit(0)).alias("n_taken_in"))


def keyed_regions(regions: DataFrame, rules_of_schema: DataFrame) -> DataFrame:
    """Regions to read: where a schema has assembly rules, only those with a field."""
    ruled = rules_of_schema.select("schema_id").distinct().withColumn("__ruled", F.lit(True))
    return regions.join(ruled, "schema_id", "left").where(F.col("__ruled").isNull() | F.col("field_key").isNotNull()).drop("__ruled")


def reader_of(region_type: Column, handwritten: Column, has_schema: Column) -> Column:
    """S3 reads handwriting, the guided path what has a schema, S2 the rest."""
    return F.when((region_type == "handwritten_field") | handwritten, "S3").when(has_schema, "guided").otherwise("S2")


def ranks_synced(value: Column, schema: str = "team string, rank string, name string") -> Column:
    """A JSON object in a field's value with its rank normalised."""
    parsed = F.from_json(value, schema)
    return F.when(parsed["rank"].isNotNull(), F.to_json(parsed.withField("rank", correct.rank_normalized(parsed["rank"])))).otherwise(value)


def loaded(table: DataFrame, done: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """The documents table after an upsert, and the queue rows of what needs a review."""
    rows = done.select("doc_id", "form_type", "processing_path", F.col("overall").alias("confidence"), "review_required", now.alias("processed_at"))
    return sinks.upserted(table, rows), route.enqueued(done, now)
