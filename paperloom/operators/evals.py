"""Evaluation of trials against earlier ones, and variance over repeated runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import METRIC_DIRECTION, PRIMARY_METRICS

LOW_CONFIDENCE = 0.75


def sign(delta: Column, direction: str) -> Column:
    if direction == "stable":
        moved = F.when(F.abs(delta) < 1, "neutral").otherwise("warning")
    else:
        better = delta > 0 if direction == "up" else delta < 0
        moved = F.when(better, "positive").otherwise("negative")
    return F.when(delta.isNull(), "unknown").when(delta == 0, "neutral").otherwise(moved)


def deltas(after: DataFrame, before: DataFrame, key: str = "doc_id", metrics: dict[str, str] = METRIC_DIRECTION) -> DataFrame:
    """(key, metric, before, after, delta, sign) for every row of after; rows only in before go."""
    held = [m for m in metrics if m in after.columns]
    a, b = (F.array(*[F.col(f"{side}.{m}").cast("double") for m in held]) for side in ("a", "b"))
    joined = after.alias("a").join(before.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "left").select(F.col(f"a.{key}").alias(key), a.alias("__a"), b.alias("__b"))
    rows = joined.select(key, F.posexplode(F.arrays_zip("__a", "__b")).alias("k", "v"))
    delta = F.col("v.__a") - F.col("v.__b")
    moved = F.when(delta.isNull(), "unknown")
    for k, m in enumerate(held):
        moved = moved.when(F.col("k") == k, sign(delta, metrics[m]))
    return rows.select(key, F.get(F.array(*[F.lit(m) for m in held]), F.col("k")).alias("metric"), F.round("v.__b", 4).alias("before"), F.round("v.__a", 4).alias("after"), F.round(delta, 4).alias("delta"), moved.alias("sign"))


def verdict(rows: DataFrame, *keys: str, primary: tuple[str, ...] = PRIMARY_METRICS) -> DataFrame:
    """(keys, verdict) of deltas: any loss among the primary metrics without a gain counts as regressed."""
    mine = F.col("metric").isin(*primary)
    up, down = F.coalesce(F.bool_or(mine & (F.col("sign") == "positive")), F.lit(False)), F.coalesce(F.bool_or(mine & (F.col("sign") == "negative")), F.lit(False))
    return rows.groupBy(*keys).agg(F.when(up & down, "MIXED").when(down, "REGRESSED").when(up, "IMPROVED").otherwise("NEUTRAL").alias("verdict"))


def mean_metrics(rows: DataFrame, *keys: str, metrics: dict[str, str] = METRIC_DIRECTION) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.round(F.avg(F.col(m).cast("double")), 4).alias(m) for m in metrics if m in rows.columns and m != "augmented_count"])


def trial_report(rows: DataFrame, *keys: str) -> DataFrame:
    """Means by each prefix of the keys, the total among them."""
    return rows.rollup(*keys).agg(F.count("*").alias("documents"), *[F.round(F.avg(F.col(m).cast("double")), 4).alias(m) for m in METRIC_DIRECTION if m in rows.columns])


def leaf_metrics(leaves: DataFrame, key: str = "doc_id") -> DataFrame:
    return leaves.groupBy(key).agg(F.count("confidence").alias("sub_confidence_count"), F.round(F.min("confidence"), 4).alias("confidence_min"), F.round(F.avg("confidence"), 4).alias("confidence_mean"), F.count_if(F.col("confidence") < LOW_CONFIDENCE).alias("low_conf_count"))


def previous_trial(trials: DataFrame, current: str) -> DataFrame:
    """The latest trial before the current one, as one row or null."""
    return trials.where((F.col("trial") < current) & F.col("readable")).agg(F.max("trial").alias("trial"))


def history(old: DataFrame, new: DataFrame, trial: str) -> DataFrame:
    """old with the new entry in place of any of the same trial, newest first."""
    return old.where(F.col("trial") != trial).unionByName(new, allowMissingColumns=True).orderBy(F.desc("trial"))


def evaluated(after: DataFrame, before: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deltas by document, means of the trial, and its verdict by the means."""
    means = [mean_metrics(side.withColumn("__all", F.lit(1)), "__all") for side in (after, before)]
    return deltas(after, before, key), means[0].drop("__all"), verdict(deltas(*means, key="__all"), "__all").drop("__all")


def timing_stats(runs: DataFrame, *keys: str, value: str = "total_ms") -> DataFrame:
    return runs.groupBy(*keys).agg(F.count(value).alias("n"), F.round(F.avg(value), 4).alias("mean"), F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 4).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))


def consistency(runs: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    """Whether repeated runs gave one value; the values are the distinct ones, in order."""
    return runs.groupBy(*keys).agg(F.count(value).alias("n_runs"), F.countDistinct(value).alias("n_values"), (F.countDistinct(value) == 1).alias("consistent"))


def distinct_values(runs: DataFrame, *keys: str, value: str = "value", shown: int = 4) -> DataFrame:
    """The first distinct values of each key; a report's limit."""
    once = runs.select(*keys, value).distinct()
    return once.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(value)), 1, shown).alias("values"))


def determinism(consistent: DataFrame, *keys: str) -> DataFrame:
    return consistent.groupBy(*keys).agg(F.count_if("consistent").alias("n_consistent"), F.count("*").alias("n_fields"), F.round(F.count_if("consistent") / F.greatest(F.count("*"), F.lit(1)), 4).alias("determinism"))


def run_flags(runs: DataFrame, *keys: str, columns: tuple[str, ...] = ("processing_path", "form_type", "review_required")) -> DataFrame:
    return runs.groupBy(*keys).agg(*[(F.countDistinct(c) == 1).alias(f"{c}_consistent") for c in columns])


def run_metric(summary: DataFrame) -> DataFrame:
    """(doc_id, retry_stats) of documents and of the pages nested in them."""
    pages = summary.select(F.explode("pdf_pages").alias("p")).select("p.doc_id", "p.retry_stats")
    return summary.select("doc_id", "retry_stats").unionByName(pages)


def sub_confidence(item: Column) -> Column:
    """The confidence of a variant that is an object, or a triple with it at the end."""
    return F.coalesce(F.try_variant_get(item, "$.confidence", "double"), F.try_variant_get(item, "$[2]", "double"))


def stage_times(pages: DataFrame, key: str = "parent_doc_id", timings: str = "timings") -> DataFrame:
    """Time of every stage over a document's pages, from maps of stage to milliseconds."""
    return pages.select(key, F.explode(timings).alias("step", "ms")).groupBy(key, "step").agg(F.round(F.sum("ms"), 1).alias("ms"))


def traces(trace: DataFrame, *keys: str) -> DataFrame:
    """Calls, their outcomes and times by trace group (a pixel budget or a skill)."""
    return trace.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "error").alias("error"), F.round(F.sum("elapsed_ms"), 1).alias("total_ms"), F.round(F.sum("elapsed_ms") / F.count("*"), 1).alias("avg_ms"))


def skew_angle(lines: DataFrame, most: float = 10.0) -> DataFrame:
    """Median angle, in degrees, of a page's lines(doc_id, x1, y1, x2, y2) that are nearly level; pages without one have no row."""
    angle = F.degrees(F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")))
    level = lines.where(F.col("x1") != F.col("x2")).withColumn("angle", angle).where(F.abs("angle") < most)
    return level.groupBy("doc_id").agg(F.median("angle").alias("angle"))


def largest(candidates: DataFrame, by: str, *, most: int = 1, key: str = "doc_id", tie: str = "pos") -> DataFrame:
    """A page's candidates (circles, contours) with the greatest size."""
    turn = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(by), tie))
    return candidates.withColumn("turn", turn).where(F.col("turn") <= most)


def snapshot(fields: DataFrame, run: Column) -> DataFrame:
    """What a run gave for every field, to compare with other runs; log-probabilities as their mean."""
    n = F.size("token_logprobs")
    mean = F.when(n > 0, F.aggregate("token_logprobs", F.lit(0.0), lambda s, x: s + x) / n).otherwise(0.0)
    return fields.select(run.alias("run_idx"), "doc_id", "field_key", F.col("corrected_value").alias("value"), F.round("confidence", 4).alias("confidence"), F.round(mean, 4).alias("logprob"))


def failure_streaks(checks: DataFrame, service: str, at: str, *ties: str, failures: int = 3) -> DataFrame:
    """checks(ok) with streak, the failures in a row up to each, and healthy: fewer than failures of them."""
    order = Window.partitionBy(service).orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    inside = checks.withColumn("__island", F.sum(F.col("ok").cast("long")).over(order))
    within = Window.partitionBy(service, "__island").orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return inside.withColumn("streak", F.sum((~F.col("ok")).cast("long")).over(within)).withColumn("healthy", F.col("streak") < failures).drop("__island")


def only_in_one(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """(key, side) of what only one of two sets has."""
    sides = [x.select(key).join(y.select(key), key, "left_anti").withColumn("side", F.lit(n)) for x, y, n in ((a, b, names[0]), (b, a, names[1]))]
    return sides[0].unionByName(sides[1])


def page_outline(contours: DataFrame, most: int = 5) -> DataFrame:
    """The largest of a page's contours(doc_id, pos, area, n_points) that has four corners, among the most largest ones."""
    few = largest(contours, "area", most=most)
    return few.where("n_points = 4").groupBy("doc_id").agg(F.min_by(F.struct("pos", "area", "turn"), "turn").alias("c")).select("doc_id", "c.*")


def variance(runs: DataFrame, values: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(times, flags, values, determinism) of repeated runs(doc_id, run_idx, total_ms, processing_path, form_type, review_required) and their values(doc_id, run_idx, key, value), fields and leaves alike."""
    seen = consistency(values, "doc_id", "key").join(distinct_values(values, "doc_id", "key"), ["doc_id", "key"])
    return timing_stats(runs, "doc_id"), run_flags(runs, "doc_id"), seen, determinism(seen, "doc_id")
