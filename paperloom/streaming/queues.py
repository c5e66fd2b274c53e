"""Streams: arrivals, health states, queue windows and upserts. All state is keyed or windowed, and survives a restart from its checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import SCANS
from ..sources.sinks import latest

FAILURES = 3


def arrivals(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """Scans as they arrive in a folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", SCANS).option("maxFilesPerTrigger", per_trigger).load(folder)


def queue_windows(events: DataFrame, at: str = "enqueued_at", late: str = "10 minutes", width: str = "5 minutes", *keys: str, total: str | None = None) -> DataFrame:
    """Counts by window, and the sum of a column; on a stream, what is later than the watermark is dropped."""
    sums = [] if total is None else [F.sum(total).alias("total")]
    counted = events.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"), *sums)
    return counted.select(F.col("window.start").alias("window_start"), *[c for c in counted.columns if c != "window"])


def health_states(checks: DataFrame, failures: int = FAILURES) -> DataFrame:
    """(service, ts, streak, healthy) of checks(service, ts, ok): unhealthy from so many failures in a row on, healthy again by one success."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
        out = []
        for r in rows.itertuples():
            streak = 0 if r.ok else streak + 1
            out.append((key[0], r.ts, streak, streak < failures))
        state.update((streak,))
        yield pd.DataFrame(out, columns=["service", "ts", "streak", "healthy"])

    return checks.groupBy("service").applyInPandasWithState(run, "service string, ts timestamp, streak long, healthy boolean", "streak long", "append", "NoTimeout")


def upserts(target: Callable[[DataFrame], None], key: str = "doc_id", at: str = "processed_at") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that gives the target the last row of each key of a batch."""

    def run(batch: DataFrame, _: int) -> None:
        target(latest(batch, key, at))

    return run


def deduplicated(stream: DataFrame, key: str = "doc_id", at: str = "processed_at", late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
