"""Steps of a run on the driver: time, warnings and errors of each, and the summary of a run's documents."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Steps:
    """Runs steps one after another; a step that fails gives None, and its error is kept."""

    def __init__(self) -> None:
        self.timings: dict[str, float] = {}
        self.warnings: list[str] = []
        self.errors: list[str] = []

    def run(self, name: str, step: Callable[[], Any], *warnings: str) -> Any:
        """What step() gives. Warnings of a step, the given ones and those its result has, are kept once each, with its name before them."""
        began, out = time.perf_counter(), None
        try:
            out = step()
            self.warn(name, *warnings, *(getattr(out, "warnings", None) or ()))
        except Exception as e:  # noqa: BLE001  a step's failure is a result
            self.errors.append(f"[{name}] {type(e).__name__}: {e}")
        self.timings[name] = round((time.perf_counter() - began) * 1000, 1)
        return out

    def warn(self, name: str, *warnings: str) -> None:
        for w in warnings:
            if (line := f"[{name}] {w}") not in self.warnings:
                self.warnings.append(line)


def step_warnings(name: str, *warnings: Column) -> Column:
    """The same for rows: the warnings of a step that are there, once each, with its name before them."""
    return F.array_distinct(F.transform(F.array_compact(F.array(*warnings)), lambda w: F.concat(F.lit(f"[{name}] "), w)))


def run_summary(outputs: DataFrame, *keys: str) -> DataFrame:
    """Documents, their outcomes, mean confidence and time by keys (a form type, a path), from outputs(status, overall_confidence, processing_ms, validation_error_count, review_queued)."""
    return outputs.groupBy(*keys).agg(
        F.count("*").alias("documents"), *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "partial", "review", "failed")],
        F.round(F.avg("overall_confidence"), 4).alias("overall_confidence"), F.round(F.sum("processing_ms"), 1).alias("processing_ms"),
        F.sum("validation_error_count").alias("validation_errors"), F.count_if("review_queued").alias("queued"),
    )
