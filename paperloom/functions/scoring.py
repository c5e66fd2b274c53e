"""Confidence functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import CLASS_OF_TYPE, DEFAULT_TOKENS, EXPECTED_TOKENS, FIELD_WEIGHT, LEAF_WEIGHT, looked_up


def clamped(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def token_confidence(logprobs: Column, field_class: Column) -> Column:
    """Geometric mean of the tokens' probabilities, less for more tokens than the class has as a rule; 0 without tokens."""
    n = F.size(logprobs)
    mean = F.greatest(F.aggregate(logprobs, F.lit(0.0), lambda s, x: s + x) / n, F.lit(-20.0))
    expected = looked_up(field_class, EXPECTED_TOKENS, DEFAULT_TOKENS)
    factor = F.least(F.lit(1.0), F.sqrt(expected / n))
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.round(clamped(F.exp(mean) * factor), 4)).otherwise(F.lit(0.0))


def mean_probability(logprobs: Column) -> Column:
    n = F.size(logprobs)
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.exp(F.aggregate(logprobs, F.lit(0.0), lambda s, x: s + x) / n))


def leaf_weight(kind: Column) -> Column:
    return looked_up(kind, LEAF_WEIGHT, 1.0)


def field_weight(data_type: Column) -> Column:
    return looked_up(looked_up(data_type, CLASS_OF_TYPE, "text"), FIELD_WEIGHT, 1.0)


def weighted_mean(value: Column, weight: Column, digits: int | None = 4) -> Column:
    """An aggregate: 0 for no rows."""
    mean = clamped(F.sum(value * weight) / F.nullif(F.sum(weight), F.lit(0.0)))
    return F.coalesce(mean if digits is None else F.round(mean, digits), F.lit(0.0))


def classified_confidence(stated: Column, logprobs: Column) -> Column:
    """What the answer states, else the tokens' mean probability, else 0.5."""
    return clamped(F.coalesce(stated, mean_probability(logprobs), F.lit(0.5)))
