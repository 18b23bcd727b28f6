"""Scalar column expressions shared by the operators (all JVM-side built-ins)."""

from pulse.functions.scalars import (
    blank_to_null,
    bus_factor_label,
    contributor_tier,
    is_distinct_from,
    safe_ratio,
    star_bucket,
    surrogate_key,
    ts,
    week_start,
    whole_hour_days,
)

__all__ = [
    "blank_to_null",
    "bus_factor_label",
    "contributor_tier",
    "is_distinct_from",
    "safe_ratio",
    "star_bucket",
    "surrogate_key",
    "ts",
    "week_start",
    "whole_hour_days",
]
