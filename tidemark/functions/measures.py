"""Derived trip and tip measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a tip above this percentage of the fare counts as high.
HIGH_TIP_PCT = 20


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, from whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def speed_per_hour(distance: Column, minutes: Column) -> Column:
    """Distance per hour, NULL unless both distance and duration are positive."""
    return F.when((minutes > 0) & (distance > 0), distance / (minutes / F.lit(60.0)))


def tip_pct(tip: Column, fare: Column) -> Column:
    """Tip as a percentage of the fare, NULL unless the fare is positive."""
    return F.when(fare > 0, tip / fare * 100)


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def share_pct(condition: Column) -> Column:
    """Percentage of rows that meet a condition."""
    return F.avg(F.when(condition, F.lit(1)).otherwise(F.lit(0))) * F.lit(100.0)
