"""Visit ratios of the visitor report, rounded half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(top: Column, visits: Column, places: int) -> Column:
    exact = top.cast("decimal(28,4)") / visits.cast("decimal(20,0)")
    return F.when(visits != 0, F.round(exact, places)).otherwise(F.lit(0))


def bounce_percent(bounces: Column, visits: Column) -> Column:
    return _ratio(bounces.cast("decimal(20,0)") * 100, visits, 2)


def seconds_per_visit(millis: Column, visits: Column) -> Column:
    """Whole milliseconds per visit first, then seconds with one place."""
    whole = _ratio(millis, visits, 0).cast("decimal(20,0)")
    return F.round(whole / F.lit(1000).cast("decimal(4,0)"), 1)


def pages_per_visit(pages: Column, visits: Column) -> Column:
    return _ratio(pages, visits, 2)
