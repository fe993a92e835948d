"""From log records to visitor statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators import logs, stats, visits
from martflow.plans.staging import stage


def repaired_visitor_measures(
    records: DataFrame,
    bounce_limit_ms: int = 10_000,
    order: tuple[str, ...] = visits.DEFAULT_ORDER,
) -> DataFrame:
    """Visitor measures of raw log records, new flags repaired.

    Neither the daily first entry nor the bounce looks at the flag, so it is
    repaired last: one join, on narrow rows, instead of one per branch.  Every
    branch needs the records, so what they need of them is written once: text is
    parsed once, and the branches read narrow columns.
    """
    carried = dict.fromkeys(["common", "page", "ts", *order])
    narrow = records.select(*carried, logs.is_start().alias("_start"))
    records = stage(narrow, "visitor_records")
    pages = records.where("NOT _start").drop("_start")
    measures = stats.visitor_union(
        pages,
        visits.unique_visit(pages, order),
        visits.user_jump(pages, bounce_limit_ms, order),
        keep=("common",),
    ).withColumn("mid", F.col("common.mid")).drop("common")
    first_days = visits.first_visit_days(records)
    return visits.repair_flag(measures, first_days, "mid", "is_new", "ts").drop("mid")


def visitor_stats(
    records: DataFrame,
    window: str = stats.WINDOW,
    bounce_limit_ms: int = 10_000,
    order: tuple[str, ...] = visits.DEFAULT_ORDER,
) -> DataFrame:
    measures = repaired_visitor_measures(records, bounce_limit_ms, order)
    return stats.visitor_stats(measures, window)
