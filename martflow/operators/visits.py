"""Devices over time: first visit, daily first entry, bounce.

None of these collects a device's records in one place.  Each is an aggregate
that combines on the map side, so a device with a third of all records costs
one row per task and group in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.times import EVENT_TIME, millis_to_day

# Records of one device at the same millisecond are told apart by content,
# unless the caller names an id column.
DEFAULT_ORDER = ("ts", "page", "common")


def is_entry(page: str = "page") -> Column:
    """No previous page: the record opens a visit."""
    return F.coalesce(F.col(f"{page}.last_page_id"), F.lit("")) == ""


def first_visit_days(log: DataFrame) -> DataFrame:
    """Per device the day of its first record flagged as new."""
    return (
        log.where(F.col("common.is_new") == "1")
        .groupBy(F.col("common.mid").alias("mid"))
        .agg(F.min("ts").alias("first_ts"))
        .select("mid", millis_to_day("first_ts").alias("first_day"))
    )


def repair_flag(
    records: DataFrame, first_days: DataFrame, mid: str, is_new: str, ts: str
) -> DataFrame:
    """Flat form of :func:`fix_is_new`: rewrite column ``is_new`` in place.

    Only rows flagged as new can change, so only they are joined; the others
    bypass the shuffle.
    """
    flagged = F.coalesce(F.col(is_new) == "1", F.lit(False))
    new = (
        records.where(flagged)
        .join(first_days.withColumnRenamed("mid", "_mid"), F.col(mid) == F.col("_mid"), "left")
        .withColumn(
            is_new,
            F.when(F.col("first_day") != millis_to_day(ts), "0").otherwise(F.col(is_new)),
        )
        .select(records.columns)
    )
    return new.unionByName(records.where(~flagged))


def fix_is_new_by(records: DataFrame, first_days: DataFrame) -> DataFrame:
    """Clear the new flag on records of another day than the device's first."""
    flat = records.withColumn("_mid_of", F.col("common.mid")).withColumn(
        "_flag", F.col("common.is_new")
    )
    fixed = repair_flag(flat, first_days, "_mid_of", "_flag", "ts")
    return fixed.withColumn(
        "common", F.col("common").withField("is_new", F.col("_flag"))
    ).select(records.columns)


def fix_is_new(records: DataFrame) -> DataFrame:
    """Clear the new flag on records after the device's first flagged day.

    Time decides, not arrival, so the result does not depend on input order.
    """
    return fix_is_new_by(records, first_visit_days(records))


def session_entries(pages: DataFrame) -> DataFrame:
    """Page records that open a visit."""
    return pages.where(is_entry())


def unique_visit(pages: DataFrame, order: tuple[str, ...] = DEFAULT_ORDER) -> DataFrame:
    """The first entry of each device and day."""
    return (
        session_entries(pages)
        .groupBy(F.col("common.mid").alias("mid"), millis_to_day("ts").alias("day"))
        .agg(F.min_by(F.struct(*pages.columns), F.struct(*order)).alias("r"))
        .select("r.*")
    )


def user_jump(
    pages: DataFrame,
    limit_ms: int = 10_000,
    order: tuple[str, ...] = DEFAULT_ORDER,
    late_ms: int = 0,
) -> DataFrame:
    """Bounces: entries whose device opens no other page within the limit.

    Time is cut into slots as long as the limit.  Two records in one slot are
    closer than the limit, so only a slot's last record can be a bounce, and
    what can prevent it is the first record of the next slot.  So each record
    counts twice, in its own slot and, by its time alone, in the one before,
    and both are plain aggregates.  A record exactly ``limit_ms`` later is too
    late.  ``late_ms`` is how far a stream's records may come out of order.
    """
    columns = [c for c in pages.columns if c != EVENT_TIME]
    own = F.col("back") == 0
    doubled = pages.select("*", F.explode(F.array(F.lit(0), F.lit(limit_ms))).alias("back"))
    # Only an entry in its own slot drags its record into the sort and shuffle.
    narrow = doubled.select(
        F.col("common.mid").alias("mid"),
        F.timestamp_millis(F.col("ts") - F.col("back")).alias("slot_time"),
        F.when(own, F.struct(*order)).alias("at"),
        F.when(own & is_entry(), F.struct(*columns)).alias("r"),
        F.when(~own, F.col("ts")).alias("next_ts"),
    ).withWatermark("slot_time", f"{limit_ms + late_ms} milliseconds")
    return (
        narrow.groupBy(F.window("slot_time", f"{limit_ms} milliseconds"), "mid")
        .agg(F.max_by("r", "at").alias("r"), F.min("next_ts").alias("next_ts"))
        .where(
            F.col("r").isNotNull()
            & (F.col("next_ts").isNull() | (F.col("next_ts") - F.col("r.ts") >= limit_ms))
        )
        .select("r.*")
    )
