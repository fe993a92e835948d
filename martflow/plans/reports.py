"""The daily report queries over the four result tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions import ratios
from martflow.schemas import VISITOR_MEASURES

# How many rows the rankings show unless asked otherwise.
TOP_BRANDS = 20
TOP_CATEGORIES = 10


def day_of(number: int) -> date:
    """A ``yyyyMMdd`` number as a date; 0 is today."""
    if number == 0:
        return datetime.now(timezone.utc).date()
    return datetime.strptime(str(number), "%Y%m%d").date()


def on_day(table: DataFrame, number: int = 0) -> DataFrame:
    """Rows whose window starts on a day.

    A range on the plain column, so that it reaches the scan; where the table
    is partitioned by ``day`` only that partition is listed.
    """
    first = day_of(number)
    if "day" in table.columns:
        table = table.where(F.col("day") == F.lit(first.strftime("%Y%m%d")))
    start = f"{first} 00:00:00"
    end = f"{first + timedelta(days=1)} 00:00:00"
    return table.where((F.col("stt") >= start) & (F.col("stt") < end))


def gmv(product_stats: DataFrame, day: int = 0) -> DataFrame:
    """Turnover of a day; null if there is no row."""
    return on_day(product_stats, day).agg(F.sum("order_amount").alias("order_amount"))


def _ranking(product_stats: DataFrame, day: int, keys: list[str], limit: int) -> DataFrame:
    return (
        on_day(product_stats, day)
        .groupBy(*keys)
        .agg(F.sum("order_amount").alias("order_amount"))
        .where(F.col("order_amount") > 0)
        .orderBy(F.col("order_amount").desc(), *keys)
        .limit(limit)
    )


def top_brands(product_stats: DataFrame, day: int = 0, limit: int = TOP_BRANDS) -> DataFrame:
    """Brands by turnover; equal ones in the order of their ids."""
    return _ranking(product_stats, day, ["tm_id", "tm_name"], limit)


def top_categories(
    product_stats: DataFrame, day: int = 0, limit: int = TOP_CATEGORIES
) -> DataFrame:
    return _ranking(product_stats, day, ["category3_id", "category3_name"], limit)


def province_totals(province_stats: DataFrame, day: int = 0) -> DataFrame:
    return (
        on_day(province_stats, day)
        .groupBy("province_id", "province_name")
        .agg(F.sum("order_amount").alias("order_amount"))
    )


def visitor_totals(visitor_stats: DataFrame, day: int = 0) -> DataFrame:
    """The five visitor measures of a day by new flag."""
    return (
        on_day(visitor_stats, day)
        .groupBy("is_new")
        .agg(*[F.sum(m).alias(m) for m in VISITOR_MEASURES])
    )


def visitor_ratios(totals: DataFrame) -> DataFrame:
    """Bounce percentage, seconds and pages per visit; 0 without visits."""
    visits = F.col("sv_ct")
    return totals.select(
        "*",
        ratios.bounce_percent(F.col("uj_ct"), visits).alias("uj_rate"),
        ratios.seconds_per_visit(F.col("dur_sum"), visits).alias("dur_per_sv"),
        ratios.pages_per_visit(F.col("pv_ct"), visits).alias("pv_per_sv"),
    )
