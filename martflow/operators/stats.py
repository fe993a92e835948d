"""Windowed statistics by visitor group, product, province and keyword.

All are grouped aggregates that combine on the map side.  Distinct orders are
counted in two steps, first one row per order, then a plain count: exact, good
for streams too (where a distinct aggregate is not allowed), and the order id
in the first key spreads a hot product or province over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.times import (
    EVENT_TIME,
    text_to_millis,
    window_bounds,
    with_event_time,
)
from martflow.operators.logs import split_display
from martflow.operators.visits import is_entry

WINDOW = "10 seconds"


# --- visitor ---------------------------------------------------------------


def _visitor_row(
    records: DataFrame, measures: dict[str, Column], keep: tuple[str, ...]
) -> DataFrame:
    return records.select(
        *keep,
        *[F.col(f"common.{k}").alias(k) for k in schemas.VISITOR_KEYS],
        *[
            measures.get(m, F.lit(0)).cast("bigint").alias(m)
            for m in schemas.VISITOR_MEASURES
        ],
        "ts",
    )


def page_measures(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each page record: one page view, a visit if it is an entry, its duration."""
    return _visitor_row(
        pages,
        {
            "pv_ct": F.lit(1),
            "sv_ct": is_entry().cast("int"),
            "dur_sum": F.coalesce("page.during_time", F.lit(0)),
        },
        keep,
    )


def unique_visit_measures(visits: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _visitor_row(visits, {"uv_ct": F.lit(1)}, keep)


def bounce_measures(bounces: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _visitor_row(bounces, {"uj_ct": F.lit(1)}, keep)


def visitor_union(
    pages: DataFrame, visits: DataFrame, bounces: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The three measure frames as one."""
    return (
        page_measures(pages, keep)
        .unionByName(unique_visit_measures(visits, keep))
        .unionByName(bounce_measures(bounces, keep))
    )


def union_on_time(*streams: tuple[DataFrame, str]) -> DataFrame:
    """Measure frames as one, each under a watermark that trails by its own delay.

    One watermark behind the union would follow the fastest stream and drop what
    the others still bring.
    """
    timed = [with_event_time(frame, delay) for frame, delay in streams]
    merged = timed[0]
    for frame in timed[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return _typed(merged) if "sku_id" in merged.columns else merged


def visitor_stats(
    measures: DataFrame, window: str = WINDOW, delay: str = "3 seconds"
) -> DataFrame:
    """Sums per window, version, channel, area and new flag.

    Bounces are known one bounce limit after they happen; a stream that has
    them among its measures needs a ``delay`` above that.
    """
    sums = [F.sum(m).alias(m) for m in schemas.VISITOR_MEASURES]
    return (
        with_event_time(measures, delay)
        .groupBy(F.window(EVENT_TIME, window), *schemas.VISITOR_KEYS)
        .agg(*sums, F.min("ts").alias("ts"))
        .select(
            *window_bounds(), *schemas.VISITOR_KEYS, *schemas.VISITOR_MEASURES, "ts"
        )
    )


# --- product ---------------------------------------------------------------


def product_clicks(pages: DataFrame) -> DataFrame:
    """One click per view of a product's page."""
    return pages.where(F.col("page.page_id") == schemas.PAGE_DETAIL).select(
        F.col("page.item").try_cast("bigint").alias("sku_id"),
        "ts",
        F.lit(1).cast("bigint").alias("click_ct"),
    )


def product_displays(pages: DataFrame) -> DataFrame:
    """One display per product shown on a page."""
    return (
        split_display(pages, keep=["ts"])
        .where(F.col("item_type") == schemas.DISPLAY_PRODUCT)
        .select(
            F.col("item").try_cast("bigint").alias("sku_id"),
            "ts",
            F.lit(1).cast("bigint").alias("display_ct"),
        )
    )


def _dated(records: DataFrame, time_text: str, *measures: Column) -> DataFrame:
    return records.select(
        F.col("sku_id").cast("bigint").alias("sku_id"),
        text_to_millis(time_text).alias("ts"),
        *measures,
    )


def _orders_of(tag: str) -> list[Column]:
    return [F.lit(tag).alias("tag"), F.col("order_id").cast("bigint").alias("order_id")]


def product_orders(wide: DataFrame) -> DataFrame:
    return _dated(
        wide,
        "create_time",
        F.col("split_total_amount").alias("order_amount"),
        F.col("sku_num").alias("order_sku_num"),
        *_orders_of("order"),
    )


def product_payments(paid: DataFrame) -> DataFrame:
    """Paid amounts, at the time the order was created."""
    return _dated(
        paid,
        "order_create_time",
        F.col("split_total_amount").alias("payment_amount"),
        *_orders_of("paid"),
    )


def product_carts(carts: DataFrame) -> DataFrame:
    return _dated(carts, "create_time", F.lit(1).cast("bigint").alias("cart_ct"))


def product_favors(favors: DataFrame) -> DataFrame:
    return _dated(favors, "create_time", F.lit(1).cast("bigint").alias("favor_ct"))


def product_refunds(refunds: DataFrame) -> DataFrame:
    return _dated(
        refunds,
        "create_time",
        F.col("refund_amount").cast(schemas.MONEY).alias("refund_amount"),
        *_orders_of("refund"),
    )


def product_comments(comments: DataFrame) -> DataFrame:
    good = F.coalesce(F.col("appraise") == schemas.APPRAISE_GOOD, F.lit(False))
    return _dated(
        comments,
        "create_time",
        F.lit(1).cast("bigint").alias("comment_ct"),
        good.cast("bigint").alias("good_comment_ct"),
    )


def product_union(*measures: DataFrame) -> DataFrame:
    """Measure frames as one; a measure a frame lacks is null and counts as 0."""
    merged = measures[0]
    for frame in measures[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return _typed(merged)


def _typed(merged: DataFrame) -> DataFrame:
    """Add the product measures that no frame has, as nulls."""
    types = {c: "bigint" for c in schemas.PRODUCT_COUNTS + ["order_id"]}
    types |= {c: schemas.MONEY for c in schemas.PRODUCT_AMOUNTS}
    types |= {"tag": "string"}
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in merged.columns}
    return merged.withColumns(missing) if missing else merged


def product_stats(
    measures: DataFrame, window: str = WINDOW, delay: str = "5 seconds"
) -> DataFrame:
    """Counts, amounts and distinct orders per window and sku.

    Only rows with an order take the step that counts an order once.
    """
    sums = schemas.PRODUCT_COUNTS + schemas.PRODUCT_AMOUNTS
    known = measures.where(F.col("sku_id").isNotNull() & F.col("ts").isNotNull())
    timed = with_event_time(known, delay)
    by_order = (
        timed.where(F.col("order_id").isNotNull())
        .groupBy(F.window(EVENT_TIME, window), "sku_id", "tag", "order_id")
        .agg(*[F.sum(c).alias(c) for c in sums], F.min("ts").alias("ts"))
    )
    others = timed.where(F.col("order_id").isNull()).select(
        F.window(EVENT_TIME, window), "sku_id", "tag", "order_id", *sums, "ts"
    )
    per_order = by_order.unionByName(others)
    counts = [
        F.count_if((F.col("tag") == tag) & F.col("order_id").isNotNull()).alias(name)
        for name, tag in schemas.PRODUCT_ORDER_COUNTS.items()
    ]
    zero = {c: F.lit(0).cast(schemas.MONEY) for c in schemas.PRODUCT_AMOUNTS}
    totals = [
        F.coalesce(F.sum(c), zero.get(c, F.lit(0).cast("bigint"))).alias(c) for c in sums
    ]
    return (
        per_order.groupBy(F.window("window", window), "sku_id")
        .agg(*totals, *counts, F.min("ts").alias("ts"))
        .select(
            *window_bounds(),
            "sku_id",
            "display_ct",
            "click_ct",
            "favor_ct",
            "cart_ct",
            "order_sku_num",
            "order_amount",
            "order_ct",
            "payment_amount",
            "paid_order_ct",
            "refund_order_ct",
            "refund_amount",
            "comment_ct",
            "good_comment_ct",
            "ts",
        )
    )


#: Registers of a sketch, as a power of two: a standard error of 0.6 %.
SKETCH_BITS = 15


def order_sketches(measures: DataFrame, window: str = WINDOW, delay: str = "5 seconds") -> DataFrame:
    """Sketches of the distinct orders per window and sku, to store beside the exact counts.

    They merge where counts do not: an order of two windows counts once in a day.  A
    sketch of few orders is a short list of them.
    """
    known = measures.where(
        F.col("sku_id").isNotNull() & F.col("ts").isNotNull() & F.col("order_id").isNotNull()
    )
    sketches = [
        F.hll_sketch_agg(F.when(F.col("tag") == tag, F.col("order_id")), SKETCH_BITS).alias(name)
        for name, tag in schemas.PRODUCT_ORDER_COUNTS.items()
    ]
    return (
        with_event_time(known, delay)
        .groupBy(F.window(EVENT_TIME, window), "sku_id")
        .agg(*sketches)
        .select(*window_bounds(), "sku_id", *schemas.PRODUCT_ORDER_COUNTS)
    )


def distinct_orders(sketches: DataFrame, *keys: Column | str) -> DataFrame:
    """Distinct orders over all windows of a group, from their sketches, about 0.6 % off.

    ``keys`` are columns of the stored rows, such as the day of ``stt`` or the sku; rows
    combine on the map side, a group costs one sketch a task.
    """
    counts = [
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(name)
        for name in schemas.PRODUCT_ORDER_COUNTS
    ]
    return sketches.groupBy(*keys).agg(*counts)


# --- province --------------------------------------------------------------


def province_measures(wide: DataFrame) -> DataFrame:
    """Each wide order line as one order's share in its province."""
    return wide.select(
        "province_id",
        "province_name",
        F.col("province_area_code").alias("area_code"),
        F.col("province_iso_code").alias("iso_code"),
        F.col("province_3166_2_code").alias("iso_3166_2"),
        "order_id",
        F.col("split_total_amount").cast(schemas.MONEY).alias("order_amount"),
        text_to_millis("create_time").alias("ts"),
    )


def province_stats(
    wide: DataFrame, window: str = WINDOW, delay: str = "3 seconds"
) -> DataFrame:
    """Amount and distinct orders per window and province.

    ``ts`` is the earliest order time, so that a rerun gives the same rows.
    """
    measures = province_measures(wide).where(F.col("ts").isNotNull())
    keys = schemas.PROVINCE_KEYS
    per_order = (
        with_event_time(measures, delay)
        .groupBy(F.window(EVENT_TIME, window), *keys, "order_id")
        .agg(F.sum("order_amount").alias("order_amount"), F.min("ts").alias("ts"))
    )
    return (
        per_order.groupBy(F.window("window", window), *keys)
        .agg(
            F.sum("order_amount").alias("order_amount"),
            F.count("order_id").alias("order_count"),
            F.min("ts").alias("ts"),
        )
        .select(*window_bounds(), *keys, "order_amount", "order_count", "ts")
    )


def province_document(stats: DataFrame) -> DataFrame:
    """Province rows as a search index takes them: the amount as a double."""
    return stats.withColumn("order_amount", F.col("order_amount").cast("double"))


# --- keyword ---------------------------------------------------------------


def keyword_stats(
    words: DataFrame,
    window: str = WINDOW,
    delay: str = "3 seconds",
    source: str = schemas.KEYWORD_SEARCH,
) -> DataFrame:
    """Occurrences per window and keyword."""
    return (
        with_event_time(words, delay)
        .groupBy(F.window(EVENT_TIME, window), "keyword")
        .agg(F.count("*").alias("ct"), F.min("ts").alias("ts"))
        .select("keyword", "ct", F.lit(source).alias("source"), *window_bounds(), "ts")
    )
