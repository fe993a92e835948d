"""Wide orders and wide payments."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.times import age_years, text_to_time, with_event_time
from martflow.operators.joins import enrich, interval_join

ORDER_BOUND = timedelta(seconds=5)
PAYMENT_BOUND = timedelta(seconds=1800)


def sku_columns() -> dict[str, Column]:
    """What a row takes from the sku dimension, whose columns are all texts."""
    return {
        "sku_name": F.col("sku_name"),
        "sku_price": F.col("price").try_cast(schemas.MONEY),
        "spu_id": F.col("spu_id").try_cast("bigint"),
        "tm_id": F.col("tm_id").try_cast("bigint"),
        "category3_id": F.col("category3_id").try_cast("bigint"),
    }


def _timed(df: DataFrame, text: str, name: str, delay: str) -> DataFrame:
    """Add the event time of a date-time text; without one a row joins nothing."""
    return with_event_time(df, delay, text_to_time(text), name)


def _typed(struct, values: dict[str, Column]) -> list[Column]:
    return [values[f.name].cast(f.dataType).alias(f.name) for f in struct.fields]


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    bound: timedelta = ORDER_BOUND,
    delay: str = "0 seconds",
    salts: int = 1,
) -> DataFrame:
    """Order lines joined with their order, created at most ``bound`` apart."""
    joined = interval_join(
        _timed(orders, "create_time", "order_time", delay).alias("o"),
        _timed(details, "create_time", "detail_time", delay).alias("d"),
        F.col("o.id") == F.col("d.order_id"),
        "order_time",
        "detail_time",
        -bound,
        bound,
        salts,
    )
    values = {
        "detail_id": F.col("d.id"),
        "order_id": F.col("o.id"),
        "split_feight_fee": F.lit(None),
        "create_date": F.substring("o.create_time", 1, 10),
        "create_hour": F.substring("o.create_time", 12, 2),
    }
    from_order = [f for f in schemas.ORDER_INFO.names if f != "id"]
    for name in schemas.ORDER_WIDE.names:
        if name not in values:
            values[name] = F.col(f"o.{name}" if name in from_order else f"d.{name}")
    return joined.select(_typed(schemas.ORDER_WIDE, values))


def with_user(wide: DataFrame, users: DataFrame, as_of: date | None = None) -> DataFrame:
    """Gender and age of the buyer; ``as_of`` is today by default."""
    return enrich(
        wide,
        users,
        {"user_id": "id"},
        {"user_age": age_years("birthday", as_of), "user_gender": F.col("gender")},
    )


def with_province(wide: DataFrame, provinces: DataFrame) -> DataFrame:
    return enrich(
        wide,
        provinces,
        {"province_id": "id"},
        {
            "province_name": F.col("name"),
            "province_area_code": F.col("area_code"),
            "province_iso_code": F.col("iso_code"),
            "province_3166_2_code": F.col("iso_3166_2"),
        },
    )


def product_dimension(
    skus: DataFrame, spus: DataFrame, categories: DataFrame, trademarks: DataFrame
) -> DataFrame:
    """The product tables as one row per sku.

    Joining the dimensions with each other first leaves a single lookup, and
    so at most a single shuffle, for the facts.
    """
    product = skus.select("id", *[c.alias(n) for n, c in sku_columns().items()])
    return _with_names(product, spus, categories, trademarks)


def _with_names(
    df: DataFrame, spus: DataFrame, categories: DataFrame, trademarks: DataFrame
) -> DataFrame:
    df = enrich(df, spus, {"spu_id": "id"}, {"spu_name": F.col("spu_name")})
    df = enrich(df, categories, {"category3_id": "id"}, {"category3_name": F.col("name")})
    return enrich(df, trademarks, {"tm_id": "id"}, {"tm_name": F.col("tm_name")})


def with_product(wide: DataFrame, products: DataFrame, price: bool = False) -> DataFrame:
    """Names and ids of sku, spu, category and brand from the product dimension."""
    names = ["sku_name", "spu_id", "tm_id", "category3_id"]
    names += ["spu_name", "category3_name", "tm_name"]
    if price:
        names.append("sku_price")
    return enrich(wide, products, {"sku_id": "id"}, {n: F.col(n) for n in names})


def with_product_tables(
    wide: DataFrame,
    skus: DataFrame,
    spus: DataFrame,
    categories: DataFrame,
    trademarks: DataFrame,
    price: bool = False,
) -> DataFrame:
    """The same from the four tables, one lookup after the other.

    For a micro-batch: joining the tables with each other costs what they hold,
    looking a few rows up does not.
    """
    columns = {n: c for n, c in sku_columns().items() if price or n != "sku_price"}
    named = enrich(wide, skus, {"sku_id": "id"}, columns)
    return _with_names(named, spus, categories, trademarks)


def payment_wide(
    payments: DataFrame,
    wide: DataFrame,
    bound: timedelta = PAYMENT_BOUND,
    delay: str = "0 seconds",
    salts: int = 1,
) -> DataFrame:
    """Payments joined with the lines of an order created at most ``bound`` before.

    Where both sides have a column, the payment's value is taken.  One row per
    order line.
    """
    joined = interval_join(
        _timed(payments, "callback_time", "callback_at", delay).alias("p"),
        _timed(wide, "create_time", "order_at", delay).alias("w"),
        F.col("p.order_id") == F.col("w.order_id"),
        "callback_at",
        "order_at",
        -bound,
        timedelta(0),
        salts,
    )
    from_payment = ["subject", "payment_type", "callback_time", "order_id", "user_id", "total_amount"]
    not_carried = ["expire_time", "create_time", "operate_time", "create_date", "create_hour"]
    from_wide = [
        c for c in wide.columns if c not in from_payment + not_carried + ["order_at"]
    ]
    return joined.select(
        F.col("p.id").alias("payment_id"),
        *[F.col(f"p.{c}") for c in from_payment],
        F.col("p.create_time").alias("payment_create_time"),
        F.col("w.create_time").alias("order_create_time"),
        *[F.col(f"w.{c}") for c in from_wide],
    )


# Columns a merge fills from the other row where this one has none.  The three
# split amounts are not among them: they are only ever taken from this row.
MERGED = [
    "order_status",
    "create_time",
    "create_date",
    "coupon_reduce_amount",
    "activity_reduce_amount",
    "original_total_amount",
    "feight_fee",
    "total_amount",
    "user_id",
    "sku_id",
    "sku_name",
    "order_price",
    "sku_num",
]


def merge_wide(this: DataFrame, other: DataFrame, key: str = "detail_id") -> DataFrame:
    """Merge two wide rows of one key, the first non-null value winning."""
    left, right = this.alias("l"), other.alias("r")
    joined = left.join(right, F.col(f"l.{key}") == F.col(f"r.{key}"), "full")
    return joined.select(
        *[
            F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c)
            if c in MERGED or c == key
            else F.col(f"l.{c}")
            for c in this.columns
        ]
    )
