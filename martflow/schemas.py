"""Record shapes that pass between the stages."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
LONG = T.LongType()
MONEY = T.DecimalType(16, 2)
TEXT_MAP = T.MapType(TEXT, TEXT)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def as_text(data_type: T.DataType) -> T.DataType:
    """The same shape with every plain value as text."""
    if isinstance(data_type, T.StructType):
        return record(**{f.name: as_text(f.dataType) for f in data_type.fields})
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(as_text(data_type.elementType))
    if isinstance(data_type, T.MapType):
        return T.MapType(TEXT, as_text(data_type.valueType))
    return TEXT


# App log record, also as the page, visit and bounce topics carry it.
PAGE = record(
    common=record(mid=TEXT, vc=TEXT, ch=TEXT, ar=TEXT, is_new=TEXT),
    page=record(page_id=TEXT, last_page_id=TEXT, item=TEXT, during_time=LONG),
    displays=T.ArrayType(record(item=TEXT, item_type=TEXT)),
    start=TEXT_MAP,
    ts=LONG,
)

# Change event after normalizing.  ``before`` finds the row of a delete, ``ts`` is
# when the database changed; messages may lack both.
CHANGE = record(
    database=TEXT, table=TEXT, type=TEXT, data=TEXT_MAP, before=TEXT_MAP, ts=LONG
)

# Raw change-capture envelope.
ENVELOPE = record(
    op=TEXT,
    before=TEXT_MAP,
    after=TEXT_MAP,
    source=record(db=TEXT, table=TEXT),
    ts_ms=LONG,
)

ROUTING = record(
    source_table=TEXT,
    operate_type=TEXT,
    sink_type=TEXT,
    sink_table=TEXT,
    sink_columns=TEXT,
    sink_pk=TEXT,
    sink_extend=TEXT,
)

ORDER_INFO = record(
    id=LONG,
    province_id=LONG,
    order_status=TEXT,
    user_id=LONG,
    total_amount=MONEY,
    activity_reduce_amount=MONEY,
    coupon_reduce_amount=MONEY,
    original_total_amount=MONEY,
    feight_fee=MONEY,
    expire_time=TEXT,
    create_time=TEXT,
    operate_time=TEXT,
)

ORDER_DETAIL = record(
    id=LONG,
    order_id=LONG,
    sku_id=LONG,
    order_price=MONEY,
    sku_num=LONG,
    sku_name=TEXT,
    create_time=TEXT,
    split_total_amount=MONEY,
    split_activity_amount=MONEY,
    split_coupon_amount=MONEY,
)

PAYMENT_INFO = record(
    id=LONG,
    order_id=LONG,
    user_id=LONG,
    total_amount=MONEY,
    subject=TEXT,
    payment_type=TEXT,
    create_time=TEXT,
    callback_time=TEXT,
)

# Actions on products.  Comments fill ``appraise``, refunds the order and amount.
PRODUCT_ACTION = record(
    sku_id=LONG, create_time=TEXT, order_id=LONG, refund_amount=MONEY, appraise=TEXT
)

# Order line joined with its order, before the dimensions are added.
ORDER_WIDE = record(
    detail_id=LONG,
    order_id=LONG,
    sku_id=LONG,
    order_price=MONEY,
    sku_num=LONG,
    sku_name=TEXT,
    province_id=LONG,
    order_status=TEXT,
    user_id=LONG,
    total_amount=MONEY,
    activity_reduce_amount=MONEY,
    coupon_reduce_amount=MONEY,
    original_total_amount=MONEY,
    feight_fee=MONEY,
    split_feight_fee=MONEY,
    split_activity_amount=MONEY,
    split_coupon_amount=MONEY,
    split_total_amount=MONEY,
    expire_time=TEXT,
    create_time=TEXT,
    operate_time=TEXT,
    create_date=TEXT,
    create_hour=TEXT,
)

# What the dimensions add to a wide order.
ORDER_DIMENSIONS = record(
    province_name=TEXT,
    province_area_code=TEXT,
    province_iso_code=TEXT,
    province_3166_2_code=TEXT,
    user_age=T.IntegerType(),
    user_gender=TEXT,
    spu_id=LONG,
    tm_id=LONG,
    category3_id=LONG,
    spu_name=TEXT,
    tm_name=TEXT,
    category3_name=TEXT,
)

ORDER_WIDE_FULL = T.StructType(ORDER_WIDE.fields + ORDER_DIMENSIONS.fields)

VISITOR_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]

PRODUCT_COUNTS = [
    "display_ct",
    "click_ct",
    "favor_ct",
    "cart_ct",
    "order_sku_num",
    "comment_ct",
    "good_comment_ct",
]
PRODUCT_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
# Result column -> tag of the measure rows whose order ids it counts.
PRODUCT_ORDER_COUNTS = {
    "order_ct": "order",
    "paid_order_ct": "paid",
    "refund_order_ct": "refund",
}

PROVINCE_KEYS = ["province_id", "province_name", "area_code", "iso_code", "iso_3166_2"]

# Codes and names the records carry.
BOOTSTRAP_INSERT = "bootstrap-insert"
SINK_DIMENSION = "hbase"
SINK_FACT = "kafka"
PAGE_DETAIL = "good_detail"
PAGE_SEARCH = "good_list"
DISPLAY_PRODUCT = "sku_id"
APPRAISE_GOOD = "1201"
KEYWORD_SEARCH = "SEARCH"
