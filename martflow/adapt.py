"""The test tables read as the records of a retail warehouse.

``oracle.py`` holds the same reading as SQL.  Keys are shifted here and there
so that some lookups miss.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.times import DATE_TIME

# Time scales of the test tables; the operators' defaults are far shorter.
ORDER_BOUND_DAYS = 90
BOUNCE_LIMIT_MS = 6 * 3600 * 1000
VISIT_ORDER = ("ts", "event_id")
SEARCH_EPOCH_MS = 1_704_067_200_000

RULES = [
    # source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend
    ("user_info", "insert", "hbase", "dim_user_info", "id,name", "id", None),
    ("user_info", "update", "hbase", "dim_user_info", "id,name", "id", None),
    ("user_info", "delete", "hbase", "dim_user_info", "id,name", "id", None),
    ("sku_info", "insert", "hbase", "dim_sku_info", "id,name,amount", None, None),
    ("sku_info", "delete", "hbase", "dim_sku_info", "id,name,amount", None, None),
    ("order_info", "insert", "kafka", "dwd_order_info", "", None, None),
    ("order_info", "update", "kafka", "dwd_order_update", "id,amount", None, None),
    ("cart_info", "insert", "clickhouse", "ck_cart_info", "id", None, None),
]


Read = Callable[[SparkSession, str, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream; the pattern matches a file as well as a folder."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def _money(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(schemas.MONEY)


def _days(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, as a range that reaches the scan."""
    start = F.to_timestamp_ntz(F.lit(f"{first} 00:00:00"))
    end = F.to_timestamp_ntz(F.lit(f"{last + timedelta(days=1)} 00:00:00"))
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def _text(column: Column | str) -> Column:
    return F.date_format(column, DATE_TIME)


def events(spark: SparkSession, sf_dir: str, read: Read = table) -> DataFrame:
    """Events with their time in ms and the number out of their JSON text."""
    props = F.from_json("props", "k BIGINT")
    return read(spark, sf_dir, "events").select(
        "event_id", _millis("ts").alias("ts"), "user_id", "event_type", "value",
        props["k"].alias("k"),
    )


def _event_sku() -> Column:
    return F.col("user_id") * 14 + F.col("k") % 14


def log_records(spark: SparkSession, sf_dir: str, read: Read = table) -> DataFrame:
    """App log records; events of type ``error`` are start records."""
    kind = F.col("event_type")
    sku = _event_sku().cast("string")
    page = F.struct(
        F.when(kind == "click", "good_detail")
        .when(kind.isin("view", "signup"), "home")
        .otherwise("payment")
        .alias("page_id"),
        F.when(kind == "signup", F.lit(None))
        .when((kind == "view") & (F.col("k") < 30), "")
        .otherwise("prev")
        .alias("last_page_id"),
        F.when(kind == "click", sku).alias("item"),
        F.when(F.col("k") > 0, F.floor("value")).cast("bigint").alias("during_time"),
    )
    displays = F.array(
        F.struct(sku.alias("item"), F.lit("sku_id").alias("item_type")),
        F.struct(F.col("k").cast("string").alias("item"), F.lit("activity_id").alias("item_type")),
    )
    start = F.create_map(F.lit("entry"), F.lit("icon"), F.lit("loading"), F.col("k").cast("string"))
    return events(spark, sf_dir, read).select(
        "event_id",
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.concat(F.lit("v"), F.col("k") % 3).alias("vc"),
            F.concat(F.lit("ch"), F.col("k") % 4).alias("ch"),
            F.concat(F.lit("ar"), F.col("k") % 5).alias("ar"),
            F.when(kind.isin("signup", "view"), "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.when(kind != "error", page).alias("page"),
        F.when(kind.isin("view", "click", "error"), displays)
        .when(kind == "signup", F.slice(displays, 1, 0))
        .alias("displays"),
        F.when(kind == "error", start).alias("start"),
        "ts",
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON text; every event value below 1 breaks its line."""
    records = log_records(spark, sf_dir)
    text = F.to_json(F.struct("common", "page", "displays", "start", "ts"))
    broken = F.coalesce(F.col("page.during_time") < 1, F.lit(False))
    return records.select(
        "event_id", F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value")
    )


def search_records(spark: SparkSession, sf_dir: str, read: Read = table) -> DataFrame:
    """Conversations as log records: what users say is their search text."""
    return read(spark, sf_dir, "conversations").select(
        F.struct(
            F.when(F.col("role") == "user", "good_list").otherwise("chat").alias("page_id"),
            F.col("text").alias("item"),
        ).alias("page"),
        (F.lit(SEARCH_EPOCH_MS) + (F.col("conv_id") * 7 + F.col("turn")) * 1000).alias("ts"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change-capture envelopes of two tables."""
    kind = F.col("event_type")
    row = F.create_map(
        F.lit("id"), F.col("user_id").cast("string"),
        F.lit("name"), F.concat(F.lit("n"), F.col("k")),
        F.lit("amount"), F.floor("value").cast("string"),
    )
    key = F.create_map(F.lit("id"), F.col("user_id").cast("string"))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "c")
        .when(kind == "view", "r")
        .when(kind == "error", "d")
        .otherwise("u")
        .alias("op"),
        F.when(kind == "error", key).alias("before"),
        F.when(kind != "error", row).alias("after"),
        F.struct(
            F.lit("shop").alias("db"),
            F.when(F.col("k") % 2 == 0, "user_info").otherwise("sku_info").alias("table"),
        ).alias("source"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change messages of four tables, some of them unusable."""
    kind = F.col("event_type")
    row = F.create_map(
        F.lit("id"), F.col("user_id").cast("string"),
        F.lit("name"), F.concat(F.lit("n"), F.col("k")),
        F.lit("amount"), F.floor("value").cast("string"),
    )
    # An update carries the name only, and for small k a null one.
    update = F.create_map(
        F.lit("id"), F.col("user_id").cast("string"),
        F.lit("name"), F.when(F.col("k") >= 10, F.concat(F.lit("u"), F.col("k"))),
    )
    # A delete has no row after it, and names the one before.
    key = F.create_map(F.lit("id"), F.col("user_id").cast("string"))
    empty = F.map_filter(row, lambda k, v: F.lit(False))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.lit("shop").alias("database"),
        F.when(F.col("k") == 99, "")
        .when(F.col("k") % 4 == 0, "user_info")
        .when(F.col("k") % 4 == 1, "sku_info")
        .when(F.col("k") % 4 == 2, "order_info")
        .otherwise("cart_info")
        .alias("table"),
        F.when(kind == "view", "bootstrap-insert")
        .when(kind == "click", "update")
        .when(kind == "error", "delete")
        .otherwise("insert")
        .alias("type"),
        F.when(kind == "error", key).alias("before"),
        F.when(kind == "error", empty)
        .when(F.col("k") == 97, F.lit(None))
        .when(F.col("k") == 98, empty)
        .when(kind == "click", update)
        .otherwise(row)
        .alias("data"),
    )


def routing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, schemas.ROUTING)


def orders(
    spark: SparkSession, sf_dir: str, day: date | None = None, read: Read = table
) -> DataFrame:
    """Orders, all of them or those of a day."""
    total = _money("o_totalprice")
    created = F.col("o_orderdate")
    placed = read(spark, sf_dir, "orders")
    if day is not None:
        placed = _days(placed, "o_orderdate", day, day)
    return placed.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 27).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        (F.col("o_custkey") + 20).alias("user_id"),
        total.alias("total_amount"),
        _money(F.lit(0)).alias("activity_reduce_amount"),
        _money(F.col("o_orderkey") % 7).alias("coupon_reduce_amount"),
        _money(total + F.col("o_orderkey") % 7).alias("original_total_amount"),
        _money(F.col("o_orderkey") % 20).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        _text(created).alias("create_time"),
        _text(created + F.expr("INTERVAL '1' HOUR")).alias("operate_time"),
    )


def details(
    spark: SparkSession, sf_dir: str, day: date | None = None, read: Read = table
) -> DataFrame:
    """Order lines, all of them or those that may belong to orders of a day."""
    lines = read(spark, sf_dir, "lineitem")
    if day is not None:
        bound = timedelta(days=ORDER_BOUND_DAYS)
        lines = _days(lines, "l_shipdate", day - bound, day + bound)
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_partkey") + 50).alias("sku_id"),
        _money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit("from order").alias("sku_name"),
        _text("l_shipdate").alias("create_time"),
        _money("l_extendedprice").alias("split_total_amount"),
        _money("l_tax").alias("split_activity_amount"),
        _money("l_discount").alias("split_coupon_amount"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment for each filled order, up to an hour after it."""
    paid = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    called = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 3600)
    return paid.select(
        (F.col("o_orderkey") + 1_000_000_000).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_custkey") + 20).alias("user_id"),
        (_money("o_totalprice") - 1).cast(schemas.MONEY).alias("total_amount"),
        F.col("o_orderpriority").alias("subject"),
        F.lit("1101").alias("payment_type"),
        _text("o_orderdate").alias("create_time"),
        _text(called).alias("callback_time"),
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines; those without a discount come without an amount."""
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        (F.col("l_partkey") + 50).alias("sku_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_discount") > 0, _money("l_extendedprice")).alias("refund_amount"),
        _text("l_shipdate").alias("create_time"),
    )


def _actions(spark: SparkSession, sf_dir: str, kind: str, *more: Column) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == kind).select(
        _event_sku().alias("sku_id"), _text(F.timestamp_millis("ts")).alias("create_time"), *more
    )


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir, "view")


def favors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir, "signup")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    appraise = F.when(F.col("k") < 50, "1201").when(F.col("k") < 80, "1204")
    return _actions(spark, sf_dir, "purchase", appraise.alias("appraise"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_nationkey") != 7, F.date_format(born, "yyyy-MM-dd")).alias("birthday"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "F").otherwise("M").alias("gender"),
    )


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") + 100).cast("string").alias("area_code"),
        F.concat(F.lit("R"), "n_regionkey").alias("iso_code"),
        F.concat(F.lit("R-"), "n_nationkey").alias("iso_3166_2"),
    )


def _category_id() -> Column:
    return (F.ascii("p_type") + F.length("p_type")).cast("string")


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_retailprice").cast(schemas.MONEY).cast("string").alias("price"),
        (F.col("p_size") + 3).cast("string").alias("spu_id"),
        F.regexp_extract("p_brand", "([0-9]+)$", 1).alias("tm_id"),
        _category_id().alias("category3_id"),
    )


def spus(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select("p_size").distinct()
    return sizes.select(
        F.col("p_size").cast("string").alias("id"),
        F.concat(F.lit("SPU "), "p_size").alias("spu_name"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    return types.select(_category_id().alias("id"), F.col("p_type").alias("name"))


def trademarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(
        F.regexp_extract("p_brand", "([0-9]+)$", 1).alias("id"), F.col("p_brand").alias("tm_name")
    )
