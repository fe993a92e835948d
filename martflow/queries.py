"""The registered queries: each operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow import adapt, schemas
from martflow.functions import times
from martflow.functions.text import register_tokenizer
from martflow.operators import changes, joins, keywords, logs, orders, stats, visits
from martflow.plans import products, reports, visitors
from martflow.plans.staging import (
    read_batches,
    stage,
    stage_files,
    stage_stream,
    staging_dir,
    write_batches,
)
from martflow.session import tune
from martflow.sinks.keyed import KeyedTable
from martflow.sinks.results import commit_results, read_committed
from martflow.sinks.topics import as_messages
from martflow.streaming import jobs, kept, repair

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Windows over events; the tables spread them over a month.
EVENT_WINDOW = "1 day"
ORDER_BOUND = timedelta(days=adapt.ORDER_BOUND_DAYS)
AS_OF = date(2024, 6, 1)
# What closes the windows of a stream comes then.
LAST_STT = "2100-01-01 00:00:00"
LAST_MILLIS = 4_102_444_800_000
ORDER_DAY = 19991211
EVENT_DAY = 20240115


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the common ground of both engines' results."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(fn(tune(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def _flat_log(records: DataFrame) -> DataFrame:
    return records.select("event_id", "common.*", "page.*", "ts")


# --- logs -------------------------------------------------------------------


@query
def parse_events(spark, sf):
    """JSON lines to records; broken lines are left out."""
    records = logs.parse_log(adapt.log_lines(spark, sf))
    shown = F.when(F.col("displays").isNull(), 0).otherwise(F.size("displays"))
    return records.select(
        "event_id", "common.*", "page.*", "ts", shown.alias("displays")
    )


@query
def parse_rejects(spark, sf):
    """The lines that are no records."""
    return logs.rejected_lines(adapt.log_lines(spark, sf)).select("event_id")


@query
def fix_is_new(spark, sf):
    fixed = visits.fix_is_new(adapt.log_records(spark, sf))
    return fixed.select("event_id", "common.mid", "common.is_new", "ts")


@query
def split_start(spark, sf):
    found = logs.split_start(adapt.log_records(spark, sf))
    return found.select(
        "event_id", F.col("start")["entry"].alias("entry"), F.col("start")["loading"].alias("loading")
    )


@query
def split_page(spark, sf):
    return _flat_log(logs.split_page(adapt.log_records(spark, sf)))


@query
def split_display(spark, sf):
    return logs.split_display(adapt.log_records(spark, sf))


def _pages(spark, sf):
    return logs.split_page(adapt.log_records(spark, sf))


@query
def session_entries(spark, sf):
    return _flat_log(visits.session_entries(_pages(spark, sf)))


@query
def unique_visit(spark, sf):
    return _flat_log(visits.unique_visit(_pages(spark, sf), adapt.VISIT_ORDER))


@query
def user_jump(spark, sf):
    found = visits.user_jump(_pages(spark, sf), adapt.BOUNCE_LIMIT_MS, adapt.VISIT_ORDER)
    return _flat_log(found)


@query
def visitor_union(spark, sf):
    pages = _pages(spark, sf)
    return stats.visitor_union(
        pages,
        visits.unique_visit(pages, adapt.VISIT_ORDER),
        visits.user_jump(pages, adapt.BOUNCE_LIMIT_MS, adapt.VISIT_ORDER),
    )


@query
def visitor_stats(spark, sf):
    return visitors.visitor_stats(
        adapt.log_records(spark, sf), EVENT_WINDOW, adapt.BOUNCE_LIMIT_MS, adapt.VISIT_ORDER
    )


# --- changes ----------------------------------------------------------------


@query
def cdc_normalize(spark, sf):
    events = changes.normalize_envelopes(adapt.envelopes(spark, sf))
    data = F.col("data")
    return events.select(
        "seq",
        "database",
        "table",
        "type",
        F.size("data").alias("fields"),
        *[data[c].alias(c) for c in ("id", "name", "amount")],
    )


@query
def cdc_latest(spark, sf):
    """Each table's rows after all changes; a delete is keyed by the row before it."""
    events = changes.normalize_envelopes(adapt.envelopes(spark, sf))
    latest = changes.latest_rows(events, ["table", "id"], ["seq"])
    data = F.col("data")
    return latest.select("table", "id", "type", data["name"].alias("name"), data["amount"].alias("amount"))


@query
def change_filter(spark, sf):
    return changes.valid_changes(adapt.changes(spark, sf)).select("seq", "table", "type")


@query
def route_changes(spark, sf):
    routed = changes.route_changes(
        changes.valid_changes(adapt.changes(spark, sf)), adapt.routing(spark)
    )
    return routed.select(
        "seq", "table", "type", "sink_type", "sink_table", "sink_pk", F.size("data").alias("fields")
    )


def _rule_history(spark, sf):
    """Changes of the rule table, placed by the ids of the events they fall between.

    Half way a rule begins, one ends, one cuts its columns, and one goes to another topic.
    """
    half = (adapt.events(spark, sf).agg(F.max("event_id")).first()[0] or 0) // 2
    first = adapt.routing(spark)
    row = F.map_from_arrays(
        F.array(*map(F.lit, first.columns)), F.array(*[F.col(c).cast("string") for c in first.columns])
    )
    operation = F.concat_ws(":", "source_table", "operate_type")
    begins, ends = operation == "order_info:insert", operation == "sku_info:delete"
    cut = F.map_concat(
        F.map_filter(row, lambda k, _: ~k.isin("sink_columns", "sink_table")),
        F.create_map(
            F.lit("sink_columns"), F.when(operation == "user_info:update", "id").otherwise(F.col("sink_columns")),
            F.lit("sink_table"), F.when(operation == "order_info:update", "dwd_later").otherwise(F.col("sink_table")),
        ),
    )
    empty = F.map_filter(row, lambda k, v: F.lit(False))
    start = first.where(~begins).select(
        F.lit(0).cast("bigint").alias("seq"), F.lit("insert").alias("type"), empty.alias("before"), row.alias("data")
    )
    later = first.select(
        F.lit(half).cast("bigint").alias("seq"),
        F.when(begins, "insert").when(ends, "delete").otherwise("update").alias("type"),
        F.when(begins, empty).otherwise(row).alias("before"),
        F.when(ends, empty).otherwise(cut).alias("data"),
    )
    return start.unionByName(later)


@query
def route_changes_as_of(spark, sf):
    """Changes by the rules in force where they stand; those without one have no sink."""
    versions = changes.rule_versions(_rule_history(spark, sf), "seq")
    valid = changes.valid_changes(adapt.changes(spark, sf))
    routed = changes.route_changes_as_of(valid, versions, "seq")
    missed = changes.without_rule(valid, versions, "seq").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("sink_type", "sink_table", "sink_pk")]
    )
    return routed.unionByName(missed).select(
        "seq", "table", "sink_type", "sink_table", F.size("data").alias("fields")
    )


@query
def cdc_handover(spark, sf):
    """Each table's rows, read in four chunks of keys while the log went on, and the log.

    The chunks see all changes up to where they were read, a little after they were
    begun; the log that is followed begins where the first chunk does.
    """
    events = changes.normalize_envelopes(adapt.envelopes(spark, sf))
    last = events.agg(F.max("seq")).first()[0] or 0
    key = changes.row_value(events, "id")
    chunks = None
    for n in range(4):
        begun = last * (n + 2) // 8
        seen = events.where((F.col("seq") <= begun + last // 16) & (F.pmod(F.xxhash64(key), F.lit(4)) == n))
        rows = changes.latest_rows(seen, ["table", "id"], ["seq"])
        rows = rows.withColumns({"type": F.lit("read"), "seq": F.lit(begun).cast("bigint")})
        chunks = rows if chunks is None else chunks.unionByName(rows)
    log = events.where(F.col("seq") > last * 2 // 8).withColumn("id", key)
    latest = changes.handover_table(chunks, log, ["table", "id"], "seq")
    data = F.col("data")
    return latest.select("table", "id", data["name"].alias("name"), data["amount"].alias("amount"))


@query
def dim_point_lookup(spark, sf):
    """Order lines beside their products, looked up in a table in key buckets."""
    folder = f"{staging_dir(spark)}/sku-{uuid.uuid4().hex}"
    skus = adapt.skus(spark, sf)
    store = KeyedTable(folder, skus.schema, "id", 8)
    store.put(skus, 0)
    lines = adapt.details(spark, sf)
    found = store.lookup(lines.select("sku_id").distinct(), "sku_id")
    named = joins.enrich(
        lines, found, {"sku_id": "id"}, {"sku_name": F.col("sku_name"), "spu_id": F.col("spu_id")}
    )
    return named.select("id", "sku_id", "sku_name", "spu_id")


@query
def project_columns(spark, sf):
    routed = changes.route_changes(
        changes.valid_changes(adapt.changes(spark, sf)), adapt.routing(spark)
    )
    data = F.col("data")
    return routed.select("seq", *[data[c].alias(c) for c in ("id", "name", "amount")])


@query
def dim_upsert(spark, sf):
    """Both dimensions after all messages, routed and cut to their rules' columns."""
    config = adapt.routing(spark)
    routed = changes.route_changes(changes.valid_changes(adapt.changes(spark, sf)), config)
    messages = changes.dimension_changes(routed)
    tables = [
        changes.fold_dimension(
            messages.where(F.col("sink_table") == name), columns, "id", ["seq"]
        ).select(
            F.lit(name).alias("sink_table"), "id", "name",
            F.col("amount") if "amount" in columns else F.lit(None).cast("string").alias("amount"),
        )
        for name, columns in (
            ("dim_user_info", ["id", "name"]),
            ("dim_sku_info", ["id", "name", "amount"]),
        )
    ]
    return tables[0].unionByName(tables[1])


@query
def to_json_rows(spark, sf):
    """Refunds as JSON text; a missing amount is left out."""
    rows = adapt.refunds(spark, sf).select("sku_id", "order_id", "refund_amount", "create_time")
    return as_messages(rows, "dwd_order_refund_info")


# --- orders -----------------------------------------------------------------


def _order_wide(spark, sf, day=None):
    """All wide orders, or those of the one day that a report asks for."""
    day = None if day is None else reports.day_of(day)
    return orders.order_wide(
        adapt.orders(spark, sf, day), adapt.details(spark, sf, day), ORDER_BOUND
    )


def _products(spark, sf):
    """The product tables joined with each other first, so facts need one lookup."""
    return orders.product_dimension(
        adapt.skus(spark, sf),
        adapt.spus(spark, sf),
        adapt.categories(spark, sf),
        adapt.trademarks(spark, sf),
    )


def _order_wide_dims(spark, sf):
    wide = orders.with_user(_order_wide(spark, sf), adapt.users(spark, sf), AS_OF)
    wide = orders.with_province(wide, adapt.provinces(spark, sf))
    return orders.with_product(wide, _products(spark, sf))


@query
def order_wide(spark, sf):
    return _order_wide(spark, sf)


@query
def order_wide_user(spark, sf):
    wide = orders.with_user(_order_wide(spark, sf), adapt.users(spark, sf), AS_OF)
    return wide.select("detail_id", "sku_id", "order_price", "user_id", "user_age", "user_gender")


@query
def order_wide_dims(spark, sf):
    return _order_wide_dims(spark, sf).select(
        "detail_id", "order_price", "sku_id", "sku_name", "province_id", "province_name",
        "province_area_code", "province_iso_code", "province_3166_2_code", "spu_id", "tm_id",
        "category3_id", "spu_name", "tm_name", "category3_name",
    )


@query
def dim_lookup_multi(spark, sf):
    """Customers by segment and nation: the first one stands for the pair."""
    customers = adapt.table(spark, sf, "customer")
    suppliers = adapt.table(spark, sf, "supplier")
    asked = suppliers.select(
        "s_suppkey",
        F.when(F.col("s_acctbal") > 0, "BUILDING").otherwise("NOBODY").alias("segment"),
        (F.col("s_nationkey") + 2).alias("nation"),
    )
    return joins.lookup(
        asked,
        customers,
        {"segment": "c_mktsegment", "nation": "c_nationkey"},
        {"contact": F.col("c_name")},
        ["c_custkey"],
    )


def _payment_wide(spark, sf, wide):
    return orders.payment_wide(adapt.payments(spark, sf), wide)


@query
def payment_wide(spark, sf):
    return _payment_wide(spark, sf, _order_wide(spark, sf))


@query
def order_wide_merge(spark, sf):
    """Open orders' lines merged with those of large orders, by line."""
    wide = _order_wide(spark, sf)
    columns = [
        "detail_id", "order_id", "order_status", "create_time", "total_amount", "user_id",
        "sku_id", "sku_num", "split_total_amount",
    ]
    one = joins.first_per_key(wide.select(columns), ["detail_id"], ["sku_id", "split_total_amount", "sku_num"])
    this = one.where(F.col("order_status") != "P").withColumn(
        "total_amount", F.when(F.col("order_status") == "O", F.col("total_amount"))
    )
    other = one.where(F.col("total_amount") > 150000).withColumn(
        "order_status", F.lit("other")
    )
    return orders.merge_wide(this.select(columns), other.select(columns))


@query
def province_stats(spark, sf):
    wide = orders.with_province(_order_wide(spark, sf), adapt.provinces(spark, sf))
    return stats.province_stats(wide)


# --- products ---------------------------------------------------------------


@query
def product_clicks(spark, sf):
    return stats.product_clicks(_pages(spark, sf))


@query
def product_displays(spark, sf):
    return stats.product_displays(_pages(spark, sf))


def _staged_wide(spark, sf):
    """What product measures need of wide orders: read twice, by orders and payments, written once."""
    columns = ["order_id", "sku_id", "sku_num", "split_total_amount", "create_time"]
    return stage(_order_wide(spark, sf).select(columns), "order_wide")


def _product_stats(spark, sf):
    wide = _staged_wide(spark, sf)
    measures = products.product_measures(
        _pages(spark, sf),
        wide,
        _payment_wide(spark, sf, wide),
        adapt.carts(spark, sf),
        adapt.favors(spark, sf),
        adapt.refunds(spark, sf),
        adapt.comments(spark, sf),
    )
    return stats.product_stats(measures, EVENT_WINDOW)


@query
def product_stats(spark, sf):
    return _product_stats(spark, sf)


def _order_product_rows(spark, sf, day=None):
    """Product rows of orders only."""
    wide = _order_wide(spark, sf, day)
    return stats.product_stats(stats.product_union(stats.product_orders(wide)), EVENT_WINDOW)


def _named_rows_of_day(spark, sf, day):
    """A day's product rows with names: few rows, looked up table by table."""
    return orders.with_product_tables(
        _order_product_rows(spark, sf, day),
        adapt.skus(spark, sf),
        adapt.spus(spark, sf),
        adapt.categories(spark, sf),
        adapt.trademarks(spark, sf),
        price=True,
    )


@query
def product_stats_dims(spark, sf):
    """Product rows of all sources, with names and price."""
    return products.with_product_dimension(_product_stats(spark, sf), _products(spark, sf))


# --- keywords ---------------------------------------------------------------


@query
def keyword_tokens(spark, sf):
    return keywords.keyword_tokens(keywords.searches(adapt.search_records(spark, sf)))


@query
def keyword_lateral(spark, sf):
    """The same tokens by the SQL function."""
    register_tokenizer(spark)
    keywords.searches(adapt.search_records(spark, sf)).createOrReplaceTempView("searches")
    return spark.sql(
        "SELECT s AS keyword, ts FROM (SELECT ik_analyze(fullword) AS words, ts FROM searches) "
        "LATERAL VIEW explode(words) t AS s"
    )


@query
def keyword_segments(spark, sf):
    """The tokens read by a dictionary of the searches' own short words, weighed by use."""
    found = keywords.searches(adapt.search_records(spark, sf))
    short = keywords.keyword_tokens(found).where(F.length("keyword") <= 4)
    dictionary = short.groupBy(F.col("keyword").alias("word")).agg(F.count(F.lit(1)).alias("weight"))
    return keywords.keyword_segments(found, dictionary)


@query
def keyword_stats(spark, sf):
    words = keywords.keyword_tokens(keywords.searches(adapt.search_records(spark, sf)))
    return stats.keyword_stats(words)


# --- streams ----------------------------------------------------------------
# The tables as streams, through the jobs.  A record of a far later day closes the
# windows that the end of the input would leave open.


@query
def stream_fix_is_new(spark, sf):
    """Log lines through the base log job, several micro-batches in order of time."""
    records = adapt.log_records(spark, sf)
    lines = records.select(
        F.to_json(F.struct("common", "page", "displays", "start", "ts")).alias("value"), "ts"
    )
    lines = stage_files(lines, "ts", "log_lines")
    folder = f"{staging_dir(spark)}/fixed-{uuid.uuid4().hex}"

    def write(batch_lines, batch):
        parsed = logs.parse_log(batch_lines.select("value")).persist()
        try:
            fixed = repair.fix_batch(parsed, batch, f"{folder}/days")
            flat = fixed.select("common.mid", "common.is_new", "ts")
            flat.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")
        finally:
            parsed.unpersist()

    jobs.start_batches(lines, write, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("mid", "is_new", "ts")


def _timed(found: DataFrame, time: str, name: str, page_id: str = "good_detail") -> DataFrame:
    """Records as a stream of some micro-batches in order of time, then one far later.

    The last record, of no product and no visitor, closes the windows of the others.
    """
    page = {"page_id": F.lit(page_id), "item": F.lit("-1")}
    row = []
    for field in found.schema:
        value = F.lit(None)
        if field.name == time:
            value = F.lit(LAST_MILLIS if time == "ts" else LAST_STT)
        elif field.name == "sku_id":
            value = F.lit(-1)
        elif field.name == "page":
            value = F.struct(*[page.get(n, F.lit(None)).alias(n) for n in field.dataType.names])
        row.append(value.cast(field.dataType).alias(field.name))
    last = found.sparkSession.range(1).select(*row).coalesce(1)
    return stage_files(found, time, name, last, slices=2)


def _page_stream(spark, sf):
    return logs.split_page(adapt.log_records(spark, sf, adapt.stream))


@query
def stream_unique_visit(spark, sf):
    """The first entries by time, each given out once its day is over."""
    pages = _timed(_pages(spark, sf).select("event_id", "common", "page", "ts"), "ts", "pages")
    found = jobs.first_entries(pages, "0 seconds", adapt.VISIT_ORDER)
    return _flat_log(stage_stream(found, "unique_visit"))


@query
def stream_user_jump(spark, sf):
    pages = _pages(spark, sf).select("event_id", "common", "page", "ts")
    found = visits.user_jump(_timed(pages, "ts", "pages"), adapt.BOUNCE_LIMIT_MS, adapt.VISIT_ORDER)
    return _flat_log(stage_stream(found, "user_jump"))


@query
def stream_visitor_stats(spark, sf):
    """All visitor measures per closed window, of three topics.

    Bounces are known two bounce limits after they happen.
    """
    pages, visits_of_day, bounces = (
        _timed(found, "ts", name)
        for name, found in (
            ("pages", _pages(spark, sf)),
            ("visits", visits.unique_visit(_pages(spark, sf), adapt.VISIT_ORDER)),
            ("bounces", visits.user_jump(_pages(spark, sf), adapt.BOUNCE_LIMIT_MS, adapt.VISIT_ORDER)),
        )
    )
    bound = f"{2 * adapt.BOUNCE_LIMIT_MS} milliseconds"
    found = jobs.visitor_stats(pages, visits_of_day, bounces, EVENT_WINDOW, bounce_delay=bound)
    return stage_stream(found, "visitor_stats").where(F.col("stt") < LAST_STT)


@query
def stream_order_wide(spark, sf):
    """Orders and lines as streams, the open ones kept between micro-batches."""
    folder = f"{staging_dir(spark)}/order_wide-{uuid.uuid4().hex}"
    rows = kept.orders_and_details(*[adapt.stream(spark, sf, t) for t in ("orders", "lineitem")])
    join = kept.order_wide(
        f"{folder}/kept",
        write_batches(f"{folder}/out"),
        ORDER_BOUND,
        order_of=lambda found: adapt.orders(spark, sf, read=lambda *_: found),
        detail_of=lambda found: adapt.details(spark, sf, read=lambda *_: found),
    )
    jobs.start_batches(rows, join, f"{folder}/checkpoint").awaitTermination()
    return read_batches(spark, f"{folder}/out", schemas.ORDER_WIDE)


@query
def stream_product_stats(spark, sf):
    """All product measures per window, of seven topics; open windows are kept between micro-batches."""
    folder = f"{staging_dir(spark)}/product-{uuid.uuid4().hex}"
    wide = _staged_wide(spark, sf)
    paid = _payment_wide(spark, sf, wide)
    sources = {
        "pages": ("ts", _pages(spark, sf).select("page", "displays", "start", "ts")),
        "wide": ("create_time", wide),
        "paid": (
            "order_create_time",
            paid.select("order_id", "sku_id", "split_total_amount", "order_create_time"),
        ),
        "carts": ("create_time", adapt.carts(spark, sf)),
        "favors": ("create_time", adapt.favors(spark, sf)),
        "refunds": ("create_time", adapt.refunds(spark, sf)),
        "comments": ("create_time", adapt.comments(spark, sf)),
    }
    streams = [_timed(found, time, name) for name, (time, found) in sources.items()]
    measures = kept.by_source(dict(zip(sources, products.product_frames(*streams))))
    delays = {name: timedelta(seconds=1860 if name == "paid" else 5) for name in sources}
    close = kept.product_stats(f"{folder}/kept", write_batches(f"{folder}/out"), delays, EVENT_WINDOW)
    jobs.start_batches(measures, close, f"{folder}/checkpoint").awaitTermination()
    found = read_batches(spark, f"{folder}/out", stats.product_stats(measures, EVENT_WINDOW).schema)
    return found.where(F.col("stt") < LAST_STT)


@query
def stream_keyword_stats(spark, sf):
    pages = _timed(adapt.search_records(spark, sf), "ts", "searches", "good_list")
    return stage_stream(jobs.keyword_stats(pages), "keyword_stats")


# --- functions --------------------------------------------------------------


@query
def time_functions(spark, sf):
    events = adapt.events(spark, sf)
    text = times.millis_to_text("ts")
    return events.select(
        "event_id",
        text.alias("text"),
        times.text_to_millis(text).alias("millis"),
        times.millis_to_day("ts").alias("day"),
        times.text_to_day_number(text).alias("day_number"),
        F.from_unixtime(F.floor(F.col("ts") / 1000)).alias("from_seconds"),
        F.unix_timestamp(text).alias("seconds"),
    )


# --- reports ----------------------------------------------------------------


@query
def report_gmv(spark, sf):
    return reports.gmv(_order_product_rows(spark, sf, ORDER_DAY), ORDER_DAY)


@query
def report_top_brand(spark, sf):
    return reports.top_brands(_named_rows_of_day(spark, sf, ORDER_DAY), ORDER_DAY)


@query
def report_top_category(spark, sf):
    return reports.top_categories(_named_rows_of_day(spark, sf, ORDER_DAY), ORDER_DAY)


@query
def report_province(spark, sf):
    wide = orders.with_province(_order_wide(spark, sf, ORDER_DAY), adapt.provinces(spark, sf))
    return reports.province_totals(stats.province_stats(wide), ORDER_DAY)


def _stored_visitor_stats(spark, sf):
    """Visitor statistics as the result table holds them: written, then read."""
    table = f"{staging_dir(spark)}/visitor_stats-{uuid.uuid4().hex}"
    commit_results(QUERIES["visitor_stats"](spark, sf), table, 0)
    return read_committed(spark, table, [str(EVENT_DAY)])


@query
def report_visitor(spark, sf):
    """A day's partition of the stored statistics."""
    return reports.visitor_totals(_stored_visitor_stats(spark, sf), EVENT_DAY)


@query
def report_visitor_ratios(spark, sf):
    totals = reports.visitor_totals(_stored_visitor_stats(spark, sf), EVENT_DAY)
    return reports.visitor_ratios(totals)
