"""One function per job, from input streams to the stream it writes.

Topics lie between the jobs, as JSON text.  Jobs that look dimensions or
routing rules up do so once per micro-batch, and so see them as they are then.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from martflow import schemas
from martflow.functions.text import map_text
from martflow.functions.times import EVENT_TIME, millis_to_day, with_event_time
from martflow.operators import changes, keywords, logs, orders, stats, visits
from martflow.sinks.dimensions import Dimension, dimension_columns
from martflow.sinks.results import append_results, commit_results
from martflow.sinks.topics import as_messages, write_messages
from martflow.sources.changes import read_changes, rejected_changes
from martflow.streaming import repair

# Topics between the jobs.
START_LOG = "dwd_start_log"
PAGE_LOG = "dwd_page_log"
DISPLAY_LOG = "dwd_displays_log"
UNIQUE_VISIT = "dwm_unique_visit"
USER_JUMP = "dwm_user_jump_detail"
ORDER_WIDE = "dwm_order_wide"
PAYMENT_WIDE = "dwm_payment_wide"

# Bounces are known up to two bounce limits after they happen.
VISITOR_DELAY = "23 seconds"
# An order may be paid half an hour after it was made, and the payment lag a little.
PAYMENT_DELAY = "1860 seconds"


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``write`` on each micro-batch of a stream."""
    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


class LateRows(StreamingQueryListener):
    """Counts the rows that came after their window was closed, over all batches.

    Add it with ``spark.streams.addListener`` before the queries start.
    """

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        query = str(event.progress.id)
        self.by_query[query] = self.by_query.get(query, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


# --- logs -------------------------------------------------------------------


def split_messages(records: DataFrame) -> DataFrame:
    """Start, page and display messages of log records, in one pass."""
    start = F.struct(F.lit(START_LOG).alias("topic"), map_text("start").alias("value"))
    whole = F.to_json(F.struct(*schemas.PAGE.names))
    page = F.struct(F.lit(PAGE_LOG).alias("topic"), whole.alias("value"))
    shown = F.transform(
        F.coalesce("displays", F.array().cast("array<struct<item:string,item_type:string>>")),
        lambda d: F.struct(
            F.lit(DISPLAY_LOG).alias("topic"),
            F.to_json(d.withField("page_id", F.col("page.page_id"))).alias("value"),
        ),
    )
    messages = F.when(logs.is_start(), F.array(start)).otherwise(
        F.concat(F.array(page), shown)
    )
    return records.select(F.explode(messages).alias("m")).select("m.topic", "m.value")


def base_log(
    day_folder: str,
    folder: str | None = None,
    servers: str | None = None,
    reject_folder: str | None = None,
    committed: bool = False,
) -> Callable[[DataFrame, int], None]:
    """App log lines to start, page and display messages, new flags repaired.

    First days are kept below ``day_folder``; lines that are no records go to
    ``reject_folder``.  ``committed`` messages are seen once by their readers.
    """

    def write(lines: DataFrame, batch: int) -> None:
        checked = logs.checked_lines(lines).persist()
        try:
            fixed = repair.fix_batch(logs.records_of(checked), batch, day_folder)
            write_messages(split_messages(fixed), batch, servers, folder, committed)
            if reject_folder:
                write_rejects(logs.rejects_of(checked), batch, reject_folder)
        finally:
            checked.unpersist()

    return write


def unique_visit(pages: DataFrame, delay: str = "1 day", salts: int = 8) -> DataFrame:
    """The first entry to arrive of each device and day.

    A day's key is remembered for as long as entries of that day may come.  A
    device's entries are thinned out on ``salts`` tasks before they meet on one.
    """
    keyed = with_event_time(visits.session_entries(pages), delay).select(
        "*",
        F.col("common.mid").alias("_mid"),
        millis_to_day("ts").alias("_day"),
        F.pmod(F.xxhash64("ts", "page", "common"), F.lit(salts)).alias("_salt"),
    )
    thinned = keyed.dropDuplicatesWithinWatermark(["_mid", "_day", "_salt"])
    return thinned.dropDuplicatesWithinWatermark(["_mid", "_day"]).select(pages.columns)


def first_entries(
    pages: DataFrame, delay: str = "1 hour", order: tuple[str, ...] = visits.DEFAULT_ORDER
) -> DataFrame:
    """The first entry by time of each device and day, once its day is over.

    A day's first entries come when the watermark has passed the day's end, and are then
    forgotten; entries later than ``delay`` are dropped.  A device costs a day one row of
    state, combined before it is shuffled.  The rows are those of the batch operator.
    """
    columns = [c for c in pages.columns if c != EVENT_TIME]
    timed = with_event_time(visits.session_entries(pages), delay)
    return (
        timed.groupBy(F.window(EVENT_TIME, "1 day"), F.col("common.mid").alias("mid"))
        .agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("r"))
        .select("r.*")
    )


def user_jump(pages: DataFrame, limit_ms: int = 10_000, late_ms: int = 0) -> DataFrame:
    """Bounces; the same operator as in batch."""
    return visits.user_jump(pages, limit_ms, late_ms=late_ms)


# --- changes ----------------------------------------------------------------


def base_db(
    read_config: Callable[[], DataFrame],
    dimension_folder: str,
    fact_folder: str | None = None,
    fact_servers: str | None = None,
    compact_every: int = 100,
    reject_folder: str | None = None,
    committed: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Route each batch of change messages to dimensions and fact topics.

    The messages come with their positions (``read_topic(positions=True)``); of two
    changes of a row the one that the database made later wins, else the one that
    arrived later.  ``read_config`` gives the rules in force, one per table and
    operation; it is asked once per batch.  Given versions of rules
    (``read_rule_versions``), each change meets the rule in force at its own time.
    Lines that are no changes go to ``reject_folder``, and with versions those that
    came before their rule or after its end.
    """

    def write(lines: DataFrame, batch: int) -> None:
        spark = lines.sparkSession
        config = read_config()
        dimensions = dimensions_of(config, dimension_folder)
        to_topics = fact_folder or fact_servers
        if not to_topics and not config.where(F.col("sink_type") == schemas.SINK_FACT).isEmpty():
            raise ValueError("a rule sends facts, and no servers or folder are named for them")
        # In files, ids grow along the lines of a task's part.
        line = F.coalesce("position.nr", F.monotonically_increasing_id())
        placed = lines.withColumn("position", F.col("position").withField("nr", line))
        read = read_changes(placed.withColumn("line", F.col("value")))
        read = read.withColumn("at", F.coalesce("ts", "arrived"))
        valid = changes.valid_changes(read)
        versioned = "since" in config.columns
        route = changes.route_changes_as_of if versioned else changes.route_changes
        routed = route(valid, config).persist()
        try:
            if to_topics:
                facts = changes.fact_messages(routed)
                write_messages(facts, batch, fact_servers, fact_folder, committed)
            dims = changes.dimension_changes(routed)
            for dimension in dimensions:
                table = dimension.folder.rsplit("/", 1)[1]
                dimension.write(dims.where(F.col("sink_table") == table), batch)
                if batch % compact_every == compact_every - 1:
                    dimension.compact(spark, batch)
        finally:
            routed.unpersist()
        if reject_folder:
            rejects = rejected_changes(lines).select("value")
            if versioned:
                kept = valid.select("at", "type", "table", F.col("line").alias("value"))
                rejects = rejects.unionByName(changes.without_rule(kept, config).select("value"))
            write_rejects(rejects, batch, reject_folder)

    return write


def write_rejects(lines: DataFrame, batch: int, folder: str) -> None:
    """Keep unreadable lines as they came; a repeated batch replaces itself."""
    lines.select("value").write.mode("overwrite").text(f"{folder}/batch={batch}")


def dimensions_of(config: DataFrame, folder: str) -> list[Dimension]:
    """The dimension tables that the rules write; there are as many as rules.

    A rule without a column list names no columns for a table, so it is refused.
    """
    rules = config.where(F.col("sink_type") == schemas.SINK_DIMENSION)
    rules = rules.select("sink_table", "sink_columns", "sink_pk")
    tables: dict[str, tuple[dict, str]] = {}
    for table, columns, pk in rules.orderBy("sink_table", "sink_columns").collect():
        if not columns:
            raise ValueError(f"a rule of dimension {table} lists no columns")
        known, _ = tables.setdefault(table, ({}, pk or "id"))
        known.update(dict.fromkeys(dimension_columns(columns, pk)))
    return [
        Dimension(f"{folder}/{table}", tuple(columns), pk)
        for table, (columns, pk) in tables.items()
    ]


# --- orders -----------------------------------------------------------------


def order_wide(
    orders_in: DataFrame,
    details_in: DataFrame,
    bound: timedelta = orders.ORDER_BOUND,
    delay: str = "0 seconds",
    salts: int = 4,
) -> DataFrame:
    return orders.order_wide(orders_in, details_in, bound, delay, salts)


# Dimensions by name: frames, which are joined whole, or tables, which are looked up.
Dimensions = dict[str, DataFrame | Dimension]


def _rows_for(dims: Dimensions, name: str, keys: DataFrame, column: str) -> DataFrame:
    """What a micro-batch needs of a dimension: the rows of its keys."""
    dim = dims[name]
    return dim.lookup(keys, column) if isinstance(dim, Dimension) else dim


def _named_products(rows: DataFrame, dims: Dimensions, price: bool = False) -> DataFrame:
    skus = _rows_for(dims, "sku", rows, "sku_id")
    others = [
        _rows_for(dims, name, skus, column)
        for name, column in (("spu", "spu_id"), ("category", "category3_id"), ("trademark", "tm_id"))
    ]
    return orders.with_product_tables(rows, skus, *others, price=price)


def write_order_wide(
    read_dimensions: Callable[[], Dimensions],
    folder: str | None = None,
    servers: str | None = None,
    as_of: date | None = None,
    committed: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Look a batch of wide orders up in the current dimensions and send it.

    Of a ``Dimension`` table a batch reads the buckets of its keys, of a frame all rows.
    """

    def write(wide: DataFrame, batch: int) -> None:
        dims = read_dimensions()
        wide = wide.persist()  # its keys are asked for before its rows
        try:
            rows = orders.with_user(wide, _rows_for(dims, "user", wide, "user_id"), as_of)
            provinces = _rows_for(dims, "province", wide, "province_id")
            rows = _named_products(orders.with_province(rows, provinces), dims)
            write_messages(as_messages(rows, ORDER_WIDE), batch, servers, folder, committed)
        finally:
            wide.unpersist()

    return write


def payment_wide(
    payments: DataFrame,
    wide: DataFrame,
    bound: timedelta = orders.PAYMENT_BOUND,
    delay: str = "0 seconds",
    salts: int = 4,
) -> DataFrame:
    return orders.payment_wide(payments, wide, bound, delay, salts)


# --- statistics -------------------------------------------------------------


def visitor_stats(
    pages: DataFrame,
    unique_visits: DataFrame,
    bounces: DataFrame,
    window: str = stats.WINDOW,
    delay: str = "3 seconds",
    bounce_delay: str = VISITOR_DELAY,
) -> DataFrame:
    """Visitor statistics of three streams, each with a watermark of its own.

    Spark closes a window when the slowest of them has passed it.
    """
    measures = stats.union_on_time(
        (stats.page_measures(pages), delay),
        (stats.unique_visit_measures(unique_visits), delay),
        (stats.bounce_measures(bounces), bounce_delay),
    )
    return stats.visitor_stats(measures, window)


def product_stats(
    *measures: DataFrame,
    window: str = stats.WINDOW,
    delay: str = "5 seconds",
    payment_delay: str = PAYMENT_DELAY,
) -> DataFrame:
    """Product statistics of any measure frames, each with a watermark of its own.

    Payments are dated by their order, so they come as late as orders may be paid.
    """
    dated = [
        (frame, payment_delay if "payment_amount" in frame.columns else delay)
        for frame in measures
    ]
    return stats.product_stats(stats.union_on_time(*dated), window)


def write_product_stats(
    read_dimensions: Callable[[], Dimensions], table: str, committed: bool = False
) -> Callable[[DataFrame, int], None]:
    """Name a batch of product rows from the current dimensions and append it."""
    append = commit_results if committed else append_results

    def write(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        try:
            append(_named_products(rows, read_dimensions(), price=True), table, batch)
        finally:
            rows.unpersist()

    return write


def write_results(
    table: str, helpers: tuple[str, ...] = (), committed: bool = False
) -> Callable[[DataFrame, int], None]:
    """Append each batch to a result table; ``committed``, its readers see it once."""
    append = commit_results if committed else append_results

    def write(rows: DataFrame, batch: int) -> None:
        append(rows, table, batch, helpers)

    return write


def province_stats(
    wide: DataFrame, window: str = stats.WINDOW, delay: str = "3 seconds"
) -> DataFrame:
    return stats.province_stats(wide, window, delay)


def keyword_stats(
    pages: DataFrame, window: str = stats.WINDOW, delay: str = "3 seconds"
) -> DataFrame:
    words = keywords.keyword_tokens(keywords.searches(pages))
    return stats.keyword_stats(words, window, delay)
