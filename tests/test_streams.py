"""Streams over files against the batch operators on the same records."""

import json
import os
import random
import time
from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest

from martflow import schemas
from martflow.operators import keywords, logs, orders, stats, visits
from martflow.plans import products
from martflow.plans.staging import read_batches, write_batches
from martflow.queries import QUERIES
from martflow.sinks.topics import as_messages, stream_messages
from martflow.sources.changes import read_routing
from martflow.sources.logs import read_log_lines, stream_log_lines
from martflow.sources.topics import kafka_options, read_topic, read_topic_table
from martflow.streaming import jobs, kept, repair
from test_logs import SAMPLE, frame, page
from test_orders import detail, order, pay

DAY = 86_400_000
LATER = 40 * 365 * DAY


@pytest.fixture
def topics(tmp_path):
    """Write batches of records to a topic, one file a batch; returns the folder."""
    clock = [1_000_000_000]

    def write(name, *batches):
        folder = f"{tmp_path}/{name}/topic={name}"
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            clock[0] += 10
            path = f"{folder}/part-{clock[0]}.txt"
            with open(path, "w") as out:
                out.writelines(
                    (r if isinstance(r, str) else json.dumps(r, default=float)) + "\n" for r in batch
                )
            os.utime(path, (clock[0], clock[0]))
        return f"{tmp_path}/{name}"

    return write


def run(query):
    assert query.awaitTermination(180), "the stream did not end"
    return query


def table_of(stream, path, files=None):
    """Run a stream into a Parquet table and read that."""
    query = stream.writeStream.format("parquet").outputMode("append")
    query = query.option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp")
    run(query.trigger(availableNow=True).start())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def sliced(records, n):
    size = -(-len(records) // n)
    return [records[i : i + size] for i in range(0, len(records), size)]


def random_log(seed, n, span, step=1000):
    rng = random.Random(seed)
    stamps = sorted(rng.sample(range(0, span, step), n))
    return [
        page(f"d{rng.randrange(5)}", ts, rng.choice(["home", "good_detail"]),
             rng.choice([None, "q"]), rng.choice(["0", "1"]), rng.randrange(90), item="5")
        for ts in stamps
    ]


def test_base_log_repairs_splits_and_survives_a_restart(spark, topics, tmp_path):
    records = random_log(1, 120, 4 * DAY)
    for r in records[::7]:
        r["start"] = {"entry": "icon"}
    for r in records[::5]:
        r["displays"] = [{"item": "5", "item_type": "sku_id"}, {"item": "6", "item_type": "x"}]
    one, two, three = sliced(records, 3)
    out, checkpoint = f"{tmp_path}/dwd", f"{tmp_path}/cp"

    def job(folder):
        write = jobs.base_log(f"{tmp_path}/days", out, reject_folder=f"{tmp_path}/rejects")
        lines = stream_log_lines(spark, f"{folder}/topic=ods", 1)
        run(jobs.start_batches(lines, write, checkpoint))

    folder = topics("ods", [*one, "broken {"], two)
    job(folder)
    job(topics("ods", three))  # the same checkpoint: the first days are remembered

    fixed = visits.fix_is_new(logs.parse_log(read_log_lines(spark, f"{folder}/topic=ods")))
    written = spark.read.text(out)
    pages = logs.parse_text(written.where(f"topic = '{jobs.PAGE_LOG}'").select("value"), schemas.PAGE)
    flags = ["common.mid", "ts", "common.is_new", "page.page_id", "page.during_time"]
    flat = [f"{f} AS c{i}" for i, f in enumerate(flags)]
    assert rows(pages.selectExpr(*flat)) == rows(logs.split_page(fixed).selectExpr(*flat))
    assert written.where(f"topic = '{jobs.START_LOG}'").count() == logs.split_start(fixed).count()
    displays = written.where(f"topic = '{jobs.DISPLAY_LOG}'")
    shown = logs.parse_text(displays.select("value"), logs.split_display(fixed).schema)
    assert rows(shown) == rows(logs.split_display(fixed))

    assert [r.value for r in spark.read.text(f"{tmp_path}/rejects").collect()] == ["broken {"]

    # The next job reads the topic that this one has written.
    topic = read_topic_table(spark, jobs.PAGE_LOG, schemas.PAGE, folder=f"{out}/batch=*")
    assert rows(table_of(topic.selectExpr(*flat), f"{tmp_path}/next")) == rows(pages.selectExpr(*flat))


def test_a_repeated_batch_gives_the_same_flags(spark, tmp_path):
    day = lambda n, is_new="1": page("a", n * DAY, is_new=is_new)
    batches = [[day(2), day(1)], [day(1), day(3)], [page("b", 5 * DAY, is_new="1"), day(2)]]
    for n in (0, 1, 1, 2, 2):
        fixed = repair.fix_batch(frame(spark, batches[n]), n, f"{tmp_path}/days")
        flags = {(r.common.mid, r.ts // DAY, r.common.is_new) for r in fixed.collect()}
        expected = [
            {("a", 1, "1"), ("a", 2, "0")}, {("a", 1, "1"), ("a", 3, "0")},
            {("b", 5, "1"), ("a", 2, "0")},
        ]
        assert flags == expected[n]


@pytest.mark.parametrize("chunk", [2, 10_000])
def test_flags_do_not_hang_on_chunks_or_order(spark, tmp_path, chunk):
    """Three batches, shuffled within, a third of all records from one device."""
    rng = random.Random(6)
    records = [
        page("hot" if i % 3 == 0 else f"d{rng.randrange(20)}", i * 3_600_000, is_new="1")
        for i in range(240)
    ]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        got = []
        for batch, part in enumerate(sliced(records, 3)):
            rng.shuffle(part)
            fixed = repair.fix_batch(frame(spark, part).repartition(5), batch, f"{tmp_path}/days")
            got += [(r.common.mid, r.ts, r.common.is_new) for r in fixed.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = visits.fix_is_new(frame(spark, records)).collect()
    assert sorted(got) == sorted((r.common.mid, r.ts, r.common.is_new) for r in want)


def test_bounces(spark, topics, tmp_path):
    folder = topics("pages", SAMPLE[:2], SAMPLE[2:], [page("end", LATER)])
    pages = read_topic_table(spark, "pages", schemas.PAGE, folder=folder, files_per_batch=1)
    found = table_of(jobs.user_jump(pages), tmp_path).where(f"ts < {LATER}")
    assert [(r.common.mid, r.ts) for r in found.collect()] == [("101", 10000)]


def test_bounces_equal_batch(spark, topics, tmp_path):
    records = random_log(2, 300, 1_200_000, 100)
    folder = topics("pages", *sliced(records, 4), [page("end", LATER)])
    pages = read_topic_table(spark, "pages", schemas.PAGE, folder=folder, files_per_batch=1)
    found = table_of(jobs.user_jump(pages), tmp_path).where(f"ts < {LATER}")
    batch = visits.user_jump(frame(spark, records))
    assert rows(found.select("common.mid", "ts")) == rows(batch.select("common.mid", "ts"))
    assert batch.count() > 20


def test_unique_visits_equal_batch(spark, topics, tmp_path):
    records = random_log(3, 150, 4 * DAY)
    folder = topics("pages", *sliced(records, 3))
    pages = read_topic_table(spark, "pages", schemas.PAGE, folder=folder, files_per_batch=1)
    found = table_of(jobs.unique_visit(pages), tmp_path)
    # Of entries in one micro-batch any may be kept, so devices and days compare.
    keys = "common.mid", "date(timestamp_millis(ts)) AS day"
    batch = visits.unique_visit(frame(spark, records))
    assert rows(found.selectExpr(*keys)) == rows(batch.selectExpr(*keys))
    assert rows(found.selectExpr(*keys)) == rows(found.selectExpr(*keys).distinct())


def test_visitor_stats_equal_batch(spark, topics, tmp_path):
    records = random_log(4, 200, 600_000)
    batch_pages = frame(spark, records)
    uv, uj = visits.unique_visit(batch_pages), visits.user_jump(batch_pages)

    def topic(name, df):
        parts = [
            [r.value for r in as_messages(df.where(f"ts div 200000 = {i}"), name).collect()]
            for i in range(3)
        ]
        return topics(name, *parts, [page("end", LATER)])

    streams = [
        read_topic_table(spark, n, schemas.PAGE, folder=topic(n, df), files_per_batch=1)
        for n, df in (("pages", batch_pages), ("uv", uv), ("uj", uj))
    ]
    found = table_of(jobs.visitor_stats(*streams), tmp_path).where(f"ts < {LATER}")
    assert rows(found) == rows(stats.visitor_stats(stats.visitor_union(batch_pages, uv, uj)))


def test_late_records_are_dropped(spark, topics, tmp_path):
    folder = topics(
        "pages", [page("a", 1_000), page("a", 30_000)], [page("a", 60_000)],
        [page("a", 2_000), page("a", 58_500)], [page("end", LATER)],
    )
    pages = read_topic_table(spark, "pages", schemas.PAGE, folder=folder, files_per_batch=1)
    counts = stats.visitor_stats(stats.page_measures(pages), delay="3 seconds")
    query = counts.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        query = query.option("checkpointLocation", f"{tmp_path}/cp")
        query = run(query.trigger(availableNow=True).start())
        for _ in range(50):  # progress is reported a little later
            if late.by_query.get(query.id):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert late.by_query[query.id] == 1
    found = spark.read.schema(counts.schema).parquet(f"{tmp_path}/out").where(f"ts < {LATER}")
    assert {(r.stt[-5:], r.pv_ct) for r in found.collect()} == {
        ("00:00", 1), ("00:30", 1), ("00:50", 1), ("01:00", 1),
    }


def shop(rng, n):
    stamp = lambda s: f"2024-03-01 10:{s // 60:02d}:{s % 60:02d}"
    placed, lines, paid = [], [], []
    for i in range(1, n + 1):
        at = rng.randrange(0, 1500)
        placed.append((at, order(i, stamp(at), user_id=i % 4, province_id=i % 3)))
        for j in range(rng.randrange(1, 4)):
            then = max(at + rng.randrange(-7, 8), 0)
            lines.append((then, detail(i * 10 + j, i, stamp(then), sku=5 + j % 2)))
        if i % 2:
            then = at + rng.choice([0, 5, 600, 1800, 1801])
            paid.append((then, pay(i, i, stamp(then))))
    return [[r for _, r in sorted(rs, key=lambda p: p[0])] for rs in (placed, lines, paid)]


def shop_tables(spark, found):
    shapes = (schemas.ORDER_INFO, schemas.ORDER_DETAIL, schemas.PAYMENT_INFO)
    return [
        spark.createDataFrame([{**dict.fromkeys(s.names), **r} for r in rs], s)
        for rs, s in zip(found, shapes)
    ]


def dimensions(spark):
    def texts(names, *values):
        return spark.createDataFrame(list(values), ", ".join(f"{n} STRING" for n in names.split()))

    return {
        "user": texts("id birthday gender", ("1", "2000-01-01", "F"), ("2", None, "M")),
        "province": texts("id name area_code iso_code iso_3166_2", ("1", "Here", "1", "H", "H-1")),
        "sku": texts("id sku_name spu_id tm_id category3_id price", ("5", "ring", "7", "2", "61", "1.50")),
        "spu": texts("id spu_name", ("7", "rings")),
        "category": texts("id name", ("61", "jewels")),
        "trademark": texts("id tm_name", ("2", "Acme")),
    }


def test_orders_payments_and_their_statistics_equal_batch(spark, topics, tmp_path):
    found = shop(random.Random(5), 60)
    placed, lines, paid = shop_tables(spark, found)
    late = "2030-01-01 00:00:00"
    ends = order(10**6, late), detail(10**6, 10**6 + 1, late), pay(10**6, 10**6, late)

    def stream(name, records, end, schema):
        folder = topics(name, *sliced(records, 3), [end])
        return read_topic_table(spark, name, schema, folder=folder, files_per_batch=1)

    shapes = (schemas.ORDER_INFO, schemas.ORDER_DETAIL, schemas.PAYMENT_INFO)
    streams = [
        stream(n, rs, e, s) for n, rs, e, s in zip(("orders", "details", "payments"), found, ends, shapes)
    ]

    # Orders with their lines, looked up batch by batch, to a topic.
    out = f"{tmp_path}/dwm_order_wide"
    wide_stream = jobs.order_wide(streams[0], streams[1], delay="10 minutes")
    writer = jobs.write_order_wide(lambda: dimensions(spark), out)
    run(jobs.start_batches(wide_stream, writer, f"{tmp_path}/cp-wide"))
    batch_wide = orders.order_wide(placed, lines)
    written = logs.parse_text(
        spark.read.text(out).select("value"), schemas.ORDER_WIDE_FULL
    )
    assert rows(written.select("detail_id", "order_id", "split_total_amount")) == rows(
        batch_wide.select("detail_id", "order_id", "split_total_amount")
    )
    assert {(r.sku_id, r.sku_name, r.tm_name) for r in written.collect()} == {
        (5, "ring", "Acme"), (6, "old", None),
    }

    # Payments join that topic.
    texts = [r.value for r in spark.read.text(out).collect()]
    folder = topics("wide", texts)
    wide_topic = read_topic_table(spark, "wide", schemas.ORDER_WIDE_FULL, folder=folder)
    joined = jobs.payment_wide(streams[2], wide_topic, delay="1 hour")
    paid_rows = table_of(joined.select("payment_id", "detail_id", "sku_id", "split_total_amount",
                                       "order_id", "order_create_time"), f"{tmp_path}/pw")
    batch_paid = orders.payment_wide(paid, batch_wide)
    assert rows(paid_rows) == rows(batch_paid.select(paid_rows.columns))
    assert batch_paid.count() > 20

    # Product and province statistics of the topic, exact distinct counts.
    end = json.dumps({"sku_id": 1, "order_id": 1, "create_time": late, "split_total_amount": 1, "sku_num": 1})
    texts.sort(key=lambda t: json.loads(t)["create_time"])
    folder = topics("stats", *sliced(texts, 3), [end], [end])
    wide_topic = read_topic_table(spark, "stats", schemas.ORDER_WIDE_FULL, folder=folder, files_per_batch=1)
    measures = stats.product_orders(wide_topic)
    table = f"{tmp_path}/product_stats"
    run(jobs.start_batches(
        jobs.product_stats(measures),
        jobs.write_product_stats(lambda: dimensions(spark), table), f"{tmp_path}/cp-product",
    ))
    stored = spark.read.parquet(table).where("stt < '2029'")
    batch_rows = stats.product_stats(stats.product_union(stats.product_orders(batch_wide)))
    expected = products.with_product_dimension(
        batch_rows, orders.product_dimension(*[dimensions(spark)[d] for d in ("sku", "spu", "category", "trademark")])
    )
    assert rows(stored.select(expected.columns)) == rows(expected)
    assert {str(r.day) for r in stored.select("day").distinct().collect()} == {"20240301"}

    run(jobs.start_batches(
        jobs.province_stats(wide_topic), jobs.write_results(f"{tmp_path}/province"), f"{tmp_path}/cp-province"
    ))
    stored = spark.read.parquet(f"{tmp_path}/province").where("stt < '2029'")
    expected = stats.province_stats(orders.with_province(batch_wide, dimensions(spark)["province"]))
    assert rows(stored.select(expected.columns)) == rows(expected)


def test_product_stats_of_all_seven_sources_equal_batch(spark, topics, tmp_path):
    rng = random.Random(9)
    placed, lines, paid = shop_tables(spark, shop(rng, 20))
    wide = orders.order_wide(placed, lines)
    wide_paid = orders.payment_wide(paid, wide)
    base = 1709287200000  # 2024-03-01 10:00:00
    pages = [{**r, "ts": r["ts"] + base} for r in random_log(8, 60, 1_500_000)]
    for r in pages[::3]:
        r["displays"] = [{"item": "6", "item_type": "sku_id"}]

    def acts(n, **more):
        return [
            {"sku_id": rng.choice([5, 6]), "create_time": f"2024-03-01 10:{rng.randrange(20):02d}:07", **more}
            for _ in range(n)
        ]

    actions = {
        "cart": acts(15), "favor": acts(15),
        "refund": acts(10, order_id=3, refund_amount="2.50") + acts(5, order_id=4),
        "comment": acts(9, appraise="1201") + acts(4, appraise="1204"),
    }
    late = "2030-01-01 00:00:00"
    shapes = {
        "page": (schemas.PAGE, pages, page("end", base + LATER, "good_detail", item="1")),
        "wide": (schemas.ORDER_WIDE, [r.value for r in as_messages(wide, "").collect()],
                 {"sku_id": 1, "create_time": late}),
        "paid": (wide_paid.schema, [r.value for r in as_messages(wide_paid, "").collect()],
                 {"sku_id": 1, "order_create_time": late}),
        **{n: (schemas.PRODUCT_ACTION, a, {"sku_id": 1, "create_time": late}) for n, a in actions.items()},
    }
    streams = [
        read_topic_table(spark, n, schema, folder=topics(n, found, [end]), files_per_batch=1)
        for n, (schema, found, end) in shapes.items()
    ]
    found = table_of(jobs.product_stats(*products.product_frames(*streams)), tmp_path)
    tables = [
        spark.createDataFrame(
            [{**dict.fromkeys(schemas.PRODUCT_ACTION.names), **r,
              "refund_amount": Decimal(r["refund_amount"]) if "refund_amount" in r else None} for r in a],
            schemas.PRODUCT_ACTION,
        )
        for a in actions.values()
    ]
    expected = stats.product_stats(
        products.product_measures(frame(spark, pages), wide, wide_paid, *tables)
    )
    assert rows(found.where("sku_id <> 1")) == rows(expected)
    assert expected.where("refund_order_ct > 0").count() and expected.where("paid_order_ct > 0").count()


def test_late_payments_and_bounces_are_counted(spark, topics, tmp_path):
    """Payments half an hour after their order, bounces two batches behind the pages."""
    base = 1709287200000  # 2024-03-01 10:00:00
    text = lambda ms: datetime.fromtimestamp(ms / 1000, UTC).strftime("%Y-%m-%d %H:%M:%S")
    steps = range(0, 8)
    clicks = [[page("a", base + k * 600_000, "good_detail", item="5")] for k in steps]
    paid = [
        [{"sku_id": 5, "order_id": k, "split_total_amount": "2.00",
          "order_create_time": text(base + k * 600_000 - 1_740_000)}]
        for k in steps
    ]
    late = base + LATER
    ends = [page("end", late, "good_detail", item="1")], [
        {"sku_id": 1, "order_id": 0, "split_total_amount": "1.00", "order_create_time": text(late)}
    ]
    shape = schemas.record(
        sku_id=schemas.LONG, order_id=schemas.LONG, split_total_amount=schemas.MONEY,
        order_create_time=schemas.TEXT,
    )
    pages = read_topic_table(
        spark, "pages", schemas.PAGE, folder=topics("pages", *clicks, ends[0]), files_per_batch=1
    )
    payments = read_topic_table(
        spark, "paid", shape, folder=topics("paid", *paid, ends[1]), files_per_batch=1
    )
    frames = stats.product_clicks(pages), stats.product_payments(payments)
    found = table_of(jobs.product_stats(*frames), tmp_path / "product").where("sku_id <> 1")
    got = found.selectExpr("sum(paid_order_ct)", "sum(payment_amount)", "sum(click_ct)").first()
    assert tuple(got) == (8, Decimal("16.00"), 8)

    views = [[page("a", base + k * 10_000)] for k in steps]
    behind = [[page("x", base)], [page("y", base)]] + views[:-2] + [views[-2] + views[-1]]
    streams = [
        read_topic_table(spark, n, schemas.PAGE, folder=topics(n, *parts, [page("end", late)]), files_per_batch=1)
        for n, parts in (("views", views), ("visits", views), ("bounces", behind))
    ]
    found = table_of(jobs.visitor_stats(*streams), tmp_path / "visitor").where(f"ts < {late}")
    assert found.selectExpr("sum(pv_ct)", "sum(uj_ct)").first() == (8, 10)


def test_keywords_equal_batch(spark, topics, tmp_path):
    records = [page("a", i * 700, "good_list", item=f"red ring {i % 5}") for i in range(100)]
    folder = topics("pages", *sliced(records, 3), [page("end", LATER, "good_list", item="end")])
    pages = read_topic_table(spark, "pages", schemas.PAGE, folder=folder, files_per_batch=1)
    found = table_of(jobs.keyword_stats(pages), tmp_path).where("keyword <> 'end'")
    words = keywords.keyword_tokens(keywords.searches(frame(spark, records)))
    assert rows(found) == rows(stats.keyword_stats(words))


def change(table, kind, **data):
    return {"database": "shop", "table": table, "type": kind, "data": data}


def rule(ts, op, before=None, **after):
    return {"op": op, "ts_ms": ts, "before": before, "after": after or None,
            "source": {"db": "shop", "table": "table_process"}}


def test_changes_are_routed_by_the_rules_of_the_moment(spark, topics, tmp_path):
    user = {"source_table": "user", "sink_type": "hbase", "sink_table": "dim_user"}
    rules = topics("rules", [
        rule(1, "r", operate_type="insert", sink_columns="id,name,city", **user),
        rule(1, "r", operate_type="update", sink_columns="id", **user),
        rule(2, "u", operate_type="update", sink_columns="id,name", **user),
        rule(1, "r", source_table="cart", operate_type="insert", sink_type="kafka", sink_table="dwd_cart"),
    ])
    read_rules = lambda: read_routing(spark, rules)
    dims, facts, checkpoint, rejects = (f"{tmp_path}/{n}" for n in ("dims", "facts", "cp", "bad"))

    def job(folder):
        lines = read_topic(spark, "db", folder=folder, files_per_batch=1, positions=True)
        write = jobs.base_db(read_rules, dims, facts, compact_every=2, reject_folder=rejects)
        run(jobs.start_batches(lines, write, checkpoint))

    job(topics(
        "db",
        [change("user", "bootstrap-insert", id=1, name="a", city="x"), change("order", "insert", id=7)],
        [change("user", "insert", id=2, name="b", city="y"), change("user", "update", id=1, name="c", city="!")],
    ))
    topics("rules", [
        rule(3, "c", source_table="order", operate_type="insert", sink_type="kafka", sink_table="dwd_order"),
        rule(3, "c", operate_type="delete", sink_columns="id", **user),
        rule(3, "d", {"source_table": "cart", "operate_type": "insert"}),
    ])
    job(topics("db", [
        change("cart", "insert", id=5),
        change("order", "insert", id=8, total=3),
        {**change("user", "delete"), "before": {"id": 2, "name": "b"}},
        "not json",
    ]))
    assert [r.value for r in spark.read.text(rejects).collect()] == ["not json"]

    (dim,) = jobs.dimensions_of(read_rules(), dims)
    assert dim.columns == ("id", "name", "city")
    assert rows(dim.current(spark)) == [("x", "1", "c")]
    # The first order came before its rule.
    messages = [(r.topic, json.loads(r.value)) for r in spark.read.text(facts).collect()]
    assert messages == [("dwd_order", {"id": "8", "total": "3"})]
    topic = read_topic(spark, "dwd_order", folder=f"{facts}/batch=*")
    assert [r.value for r in table_of(topic, f"{tmp_path}/t").collect()] == ['{"id":"8","total":"3"}']


def changes_in(spark, tmp_path, folder, rules, files=10):
    lines = read_topic(spark, "db", folder=folder, files_per_batch=files, positions=True)
    config = spark.createDataFrame(rules, schemas.ROUTING)
    write = jobs.base_db(lambda: config, f"{tmp_path}/dims")
    run(jobs.start_batches(lines, write, f"{tmp_path}/cp"))
    return jobs.dimensions_of(config, f"{tmp_path}/dims")


USER_RULES = [("user", op, "hbase", "dim_user", "id,name", "id", None) for op in ("insert", "update")]


def test_the_newer_file_wins_whatever_its_size(spark, topics, tmp_path):
    old = [change("user", "insert", id=1, name="old")]
    new = [change("user", "update", id=1, name="new")]
    new += [change("cart", "insert", id=n, name="x" * 50) for n in range(200)]
    (dim,) = changes_in(spark, tmp_path, topics("db", old, new), USER_RULES)
    assert rows(dim.current(spark)) == [("1", "new")]


def test_the_later_change_wins_over_the_later_arrival(spark, topics, tmp_path):
    one = [{**change("user", "update", id=1, name="later"), "ts": 2_000_000_000_000}]
    two = [{**change("user", "insert", id=1, name="earlier"), "ts": 1_900_000_000_000}]
    (dim,) = changes_in(spark, tmp_path, topics("db", one, two), USER_RULES)
    assert rows(dim.current(spark)) == [("1", "later")]


def test_a_rule_without_columns_is_refused(spark, tmp_path):
    rules = [("user", "insert", "hbase", "dim_user", "", "id", None)]
    with pytest.raises(ValueError, match="dim_user"):
        jobs.dimensions_of(spark.createDataFrame(rules, schemas.ROUTING), "x")


def test_kafka_options():
    assert kafka_options("h:1", "t", "g", "latest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "kafka.group.id": "g",
        "startingOffsets": "latest",
    }
    with pytest.raises(ValueError):
        read_topic(None, "t")


def test_open_orders_are_kept_between_batches(spark, tmp_path):
    """Lines up to a bound before and after their order, which batches cut apart; one is repeated."""
    stamp = lambda s: f"2024-03-01 10:{s // 60:02d}:{s % 60:02d}"
    placed = [order(k, stamp(60 * k)) for k in range(1, 13)]
    lines = [
        detail(k * 10 + j, k, stamp(60 * k + apart))
        for k in range(1, 13)
        for j, apart in enumerate((-6, -5, -3, 0, 3, 5, 6))
    ]
    shapes = zip((schemas.ORDER_INFO, schemas.ORDER_DETAIL), (placed, lines))
    frames = [spark.createDataFrame([{**dict.fromkeys(s.names), **r} for r in rs], s) for s, rs in shapes]
    steps = [stamp(s) for s in (0, 180, 361, 540, 900)]
    cuts = [
        [f.where((f.create_time >= since) & (f.create_time < until)) for f in frames]
        for since, until in zip(steps, steps[1:])
    ]
    run_batch = kept.order_wide(f"{tmp_path}/kept", write_batches(f"{tmp_path}/out"))
    for n, cut in enumerate(cuts):
        for _ in range(2 if n == 2 else 1):
            run_batch(kept.orders_and_details(*cut), n)
        open_orders = spark.read.parquet(f"{tmp_path}/kept/batch={n}/order")
        assert open_orders.count() <= 1
    found = read_batches(spark, f"{tmp_path}/out", schemas.ORDER_WIDE)
    assert rows(found) == rows(orders.order_wide(*frames))
    assert found.count() == 12 * 5
    assert sum(orders.order_wide(*cut).count() for cut in cuts) < 12 * 5
    assert not os.path.exists(f"{tmp_path}/kept/batch=0")


def test_windows_are_kept_until_all_sources_have_passed(spark, tmp_path):
    """Two sources, one two batches behind; a late row of a closed window; a batch repeated."""
    base = 1709287200000  # 2024-03-01 10:00:00

    def batch(carts, refunds):
        shapes = "sku_id BIGINT, ts BIGINT, ", "tag STRING, order_id BIGINT, refund_amount DECIMAL(16,2)"
        found = {
            "carts": spark.createDataFrame([(5, base + s * 1000, 1) for s in carts], shapes[0] + "cart_ct BIGINT"),
            "refunds": spark.createDataFrame(
                [(5, base + s * 1000, "refund", o, Decimal("2.50")) for s, o in refunds], shapes[0] + shapes[1]
            ),
        }
        return kept.by_source(found)

    steps = [
        batch([1, 12, 24], []),
        batch([31, 42], [(1, 7), (2, 7), (3, 8)]),
        batch([55, 58], [(9, 8), (24, 9), (31, 9)]),
        batch([2], [(60, 9)]),  # a cart of the first window, long closed
        batch([], [(90, 9)]),
    ]
    delays = {"carts": timedelta(seconds=0), "refunds": timedelta(seconds=3)}
    run_batch = kept.product_stats(f"{tmp_path}/kept", write_batches(f"{tmp_path}/out"), delays)
    closed = []
    for n, step in enumerate(steps):
        for _ in range(2 if n == 2 else 1):
            run_batch(step, n)
        sent = spark.read.parquet(f"{tmp_path}/out/batch={n}")
        closed.append(sorted(r.stt[-5:] for r in sent.collect()))
    assert closed == [[], [], ["00:00", "00:10"], ["00:20", "00:30", "00:40"], []]
    whole = steps[0].unionByName(steps[1]).unionByName(steps[2])
    found = read_batches(spark, f"{tmp_path}/out", sent.schema)
    expected = stats.product_stats(whole).where("stt < '2024-03-01 10:00:50'")
    assert rows(found) == rows(expected) and found.agg({"refund_order_ct": "sum"}).first()[0] == 4


@pytest.mark.parametrize("name", ["order_wide", "product_stats"])
def test_registered_streams_without_state_stores(spark, monkeypatch, name):
    """A state store is asked several times for each row; these queries have none."""
    seen = []

    def watched(stream, write, checkpoint, trigger=None, start=jobs.start_batches):
        query = start(stream, write, checkpoint, trigger)
        query.awaitTermination()
        seen.extend(p["stateOperators"] for p in query.recentProgress)
        return query

    monkeypatch.setattr(jobs, "start_batches", watched)
    sf = "/root/testdata/sf0.001"
    found = QUERIES[f"stream_{name}"](spark, sf)
    assert rows(found) == rows(QUERIES[name](spark, sf))
    assert seen and not any(seen)
