"""Change events: normalizing, routing, folding, the dimension store."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.times import text_to_millis
from martflow.operators import changes
from martflow.operators.logs import parse_text
from martflow.sinks.dimensions import Dimension, dimension_columns, dimension_schema
from martflow.sources.changes import read_changes, read_envelopes, snapshot_as_changes

CHANGES = "seq BIGINT, `database` STRING, `table` STRING, type STRING, data MAP<STRING,STRING>"


def events(spark, rows):
    return spark.createDataFrame([(i, "shop", *r) for i, r in enumerate(rows)], CHANGES)


def rules(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (7 - len(r))) for r in rows], schemas.ROUTING)


def envelope(op, before=None, after=None):
    return json.dumps(
        {"op": op, "before": before, "after": after, "source": {"db": "shop", "table": "t"}}
    )


def test_envelopes(spark):
    texts = [
        envelope("c", after={"id": 1, "name": "x"}),
        envelope("r", after={"id": 2}),
        envelope("u", {"id": 1}, {"id": 1, "name": None}),
        envelope("d", {"id": 1}),
        envelope("CREATE", after={"id": 3}),
        envelope("TRUNCATE"),
        "nonsense",
    ]
    df = read_envelopes(spark.createDataFrame([(t,) for t in texts], "value STRING"))
    rows = [(r["database"], r["table"], r["type"], r["data"]) for r in df.collect()]
    assert rows == [
        ("shop", "t", "insert", {"id": "1", "name": "x"}),
        ("shop", "t", "read", {"id": "2"}),
        ("shop", "t", "update", {"id": "1", "name": None}),
        ("shop", "t", "delete", {}),
        ("shop", "t", "insert", {"id": "3"}),
        ("shop", "t", "truncate", {}),
    ]


def test_validity(spark):
    df = events(spark, [
        ("t", "insert", {"id": "1"}), ("", "insert", {"id": "1"}), (None, "insert", {"id": "1"}),
        ("t", "insert", None), ("t", "delete", {}), ("t", "insert", {"id": None}),
    ])
    assert [r.seq for r in changes.valid_changes(df).collect()] == [0]


def test_routing(spark):
    config = rules(spark, [
        ("t", "insert", "hbase", "dim_t", "id,name"),
        ("o", "insert", "kafka", "dwd_o", ""),
        ("o", "update", "kafka", "dwd_ou", None),
        ("c", "insert", "clickhouse", "ck", "id"),
    ])
    df = events(spark, [
        ("t", "bootstrap-insert", {"id": "1", "name": "x", "url": "u"}),
        ("o", "insert", {"id": "2", "a": "b"}),
        ("o", "update", {"id": "3", "a": None}),
        ("o", "delete", {"id": "4"}),
        ("c", "insert", {"id": "5"}),
        ("unknown", "insert", {"id": "6"}),
    ])
    routed = changes.route_changes(df, config)
    got = {r.seq: (r.type, r.sink_type, r.sink_table, r.sink_pk, r["data"]) for r in routed.collect()}
    assert got == {
        0: ("insert", "hbase", "dim_t", "id", {"id": "1", "name": "x"}),
        1: ("insert", "kafka", "dwd_o", "id", {"id": "2", "a": "b"}),
        2: ("update", "kafka", "dwd_ou", "id", {"id": "3", "a": None}),
    }
    assert changes.dimension_changes(routed).count() == 1
    messages = {r.topic: json.loads(r.value) for r in changes.fact_messages(routed).collect()}
    assert messages == {"dwd_o": {"id": "2", "a": "b"}, "dwd_ou": {"id": "3"}}


def test_columns_are_not_trimmed(spark):
    df = events(spark, [("t", "insert", {"id": "1", "name": "x"})])
    config = rules(spark, [("t", "insert", "kafka", "k", "id, name")])
    assert changes.route_changes(df, config).first()["data"] == {"id": "1"}


def test_rules_are_replaced_and_deleted(spark):
    def rule(table, sink):
        return {"source_table": table, "operate_type": "insert", "sink_type": "kafka", "sink_table": sink}

    rows = [
        (1, "read", None, rule("a", "one")),
        (2, "update", rule("a", "one"), rule("a", "two")),
        (3, "insert", None, rule("b", "three")),
        (4, "delete", rule("b", "three"), {}),
        (5, "delete", None, {}),
    ]
    df = spark.createDataFrame(
        rows, "seq INT, type STRING, before MAP<STRING,STRING>, data MAP<STRING,STRING>"
    )
    rows = changes.latest_config(df, ["seq"]).collect()
    assert [(r.source_table, r.sink_table) for r in rows] == [("a", "two")]


def test_snapshot_and_changes(spark):
    snapshot = snapshot_as_changes(spark.createDataFrame([(1, "x"), (2, "y")], "id INT, n STRING"), "shop", "t")
    assert snapshot.first()["data"] == {"id": "1", "n": "x"}
    later = events(spark, [("t", "update", {"id": "1", "n": "z"}), ("t", "delete", {"id": "2"})]).drop("seq")
    both = changes.change_table(snapshot.selectExpr("*", "-1L AS seq"), later.selectExpr("*", "1L AS seq"))
    keyed = both.selectExpr("*", "data['id'] AS id")
    rows = changes.latest_rows(keyed, ["table", "id"], ["seq"]).collect()
    assert [(r.id, r["data"]["n"], r.type) for r in rows] == [("1", "z", "update")]


UPSERTS = [
    ("t", "insert", {"id": "1", "name": "a", "city": "x"}),
    ("t", "update", {"id": "1", "name": None}),
    ("t", "insert", {"id": "2", "name": "b"}),
    ("t", "delete", {"id": "2"}),
    ("t", "insert", {"id": "3", "name": "c", "city": "y"}),
    ("t", "delete", {"id": "3"}),
    ("t", "update", {"id": "3", "city": "z"}),
    ("t", "insert", {"name": "no key"}),
]
FOLDED = [("1", "", "x"), ("3", None, "z")]


def test_fold(spark):
    folded = changes.fold_dimension(events(spark, UPSERTS), ["id", "name", "city"])
    assert sorted(map(tuple, folded.collect())) == FOLDED
    shuffled = changes.fold_dimension(events(spark, UPSERTS).repartition(4, "type"), ["id", "name", "city"])
    assert sorted(map(tuple, shuffled.collect())) == FOLDED


def test_dimension_store(spark, tmp_path):
    dim = Dimension(f"{tmp_path}/dim_t", ("id", "name", "city"))
    assert dim.current(spark).collect() == []
    place = "named_struct('file', '', 'nr', CAST(seq AS BIGINT)) AS position"
    df = events(spark, UPSERTS).drop("database", "table").selectExpr("*", "0L AS at", place)
    for batch in range(4):
        dim.write(df.where(f"seq div 2 = {batch}"), batch)
        dim.write(df.where(f"seq div 2 = {batch}"), batch)  # a repeated batch
        if batch == 2:
            assert sorted(map(tuple, dim.current(spark).collect())) == [("1", "", "x")]
            dim.compact(spark, batch)
            assert sorted(map(tuple, dim.current(spark).collect())) == [("1", "", "x")]
    assert sorted(map(tuple, dim.current(spark).collect())) == FOLDED
    # A base that was written but not listed does not count.
    dim._state(spark).limit(0).write.parquet(f"{tmp_path}/dim_t/base/upto=3")
    assert sorted(map(tuple, dim.current(spark).collect())) == FOLDED


def test_dimension_schema():
    assert dimension_columns("id,name", None) == ["id", "name"]
    assert dimension_columns("name", "code") == ["code", "name"]
    schema = dimension_schema("id,name")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("id", "string", False), ("name", "string", True),
    ]


def test_read_changes_keeps_other_columns(spark):
    text = '{"database":"d","table":"t","type":"insert","data":{"id":1,"x":null}}'
    df = read_changes(spark.createDataFrame([(5, text)], "seq BIGINT, value STRING"))
    assert df.first().asDict() == {
        "seq": 5, "database": "d", "table": "t", "type": "insert", "data": {"id": "1", "x": None},
        "before": None, "ts": None,
    }


def test_deletes_are_kept_and_found_by_the_row_before(spark):
    lines = spark.createDataFrame(
        [
            ('{"op":"c","after":{"id":1,"name":"a"},"source":{"db":"d","table":"t"},"ts_ms":1}',),
            ('{"op":"d","before":{"id":1,"name":"a"},"source":{"db":"d","table":"t"},"ts_ms":2}',),
            ('{"op":"r","after":{"id":2,"name":"b"},"source":{"db":"d","table":"t"},"ts_ms":0}',),
        ],
        "value STRING",
    )
    events = changes.valid_changes(read_envelopes(lines))
    assert sorted(r.type for r in events.collect()) == ["delete", "insert", "read"]
    latest = changes.latest_rows(events, ["table", "id"], ["ts_ms"]).collect()
    assert [(r.id, r.type) for r in latest] == [("2", "read")]
    config = spark.createDataFrame(
        [("t", op, "hbase", "dim_t", "id,name", None, None) for op in ("insert", "delete")], schemas.ROUTING
    )
    routed = changes.route_changes(events, config)
    folded = changes.fold_dimension(routed, ["id", "name"], order=["ts_ms"])
    assert list(map(tuple, folded.collect())) == [("2", "b")]


@pytest.mark.parametrize(
    "text, millis",
    [("1970-01-01 12:00:00", 43_200_000), ("12:00:00", None), ("1970-01-01", None), ("x", None),
     ("1970-01-01T12:00:00", None), ("1970-99-01 12:00:00", None)],
)
def test_only_date_time_texts_are_times(spark, text, millis):
    assert spark.range(1).select(text_to_millis(F.lit(text)).alias("t")).first().t == millis


def test_numbers_may_be_text(spark):
    texts = [
        '{"id": 8, "total_amount": 3.5, "create_time": "2024-03-01 10:00:00"}',
        '{"id": "8", "total_amount": "3.50", "create_time": "2024-03-01 10:00:00"}',
        '{"id": "eight", "total_amount": 3.5, "create_time": "2024-03-01 10:00:00"}',
    ]
    lines = spark.createDataFrame([(t,) for t in texts], "value STRING")
    rows = parse_text(lines, schemas.ORDER_INFO).select("id", "total_amount", "create_time").collect()
    assert rows[0] == rows[1] == (8, Decimal("3.50"), "2024-03-01 10:00:00")
    assert rows[2] == (None, Decimal("3.50"), "2024-03-01 10:00:00")
