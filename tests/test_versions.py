"""Rules by their versions, tables handed over from rows to log, first entries by time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators import changes, logs, visits
from martflow.sources.changes import read_rule_versions
from martflow.sources.topics import read_topic, read_topic_table
from martflow.streaming import jobs
from martflow.streaming.snapshots import Handover
from test_logs import frame
from test_streams import DAY, LATER, change, page, random_log, rows, rule, run, table_of, topics  # noqa: F401

RULE = "seq long, type string, before map<string,string>, data map<string,string>"


def stated(table, operation, sink, columns=""):
    return {"source_table": table, "operate_type": operation, "sink_type": "kafka",
            "sink_table": sink, "sink_columns": columns}


def test_versions_of_rules(spark):
    one, two, moved = stated("a", "insert", "one"), stated("a", "insert", "two"), stated("a", "update", "two")
    history = spark.createDataFrame([
        (1, "insert", None, one), (5, "update", one, two), (9, "update", two, moved),
        (3, "read", None, stated("b", "insert", "b")), (7, "delete", stated("b", "insert", "b"), {}),
        (8, "insert", None, stated("b", "insert", "b2")), (4, "delete", None, {}),
    ], RULE)
    found = changes.rule_versions(history, "seq").select("source_table", "operate_type", "sink_table", "since", "until")
    assert rows(found) == sorted([
        ("insert", 1, "one", "a", 5), ("insert", 5, "two", "a", 9), ("update", 9, "two", "a", None),
        ("insert", 3, "b", "b", 7), ("insert", 8, "b2", "b", None),
    ], key=str)

    shape = "at long, `table` string, type string, data map<string,string>"
    places = [("a", "insert"), ("a", "update"), ("b", "bootstrap-insert"), ("c", "insert")]
    frame_of = spark.createDataFrame(
        [(at, t, kind, {"id": str(at)}) for at in range(11) for t, kind in places] + [(None, "a", "insert", {})], shape
    )
    routed = changes.route_changes_as_of(frame_of, changes.rule_versions(history, "seq"))
    expected = {("a", "insert", at): "one" if at < 5 else "two" for at in range(1, 9)}
    expected |= {("a", "update", at): "two" for at in (9, 10)}
    expected |= {("b", "insert", at): "b" if at < 7 else "b2" for at in (3, 4, 5, 6, 8, 9, 10)}
    assert {(r.table, r.type, r.at): r.sink_table for r in routed.collect()} == expected
    missed = changes.without_rule(frame_of, changes.rule_versions(history, "seq"))
    kinds = {"bootstrap-insert": "insert"}
    assert {(r.table, kinds.get(r.type, r.type), r.at) for r in missed.collect()} == {
        (t, kinds.get(kind, kind), at) for at in [*range(11)] for t, kind in places if t != "c"
    } - set(expected) | {("a", "insert", None)}


def test_a_rule_that_changes_inside_a_batch_routes_both_halves(spark, topics, tmp_path):  # noqa: F811
    order = {"source_table": "order", "operate_type": "insert", "sink_type": "kafka"}
    folder = topics("rules", [
        rule(100, "c", sink_table="first", **order),
        rule(200, "u", {**order, "sink_table": "first"}, sink_table="second", sink_columns="id", **order),
    ])
    lines = [{**change("order", "insert", id=n, total=n), "ts": ts} for n, ts in enumerate((50, 100, 150, 199, 200, 300))]
    random.Random(1).shuffle(lines)
    facts, rejects = f"{tmp_path}/facts", f"{tmp_path}/bad"
    write = jobs.base_db(lambda: read_rule_versions(spark, folder), f"{tmp_path}/dims", facts, reject_folder=rejects)
    batch = read_topic(spark, "db", folder=topics("db", lines), files_per_batch=1, positions=True)
    run(jobs.start_batches(batch, write, f"{tmp_path}/cp"))
    got = {(r.topic, json.loads(r.value)["id"], "total" in r.value) for r in spark.read.text(facts).collect()}
    assert got == {("first", str(n), True) for n in (1, 2, 3)} | {("second", str(n), False) for n in (4, 5)}
    assert [json.loads(r.value)["data"]["id"] for r in spark.read.text(rejects).collect()] == [0]


class Database:
    """A table that changes and keeps its log."""

    def __init__(self, seed, keys):
        self.rng, self.rows, self.log = random.Random(seed), {}, []
        for n in range(keys):
            self.rows[str(n)] = f"start{n}"

    def step(self):
        key, at = str(self.rng.randrange(14)), len(self.log) + 1
        if key in self.rows and self.rng.random() < 0.3:
            del self.rows[key]
            self.log.append((at, "delete", {"id": key}, {}))
        else:
            kind = "update" if key in self.rows else "insert"
            self.rows[key] = f"v{at}"
            self.log.append((at, kind, None, {"id": key, "name": f"v{at}"}))


LOG = "log_position long, type string, before map<string,string>, data map<string,string>"


@pytest.mark.parametrize("seed", [1, 2])
def test_chunks_and_log_in_any_order_give_the_table(spark, tmp_path, seed):
    """Changes come while chunks are read; the log is taken before, between or after; one run dies."""
    base = Database(seed, 10)
    rng = random.Random(seed)
    handover = Handover(f"{tmp_path}/t", ("id", "name"), buckets=2)
    taken, batches = [0], [0]

    def follow():
        changes_now = base.log[taken[0] :]
        if changes_now:
            handover.write_log(spark.createDataFrame(changes_now, LOG).coalesce(1), batches[0])
            taken[0], batches[0] = len(base.log), batches[0] + 1

    dies = [True]

    def read(chunk):
        found = []
        for key in [str(n) for n in range(14) if n % 3 == chunk]:  # rows are read one by one
            base.step()
            if key in base.rows:
                found.append(("read", None, {"id": key, "name": base.rows[key]}))
        if rng.random() < 0.5:
            follow()
        if chunk == 1 and dies.pop():
            dies.append(False)
            raise RuntimeError("killed")
        base.step()
        return spark.createDataFrame(found, LOG.split(", ", 1)[1]).coalesce(1)

    position = lambda: len(base.log)
    with pytest.raises(RuntimeError):
        handover.read_chunks(spark, 3, position, read)
    dies.append(False)
    assert handover.read_chunks(spark, 3, position, read) == 2
    assert handover.read_chunks(spark, 3, position, read) == 0
    for _ in range(5):
        base.step()
    follow()
    assert 0 < handover.consistent_at(spark) <= taken[0]
    assert rows(handover.table.current(spark)) == sorted((k, v) for k, v in base.rows.items())


def test_first_entries_by_time_are_those_of_the_batch(spark, topics, tmp_path):  # noqa: F811
    """Files hold a day's records in any order; whole rows come, once the day is over."""
    records = [r for r in random_log(7, 150, 4 * DAY, 60_000)]
    days = [[r for r in records if r["ts"] // DAY == d] for d in range(4)]
    for day in days:
        random.Random(3).shuffle(day)
    halves = [half for day in days for half in (day[: len(day) // 2], day[len(day) // 2 :])]
    folder = topics("pages", *halves, [page("end", LATER)])
    pages = read_topic_table(spark, "pages", schemas.PAGE, folder=folder, files_per_batch=1)
    found = table_of(jobs.first_entries(pages, "1 day"), tmp_path)
    expected = visits.unique_visit(logs.split_page(frame(spark, records)).select(schemas.PAGE.names))
    flat = ["common.mid", "ts", "page.page_id", "page.during_time", "common.vc"]
    assert rows(found.selectExpr(*flat)) == rows(expected.selectExpr(*flat))
    assert expected.count() >= 15
    assert "start" in found.columns and found.where(F.col("ts") >= LATER).count() == 0
