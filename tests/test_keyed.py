"""Tables looked up by key: what is found, and what is read for it."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.operators import orders, visits
from martflow.schemas import TEXT, record
from martflow.sinks import keyed
from martflow.sinks.dimensions import Dimension
from martflow.sinks.keyed import KeyedTable
from martflow.streaming import jobs, repair
from test_logs import frame, page
from test_streams import dimensions, shop, shop_tables

DAY = 86_400_000
SHAPE = record(id=TEXT, name=TEXT)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def bytes_read(spark, run):
    """What Spark's file system has read while ``run`` ran."""
    storage = spark._jvm.org.apache.hadoop.fs.FileSystem

    def total():
        return sum(s.getBytesRead() for s in storage.getAllStatistics())

    before = total()
    result = run()
    return total() - before, result


def keys_of(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


@pytest.mark.parametrize("few", [3, 200])
def test_lookups_find_what_a_join_finds(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(keyed, "FEW_KEYS", few)
    store = KeyedTable(f"{tmp_path}/t", SHAPE, "id", 8)
    whole = [(str(n), f"n{n}") for n in range(500)] + [("é/=%", "odd"), ("", "empty")]
    frames = [spark.createDataFrame(whole[k::3], SHAPE) for k in range(3)]
    for n, rows in enumerate(frames):
        assert store.put(rows, n)
        assert not store.put(rows, n)
    for keys in ([], [None], ["1"], ["x"], ["é/=%", "", "7", "7", None], [str(n) for n in range(400, 600)]):
        wanted = keys_of(spark, keys)
        found = store.lookup(wanted, "k").join(wanted.distinct(), F.col("id") == F.col("k"), "left_semi")
        assert rows_of(found) == sorted(r for r in whole if r[0] in keys)
    assert store.merge(spark, whole=True) == 8
    assert rows_of(store.read(spark)) == sorted(whole)
    assert rows_of(store.lookup(keys_of(spark, ["9"]), "k"))[0] in whole


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a")], SHAPE)
    KeyedTable(f"{tmp_path}/t", SHAPE, "id", 8).put(rows, 0)
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(f"{tmp_path}/t", SHAPE, "id", 9).put(rows, 1)


def test_ten_keys_of_a_million_read_under_one_percent(spark, tmp_path):
    store = KeyedTable(f"{tmp_path}/t", record(id=TEXT, name=TEXT, city=TEXT), "id", 64)
    name = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(1_000_000).select(
        F.col("id").cast("string"), name.alias("name"), F.substring(name, 1, 20).alias("city")
    )
    store.put(rows, 0)
    size = sum(s.bytes for s in store.table.segments(spark))
    keys = keys_of(spark, [str(n * 99_991) for n in range(10)])
    read, found = bytes_read(spark, lambda: store.lookup(keys, "k").collect())
    assert sorted(r.id for r in found) == sorted(str(n * 99_991) for n in range(10))
    assert read < size / 100, (read, size)


def test_flag_repair_reads_what_its_batch_needs(spark, tmp_path):
    """Fifty batches of two new devices each, over a history that grows."""
    folder = f"{tmp_path}/days"
    history = spark.range(20_000).select(
        F.concat(F.lit("old"), "id").alias("mid"), F.lit("20200101").alias("first_day")
    )
    repair.day_store(folder, 8).put(history, 0, "history")
    read = []
    for n in range(50):
        records = frame(
            spark, [page(f"d{2 * n + k}", n * DAY, is_new="1") for k in (0, 1)] + [page("d0", n * DAY, is_new="1")]
        )
        held, fixed = bytes_read(spark, lambda r=records, n=n: repair.fix_batch(r, n, folder, 8).collect())
        flags = {r.common.mid: r.common.is_new for r in fixed}
        assert flags[f"d{2 * n + 1}"] == "1" and flags["d0"] == ("1" if n == 0 else "0")
        read.append(held)
    store = repair.day_store(folder, 8)
    files = [len(s.files) for s in store.table.segments(spark)]
    assert max(files) == 1 and len(files) <= 8 * (7 + 7)  # 7 of each of two levels
    assert sum(read[25:]) < 1.5 * sum(read[:25])
    assert store.read(spark).count() == 20_000 + 100


def test_flags_by_two_queries(spark, tmp_path):
    """The earlier stored day counts, and a merge leaves one."""
    store = repair.day_store(f"{tmp_path}/days")
    for query, day in (("a", "20240105"), ("b", "20240103")):
        store.put(spark.createDataFrame([("x", day)], "mid string, first_day string"), 0, query)
    at = 1_704_240_000_000  # 2024-01-03
    records = frame(spark, [page("x", at, is_new="1"), page("x", at + 2 * DAY, is_new="1")])
    flags = {r.ts: r.common.is_new for r in repair.fix_batch(records, 0, f"{tmp_path}/days").collect()}
    assert flags == {at: "1", at + 2 * DAY: "0"}
    store.merge(spark, repair._first, whole=True)
    assert rows_of(store.read(spark)) == [("x", "20240103")]
    assert visits.first_visit_days(records).count() == 1


def dimension_of(spark, folder, frame_of_rows, buckets=4):
    """A dimension table with the rows of a frame, by changes of two batches."""
    columns = frame_of_rows.columns
    dim = Dimension(folder, tuple(columns), "id", buckets)
    changes = frame_of_rows.select(
        F.lit("insert").alias("type"),
        F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*columns)).alias("data"),
        F.lit(1).cast("bigint").alias("at"),
        F.struct(F.lit("").alias("file"), F.lit(1).cast("bigint").alias("nr")).alias("position"),
    )
    dim.write(changes, 0)
    dim.write(changes.limit(1), 1)
    return dim


def test_a_changed_key_rewrites_its_bucket_only(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string"), F.lit("a").alias("name"))
    dim = dimension_of(spark, f"{tmp_path}/dim", rows, 8)
    dim.compact(spark)
    before = {s.part: s.path for s in dim.store.table.segments(spark)}
    assert len(before) == 8
    change = spark.createDataFrame(
        [("update", {"id": "7", "name": "b"}, 2, ("", 2))],
        "type string, data map<string,string>, at long, position struct<file:string,nr:long>",
    )
    dim.write(change, 2)
    dim.write(change, 2)
    dim.compact(spark)
    after = {s.part: s.path for s in dim.store.table.segments(spark)}
    assert sum(before[p] != after[p] for p in before) == 1
    found = dict(map(tuple, dim.current(spark).collect()))
    assert len(found) == 100 and found["7"] == "b" and found["8"] == "a"
    looked = dim.lookup(keys_of(spark, ["7", "7", "x", None]), "k")
    assert rows_of(looked) == [("7", "b")]


def test_wide_orders_by_lookups_are_those_of_whole_joins(spark, tmp_path):
    placed, lines, _ = shop_tables(spark, shop(random.Random(8), 40))
    wide = orders.order_wide(placed, lines)
    frames = dimensions(spark)
    tables = {n: dimension_of(spark, f"{tmp_path}/{n}", f) for n, f in frames.items()}
    for name, dims in (("frames", frames), ("tables", tables)):
        jobs.write_order_wide(lambda d=dims: d, f"{tmp_path}/out-{name}")(wide, 0)
    texts = [sorted(r.value for r in spark.read.text(f"{tmp_path}/out-{n}").collect()) for n in ("frames", "tables")]
    assert texts[0] == texts[1] and len(texts[0]) > 40
    assert any("Acme" in t for t in texts[0])
