"""Tables behind commits: whole batches, once, for readers and streams."""

import json
import os
import threading
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from martflow.schemas import LONG, TEXT, record
from martflow.sinks import results
from martflow.sinks.commits import CommitTable
from martflow.sinks.files import Files
from martflow.sinks.topics import write_messages
from martflow.sources.logs import stream_log_lines
from martflow.sources.topics import read_topic
from martflow.streaming import jobs
from test_logs import page

SHAPE = record(day=TEXT, id=LONG, note=TEXT)


def table(tmp_path):
    return CommitTable(f"{tmp_path}/t", SHAPE, "day")


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE).coalesce(1)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_batches_are_there_once(spark, tmp_path):
    t = table(tmp_path)
    assert got(t.read(spark)) == []
    one = [("20240101", 1, "a"), ("20240102", 2, None), (None, 3, "x y/=%")]
    assert t.commit(frame(spark, one), 0)
    assert not t.commit(frame(spark, [("20240101", 9, "again")]), 0)
    assert t.commit(frame(spark, [("20240102", 4, "d")]), 1)
    assert t.commit(frame(spark, [("a b/c=%", 5, "odd")]), 0, query="other")
    assert t.commit(frame(spark, []), 2)
    whole = sorted([*one, ("20240102", 4, "d"), ("a b/c=%", 5, "odd")], key=str)
    assert got(t.read(spark)) == whole
    assert got(t.read(spark, ["20240102"])) == [("20240102", 2, None), ("20240102", 4, "d")]
    assert got(t.read(spark, ["a b/c=%"])) == [("a b/c=%", 5, "odd")]
    assert t.read(spark).schema == SHAPE


def test_a_killed_batch_is_seen_once(spark, tmp_path, monkeypatch):
    """A batch dies between its files and its manifest, and is repeated.

    A reader beside it and a stream over the table see each row once, and no part of a batch.
    """
    t = table(tmp_path)
    batches = [[(f"2024010{n % 2 + 1}", 10 * n + i, "r") for i in range(5)] for n in range(6)]
    seen, stop, wrong = [], threading.Event(), []

    def watch():
        while not stop.is_set():
            counts = Counter(r.id for r in t.read(spark).collect())
            whole = {i // 10 for i in counts}
            if any(c > 1 for c in counts.values()) or len(counts) != 5 * len(whole):
                wrong.append(counts)
            seen.append(len(counts))

    def stream():
        query = t.stream(spark, batches=2).writeStream.format("parquet")
        query = query.option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out")
        assert query.trigger(availableNow=True).start().awaitTermination(120)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        put = Files.put
        for n, rows in enumerate(batches):
            if n in (1, 4):

                def killed(self, name, text):
                    raise KeyboardInterrupt(name)

                monkeypatch.setattr(Files, "put", killed)
                with pytest.raises(KeyboardInterrupt):
                    t.commit(frame(spark, rows), n)
                monkeypatch.setattr(Files, "put", put)
            if n == 3:
                stream()
            assert t.commit(frame(spark, rows), n)
            assert not t.commit(frame(spark, rows), n)
        stream()
    finally:
        stop.set()
        watcher.join()
    expected = sorted((r for rows in batches for r in rows), key=str)
    assert got(t.read(spark)) == expected
    assert not wrong and seen
    assert got(spark.read.schema(SHAPE).parquet(f"{tmp_path}/out")) == expected
    # The files of the killed attempts are found by their age.
    folders = len(Files(spark, t.folder).listed("data"))
    assert folders == 8
    assert t.clean(spark, 3600) == 0
    assert t.clean(spark, -10) == 2
    assert got(t.read(spark)) == expected


def test_merges_bound_the_files_of_a_hundred_batches(spark, tmp_path):
    t = table(tmp_path)
    most = 0
    for n in range(100):
        t.commit(frame(spark, [("20240101", n, "r")]), n)
        t.merge(spark, fan_in=4)
        held = t.segments(spark)
        most = max(most, sum(len(s.files) for s in held))
    assert most <= 3 * 4  # three at most of each of four levels
    assert sorted(r.id for r in t.read(spark).collect()) == list(range(100))
    files = Files(spark, t.folder)
    assert len(files.listed("folds")) >= 2
    state = t._state(files)
    assert state.loose <= 40
    # A batch that only a fold knows is still known.
    t.clean(spark, -10)
    assert len(files.listed("data")) == len({s.path.split("/")[1] for s in held})
    assert len(files.listed("commits")) < 40
    assert not t.commit(frame(spark, [("20240101", 5, "again")]), 5)
    assert sorted(r.id for r in t.read(spark).collect()) == list(range(100))


def test_merges_that_overlap_count_once(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    for n in range(3):
        t.commit(frame(spark, [("d", n, "r")]), n)
    old = t._state(Files(spark, t.folder))
    assert t.merge(spark, whole=True) == 1
    # Another one starts from what was there before.
    late = CommitTable(t.folder, SHAPE, "day")
    states = iter([old])
    plain = CommitTable._state
    monkeypatch.setattr(CommitTable, "_state", lambda s, f: next(states, None) or plain(s, f))
    assert late.merge(spark, whole=True) == 0
    monkeypatch.undo()
    assert len(t.segments(spark)) == 1
    assert sorted(r.id for r in t.read(spark).collect()) == [0, 1, 2]


def test_a_fold_of_rows(spark, tmp_path):
    t = table(tmp_path)
    for n in range(3):
        t.commit(frame(spark, [("d", 1, str(n)), ("e", n, "r")]), n)
    newest = lambda df: df.groupBy("day", "id").agg({"note": "max"}).toDF("day", "id", "note")
    assert t.merge(spark, newest, whole=True) == 2
    assert got(t.read(spark, ["d"])) == [("d", 1, "2")]
    assert t.merge(spark, newest, whole=True) == 0


def test_streams_name_their_batches_by_their_checkpoint(spark, tmp_path):
    """A new query starts from batch 0 again and is not taken for the old one."""
    t = table(tmp_path)
    frame(spark, [("d", 1, "r")]).write.parquet(f"{tmp_path}/in")
    for checkpoint in ("one", "one", "two"):
        reader = spark.readStream.schema(SHAPE).parquet(f"{tmp_path}/in")
        query = reader.writeStream.foreachBatch(lambda df, n: t.commit(df, n) and None)
        query = query.option("checkpointLocation", f"{tmp_path}/{checkpoint}")
        assert query.trigger(availableNow=True).start().awaitTermination(60)
    assert got(t.read(spark)) == [("d", 1, "r")] * 2


RESULT = "stt string, edt string, keyword string, ct long, helper string"


def test_results_behind_commits(spark, tmp_path):
    """Batches repeat; days are merged; a report's day is read alone; a stream sees rows once."""
    path = f"{tmp_path}/results"
    with pytest.raises(FileNotFoundError):
        results.read_committed(spark, path)
    expected = []
    for n in range(7):
        day = f"2024-01-0{n % 2 + 1}"
        row = (f"{day} 00:00:{n:02}", f"{day} 00:00:{n:02}", "k", n, "h")
        expected.append((*row[:4], day.replace("-", "")))
        for again in (True, False):
            df = spark.createDataFrame([row], RESULT)
            assert results.commit_results(df, path, n, ("helper",), fan_in=3) == again
    whole = results.read_committed(spark, path)
    assert whole.columns == ["stt", "edt", "keyword", "ct", "day"]
    assert got(whole) == sorted(expected, key=str)
    day = results.read_committed(spark, path, ["20240101"])
    assert got(day) == sorted((r for r in expected if r[4] == "20240101"), key=str)
    assert len(day.inputFiles()) <= 2 and all("day=20240101" in f for f in day.inputFiles())
    stream = results.stream_committed(spark, path, batches=2).writeStream.format("parquet")
    stream = stream.option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out")
    assert stream.trigger(availableNow=True).start().awaitTermination(120)
    assert got(spark.read.schema(whole.schema).parquet(f"{tmp_path}/out")) == sorted(expected, key=str)


def test_a_job_killed_before_its_commit_sends_its_messages_once(spark, tmp_path, monkeypatch):
    """From the base log to the next job, over a crash and a restart from the checkpoint."""
    lines = [json.dumps(page(f"d{n}", n * 1000)) for n in range(6)]
    os.makedirs(f"{tmp_path}/ods")
    for n in range(3):
        with open(f"{tmp_path}/ods/{n}.txt", "w") as out:
            out.write("\n".join(lines[2 * n : 2 * n + 2]))
        os.utime(f"{tmp_path}/ods/{n}.txt", (1000 + n, 1000 + n))
    put, seen = Files.put, []

    def killed(self, name, text):
        if self.folder.endswith("/dwd") and name.startswith("commits/") and len(seen) == 1:
            seen.append(name)
            raise RuntimeError("killed")
        if self.folder.endswith("/dwd"):
            seen.append(name)
        return put(self, name, text)

    def start():
        write = jobs.base_log(f"{tmp_path}/days", f"{tmp_path}/dwd", committed=True)
        query = jobs.start_batches(stream_log_lines(spark, f"{tmp_path}/ods", 1), write, f"{tmp_path}/cp")
        return query.awaitTermination(120)

    monkeypatch.setattr(Files, "put", killed)
    with pytest.raises(StreamingQueryException):
        start()
    assert start()
    assert len(seen) == 4
    topic = read_topic(spark, jobs.PAGE_LOG, folder=f"{tmp_path}/dwd", committed=True)
    query = topic.writeStream.format("text").option("checkpointLocation", f"{tmp_path}/cp2")
    assert query.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination(120)
    mids = sorted(json.loads(r.value)["common"]["mid"] for r in spark.read.text(f"{tmp_path}/out").collect())
    assert mids == [f"d{n}" for n in range(6)]
    with pytest.raises(ValueError):
        read_topic(spark, "t", folder="x", committed=True, positions=True)
    with pytest.raises(ValueError):
        write_messages(topic, 0, servers="h:1", committed=True)
