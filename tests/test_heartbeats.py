"""Windows close although inputs are silent, and nothing is lost that comes in time."""

import os
from datetime import UTC, datetime

import pytest

from martflow import schemas
from martflow.operators import logs, stats
from martflow.streaming import heartbeats
from test_logs import frame, page
from test_streams import rows, table_of

START = 1_700_000_000_000


def stream_of(spark, path, batches, schema):
    """A file a micro-batch, in order."""
    os.makedirs(path, exist_ok=True)
    for n, batch in enumerate(batches):
        one = f"{path}-{n}"
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(one)
        name = next(f for f in os.listdir(one) if f.endswith(".parquet"))
        os.link(f"{one}/{name}", f"{path}/{n}.parquet")
        os.utime(f"{path}/{n}.parquet", (1000 + n, 1000 + n))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("beating", [False, True])
def test_six_of_seven_inputs_are_silent(spark, tmp_path, beating):
    """The one that speaks brings a record eight seconds late, within the idle time."""
    seconds = [[0, 4, 11], [20, 12, 31], [40, 55], [64]]
    records = [[page("d", START + 1000 * s) for s in batch] for batch in seconds]
    spoken = [[r.asDict(recursive=True) for r in frame(spark, batch).collect()] for batch in records]
    beats = [[(datetime.fromtimestamp(START / 1000 + s, UTC),)] for s in (12, 33, 56, 100)]
    inputs = []
    for n in range(7):
        batches = spoken if n == 0 else [[]]
        pages = stream_of(spark, f"{tmp_path}/in{n}", batches, schemas.PAGE)
        measures = stats.page_measures(logs.split_page(pages))
        if beating:
            ticks = stream_of(spark, f"{tmp_path}/beats{n}", beats, "timestamp timestamp")
            measures = heartbeats.with_heartbeats(measures, ticks, "3 seconds", "20 seconds")
        inputs.append((measures, "3 seconds"))
    found = stats.visitor_stats(stats.union_on_time(*inputs))
    got = rows(table_of(found, tmp_path).select("stt", "pv_ct"))
    if not beating:
        assert got == []
        return
    whole = frame(spark, [r for batch in records for r in batch])
    expected = stats.visitor_stats(stats.page_measures(logs.split_page(whole)))
    closed = datetime.fromtimestamp(START / 1000 + 70, UTC).strftime("%Y-%m-%d %H:%M:%S")
    assert got == rows(expected.where(f"edt <= '{closed}'").select("stt", "pv_ct"))
    assert sum(r[0] if isinstance(r[0], int) else r[1] for r in got) == 9
