"""New-flag repair on a stream: one remembered day per device, in a keyed table.

Each micro-batch is repaired with the batch operators, which combine on the map side
and split a hot device, so the result does not hang on how its rows are cut up. It reads
the buckets that its devices hash to and adds the devices it is the first to flag, so it
costs what it holds, whatever has been stored before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.visits import first_visit_days, fix_is_new_by
from martflow.schemas import TEXT, record
from martflow.sinks.keyed import KeyedTable

BUCKETS = 16


def day_store(folder: str, buckets: int = BUCKETS) -> KeyedTable:
    """First days by device; the number of buckets is the folder's for good."""
    return KeyedTable(folder, record(mid=TEXT, first_day=TEXT), "mid", buckets)


def _first(days: DataFrame) -> DataFrame:
    """A row per device, should two queries have stored one each."""
    return days.groupBy("mid").agg(F.min("first_day").alias("first_day"))


def compact_days(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> int:
    """Merge buckets that batches have left many files in."""
    return day_store(folder, buckets).merge(spark, _first)


def fix_batch(records: DataFrame, batch: int, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """Repair a micro-batch of records by the days kept in ``folder``.

    Stores the days of the devices it is the first to flag, and returns the
    repaired records.  Within the batch event time decides. A repeated batch finds
    what it has stored.
    """
    spark = records.sparkSession
    store = day_store(folder, buckets)
    here = first_visit_days(records).persist()
    try:
        chosen = store.choose(here)
        known = store.chosen_rows(spark, chosen)
        new = here.join(known.select("mid"), "mid", "left_anti")
        if store.put(new, batch):
            store.merge(spark, _first)
        # With what has just been stored.
        days = store.chosen_rows(spark, chosen)
    finally:
        here.unpersist()
    return fix_is_new_by(records, _first(days))
