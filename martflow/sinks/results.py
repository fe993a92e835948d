"""Result tables: append-only, split by the day of the window start.

``commit_results`` puts them behind commits: readers see a batch whole and once, and the
files of a day are merged by levels. ``append_results`` writes a plain folder by day and
batch, for readers that know nothing of commits; one that has read the first attempt of a
repeated batch sees the batch twice. A report of a day lists that day's files only,
whatever has been written before.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.sinks.commits import FAN_IN, CommitTable
from martflow.sinks.files import Files


def result_rows(df: DataFrame, helpers: tuple[str, ...] = ()) -> DataFrame:
    """Stored columns plus ``day``; ``helpers`` are columns not to store."""
    day = F.regexp_replace(F.substring("stt", 1, 10), "-", "")
    return df.drop(*helpers).withColumn("day", day)


def append_results(
    df: DataFrame, table: str, batch: int, helpers: tuple[str, ...] = ()
) -> None:
    """Append a micro-batch; a repeated batch replaces itself, day by day."""
    rows = result_rows(df, helpers).withColumn("batch", F.lit(batch))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "batch").parquet(table)


def read_results(spark: SparkSession, table: str) -> DataFrame:
    """A result table; reports that ask for a ``day`` list its folder only."""
    return spark.read.parquet(table).withColumn("day", F.col("day").cast("string"))


def _committed(spark: SparkSession, table: str, rows: DataFrame | None = None) -> CommitTable:
    """The table by the shape its first batch had."""
    files = Files(spark, table)
    if not files.exists("schema.json"):
        if rows is None:
            raise FileNotFoundError(f"{table} has no batch")
        files.make()
        try:
            files.put("schema.json", rows.schema.json())
        except FileExistsError:  # another query's batch came first
            pass
    shape = T.StructType.fromJson(json.loads(files.read("schema.json")))
    return CommitTable(table, shape, "day")


def commit_results(
    df: DataFrame,
    table: str,
    batch: int,
    helpers: tuple[str, ...] = (),
    query: str | None = None,
    fan_in: int = FAN_IN,
) -> bool:
    """Append a micro-batch, whole and once; False if it is there already.

    ``query`` is that of the micro-batch unless named. Days that have got ``fan_in`` files
    of a size are merged.
    """
    rows = result_rows(df, helpers)
    held = _committed(df.sparkSession, table, rows)
    done = held.commit(rows, batch, query)
    if done:
        held.merge(df.sparkSession, fan_in=fan_in)
    return done


def read_committed(
    spark: SparkSession, table: str, days: list[str] | None = None
) -> DataFrame:
    """A table that ``commit_results`` writes, as it is now; of some days or of all."""
    return _committed(spark, table).read(spark, days)


def stream_committed(spark: SparkSession, table: str, batches: int | None = None) -> DataFrame:
    """The same as a stream: each row once."""
    return _committed(spark, table).stream(spark, batches=batches)


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batch_size: int = 1000,
    helpers: tuple[str, ...] = (),
    properties: dict[str, str] | None = None,
) -> None:
    """Append to a database table, by column name, ``batch_size`` rows an insert.

    A repeated micro-batch inserts its rows again; the window start and the
    keys tell such rows apart from new ones.
    """
    options = {**(properties or {}), "batchsize": str(batch_size)}
    df.drop(*helpers).write.jdbc(url, table, mode="append", properties=options)
