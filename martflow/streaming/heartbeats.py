"""Inputs that fall silent: a clock beside an input lets its watermark go on.

Spark closes a window when the slowest input of a union has passed it, and an input without
records never does. With heartbeats an input's watermark is at least the clock's time less
the idle time, so a silent input holds the windows open for that long. Records that come
later than that, behind the watermark, are dropped as any late ones: take an idle time above
what an input may lag behind the clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.times import EVENT_TIME


def clock(spark: SparkSession) -> DataFrame:
    """The time, once a second, as a stream of ``timestamp``."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select("timestamp")


def with_heartbeats(
    frame: DataFrame, beats: DataFrame, delay: str = "0 seconds", idle: str = "1 minute"
) -> DataFrame:
    """``frame`` (with ``ts``) under a watermark by its event time, or by ``beats`` when silent.

    ``beats`` is a stream of ``timestamp``, such as :func:`clock`. Its rows count for the
    watermark and are gone behind it. Operators that add an event time of their own leave
    the result as it is.
    """
    timed = frame.select("*", F.timestamp_millis("ts").alias(EVENT_TIME), F.lit(False).alias("_beat"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema.fields]
    passed = F.col("timestamp") - F.expr(f"INTERVAL {idle}")
    beat = beats.select(*nothing, passed.alias(EVENT_TIME), F.lit(True).alias("_beat"))
    both = timed.unionByName(beat).withWatermark(EVENT_TIME, delay)
    # A filter on other columns alone would be moved below the watermark.
    kept = ~F.col("_beat") | (F.col(EVENT_TIME) < F.lit("0001-01-01").cast("timestamp"))
    return both.where(kept).drop("_beat")
