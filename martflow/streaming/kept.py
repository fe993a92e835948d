"""Joins and windows of streams by micro-batch, the rows still open kept in tables.

Spark's own stateful operators ask and change a state store several times for each row.
Where micro-batches are large that costs far more than the work itself.  Here a batch
and the rows that those before it left open meet in one batch operator, and what is
still open then is written as a Parquet table.  A batch rewrites the open rows, so its
rows should not be few beside them; for small batches the jobs on state stores serve.

A row is open as long as the slowest source may still bring what it waits for: each
source has come as far as its latest event time less its delay.  A repeated batch starts
from the same kept rows and replaces what it wrote.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.times import text_to_time
from martflow.operators import orders, stats
from martflow.sinks.files import Files

Write = Callable[[DataFrame, int], None]


class Kept:
    """A folder with the open rows after each micro-batch, and how far the sources were."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder, Files(spark, folder)

    def begin(self, batch: int) -> None:
        """What an attempt at this batch left goes, and what no batch reads any more."""
        self.files.delete(f"batch={batch}")
        self.files.delete(f"batch={batch - 2}")

    def rows(self, batch: int, name: str, like: DataFrame) -> DataFrame | None:
        """The rows that the batch before left open; None if there was none."""
        if not self.files.exists(f"batch={batch - 1}/{name}"):
            return None
        return self.spark.read.schema(like.schema).parquet(f"{self.folder}/batch={batch - 1}/{name}")

    def keep(self, rows: DataFrame, batch: int, name: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}/{name}")

    def reached(self, batch: int) -> dict[str, int]:
        """The latest event time of each source after a batch, in epoch microseconds."""
        name = f"batch={batch}/reached.json"
        return json.loads(self.files.read(name)) if self.files.exists(name) else {}

    def advance(self, batch: int, latest: dict[str, int | None]) -> dict[str, int]:
        """Add the latest event times of a batch; a source that brings none stays where it was."""
        reached = self.reached(batch - 1)
        for source, micros in latest.items():
            if micros is not None:
                reached[source] = max(micros, reached.get(source, micros))
        self.files.put(f"batch={batch}/reached.json", json.dumps(reached))
        return reached


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _not_before(time: Column, micros: int | None) -> Column:
    """Whether a time is still open; all are while a source has brought nothing."""
    return time.isNotNull() if micros is None else time >= F.timestamp_micros(F.lit(micros))


def _both(kept: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if kept is None else kept.unionByName(new)


Of = Callable[[DataFrame], DataFrame]


def orders_and_details(orders_in: DataFrame, details_in: DataFrame) -> DataFrame:
    """Both streams as one, a row in the column of its own source."""
    placed = orders_in.select(F.struct("*").alias("order"))
    return placed.unionByName(details_in.select(F.struct("*").alias("detail")), allowMissingColumns=True)


def order_wide(
    folder: str,
    write: Write,
    bound: timedelta = orders.ORDER_BOUND,
    delay: timedelta = timedelta(0),
    order_of: Of = lambda rows: rows,
    detail_of: Of = lambda rows: rows,
) -> Write:
    """Join each micro-batch of :func:`orders_and_details` and send its wide orders on.

    Orders and lines join with all of the other source that were kept or come with them,
    by the batch operator, so a hot order is split at run time and none is copied.
    ``order_of`` and ``detail_of`` make records of rows that come in another shape; a
    batch is read several times, and here Spark leaves out the columns it need not make.
    """

    def run(rows: DataFrame, batch: int) -> None:
        kept = Kept(rows.sparkSession, folder)
        kept.begin(batch)
        new = {
            n: of(rows.where(F.col(n).isNotNull()).select(f"{n}.*"))
            for n, of in (("order", order_of), ("detail", detail_of))
        }
        old = {n: kept.rows(batch, n, df) for n, df in new.items()}
        wide = orders.order_wide(new["order"], _both(old["detail"], new["detail"]), bound)
        if old["order"] is not None:
            wide = wide.unionByName(orders.order_wide(old["order"], new["detail"], bound))
        write(wide, batch)
        latest = {n: df.agg(F.unix_micros(F.max(text_to_time("create_time")))).first()[0] for n, df in new.items()}
        reached = kept.advance(batch, latest)
        for name, other in (("order", "detail"), ("detail", "order")):
            behind = reached.get(other)
            if behind is not None:
                behind -= _micros(bound + delay)
            still = _not_before(text_to_time("create_time"), behind)
            kept.keep(_both(old[name], new[name]).where(still), batch, name)

    return run


def by_source(measures: dict[str, DataFrame]) -> DataFrame:
    """Product measures of several streams as one, each row with the name of its source."""
    return stats.product_union(
        *[frame.withColumn("source", F.lit(name)) for name, frame in measures.items()]
    )


def _least(reached: dict[str, int], delays: dict[str, timedelta]) -> int | None:
    """How far all sources have come, less their delays; None while one has brought nothing."""
    if any(source not in reached for source in delays):
        return None
    return min(reached[source] - _micros(delay) for source, delay in delays.items())


def product_stats(
    folder: str, write: Write, delays: dict[str, timedelta], window: str = stats.WINDOW
) -> Write:
    """Product statistics of :func:`by_source` rows, a window when all sources have passed it.

    ``delays`` names every source.  Rows of open windows are kept as they came, and a
    window is counted once, by the batch operator; a batch sends the windows that it
    closes itself, and drops rows of windows that an earlier one has closed.
    """
    end = F.unix_micros(F.window(F.timestamp_millis("ts"), window)["end"])

    def run(rows: DataFrame, batch: int) -> None:
        kept = Kept(rows.sparkSession, folder)
        kept.begin(batch)
        passed = _least(kept.reached(batch - 1), delays)
        latest = rows.groupBy("source").agg(F.unix_micros(F.timestamp_millis(F.max("ts"))))
        least = _least(kept.advance(batch, {source: at for source, at in latest.collect()}), delays)
        known = rows.where(F.col("sku_id").isNotNull() & F.col("ts").isNotNull())
        new = known.select("*", end.alias("end"))
        if passed is not None:
            new = new.where(F.col("end") > passed)
        held = _both(kept.rows(batch, "measures", new), new)
        closed = F.lit(False) if least is None else F.col("end") <= least
        write(stats.product_stats(held.where(closed), window), batch)
        kept.keep(held.where(~closed), batch, "measures")

    return run
