"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Set on any session, also one that somebody else has built.
RUNTIME_SETTINGS = {
    # Days and window texts are cut in one zone for the whole warehouse.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot device, order or product is split over many tasks in a sort-merge
    # join, even where that costs a later operator one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream state outgrows the heap, and only its changes go to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store per partition of a stream join instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app: str = "martflow",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; leave ``master`` unset where spark-submit names it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
