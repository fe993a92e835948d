"""Topics of JSON text: Kafka, or folders of line files in its place.

A folder of topics is a text table partitioned by ``topic``, as the sinks
write it.  Positions are kept by the query's checkpoint, so there is no
consumer group to manage; ``group`` only names one for the broker's monitoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.logs import parse_text
from martflow.schemas import TEXT, record
from martflow.sinks.topics import topic_commits


def kafka_options(
    servers: str, topic: str, group: str | None = None, starting: str | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if group:
        options["kafka.group.id"] = group
    if starting:
        options["startingOffsets"] = starting
    return options


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    group: str | None = None,
    starting: str | None = None,
    files_per_batch: int | None = None,
    positions: bool = False,
    committed: bool = False,
) -> DataFrame:
    """A topic as a stream with one text column ``value``.

    Name either the Kafka ``servers`` or the ``folder`` of topics.  What a job
    writes batch by batch is read as the pattern ``<folder>/batch=*``.  With
    ``positions`` each message says when it arrived (``arrived``, epoch ms) and
    where it stands (``position``): on Kafka its offset, which orders the messages
    of one key, in files the file and the place where a task's part of it begins.
    A ``committed`` folder is one that jobs commit to: each message comes once, and
    ``files_per_batch`` counts their batches.
    """
    if committed:
        if not folder or positions:
            raise ValueError("a committed topic has a folder, and no positions")
        rows = topic_commits(folder).stream(spark, [topic], files_per_batch)
        return rows.select("value")
    if servers:
        reader = spark.readStream.format("kafka").options(
            **kafka_options(servers, topic, group, starting)
        )
        where = [
            F.unix_millis("timestamp").alias("arrived"),
            F.struct(F.lit("").alias("file"), F.col("offset").alias("nr")).alias("position"),
        ]
        value = F.col("value").cast("string").alias("value")
        return reader.load().select(value, *(where if positions else []))
    if not folder:
        raise ValueError("name Kafka servers or a folder")
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    where = [
        F.unix_millis("_metadata.file_modification_time").alias("arrived"),
        F.struct(
            F.concat_ws(
                ":", "_metadata.file_path", F.lpad(F.col("_metadata.file_block_start"), 20, "0")
            ).alias("file"),
            F.lit(None).cast("bigint").alias("nr"),
        ).alias("position"),
    ]
    kept = ["value", *(where if positions else [])]
    if "*" in folder:
        return reader.schema(record(value=TEXT)).text(f"{folder}/topic={topic}").select(*kept)
    # Through the folder, whose log lists the files that count.
    whole = reader.schema(record(value=TEXT, topic=TEXT)).text(folder)
    return whole.where(F.col("topic") == topic).select(*kept)


def read_topic_table(
    spark: SparkSession,
    topic: str,
    schema: T.StructType,
    servers: str | None = None,
    folder: str | None = None,
    group: str | None = None,
    files_per_batch: int | None = None,
    committed: bool = False,
) -> DataFrame:
    """A JSON topic as a typed stream; on Kafka from the latest records on."""
    lines = read_topic(
        spark, topic, servers, folder, group, "latest", files_per_batch, committed=committed
    )
    return parse_text(lines, schema)
