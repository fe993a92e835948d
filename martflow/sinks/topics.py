"""Write JSON text to topics: Kafka, or a folder of line files in its place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martflow.schemas import TEXT, record
from martflow.sinks.commits import CommitTable


def as_messages(df: DataFrame, topic: str) -> DataFrame:
    """Each row as JSON text for one topic; null fields are left out."""
    text = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(F.lit(topic).alias("topic"), text.alias("value"))


def stream_messages(
    messages: DataFrame,
    checkpoint: str,
    servers: str | None = None,
    folder: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start writing a stream of ``topic`` and ``value``, each row to its topic.

    Files are written exactly once; a folder belongs to one query.  Kafka gets
    each message at least once, so its readers should expect repeats after a
    restart.
    """
    writer = messages.select("topic", "value").writeStream.outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if servers:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers).start()
    return writer.format("text").partitionBy("topic").start(folder)


def topic_commits(folder: str) -> CommitTable:
    """Topics behind commits, a part for each."""
    return CommitTable(folder, record(topic=TEXT, value=TEXT), "topic")


def write_messages(
    messages: DataFrame,
    batch: int,
    servers: str | None = None,
    folder: str | None = None,
    committed: bool = False,
) -> None:
    """The same for one micro-batch.

    As files, each batch has a folder ``batch=N`` that a repeated batch
    replaces; read them back as the folder ``<folder>/batch=*``.  With ``committed``
    they lie behind commits, and readers see each message once (``topic_commits``).
    """
    if not servers and not folder:
        raise ValueError("name Kafka servers or a folder")
    if committed and not folder:
        raise ValueError("commits need a folder; Kafka may get a batch twice")
    rows = messages.select("topic", "value")
    if committed:
        table = topic_commits(folder)
        if table.commit(rows, batch):
            table.merge(messages.sparkSession)
    elif servers:
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        rows.write.mode("overwrite").partitionBy("topic").text(f"{folder}/batch={batch}")
