"""Database changes: envelopes as JSON text, and the snapshot before them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators.changes import latest_config, normalize_envelopes, rule_versions
from martflow.operators.logs import parse_text


def read_envelopes(lines: DataFrame) -> DataFrame:
    """Envelope texts to change events; texts that are none are left out."""
    parsed = parse_text(lines, schemas.ENVELOPE).where(F.col("op").isNotNull())
    return normalize_envelopes(parsed)


def read_routing(spark: SparkSession, folder: str) -> DataFrame:
    """The routing rules in force, from a folder of the rule table's envelopes."""
    lines = spark.read.text(folder).select("value", "_metadata.file_name")
    # Changes of one millisecond are told apart by the rule they state.
    events = read_envelopes(lines).withColumn("_rule", F.to_json("data"))
    return latest_config(events, ["ts_ms", "file_name", "_rule"])


def read_rule_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule of such a folder, with the times (epoch ms) it was in force."""
    lines = spark.read.text(folder).select("value", "_metadata.file_name")
    events = read_envelopes(lines).withColumn("_rule", F.to_json("data"))
    return rule_versions(events, "ts_ms", ["file_name", "_rule"])


def read_changes(lines: DataFrame) -> DataFrame:
    """Change-event texts to columns; other columns of ``lines`` are kept."""
    return parse_text(lines, schemas.CHANGE)


def rejected_changes(lines: DataFrame) -> DataFrame:
    """The lines that are no change events, as they came."""
    kept = lines.withColumn("_line", F.struct(*lines.columns))
    return read_changes(kept).where(F.col("type").isNull()).select("_line.*")


def snapshot_as_changes(rows: DataFrame, database: str, table: str) -> DataFrame:
    """Rows of a table as ``read`` events."""
    entries = [F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in rows.columns]
    return rows.select(
        F.lit(database).alias("database"),
        F.lit(table).alias("table"),
        F.lit("read").alias("type"),
        F.map_from_entries(F.array(*entries)).alias("data"),
    )


def jdbc_snapshot(
    spark: SparkSession,
    url: str,
    database: str,
    table: str,
    split_column: str,
    lower: int,
    upper: int,
    parts: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table as ``read`` events, read in ``parts`` parallel ranges.

    The bounds only cut the ranges; rows beyond them are read too.
    """
    rows = spark.read.jdbc(
        url,
        f"{database}.{table}",
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=parts,
        properties=properties or {},
    )
    return snapshot_as_changes(rows, database, table)
