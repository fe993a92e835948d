"""A table handed over from its rows to its log, chunk by chunk, while it changes.

The log is followed from the start on. Beside it the table is read in chunks of keys: the
log's position is asked for, the chunk is read, and its rows are written as of that position.
Where the log changes a row after that position, before or after the chunk was read, the
change wins; where it did so before, the chunk's row does. So chunks and micro-batches may
come in any order, nothing is locked, and a chunk that is written is not read again after a
restart. Once the log has been followed to ``consistent_at``, the table is as it was there.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.sinks.dimensions import Dimension
from martflow.sinks.files import Files

_CHUNKS = "chunks"
# A chunk's row comes after the changes at its own position.
_ROW, _CHANGE = 1, 0


def _placed(changes: DataFrame, position, kind: int) -> DataFrame:
    place = F.struct(F.lit("").alias("file"), F.lit(kind).cast("bigint").alias("nr"))
    return changes.select(
        *[c for c in changes.columns if c not in ("at", "position")],
        position.cast("bigint").alias("at"),
        place.alias("position"),
    )


@dataclass(frozen=True)
class Handover:
    """A dimension table that takes a log and, chunk by chunk, what was there before it."""

    folder: str
    columns: tuple[str, ...]
    pk: str = "id"
    buckets: int = 16

    @property
    def table(self) -> Dimension:
        return Dimension(
            f"{self.folder}/table", self.columns, self.pk, self.buckets, ("at", "position")
        )

    def write_log(self, changes: DataFrame, batch: int, position: str = "log_position") -> None:
        """A micro-batch of the log: ``type``, ``data`` and where each change stands."""
        self.table.write(_placed(changes, F.col(position), _CHANGE).drop(position), batch)

    def read_chunks(
        self,
        spark: SparkSession,
        chunks: int,
        log_position: Callable[[], int],
        read_chunk: Callable[[int], DataFrame],
    ) -> int:
        """Read the chunks that are not there yet; returns how many.

        ``read_chunk`` gives a chunk's rows as changes, ``log_position`` where the log
        ends. A chunk is there when its rows are committed.
        """
        files = Files(spark, self.folder)
        files.make(_CHUNKS)
        taken = 0
        for chunk in range(chunks):
            if files.exists(f"{_CHUNKS}/{chunk}.json"):
                continue
            low = log_position()
            rows = _placed(read_chunk(chunk), F.lit(low), _ROW)
            # One query a chunk, so that any of them can be repeated alone.
            self.table.write(rows, 0, f"chunk-{chunk}")
            files.put(f"{_CHUNKS}/{chunk}.json", json.dumps({"low": low, "high": log_position()}))
            taken += 1
        return taken

    def consistent_at(self, spark: SparkSession) -> int | None:
        """The position from which on the table agrees with its log; None without chunks."""
        files = Files(spark, self.folder)
        told = [json.loads(files.read(f"{_CHUNKS}/{f.name}")) for f in files.listed(_CHUNKS)]
        return max((t["high"] for t in told), default=None)
