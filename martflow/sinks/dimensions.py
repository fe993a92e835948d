"""Dimension tables that take upserts of single columns.

A table is a keyed table (``keyed.py``) of folded changes: each batch adds a segment to the
buckets of the keys that it changes, and segments of a bucket fold into one by levels, so
a changed key rewrites its bucket alone.  Reading the whole table folds the buckets that
hold more than one segment; a lookup reads what its keys need.  A repeated batch is there
already.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.changes import fold_dimension, merge_folds, visible_rows
from martflow.schemas import LONG, TEXT, record
from martflow.sinks.keyed import BUCKET, KeyedTable

# Later batches win; within one the time of the change, then the place in the topic.
ORDER = ["batch", "at", "position"]
_AT = record(batch=LONG, at=LONG, position=record(file=TEXT, nr=LONG))


def dimension_columns(sink_columns: str, pk: str | None = None) -> list[str]:
    """Columns of a dimension from its rule: the key and the listed ones."""
    names = sink_columns.split(",")
    key = pk or "id"
    return names if key in names else [key, *names]


def dimension_schema(sink_columns: str, pk: str | None = None) -> T.StructType:
    """All columns are texts; the key, ``id`` by default, is never null."""
    key = pk or "id"
    return T.StructType(
        [T.StructField(n, TEXT, n != key) for n in dimension_columns(sink_columns, pk)]
    )


@dataclass(frozen=True)
class Dimension:
    """A dimension table in ``folder`` with text ``columns`` and the key ``pk``.

    Later by ``order`` wins: by default the later batch.  By ("at", "position") it is the
    later change, whatever query wrote it and when, as a table needs that several write.
    """

    folder: str
    columns: tuple[str, ...]
    pk: str = "id"

    buckets: int = 16
    order: tuple[str, ...] = tuple(ORDER)

    def _schema(self) -> T.StructType:
        cell = record(value=TEXT, at=_AT)
        return T.StructType(
            record(_pk=TEXT, _deleted_at=_AT, _written_at=_AT).fields
            + [T.StructField(name, cell) for name in self.columns]
        )

    @property
    def store(self) -> KeyedTable:
        return KeyedTable(self.folder, self._schema(), "_pk", self.buckets)

    def _fold(self, folds: DataFrame) -> DataFrame:
        return merge_folds(folds, list(self.columns))

    def write(self, changes: DataFrame, batch: int, query: str | None = None) -> None:
        """Fold a batch of changes (``type``, ``data``, ``at``, ``position``) and store it."""
        folded = fold_dimension(
            changes.withColumn("batch", F.lit(batch).cast("bigint")),
            list(self.columns),
            self.pk,
            list(self.order),
            keep_state=True,
        )
        if self.store.put(folded, batch, query):
            self.store.merge(changes.sparkSession, self._fold)

    def _state(self, spark: SparkSession) -> DataFrame:
        table = self.store.table
        held: dict[str, list] = {}
        for segment in table.segments(spark):
            held.setdefault(segment.part, []).append(segment)
        # A segment holds a key once, so a bucket with one segment is as it should be.
        alone = [own[0] for own in held.values() if len(own) == 1]
        several = [segment for own in held.values() if len(own) > 1 for segment in own]
        found = table.of(spark, alone).drop(BUCKET)
        if not several:
            return found
        return found.unionByName(self._fold(table.of(spark, several).drop(BUCKET)))

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as it is now, one row per key."""
        return visible_rows(self._state(spark), list(self.columns), self.pk)

    def lookup(self, keys: DataFrame, column: str) -> DataFrame:
        """The table's rows that have one of the keys in ``column``, and maybe others.

        Reads the keys' buckets, and of them the keys alone where they are few.
        """
        wanted = keys.select(column).distinct()
        return visible_rows(self._fold(self.store.lookup(wanted, column)), list(self.columns), self.pk)

    def compact(self, spark: SparkSession, upto: int | None = None) -> None:
        """Fold every bucket into one segment, whatever its levels; ``upto`` is not needed."""
        self.store.merge(spark, self._fold, whole=True)
