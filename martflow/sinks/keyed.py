"""Tables looked up by key: hash buckets behind commits, keys found by Parquet's own marks.

A row lies in the bucket its key hashes to, in files sorted by key, with pages of some
keys. A lookup reads the buckets its keys hash to; where they are few, also the keys
themselves go to the scan, which passes over files and pages by their least and greatest
keys. So what is read grows with the keys asked for, and with the table only by a bucket's
share of it when keys are many.

Bloom filters are left out: of 1,000,000 rows in 64 buckets, a lookup of 10 keys reads
0.15 % by pages of 1,000 keys alone, and 2.1 % with filters, as a page is smaller than a
file's filter.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.schemas import TEXT
from martflow.sinks.commits import FAN_IN, CommitTable
from martflow.sinks.files import Files

BUCKET = "key_bucket"
FEW_KEYS = 200
_KEYS_A_PAGE = 1000


@dataclass(frozen=True)
class Chosen:
    """Buckets to read, and the keys themselves where they are few."""

    buckets: frozenset[str]
    keys: tuple[str, ...] | None


@dataclass(frozen=True)
class KeyedTable:
    """Rows of ``schema`` by the text column ``key`` in so many ``buckets``.

    The number of buckets is the table's for good: take one that makes a bucket of the
    full-grown table a few files.
    """

    folder: str
    schema: T.StructType
    key: str
    buckets: int = 64

    @cached_property
    def table(self) -> CommitTable:
        shape = T.StructType([*self.schema.fields, T.StructField(BUCKET, TEXT)])
        options = (
            ("parquet.page.row.count.limit", str(_KEYS_A_PAGE)),
            # A dictionary of keys that hardly repeat would be read for nothing.
            (f"parquet.enable.dictionary#{self.key}", "false"),
        )
        return CommitTable(self.folder, shape, BUCKET, options, (self.key,))

    def bucket(self, key: str | None = None) -> Column:
        """The bucket of a key column, as text."""
        number = F.pmod(F.xxhash64(F.col(key or self.key).cast("string")), F.lit(self.buckets))
        return number.cast("string")

    def _check(self, spark: SparkSession) -> None:
        files = Files(spark, self.folder)
        told = {"key": self.key, "buckets": self.buckets}
        if not files.exists("keyed.json"):
            files.make()
            try:
                files.put("keyed.json", json.dumps(told))
            except FileExistsError:  # another writer came first
                pass
        found = json.loads(files.read("keyed.json"))
        if found != told:
            raise ValueError(f"{self.folder} has {found}, not {told}")

    def put(self, rows: DataFrame, batch: int, query: str | None = None) -> bool:
        """Add a batch of rows to their buckets; False if it is there already."""
        self._check(rows.sparkSession)
        return self.table.commit(rows.withColumn(BUCKET, self.bucket()), batch, query)

    def merge(
        self,
        spark: SparkSession,
        fold: Callable[[DataFrame], DataFrame] | None = None,
        fan_in: int = FAN_IN,
        whole: bool = False,
    ) -> int:
        """Merge buckets; ``fold`` makes the rows of a key into fewer. A key is in one bucket."""

        def folded(rows: DataFrame) -> DataFrame:
            return fold(rows.drop(BUCKET)).withColumn(BUCKET, self.bucket())

        return self.table.merge(spark, folded if fold else None, fan_in, whole)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark).drop(BUCKET)

    def choose(self, keys: DataFrame, column: str | None = None) -> Chosen:
        """What a lookup of the keys in ``column`` has to read.

        The driver gets ``FEW_KEYS`` keys at most, or the numbers of the buckets. Rows
        are counted, not keys: make them distinct where they repeat.
        """
        column = column or self.key
        key = F.col(column).cast("string")
        wanted = keys.where(key.isNotNull()).select(key.alias("key"), self.bucket(column).alias("b"))
        few = wanted.limit(FEW_KEYS + 1).collect()
        if len(few) <= FEW_KEYS:
            return Chosen(frozenset(r.b for r in few), tuple({r.key: None for r in few}))
        return Chosen(frozenset(r.b for r in wanted.select("b").distinct().collect()), None)

    def chosen_rows(self, spark: SparkSession, chosen: Chosen) -> DataFrame:
        """The table's rows that a lookup has to read, as the table is now."""
        if not chosen.buckets:
            return spark.createDataFrame([], self.schema)
        found = self.table.read(spark, chosen.buckets)
        if chosen.keys is not None:
            found = found.where(_any_of(F.col(self.key), list(chosen.keys)))
        return found.drop(BUCKET)

    def lookup(self, keys: DataFrame, column: str | None = None) -> DataFrame:
        """Rows that may be of the keys in ``column``.

        Where the keys are not few, rows of other keys of their buckets are among them;
        a join with the keys tells.
        """
        return self.chosen_rows(keys.sparkSession, self.choose(keys, column))


def _any_of(column: Column, values: list[str]) -> Column:
    """One of the values, as equalities: Spark gives a scan a long list by its ends alone."""
    tests = [column == value for value in values]
    while len(tests) > 1:  # a flat tree
        pairs = [a | b for a, b in zip(tests[::2], tests[1::2], strict=False)]
        tests = pairs + tests[len(pairs) * 2 :]
    return tests[0]
