"""Helpers the operators share: tables by name, small sides of joins, shared files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words in the quality and mixing contracts.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


ROWS_A_BATCH = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have Python workers get whole texts some megabytes at a time, not by 10,000 rows."""
    if not 0 < int(spark.conf.get(_BATCH)) <= ROWS_A_BATCH:
        spark.conf.set(_BATCH, str(ROWS_A_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder, for an operator that reads it in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_for(total: int | None, per_part: int) -> int:
    """Parts of about ``per_part`` that ``total`` fills; one at least."""
    return max(1, -(-int(total or 0) // per_part))


def small_side(staged: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """A written table, to be broadcast if its files are small; else Spark shuffles.

    The size is that of the files, which Spark has listed; nothing is run for it.
    """
    plan = staged._jdf.queryExecution().optimizedPlan()
    if int(plan.stats().sizeInBytes()) <= limit:
        return F.broadcast(staged)
    return staged


def returning(function):
    """A function for ``mapInArrow`` that gives its memory back when its task ends.

    Python workers live on between tasks, and would hold it beside whatever runs next.
    """

    def run(batches):
        try:
            yield from function(batches)
        finally:
            _give_back()

    return run


def _give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def open_store(uri: str):
    """The file system of a folder and the folder's path in it.

    Works in the driver and in tasks, for whatever store the shared folder is in.
    """
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri
