"""Search keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.text import tokens
from martflow.operators.segments import segments


def searches(pages: DataFrame) -> DataFrame:
    """Search text and time of the records of the search page."""
    return pages.where(
        (F.col("page.page_id") == schemas.PAGE_SEARCH) & F.col("page.item").isNotNull()
    ).select(F.col("page.item").alias("fullword"), "ts")


def keyword_tokens(found: DataFrame, tokenize=tokens) -> DataFrame:
    """One row per token of ``fullword``; a text without tokens gives none.

    ``tokenize`` makes an array column of tokens from a text column.
    """
    return found.select(F.explode(tokenize(F.col("fullword"))).alias("keyword"), "ts")


def keyword_segments(found: DataFrame, dictionary: DataFrame, tokenize=tokens) -> DataFrame:
    """One row per word of ``fullword``, whose tokens are read by a ``dictionary``.

    ``dictionary`` has ``word`` and ``weight``. Each distinct token is read once, however
    many searches have it. On a stream it runs per micro-batch, in ``foreachBatch``.
    """
    runs = keyword_tokens(found, tokenize).withColumnRenamed("keyword", "run")
    read = runs.join(segments(runs, dictionary), "run")
    return read.select(F.explode("tokens").alias("keyword"), "ts")
