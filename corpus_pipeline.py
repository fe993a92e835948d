"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet
and read again as the next one's ``docs``. All but the last give the columns of docs.

- quality rules: lines that are boilerplate of their host are taken out of the texts;
  documents that fail a rule, or of which line frequency leaves too
  little, go;
- language: documents without a letter, or in no language told well enough, go;
- near duplicates: of each group the document with the least id stays;
- mix: each document comes as often as its source's target weight asks for;
- packing: sequences of at most 2,048 ids; a row for each piece.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martflow.llm import byte_language, line_frequency, mixing, near_texts, packing
from martflow.llm.common import small_batches, table
from martflow.plans.staging import staging_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return line_frequency.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return byte_language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_texts.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    # Small workers, beside executors that the stages before have filled.
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, shard_bytes=16 << 20, kept_words=100_000, bytes_at_once=4 << 20)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: The trained network, signatures and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{staging_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
