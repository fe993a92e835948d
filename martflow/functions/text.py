"""JSON text and keyword tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Fixed value: everything that is neither letter nor digit separates tokens.
SEPARATORS = r"[^\p{L}\p{N}]+"

# Fixed value: the name queries call the tokenizer by.
TOKENIZER = "ik_analyze"


def map_text(data: Column | str) -> Column:
    """A map as JSON text; like a record's, its null fields are left out."""
    return F.to_json(F.map_filter(data, lambda _, value: value.isNotNull()))


def tokens(text: Column | str) -> Column:
    """Array of the lower-case tokens of a text, repeated ones included."""
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda t: t != "")


def register_tokenizer(
    spark: SparkSession,
    tokenizer: Callable[[str], Iterable[str]] | None = None,
    name: str = TOKENIZER,
) -> None:
    """Make ``ik_analyze(text)`` usable in SQL: the array of a text's tokens.

    ``LATERAL VIEW explode`` over a subquery that calls it gives a row per token.
    Without ``tokenizer`` it is a SQL function over the same expression as
    :func:`tokens`, which Catalyst puts in its place: one scan, no join.  A
    tokenizer of the user's own (a dictionary segmenter, say) gets the texts in
    Arrow batches.
    """
    if tokenizer is None:
        pattern = SEPARATORS.replace("\\", "\\\\")
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS ARRAY<STRING> "
            f"RETURN filter(split(lower(text), '{pattern}'), t -> t <> '')"
        )
        return

    @pandas_udf("array<string>")
    def tokenized(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [] if text is None else list(tokenizer(text)))

    spark.udf.register(name, tokenized)
