"""Join shapes: time-bounded joins of facts, lookups in dimensions.

Whether a side is broadcast is left to Spark, which does so when its size is
below ``spark.sql.autoBroadcastJoinThreshold``, from statistics or at run time,
and else sorts and merges, splitting skewed partitions.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Column,
    left_time: str,
    right_time: str,
    lower: timedelta,
    upper: timedelta,
    salts: int = 1,
) -> DataFrame:
    """Inner join on ``keys`` with ``right_time`` in left_time + [lower, upper].

    Both bounds belong to the interval.  The time columns need names of their
    own; in a stream both carry a watermark, from which Spark derives when the
    join may forget a row.

    In batch Spark splits a hot key at run time.  A stream is planned without
    that: ``salts`` above 1 spreads the right rows of each key over as many
    tasks, and gives each of them a copy of the key's left rows.
    """
    if salts > 1:
        every = F.array(*[F.lit(n) for n in range(salts)])
        left = left.select("*", F.explode(every).alias("left_salt"))
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.lit(salts))
        right = right.select("*", salt.cast("int").alias("right_salt"))
        keys = keys & (F.col("left_salt") == F.col("right_salt"))
    return left.join(
        right,
        keys
        & (F.col(right_time) >= F.col(left_time) + F.lit(lower))
        & (F.col(right_time) <= F.col(left_time) + F.lit(upper)),
    )


def first_per_key(dim: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``."""
    rest = [c for c in dim.columns if c not in keys]
    return (
        dim.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(*keys, "r.*")
    )


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    columns: dict[str, Column],
) -> DataFrame:
    """Look rows up in a dimension that has one row per key.

    ``on`` maps columns of ``df`` to key columns of ``dim``, compared as text.
    ``columns`` gives the result columns in terms of the dimension.  A hit sets
    them, also to null; a miss keeps the row and what it has in them.
    """
    taken = [c.alias(f"_dim_{name}") for name, c in columns.items()]
    keys = [F.col(k).cast("string").alias(f"_key_{k}") for k in on.values()]
    side = dim.select(*keys, *taken, F.lit(True).alias("_hit"))
    condition = None
    for column, key in on.items():
        equal = F.col(column).cast("string") == F.col(f"_key_{key}")
        condition = equal if condition is None else condition & equal
    joined = df.join(side, condition, "left")
    out = []
    for name in df.columns:
        if name in columns:
            out.append(
                F.when(F.col("_hit"), F.col(f"_dim_{name}")).otherwise(F.col(name)).alias(name)
            )
        else:
            out.append(F.col(name))
    added = [F.col(f"_dim_{n}").alias(n) for n in columns if n not in df.columns]
    return joined.select(*out, *added)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    columns: dict[str, Column],
    order: list[str],
) -> DataFrame:
    """:func:`enrich` by a key that may repeat in ``dim``: its first row wins."""
    return enrich(df, first_per_key(dim, list(on.values()), order), on, columns)
