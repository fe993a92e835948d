"""Words of texts without separators, by a dictionary table.

A run is a stretch of letters and digits. Every place of a distinct run at which a word of
the dictionary stands is an edge of its lattice, found by a join with the dictionary. Of
all readings of a run that one is taken which leaves the fewest characters outside of words,
then has the fewest words, then the greatest sum of weights, then, from the left, the
longer words. Characters outside of words are tokens too, neighbours as one.

Places that no edge crosses cut a run into chains, which are read one by one; where a chain
is one word there is nothing to choose. Runs and their edges are spread by run, however often a
text comes, and no more than the edges of a run is held at once. A run costs its length
times the number of word lengths in the dictionary.

Defined results: a null or empty run has no tokens and no row; repeated runs give one row;
words that are null or empty are left out, a repeated word has its greatest weight, a null weight
is 0; an empty dictionary makes each run one token. Other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reading(starts, lengths, weights) -> list[int]:
    """Numbers of the edges of the best reading of a chain, from left to right."""
    leaving: dict[int, list[int]] = {}
    for edge, start in enumerate(starts):
        leaving.setdefault(int(start), []).append(edge)
    first = min(leaving)
    last = max(int(s + n) for s, n in zip(starts, lengths, strict=True))
    # What is behind a place: characters outside of words, words, weight; and the edge taken.
    costs, taken = {last: (0, 0, 0)}, {}
    for place in range(last - 1, first - 1, -1):
        outside, words, weight = costs[place + 1]
        best, taken[place] = (outside + 1, words, weight, 0), None
        for edge in leaving.get(place, ()):
            outside, words, weight = costs[place + int(lengths[edge])]
            other = (outside, words + 1, weight - int(weights[edge]), -int(lengths[edge]))
            if other < best:
                best, taken[place] = other, edge
        costs[place] = best[:3]
    found, place = [], first
    while place < last:
        edge = taken[place]
        if edge is not None:
            found.append(edge)
        place += 1 if edge is None else int(lengths[edge])
    return found


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _readings(starts: pd.Series, lengths: pd.Series, weights: pd.Series) -> pd.Series:
    rows = zip(starts, lengths, weights, strict=True)
    return pd.Series([None if row[0] is None else reading(*row) for row in rows], dtype=object)


def lattice(runs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """A row (key, start, length, weight) for each word at each place of ``runs`` (key, run)."""
    words = dictionary.where(F.length("word") > 0).groupBy("word")
    words = words.agg(F.coalesce(F.max(F.col("weight").cast("long")), F.lit(0)).alias("weight"))
    # As many numbers as words have lengths.
    sizes = [r[0] for r in words.select(F.length("word")).distinct().orderBy(F.length("word")).collect()]
    sizes = F.array(*map(F.lit, sizes)).cast("array<int>")
    places = runs.select("key", "run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start"))
    places = places.withColumn("length", F.explode(sizes))
    places = places.where(F.col("start") + F.col("length") - 1 <= F.length("run")).select(
        "key", "start", "length", F.col("run").substr(F.col("start"), F.col("length")).alias("word")
    )
    return places.join(words, "word").select("key", "start", "length", "weight")


def best_words(edges: DataFrame) -> DataFrame:
    """(key, words): start and length of the words of each run's best reading, in order."""
    order = Window.partitionBy("key").orderBy("start", "length")
    reach = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1))
    edges = edges.withColumn("cut", cut).withColumn("chain", F.sum("cut").over(order))
    chains = edges.groupBy("key", "chain").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "weight"))).alias("edges")
    )
    several = F.size("edges") > 1
    chosen = _readings(*(F.when(several, F.col(f"edges.{c}")) for c in ("start", "length", "weight")))
    chains = chains.withColumn("chosen", F.coalesce(chosen, F.array(F.lit(0))))
    picked = F.transform("chosen", lambda i: F.get(F.col("edges"), i))
    words = F.transform(picked, lambda e: F.struct(e["start"].alias("start"), e["length"].alias("length")))
    chains = chains.select("key", words.alias("words"))
    return chains.groupBy("key").agg(F.sort_array(F.flatten(F.collect_list("words"))).alias("words"))


def segments(runs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(run, tokens) of the distinct texts ``run``, by a ``dictionary`` of (word, weight)."""
    runs = runs.where(F.length("run") > 0).select("run").distinct()
    runs = runs.select(F.sha2("run", 256).alias("key"), "run")
    found = runs.join(best_words(lattice(runs, dictionary)), "key", "left")

    def span(start, length):
        return F.struct(start.cast("int").alias("start"), length.cast("int").alias("length"))

    none = F.expr("CAST(array() AS array<struct<start:int,length:int>>)")
    marks = F.concat(
        F.array(span(F.lit(1), F.lit(0))),
        F.coalesce("words", none),
        F.array(span(F.length("run") + 1, F.lit(0))),
    )
    found = found.select("run", marks.alias("marks"))

    def with_gap(mark, i):
        end = mark["start"] + mark["length"]
        until = F.coalesce(F.get(F.col("marks"), i + 1)["start"], end)
        return F.array(span(mark["start"], mark["length"]), span(end, until - end))

    spans = F.filter(F.flatten(F.transform("marks", with_gap)), lambda s: s["length"] > 0)
    tokens = F.transform(spans, lambda s: F.col("run").substr(s["start"], s["length"]))
    return found.select("run", tokens.alias("tokens"))
