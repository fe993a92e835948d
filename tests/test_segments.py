import random

import pytest
from pyspark.sql import functions as F

from martflow.operators import keywords
from martflow.operators.segments import reading, segments

SCHEMA = "word string, weight long, run int, tokens string, key string"


def brute(run, words):
    """The best of all readings of a run."""
    found = []

    def extend(place, steps):
        if place == len(run):
            outside = sum(n == 0 for n in steps)
            taken, at = [], 0
            for n in steps:
                taken.append(run[at : at + n] if n else "")
                at += n or 1
            weight = sum(words[t] for t in taken if t)
            found.append((outside, sum(n > 0 for n in steps), -weight, [-n for n in steps], steps))
            return
        extend(place + 1, [*steps, 0])
        for word in words:
            if run.startswith(word, place):
                extend(place + len(word), [*steps, len(word)])

    extend(0, [])
    tokens, at, gap = [], 0, ""
    for n in min(found)[-1]:
        if n:
            tokens += [gap] if gap else []
            tokens.append(run[at : at + n])
            gap = ""
        else:
            gap += run[at]
        at += n or 1
    return tokens + ([gap] if gap else [])


def read(spark, runs, words):
    given = [(w, n, 1, "t", "k") for w, n in words]
    texts = spark.createDataFrame([(r, "w", 1) for r in runs], "run string, word string, weight int")
    rows = segments(texts, spark.createDataFrame(given, SCHEMA)).collect()
    assert len(rows) == len({r.run for r in rows})
    return {r.run: r.tokens for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_readings(spark, seed):
    draw = random.Random(seed)
    letters = ["ab", "abc", "é云𝒂b"][seed - 1]

    def text(most):
        return "".join(draw.choices(letters, k=draw.randint(1, most)))

    words = {text(4): draw.randint(0, 3) for _ in range(6)}
    runs = [text(9) for _ in range(150)]
    assert read(spark, runs, words.items()) == {r: brute(r, words) for r in runs}


def test_a_reading_is_chosen_by_each_rule(spark):
    words = [("ab", 1), ("cd", 1), ("abc", 1), ("bcd", 9), ("a", 5), ("xy", 1), ("yz", 4), ("mn", 1), ("nop", 1), ("m", 1), ("op", 1)]
    got = read(spark, ["abcd", "xyz", "mnop", "qabq", "q"], words)
    assert got == {
        "abcd": ["a", "bcd"],  # both cover it in two words; more weight
        "xyz": ["x", "yz"],  # one character is left out either way
        "mnop": ["mn", "op"],  # as many words, as much weight; the longer first
        "qabq": ["q", "ab", "q"],
        "q": ["q"],
    }


def test_nulls_repeats_and_empty_tables(spark):
    words = [("ab", None), ("ab", 3), ("ba", 2), (None, 9), ("", 9)]
    assert read(spark, [None, "", "aba", "aba"], words) == {"aba": ["ab", "a"]}
    assert read(spark, ["aba"], []) == {"aba": ["aba"]}
    assert read(spark, [], words) == {}


def test_long_chains_end(spark):
    run = "a" * 6000
    got = read(spark, [run], [("a", 1), ("aa", 1), ("aaa", 1)])[run]
    assert got == ["aaa"] * 2000
    assert reading([1, 2], [2, 2], [0, 5]) == [1]


def test_searches_keep_their_times_and_counts(spark):
    found = spark.createDataFrame(
        [("Redring blue", 1), ("redring", 2), ("--", 3), (None, 4)], "fullword string, ts long"
    )
    words = spark.createDataFrame([("red", 1), ("ring", 1)], "word string, weight int")
    got = keywords.keyword_segments(found, words)
    assert sorted(map(tuple, got.collect())) == [("blue", 1), ("red", 1), ("red", 2), ("ring", 1), ("ring", 2)]
    hot = spark.range(20_000).select(F.lit("redring").alias("fullword"), F.col("id").alias("ts"))
    assert keywords.keyword_segments(hot, words).count() == 40_000
