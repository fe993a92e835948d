import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from compare import connect, spark_rows, sql_rows

from martflow.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies int, mark string"


def brute_targets(sizes, weights=(3, 1, 2)):
    """Hand out the budget by weight; what exceeds a cap goes round again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in full]
        if not left:
            return full
        rest = budget - sum(full.values())
        shares = {s: rest * weight[s] / sum(weight[t] for t in left) for s in left}
        over = {s: Fraction(2 * sizes[s]) for s in left if shares[s] > 2 * sizes[s]}
        if not over:
            return full | shares
        full |= over


def size_of(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    targets = brute_targets(dict(sizes))
    out = []
    for source in sizes:
        own = [(size_of(t), mark(d, t), d is not None, d or 0) for d, t, s in rows if s == source]
        step = math.floor(float(targets[source]) / sizes[source] * 2**24) if sizes[source] else 0
        at = int(hashlib.md5(f"mix-1|{source or ''}".encode()).hexdigest()[:6], 16)
        for size, _, known, doc in sorted(own):
            copies = (at + step) // 2**24 - at // 2**24
            at += step
            doc = doc if known else None
            out.append((doc, size, sizes[source], float(targets[source]), copies * size))
    return out


def mark(doc, text):
    told = "|".join(str(x) for x in ("mix-1", doc, text) if x is not None)
    return hashlib.md5(told.encode()).hexdigest()


def as_tuples(rows):
    names = ("doc_id", "size", "source_size", "target", "taken")
    return sorted((tuple(r[n] for n in names) for r in rows), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 9, "y") for r in rows], SCHEMA)


ROWS = (
    [(i, "w " * (i % 7), "hot") for i in range(300)]
    + [(1000 + i, "word " * 40, "b") for i in range(20)]
    + [(2000 + i, f"{i} a\x0bb\tc", "small") for i in range(3)]
    + [(3000, None, "hot"), (None, "no id", "b"), (None, None, None), (3001, "", None)]
    + [(3002, "none has this source", None), (4000, "same row", "b")]
    + [(4000, "same row", "b")] * 5
    + [(5000, "x " * 20_000, "c"), (5001, "  \x1c", "empty?"), (5002, None, "nothing")]
)


def test_against_brute_force(spark):
    docs = frame(spark, ROWS)
    got = mixing.mixed(docs).collect()
    want = sorted(brute(ROWS), key=str)
    assert [r[:3] + r[4:] for r in as_tuples(got)] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in as_tuples(got)] == pytest.approx([r[3] for r in want])
    assert max(r.copies for r in got) <= 2
    assert as_tuples(mixing.mixed(docs.repartition(7)).collect()) == as_tuples(got)


@pytest.mark.parametrize("seed", range(8))
def test_targets_of_many_sources(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": int(rng.paretovariate(0.5)) for i in range(rng.randint(1, 40))}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    want = brute_targets(sizes)
    assert got == {s: pytest.approx(float(want[s])) for s in sizes}
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_words_come_near_targets(spark):
    taken, target, largest = Counter(), {}, Counter()
    source = {r[0]: r[2] for r in ROWS}
    for r in mixing.mixed(frame(spark, ROWS)).collect():
        own = source[r.doc_id] if r.doc_id is not None else (r.size and "b" or None)
        taken[own] += r.taken
        target[own] = r.target
        largest[own] = max(largest[own], r.size)
        assert r.taken <= 2 * r.size
    for own in target:
        assert abs(taken[own] - target[own]) <= 2 * largest[own] + 1e-6


def test_stage_repeats_rows(spark):
    docs = frame(spark, ROWS)
    out = mixing.take_mix(docs)
    assert out.columns == docs.columns
    wanted = Counter()
    for r in mixing.mixed(docs).collect():
        wanted[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +wanted


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(docs).count() == 0
    assert mixing.take_mix(docs).count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert spark_rows(mixing.op10_systematic_mix(spark, folder)) == sql_rows(
        connect(folder), mixing.OP10_SQL
    )
