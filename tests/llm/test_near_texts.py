import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from martflow.llm import near_texts as near

SCHEMA = "doc_id long, text string, id string, words int, kept string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def grams(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else {}


def brute_similarity(a, b):
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    x, y = ({g: 1 + math.log(n) for g, n in m.items()} for m in (a, b))
    weighted = sum(
        1 / sum(max(x.get(h, 0) / x[g], y.get(h, 0) / y[g]) for h in x.keys() | y.keys())
        for g in x.keys() & y.keys()
    )
    return plain, weighted


def brute(rows):
    """{doc_id: least doc_id of its group} by all pairs."""
    sets = {d: grams(t) for d, t in rows}
    group = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and max(brute_similarity(sets[a], sets[b])) >= 0.8:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return group


def words(rng, n):
    return [f"w{rng.randint(0, 3000)}" for _ in range(n)]


def edited(rng, base, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in base]


def corpus():
    rng = random.Random(7)
    rows = []
    for share in (0.0, 0.004, 0.01, 0.02, 0.03, 0.06):
        base = words(rng, 200)
        rows += [" ".join(edited(rng, base, share)) for _ in range(8)]
    step = words(rng, 300)  # a chain: neighbours are near, the ends are not
    for _ in range(12):
        rows.append(" ".join(step))
        step = step[18:] + words(rng, 18)
    rows += [" ".join(words(rng, rng.choice([1, 3, 4, 5, 6, 30, 400]))) for _ in range(40)]
    spam = ["buy", "now", "and", "save", "more", "today"]
    rows += [" ".join(spam * k + words(rng, 3)) for k in (5, 40, 200)]
    rows += ["One two  three", "one TWO three", "", "  \n", "É a b c d e", "é a b c d e"]
    rows += [" ".join(words(rng, 30_000))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_similarity_against_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        base = [f"w{rng.randint(0, 4)}" for _ in range(rng.randint(1, 60))]
        pair = [" ".join(edited(rng, base, 0.1)) for _ in range(2)]
        docs, found, times, _ = near.shingles(pa.array(pair))
        one, two = ((found[docs == i], times[docs == i]) for i in range(2))
        got = near.similarity(*one, *two)
        assert got == pytest.approx(brute_similarity(*map(grams, pair)))


def test_shingles_against_brute_force():
    texts = [t for _, t in corpus()] + [None]
    docs, found, times, keys = near.shingles(pa.array(texts))
    seen = {}
    for i, text in enumerate(texts):
        own = grams(text)
        assert sorted(own.values()) == sorted(times[docs == i].tolist())
        assert len(own) == len(set(found[docs == i].tolist()))
        assert (keys[i] == b"") == (not own)
        for other, hashes in seen.items():
            shared = len(grams(texts[other]).keys() & own.keys())
            assert shared == len(np.intersect1d(found[docs == i], hashes))
        if i % 10 == 0:
            seen[i] = found[docs == i]


def test_a_slice_is_read_like_a_copy():
    texts = pa.array([t for _, t in corpus()] * 40)
    part = texts.slice(2500, 700)
    for got, want in zip(near.shingles(part), near.shingles(pa.array(part.to_pylist())), strict=True):
        assert np.array_equal(got, want)


def test_registers_estimate_probability_jaccard():
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 60)}" for _ in range(300)]
    pair = [" ".join(edited(rng, base, 0.05)) for _ in range(2)] + [" ".join(base[:2])]
    docs, found, times, _ = near.shingles(pa.array(pair))
    signs = near.signatures(docs, found, 1 + np.log(times), 3, 4000)
    _, wanted = brute_similarity(grams(pair[0]), grams(pair[1]))
    assert (signs[0] == signs[1]).mean() == pytest.approx(wanted, abs=0.04)
    again = near.signatures(docs[docs == 1] - 1, found[docs == 1], 1 + np.log(times[docs == 1]), 1, 4000)
    assert (again[0] == signs[1]).all(), "a signature does not hang on the texts beside it"


def by_group(got):
    groups = defaultdict(list)
    for r in got:
        groups[r.class_id].append(r)
    return groups


@pytest.mark.parametrize("block", [256, 3])
def test_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "_BLOCK", block)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found, links = near.near_duplicates(docs)
    got = found.collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    for members in by_group(got).values():
        assert [r.doc_id for r in members if r.kept] == [min(r.doc_id for r in members)]
        assert {r.n_copies for r in members} == {len(members)}
    for r in links.collect():
        assert max(r.jaccard, r.probability_jaccard) >= 0.8


def test_stage_on_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (2, text.upper()), (None, text), (None, None), (None, "alone at last")]
    rows += [(3, None), (3, None), (4, ""), (5, "other words"), (5, "other words"), (None, "alone at last")]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(1, text), (None, None), (None, "alone at last"), (3, None), (3, None), (4, ""), (5, "other words")]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near.near_duplicates(docs)[0].count() == 0
    assert near.keep_one(docs).count() == 0


def test_query_against_brute_force(spark):
    import duckdb

    got = near.op6_probminhash(spark, "/root/testdata/sf0.001").collect()
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
