import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("martflow.llm.periodic_runs")
from martflow.llm import periodic_runs  # noqa: E402

DOCS = "doc_id long, text string, runs string, n_words long, collapsed long"


def brute(words, least=12):
    """Every period at every place."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w = np.array([ids[x] for x in words], np.int64)
    n, found = len(w), []
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = e - s + q
            if length < max(least, 2 * q):
                continue
            own = w[s : s + length]
            if not any((own[p:] == own[:-p]).all() for p in range(1, q)):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = [] if text is None else text.encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, words):
    runs = brute(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = (hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept))
    return (doc_id, len(runs), *best, milli, *digests)


def found_in(texts, least=12):
    numbers, ends = periodic_runs._numbered(texts)
    rows = periodic_runs.runs_of(numbers, ends, least)
    starts = np.concatenate([[0], ends])
    out = []
    for n in range(len(texts)):
        own = rows[(rows[:, 0] >= starts[n]) & (rows[:, 0] < starts[n + 1])]
        out.append([(s - int(starts[n]), length, q) for s, length, q in own.tolist()])
    return out


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4),
    st.integers(2, 12),
)
def test_runs_of_texts_of_few_words(texts, least):
    texts = [[w.encode() for w in words] for words in texts]
    assert found_in(texts, least) == [brute(words, least) for words in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=7), st.integers(1, 9)), max_size=6))
def test_runs_of_repeated_blocks(blocks):
    words = [w.encode() for block, times in blocks for w in block * times]
    assert found_in([words, words]) == [brute(words)] * 2


def test_fibonacci_words():
    a, b = "x", "xy"
    for _ in range(12):
        a, b = b, b + a
    words = [w.encode() for w in b]
    assert found_in([words], 2) == [brute(words, 2)]


def test_many_equal_words_take_little_more_than_their_number():
    n = 200_000
    assert found_in([[b"w"] * n]) == [[(0, n, 1)]]
    block = [str(i % 700).encode() for i in range(n)]
    assert found_in([block]) == [[(0, n, 700)]]


def test_chunks_of_ordered_positions():
    rng = np.random.default_rng(3)
    places = rng.permutation(5000).tolist()
    held = periodic_runs.Positions(places[0])
    for n, place in enumerate(places[1:2000], 1):
        before = max((p for p in places[:n] if p < place), default=-1)
        after = min((p for p in places[:n] if p > place), default=-1)
        assert held.around(place) == (before, after)
        held.add(place)
    assert list(held) == sorted(places[:2000])


ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "a b " * 20),
    (4, "a b " * 20),
    (None, "q " * 30),
    (5, "a b c d e f a b c d e f"),
    (5, "a b c d e a b c d e a"),
    (6, "é     " * 9 + "x\x0b\x0cy " * 9),
    (7, "one two three " * 7000),
    (8, " ".join(str(i * i % 97) for i in range(900))),
    (9, "x x x x y x x x x y z " * 3),
]


@pytest.mark.parametrize("at_once", [300_000, 50])
def test_rows(spark, monkeypatch, at_once):
    monkeypatch.setattr(periodic_runs, "_WORDS_AT_ONCE", at_once)
    docs = spark.createDataFrame([(*r, "r", 1, 2) for r in ROWS], DOCS)
    got = periodic_runs.run_digests(periodic_runs.find_runs(docs)).collect()
    want = [expected(d, (t or "").encode().split()) for d, t in ROWS]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_spans_and_texts(spark):
    docs = spark.createDataFrame([(1, "see " + "a b c " * 5 + "end", "", 1, 1)], DOCS)
    row = periodic_runs.find_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)]
    assert (row.n_words, row.collapsed) == (17, "see a b c end")


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert periodic_runs.run_digests(periodic_runs.find_runs(docs)).count() == 0


def test_query_on_whole_table(spark):
    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    got = periodic_runs.op11_periodic_runs(spark, "/root/testdata/sf0.001")
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    got = sorted(map(tuple, got.collect()))
    want = sorted(expected(d, planted(d, t)) for d, t in rows)
    assert got == want
    assert sum(r[1] > 0 for r in want) >= len(rows) // 20
