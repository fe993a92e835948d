import re
from collections import Counter, defaultdict

import pytest
from compare import connect, spark_rows, sql_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.llm import line_frequency as lf

SCHEMA = "doc_id long, text string, source string, n_words string, line int, c0 string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_measures(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    held = {
        i + k
        for i in range(len(words) - 4)
        if grams[tuple(words[i : i + 5])] > 1
        for k in range(5)
    }
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(held),
    )


def plain(line):
    ascii_lower = "".join(c.lower() if c.isascii() else c for c in line)
    return " ".join(WORD.findall(ascii_lower))


def brute(rows):
    """[(doc_id, measures..., base_failed, removed, kept)] of (doc_id, text, host) rows."""
    texts, holders = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text)
        for line in (text or "").split("\n"):
            if plain(line):
                holders[host, plain(line)].add(text)
    often = {k for k, v in holders.items() if len(v) > 20 and len(v) > 0.1 * len(texts[k[0]])}
    for doc, text, host in rows:
        m = brute_measures(text)
        base = m[0] < 10 or 100 * m[4] > 20 * m[0]
        removed = sum(
            len(WORD.findall(x)) for x in (text or "").split("\n") if (host, plain(x)) in often
        )
        rest = m[0] - removed
        gone = removed > 0 and (rest < 10 or rest < 0.3 * m[0])
        yield (doc, *m, base, removed, not base and not gone)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab |É\n\t\x0b\x1c#", max_size=60), max_size=6))
def test_measures(texts):
    import pyarrow as pa

    found, _ = lf.measure(pa.array(texts, pa.string()))
    got = list(zip(*(found[m].tolist() for m in lf.MEASURES), strict=True)) if texts else []
    assert got == [brute_measures(t) for t in texts]


def rows_of_a_host():
    filler = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(60)]
    menu = "Share THIS  page " + " ".join(f"menu{k}" for k in range(30))
    rows = [(i, f"{menu}\n{filler[i]}", "a.org") for i in range(40)]
    own = "only a few own words stand here below the menu"
    rows += [(100 + i, f"{menu.lower()}\n{own} {i}", "a.org") for i in range(3)]
    rows += [(200 + i, f"{menu}\n{filler[i]}", "b.org") for i in range(15)]
    rows += [(300, filler[50] + "\n" + "copied line of eleven words is here for a while yes", "a.org")] * 30
    rows += [(400, None, "a.org"), (None, filler[51], None), (None, None, None), (401, "", "b.org")]
    rows += [(500, "long " + " ".join(map(str, range(30_000))), "b.org")]
    return rows


def as_tuples(df):
    return sorted(
        (tuple(r[c] for c in ("doc_id", *lf.MEASURES, "base_failed", "n_removed_words", "kept"))
         for r in df.collect()),
        key=str,
    )


def test_verdicts_against_brute_force(spark):
    rows = rows_of_a_host()
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = as_tuples(lf.judge(docs))
    assert got == sorted(brute(rows), key=str)
    gone = {r[0] for r in got if not r[-1] and not r[-3]}
    assert gone == {100, 101, 102}, "boilerplate takes these, and no base rule does"


def test_stage_keeps_columns_and_the_good(spark):
    rows = rows_of_a_host()
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    kept = lf.keep_good(docs)
    assert kept.columns == docs.columns
    good = [(r[0]) for r in brute(rows) if r[-1]]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, good))


def test_stage_takes_boilerplate_out_of_texts(spark):
    rows = rows_of_a_host()
    menu, rest = rows[0][1].split("\n")
    rows += [(600, f"\n{rest}\r\n\n \t{menu.upper()}\nlast É line\n", "a.org")]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = lf.keep_good(docs).collect()
    want = []
    for (doc, text, host), verdict in zip(rows, brute(rows), strict=True):
        if verdict[-1]:
            taken = {plain(menu)} if host == "a.org" else set()
            kept = [x for x in text.split("\n") if plain(x) not in taken]
            want.append((doc, "\n".join(kept), host))
            assert verdict[-2] == len(WORD.findall(text)) - len(WORD.findall(want[-1][1]))
    assert sorted(((r.doc_id, r.text, r.source) for r in got), key=str) == sorted(want, key=str)
    assert {r.text for r in got if r.doc_id == 600} == {f"\n{rest}\r\n\nlast É line\n"}
    assert any("menu1" in r.text for r in got), "the line is no boilerplate of the other host"


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lf.judge(docs).count() == 0
    assert lf.keep_good(docs).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_against_sql(spark, folder):
    got = spark_rows(lf.op9_line_frequency(spark, folder))
    assert got == sql_rows(connect(folder), lf.OP9_SQL)
