import random
import re

import pytest

from martflow.llm import license_scan as scan

SCHEMA = "doc_id long, text string, n_words string, found int, label string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text):
    """Every rule at every word; every detection against every other."""
    words = words_of(text)
    plain = " " + " ".join(words) + " " if words else " "
    starts = [i for i, c in enumerate(plain) if c == " "][: len(words)]
    found = []
    for rule in scan.rules():
        pattern, at = re.compile(rule.pattern), 0
        while match := pattern.search(plain, at):
            first = starts.index(match.start())
            found.append((rule, first, first + match.group().count(" ") - 1))
            at = match.end()

    def inside(a, b):
        if b is a or not (b[1] <= a[1] and a[2] <= b[2]):
            return False
        if b[1:] != a[1:]:
            return b[0].priority >= a[0].priority
        return (-b[0].priority, b[0].number) < (-a[0].priority, a[0].number)

    stand = [a for a in found if not any(inside(a, b) for b in found)]
    phrases = [(p.split(), label) for p, label, _ in scan.BASE]
    base = [(i, n) for p, n in phrases for i in range(len(words)) if words[i : i + len(p)] == p]
    labels = {n for _, n in base} | {r.label for r, _, _ in stand}
    weights = [r.weight for r, _, _ in stand] + [1.0 for _ in base]
    return (
        len(words), len(base),
        min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
        ",".join(sorted({n for _, n in base})), ",".join(sorted(labels)),
        max(weights, default=0.0), len(found), len(stand),
    )


def texts():
    rng = random.Random(2)
    bits = (
        "Licensed under the Apache License, Version 2.0.|Released under the MIT License|CC BY-NC 4.0|"
        "CC-BY-NC-SA 4.0|SPDX-License-Identifier: MIT license|GNU General Public License, version 3|"
        "see the Mozilla Public License v 2.0 for|Creative Commons Attribution-NonCommercial|"
        "under the|mit|license|apache|cc|by|nc|the terms of the BSD 3-clause license|word|É accès|"
        "under the MIT licence|2.0|version|under|cc by"
    ).split("|")
    out = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    out += [rng.choice(["-", "\n", "/"]).join(rng.choice(bits) for _ in range(9)) for _ in range(50)]
    out += [None, "", " \t", "!!", "cc by nc", "CC BY NC", "UNDER\x00THE\x7fMIT`LICENSE", "ccby nc"]
    out += ["under the mit license", "K cc by nc", "xcc by nc cc by ncx", "İ cc by nc"]
    out += ["cc by nc " * 3000, "plain words only " * 4000]
    return out


def test_there_are_hundreds_of_rules():
    known = scan.rules()
    assert len(known) > 300
    for rule in known:
        assert re.compile(rule.pattern)


def matches(pattern):
    """All texts of a pattern of literals, choices and options."""
    from re import _constants as kind
    from re import _parser as parser

    def all_of(parts):
        made = [""]
        for part in parts:
            made = [a + b for a in made for b in one(*part)]
        return made

    def one(op, value):
        if op is kind.LITERAL:
            return [chr(value)]
        if op is kind.IN:
            return [chr(c) for _, c in value]
        if op is kind.BRANCH:
            return [x for branch in value[1] for x in all_of(branch)]
        if op is kind.SUBPATTERN:
            return all_of(value[3])
        if op is kind.MAX_REPEAT and tuple(value[:2]) == (0, 1):
            return ["", *all_of(value[2])]
        assert op is kind.ASSERT
        return [""]

    return all_of(parser.parse(pattern))


def test_every_match_holds_a_keyword():
    for rule in scan.rules():
        made = matches(rule.pattern)
        assert all(re.match(rule.pattern, f"{m} ") for m in made)
        for match in made:
            assert set(rule.keywords) & set(match.split()), (rule, match)


def test_written_rules_match_whole_and_no_less():
    written = [r for r in scan.rules() if r.number >= 3 + len(scan.PHRASINGS) * len(scan.LICENSES)]
    assert len(written) >= 170 and len({r.pattern for r in written}) == len(written)
    for rule in written:
        for text in matches(rule.pattern):
            words = text.split()
            assert re.match(rule.pattern, f"{text} ")
            shorter = [m for m in matches(rule.pattern) if len(m) < len(text)]
            for some in (words[1:], words[:-1], [*words[:-1], f"{words[-1]}x"]):
                part = " ".join(["", *some, ""])
                if not any(f"{m} " in part for m in shorter):
                    assert not re.search(rule.pattern, part), (rule, part)


def test_written_rules_against_brute_force(spark):
    tables = (scan.OPENINGS, scan.SENTENCES, scan.NOTICES, scan.EXCEPTIONS)
    known = [(label, pattern) for own in tables for label, _, pattern in own]
    known += [(label, f"spdx licen[cs]e identifier {name}") for label, _, name in scan.SPDX]
    rows = [(label, m) for label, pattern in known for m in matches(pattern)[-2:]]
    docs = [(i, f"Some words, {m.upper()}; others.", "x", 1, "y") for i, (_, m) in enumerate(rows)]
    got = scan.license_labels(spark.createDataFrame(docs, SCHEMA)).collect()
    for row in got:
        assert tuple(row)[1:] == brute(docs[row.doc_id][1])
        assert rows[row.doc_id][0] in row.labels.split(","), rows[row.doc_id]


def test_all_names_against_brute_force(spark):
    rows = [x for _, _, name in scan.LICENSES for x in matches(name)]
    rows += ["Licensed under the Expat License.", "GPL2 or GPL3", "LGPL2.1", "LGPL3", "AGPL3", "CDDL1.0"]
    rows = list(enumerate(dict.fromkeys(rows)))
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = {r.doc_id: tuple(r)[1:] for r in scan.license_labels(docs).collect()}
    for i, text in rows:
        assert got[i] == brute(text) and got[i][5], text


def test_written_forms(spark):
    want = {
        "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: MPL-2.0": "mpl-2",
        "SPDX-License-Identifier: Apache-2.0": "apache-2", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3",
        "SPDX-License-Identifier: GPL-2.0-only": "gpl-2", "SPDX-License-Identifier: ISC": "isc",
        "released under GPLv2": "gpl-2", "GPLv3": "gpl-3", "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software)": "mit",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that": "bsd",
        "mit alone says nothing": "",
    }
    rows = list(enumerate(want))
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = {r.doc_id: tuple(r)[1:] for r in scan.license_labels(docs).collect()}
    for i, text in rows:
        assert got[i] == brute(text) and got[i][5] == want[text], text


def test_against_brute_force(spark):
    rows = list(enumerate(t for t in texts() if not t or len(t) < 5000))
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = {r.doc_id: tuple(r)[1:] for r in scan.license_labels(docs).collect()}
    for i, text in rows:
        assert got[i] == brute(text), text


def test_long_texts_and_odd_rows(spark):
    rows = [(None, "Released under the MIT License."), (1, None), (2, "cc by nc " * 3000)]
    rows += [(3, "x"), (3, "x"), (4, "plain words only " * 4000)]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = sorted((tuple(r)[:6] for r in scan.license_labels(docs).collect()), key=str)
    want = [
        (None, 5, 1, 1, 1, "mit"), (1, 0, 0, None, None, ""), (2, 9000, 3000, 0, 8997, "cc-by-nc"),
        (3, 1, 0, None, None, ""), (3, 1, 0, None, None, ""), (4, 12000, 0, None, None, ""),
    ]
    assert got == sorted(want, key=str)
    assert scan.license_labels(docs.limit(0)).count() == 0


def test_no_python_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "x", "x", 1, "y")], SCHEMA)
    plan = scan.license_labels(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)


def test_query_against_brute_force(spark):
    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    want = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    got = scan.op5_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted((d, *brute(t)) for d, t in want)
    assert pytest.approx(1.0) == max(r.score for r in got)


def test_other_capitals_stay(spark):
    """The Kelvin sign is no k."""
    text = "Creative Commons Attribution Share Ali\u212ae"
    docs = spark.createDataFrame([(1, text), (2, text.replace("\u212a", "K"))], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in scan.license_labels(docs).collect()}
    assert got == {1: "cc-by", 2: "cc-by-sa"}


def test_long_texts_dense_in_detections(spark):
    import time

    def seconds(times):
        docs = spark.createDataFrame([(1, "cc by nc " * times)], "doc_id long, text string")
        start = time.time()
        row = scan.license_labels(docs).first()
        assert (row.n_base, row.base_labels) == (times, "cc-by-nc")
        assert row.n_standing == times
        return time.time() - start

    fixed = min(seconds(10) for _ in range(2))
    assert seconds(32_000) < fixed + 20
