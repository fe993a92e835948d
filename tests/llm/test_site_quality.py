import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import site_quality as site

DOCS = "doc_id long, text string, source string, lang string, quality string, n_toxic int"
LABELS = "doc_id long, quality int, toxic int"


def brute_strength(groups):
    """groups: (n, s, parent rate)."""
    groups = [g for g in groups if g[0]]
    distance = sum((s - n * p) ** 2 / n for n, s, p in groups)
    chance = sum(p * (1 - p) for _, _, p in groups)
    slope = sum(p * (1 - p) * (n - 1) for n, _, p in groups)
    if not slope:
        return 10_000.0
    share = (distance - chance) / slope
    return 10_000.0 if share <= 1 / 10_001 else 1.0 if share >= 0.5 else 1 / share - 1


def brute_sites(docs, labels, target):
    """{row number: posterior of the document's path without its own labels}."""
    own = defaultdict(lambda: [0, 0])
    for doc, *values in labels:
        value = values[target]
        if doc is not None and value is not None:
            own[doc][0] += 1
            own[doc][1] += value > 0
    mine = [own[d[0]] if d[0] is not None and d[0] in own else [0, 0] for d in docs]
    host, path = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (_, _, h, p), (n, s) in zip(docs, mine, strict=True):
        for key, table in ((h, host), ((h, p), path)):
            table[key][0] += n
            table[key][1] += s
    rate = (sum(s for _, s in host.values()) + 0.5) / (sum(n for n, _ in host.values()) + 1)
    k = brute_strength([(n, s, rate) for n, s in host.values()])
    host_rate = {h: (s + k * rate) / (n + k) for h, (n, s) in host.items()}
    kp = brute_strength([(n, s, host_rate[h]) for (h, _), (n, s) in path.items()])
    out = []
    for (_, _, h, p), (n, s) in zip(docs, mine, strict=True):
        of_host = (host[h][1] - s + k * rate) / (host[h][0] - n + k)
        out.append((path[h, p][1] - s + kp * of_host) / (path[h, p][0] - n + kp))
    return rate, out


def small_world():
    draw = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(300):
        host = f"h{draw.integers(0, 8)}"
        good = draw.random() < (0.9 if host < "h4" else 0.3)
        toxic = draw.random() < 0.2
        words = [f"w{draw.integers(0, 40)}" for _ in range(30)]
        text = " ".join(words + (["vile"] * 2 if toxic else []))
        docs.append((i, text if good else text.upper().replace(" ", "!! "), host, f"p{i % 3}"))
        if draw.random() < 0.7:
            labels.append((i, int(good), int(toxic)))
    docs += [(900, None, "h1", None), (None, "no id here", None, None), (901, "", "new", "p0")]
    docs += [(902, "same row", "h2", "p1")] * 3 + [(903, "long " * 30_000, "h3", "p2")]
    labels += [(None, 1, 1), (7777, 0, 1), (3, None, 1), (902, 1, None), (5, 1, 0), (5, 0, 0)]
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS),
        spark.createDataFrame(labels, LABELS),
    )


def test_posteriors_against_brute_force(spark):
    docs, labels = small_world()
    got = site.judge(*frames(spark, docs, labels)).collect()
    assert len(got) == len(docs)
    for target, name in enumerate(site.TARGETS):
        rate, want = brute_sites(docs, labels, target)
        by_id = defaultdict(list)
        for (doc, *_), value in zip(docs, want, strict=True):
            by_id[doc].append(value)
        for r in got:
            assert any(r[f"site_{name}"] == pytest.approx(v) for v in by_id[r.doc_id])
            odds = r[f"text_{name}"] / (1 - r[f"text_{name}"])
            odds *= r[f"site_{name}"] / (1 - r[f"site_{name}"]) / (rate / (1 - rate))
            assert r[name] == pytest.approx(odds / (1 + odds))
    for r in got:
        assert r.kept == (r.quality >= site.LEAST_QUALITY and r.toxic <= site.MOST_TOXIC)


def test_sparse_sites_shrink(spark):
    docs = [(i, "same text", "big", "a") for i in range(400)]
    docs += [(1000 + i, "same text", f"s{i % 40}", "a") for i in range(80)]
    labels = [(d[0], int(d[0] % 10 < 9), 0) for d in docs[:400]]
    labels += [(d[0], int(d[2] < "s2"), 0) for d in docs[400:]]
    got = {r.doc_id: r for r in site.judge(*frames(spark, docs, labels)).collect()}
    low = np.mean([got[d[0]].site_quality for d in docs[400:] if d[2] >= "s2"])
    assert 0.1 < low < 0.8, "one other label pulls a site, but not all the way"
    assert got[0].site_quality == pytest.approx(0.9, abs=0.03)


def test_no_labels_and_no_rows(spark):
    docs, _ = small_world()
    some, none = frames(spark, docs, [(None, None, None)])
    got = site.judge(some, none.limit(0)).collect()
    assert {(r.quality, r.toxic, r.kept) for r in got} == {(0.5, 0.5, True)}
    assert site.judge(some.limit(0), none).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    got = site.judge(docs, labels.filter(fold != 2)).collect()
    got = {r.doc_id: r for r in got}
    held_out = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good = np.mean([(got[r.doc_id].quality >= 0.5) == r.quality for r in held_out])
    toxic = np.mean([(got[r.doc_id].toxic > site.MOST_TOXIC) == r.toxic for r in held_out])
    clean = [got[r.doc_id].kept for r in held_out if r.quality and not r.toxic]
    print("held-out accuracy", good, toxic, np.mean(clean), len(held_out))
    assert good >= 0.98 and toxic >= 0.96 and np.mean(clean) >= 0.98
    assert not any(math.isnan(r.quality) or math.isnan(r.toxic) for r in got.values())
