
import pytest

import corpus_pipeline
from martflow.llm import byte_language as lang
from test_line_frequency import brute as brute_lines
from test_mixing import brute as brute_mix
from test_near_texts import brute as brute_near

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it made."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        made = spark.read.parquet(f"{folder}/{name}")
        found.append((docs, made))
        docs = made
    return found


def test_columns_are_kept(stages):
    for docs, made in stages[:-1]:
        assert made.columns == docs.columns
        assert made.dtypes == docs.dtypes


def test_quality_stage(stages):
    docs, made = stages[0]
    given = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    kept = {r[0] for r in brute_lines(given) if r[-1]}
    assert sorted(r.doc_id for r in made.collect()) == sorted(kept)
    assert len(kept) < len(given)


def test_language_stage(stages):
    docs, made = stages[1]
    net = lang.train(lang.sample_stretches(docs))
    judged = {r.doc_id: r for r in lang.predict(docs, net).collect()}
    want = [d for d, r in judged.items() if r.lang_pred != "und" and r.score >= lang.LEAST_SCORE]
    assert sorted(r.doc_id for r in made.collect()) == sorted(want)
    assert len(want) >= 0.99 * len(judged)


def test_near_duplicate_stage(stages):
    docs, made = stages[2]
    group = brute_near([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in made.collect()) == sorted(set(group.values()))


def test_mix_stage(stages):
    docs, made = stages[3]
    given = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = sorted(d for d, size, _, _, taken in brute_mix(given) for _ in range(taken // max(size, 1)))
    assert sorted(r.doc_id for r in made.collect()) == want


def test_pack_stage(stages):
    docs, made = stages[4]
    taken = [(r.doc_id, r.text) for r in docs.collect()]
    texts = dict(taken)
    got = made.collect()
    copies = {d: sum(1 for x, _ in taken if x == d) for d in texts}
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = {d: sum(r.length for r in got if r.doc_id == d) for d in texts}
    doc_tokens = {r.doc_id: r.doc_tokens for r in got}
    assert total == {d: doc_tokens[d] * copies[d] for d in texts}


def test_whole_run(spark, stages):
    ran = corpus_pipeline.run(spark, FOLDER)
    assert sorted(rows(ran), key=str) == sorted(rows(stages[-1][1]), key=str)


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
