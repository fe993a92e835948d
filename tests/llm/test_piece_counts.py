import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from martflow.llm import piece_counts as pieces  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile("[^\x20\x09-\x0d]+")


def library(vocabulary):
    """The tokenizers library's Unigram model; its unknown piece matches no text."""
    from tokenizers import Tokenizer, models

    return Tokenizer(models.Unigram([("\U0010ffff?", 0.0), *vocabulary], 0, False))


def by_library(tokenizer, text):
    return sum(len(tokenizer.encode("▁" + w).ids) for w in WORD.findall(text or ""))


SMALL = [(p, s) for p, s in zip(
    ["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb", "abab", "▁b"],
    [-2.0, -1.0, -1.0, -2.0, -2.0, -3.0, -3.0, -4.0, -1.5, -4.0, -3.0], strict=True,
)]


def brute(word, vocabulary):
    """Best score and fewest-by-rule count over all ways to cut a word, by recursion."""
    scores = dict(vocabulary)
    unknown = min(scores.values()) - 10
    text = "▁" + word
    best = {0: 0.0}
    for end in range(1, len(text) + 1):
        found = [best[s] + scores[text[s:end]] for s in range(end) if text[s:end] in scores]
        if text[end - 1] not in scores:
            found.append(best[end - 1] + unknown)
        best[end] = max(found)
    return best[len(text)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcé▁", max_size=14))
def test_ties_as_in_the_library(word):
    counter = pieces.PieceCounter(SMALL)
    if WORD.fullmatch(word):
        count, _, score = counter.word(word)
        assert count == len(library(SMALL).encode("▁" + word).ids)
        assert score == pytest.approx(brute(word, SMALL))


def test_public_vocabulary_against_the_library():
    vocabulary = pieces.zipf_vocabulary(PATH)
    counter, model = pieces.PieceCounter(vocabulary), library(vocabulary)
    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    texts = [t for (t,) in duckdb.sql(f"select text from '{path}'").fetchall()]
    texts += ["日本語 \U0001f600\U0001f600x \U0001f600", "", " ", "ABC▁▁d " + "x" * 5000]
    import pyarrow as pa

    got = counter(pa.array(texts))
    assert got["n_pieces"].tolist() == [by_library(model, t) for t in texts]
    assert got["n_words"].tolist() == [len(WORD.findall(t)) for t in texts]


def test_odd_rows(spark):
    rows = [(1, "two words"), (None, "no id"), (2, None), (3, ""), (4, "same"), (4, "same")]
    docs = spark.createDataFrame(
        [(*r, 1.5, "n") for r in rows], "doc_id long, text string, score double, n_words string"
    )
    got = pieces.piece_counts(docs, PATH).collect()
    words = sorted((r.doc_id or -1, r.n_words) for r in got)
    assert words == [(-1, 2), (1, 2), (2, 0), (3, 0), (4, 1), (4, 1)]
    assert all(math.isfinite(r.score) and (r.score == 0) == (r.n_words == 0) for r in got)
    assert pieces.piece_counts(docs.limit(0), PATH).count() == 0


def test_query_counts_every_document(spark):
    got = pieces.op7_viterbi_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len({r.doc_id for r in got}) == 200
