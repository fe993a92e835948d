import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from martflow.llm import token_shards, tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, n_tokens string, shard string"
ODD = [
    "",
    "  \n\t ",
    "Plain words, and. more",
    "it's <|endoftext|> <|ENDOFTEXT|>x, don't.'s",
    "é é İstanbul ŉ ﬁ ́a .́ ÉCOLE,",
    "a b c\x1cd\x85e",
    "x" * 5000,
    "日本語 テスト 123 4.5,6",
    "Word. word, WORD.. word., .word",
]


def whole(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    return [e.ids for e in found]


def by_words(texts):
    import pyarrow as pa

    flat, counts = tokens.encoder(PATH)(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    return [flat[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)]


def test_ids_by_words_are_ids_of_whole_texts():
    assert by_words(ODD) == whole(ODD)
    assert by_words([None, "a"]) == [[], whole(["a"])[0]]
    assert by_words([]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé.,'s <|>́\n1İ 日-", max_size=25), min_size=1))
def test_ids_by_words_on_any_text(texts):
    assert by_words(texts) == whole(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=1024), st.floats(0, 1))
def test_block_round_trip(ids, fit):
    ids = np.array(ids, np.uint32)
    assert token_shards.unpack_block(memoryview(token_shards.pack_block(ids, fit))).tolist() == (
        ids.tolist()
    )


def test_outliers_are_exceptions_and_cost_little():
    ids = np.arange(1000, dtype=np.uint32) % 16 + 7
    ids[::20] = 4_000_000_000
    assert len(token_shards.pack_block(ids)) < 1000 // 2 + 50 * 6 + 20


def expected(rows):
    rows = sorted(
        ((d, ids + [1]) for (d, _), ids in zip(rows, whole([t or "" for _, t in rows]), strict=True)),
        key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()),
    )
    out, start = [], 0
    for doc, ids in rows:
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_written_and_read_back(spark, tmp_path, shard_bytes):
    rows = [(i * 7 % 40, ODD[i % len(ODD)]) for i in range(40)]
    rows += [(None, "no id"), (None, None), (5, "again"), (5, "again"), (-3, "first")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)
    folder = str(tmp_path / "shards")
    shards = token_shards.write_shards(docs, folder, PATH, shard_bytes=shard_bytes)
    got = token_shards.read_shards(shards, folder).drop("shard").collect()
    key = lambda r: r[1]
    assert sorted(map(tuple, got), key=key) == expected(rows)
    assert (shards.count() > 3) == (shard_bytes == 300)


def test_one_stretch_reads_its_blocks_only(tmp_path):
    writer = token_shards.ShardWriter(str(tmp_path), 0)
    ids = np.random.default_rng(1).integers(0, 49_000, 10_000).astype(np.uint32)
    writer.add(1, ids[:3])
    writer.add(2, ids[3:])
    writer.close()
    reader = token_shards.ShardReader(str(tmp_path), 0)
    assert reader.ids(1000, 5000).tolist() == ids[1000:5000].tolist()
    assert len(reader.starts) == 10


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    shards = token_shards.write_shards(docs, str(tmp_path / "none"), PATH)
    assert token_shards.read_shards(shards, str(tmp_path / "none")).count() == 0


def test_query_on_whole_table(spark):
    import duckdb

    got = token_shards.op1_token_shards(spark, "/root/testdata/sf0.001")
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    got = [tuple(r)[:4] for r in got.collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
