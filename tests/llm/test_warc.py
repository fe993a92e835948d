import base64
import gzip
import hashlib
import io
import json
import os
import random

import pytest
from compare import connect, spark_rows, sql_rows
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("martflow.llm.warc")
from martflow.llm import warc  # noqa: E402

PAGES = "page_id long, url string, html string, archive string, number string, record_type int"


def expected(pages):
    firsts, out = {}, []
    order = sorted(range(len(pages)), key=lambda i: (pages[i][0] is None, pages[i][0] or 0))
    for i in order:
        page_id, _, html = pages[i]
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        known = payload in firsts
        first = firsts.setdefault(payload, page_id)
        kind = "revisit" if known else "response"
        out.append((page_id, len(payload), digest, kind, first if known else None))
    return sorted(map(str, out))


def archived(spark, pages, folder, **sizes):
    frame = spark.createDataFrame([(*p, "x", "y", 1) for p in pages], PAGES)
    records = warc.write_archives(frame, f"{folder}/streams", **sizes)
    archives = warc.normalise(records, warc.repeated(records), f"{folder}/streams", f"{folder}/members")
    return records, archives, warc.read_archives(archives, f"{folder}/members")


ODD = [
    (1, "http://a.example/x y\r\nz", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "http://b.example/", None),
    (4, "", ""),
    (5, "u", "é日本\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "u", "é日本\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "u", "only null"),
    (None, "u", "only null"),
    (None, "u", "<p>one</p>"),
    (7, "u", "same row"),
    (7, "u", "same row"),
    (-3, "http://ü.example/ß", "negative"),
    (8, "u", "".join(chr(random.Random(5).randrange(32, 9000)) for _ in range(3)) * 400_000),
    (9, "u", "negative"),
]


@pytest.mark.parametrize("sizes", [{}, {"archive_records": 2}, {"archive_bytes": 20}])
def test_written_and_read_back(spark, tmp_path, sizes):
    records, archives, got = archived(spark, ODD, tmp_path, **sizes)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(ODD)
    assert records.count() == len(ODD)
    if sizes:
        assert archives.count() >= 7


def test_members_stand_where_the_index_says(spark, tmp_path):
    pages = [(i, f"http://a.example/{i}", f"page {i % 7} " * 50) for i in range(100)]
    _, archives, _ = archived(spark, pages, tmp_path)
    seen = 0
    for row in archives.collect():
        path = f"{tmp_path}/members/{row.archive}"
        data = open(path, "rb").read()
        assert os.path.getsize(path) == row.bytes
        at = 0
        for line in map(json.loads, open(f"{path}.idx")):
            assert line["offset"] == at
            record = gzip.decompress(data[at : at + line["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert f"WARC-Type: {line['type']}\r\n".encode() in record
            assert line["id"].encode() in record
            at += line["length"]
            seen += 1
        assert at == len(data)
    assert seen == 100


def test_streams_are_single_members(spark, tmp_path):
    pages = [(i, "u", f"page {i}") for i in range(20)]
    records, _, _ = archived(spark, pages, tmp_path)
    for (name,) in records.select("archive").distinct().collect():
        data = open(f"{tmp_path}/streams/{name}", "rb").read()
        inflater = warc.zlib.decompressobj(31)
        assert inflater.decompress(data).count(b"WARC/1.1\r\n") >= 1
        assert inflater.eof and not inflater.unused_data


def record(body: bytes, number: int) -> bytes:
    return warc.response_head(number, "u", body) + body + b"\r\n\r\n"


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.binary(max_size=60), st.integers(1, 9), st.booleans(), st.booleans())),
    st.integers(1, 50),
)
def test_any_stream_is_rewritten(bodies, piece):
    """Members before may hold one record, several, or parts of them."""
    source, revisits, want = b"", [], []
    packer = None
    for n, (body, times, apart, again) in enumerate(bodies):
        body = body * times
        if packer is None or apart:
            source += packer.flush() if packer else b""
            packer = warc.zlib.compressobj(6, warc.zlib.DEFLATED, 31)
        source += packer.compress(record(body, n))
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if again:
            revisits.append((n, None if n % 3 else n + 5))
        kind = "revisit" if again else "response"
        want.append((n, len(body), digest, kind, revisits[-1][1] if again else None))
    source += packer.flush() if packer else b""
    sink = io.BytesIO()
    old, warc._PIECE = warc._PIECE, piece
    try:
        lines = list(warc.normalise_stream(io.BytesIO(source), sink, iter(revisits)))
        got = [warc.read_member(sink, x["offset"], x["length"]) for x in lines]
    finally:
        warc._PIECE = old
    assert got == want


def test_broken_streams_are_refused():
    whole = gzip.compress(record(b"x" * 500, 1))
    for source in (whole[:-30], gzip.compress(record(b"x" * 500, 1)[:-300]), whole + whole[:40]):
        with pytest.raises(ValueError):
            list(warc.normalise_stream(io.BytesIO(source), io.BytesIO()))
    assert list(warc.normalise_stream(io.BytesIO(b""), io.BytesIO())) == []
    sink = io.BytesIO()
    (line,) = warc.normalise_stream(io.BytesIO(whole), sink)
    head = warc.response_head(1, "u", b"other")
    wrong = gzip.compress(head + b"OTHER\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        warc.read_member(io.BytesIO(wrong), 0, len(wrong))
    assert line["type"] == "response"


def test_lost_tasks_leave_nothing_to_read(spark, tmp_path):
    """Files that no row names are not read."""
    records, archives, got = archived(spark, ODD, tmp_path)
    for folder in ("streams", "members"):
        with open(f"{tmp_path}/{folder}/orphan.warc.gz", "wb") as out:
            out.write(gzip.compress(record(b"orphan", 99)))
    assert got.count() == len(ODD)


def test_a_hot_payload_is_spread(spark, tmp_path):
    pages = [(i, "u", "hot" if i % 3 else f"page {i}") for i in range(3000)]
    records, _, got = archived(spark, pages, tmp_path)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(pages)
    assert warc.repeated(records).count() == 1999
    short = warc.repeated(records, least_bytes=4).count()
    assert short == 0


def test_empty_table(spark, tmp_path):
    _, archives, got = archived(spark, [], tmp_path)
    assert archives.count() == 0 and got.count() == 0
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "string", "string", "bigint"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = spark_rows(warc.op13_warc_members(spark, path))
    assert got == sql_rows(connect(path), warc.OP13_SQL)
    assert sum(got[1].values()) > 0
