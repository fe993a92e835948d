"""Operator 1, token output: ids in patched frame-of-reference blocks.

Documents are dealt to shards by ranges of ``doc_id``, each shard is written by one
task as one file in ascending order, and the files are read back shard by shard.

A file holds blocks of 1,024 ids. A block keeps its least id and the ids' distances
from it, packed at the width that a given share of the distances fits (90 % unless
told otherwise); a distance that does not fit is an exception, listed with its
position after the packed bits. Behind the blocks stand the start of each block and
the documents, so that any document can be read alone::

    "PFR1"  block*  block start u64*  doc_id i64*  doc_id known u8*  ids u64*  footer
    block:  least u32, width u8, 0 u8, ids u16, exceptions u16,
            bits, exception position u16*, exception distance u32*
    footer: blocks u64, documents u64, ids u64, start of the index u64, "PFR1"

All numbers are little-endian.

Defined results: a null text is an empty one and has only the end id; a null
``doc_id`` comes before all others; rows that share a ``doc_id`` stand together,
ordered by their ids; an empty table gives no file and no rows; other columns are
ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martflow.llm import tokens
from martflow.llm.common import open_store, parts_for, table
from martflow.plans.staging import stage, staging_dir

MAGIC = b"PFR1"
BLOCK = 1024
FIT = 0.9
SHARD_BYTES = 32 << 20
_HEAD = struct.Struct("<IBBHH")
_FOOT = struct.Struct("<QQQQ4s")


def pack_block(ids: np.ndarray, fit: float = FIT) -> bytes:
    """One block of up to 1,024 ids."""
    least = int(ids.min())
    distance = ids.astype(np.uint32) - np.uint32(least)
    rank = min(len(ids) - 1, max(0, int(np.ceil(fit * len(ids))) - 1))
    width = int(np.partition(distance, rank)[rank]).bit_length()
    over = np.flatnonzero(distance >> np.uint32(width)) if width < 32 else np.empty(0, int)
    packed = distance.copy()
    packed[over] = 0
    bits = np.unpackbits(packed.astype("<u4").view(np.uint8), bitorder="little")
    bits = bits.reshape(len(ids), 32)[:, :width]
    return b"".join(
        [
            _HEAD.pack(least, width, 0, len(ids), len(over)),
            np.packbits(bits, axis=None, bitorder="little").tobytes(),
            over.astype("<u2").tobytes(),
            distance[over].astype("<u4").tobytes(),
        ]
    )


def unpack_block(data: memoryview, at: int = 0) -> np.ndarray:
    """The ids of the block that starts at byte ``at``."""
    least, width, _, count, exceptions = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (count * width + 7) // 8
    bits = np.unpackbits(
        np.frombuffer(data, np.uint8, size, at), count=count * width, bitorder="little"
    )
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits.reshape(count, width)
    ids = np.packbits(wide, axis=None, bitorder="little").view("<u4").astype(np.uint32)
    at += size
    where = np.frombuffer(data, "<u2", exceptions, at)
    ids[where] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return ids + np.uint32(least)


class ShardWriter:
    """Writes one file under a name of its own and then gives it its final name."""

    def __init__(self, folder: str, shard: int, fit: float = FIT):
        self.store, base = open_store(folder)
        self.final = f"{base}/shard-{shard:06d}.pfr"
        self.draft = f"{base}/.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft)
        self.fit, self.at, self.total = fit, 0, 0
        self.starts: list[int] = []
        self.docs: list[int] = []
        self.known: list[bool] = []
        self.counts: list[int] = []
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(0 if doc_id is None else doc_id)
        self.known.append(doc_id is not None)
        self.counts.append(len(ids))
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 64 * BLOCK:
            self._blocks(whole=False)

    def _blocks(self, whole: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.empty(0, np.uint32)
        end = len(ids) if whole else len(ids) - len(ids) % BLOCK
        for at in range(0, end, BLOCK):
            self.starts.append(self.at)
            self._put(pack_block(ids[at : min(at + BLOCK, end)], self.fit))
        self.total += end
        self.rest = [ids[end:]]
        self.waiting = len(ids) - end

    def close(self) -> None:
        self._blocks(whole=True)
        index = self.at
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array(self.docs, "<i8").tobytes())
        self._put(np.array(self.known, "u1").tobytes())
        self._put(np.array(self.counts, "<u8").tobytes())
        self._put(_FOOT.pack(len(self.starts), len(self.docs), self.total, index, MAGIC))
        self.out.close()
        self.store.move(self.draft, self.final)


class ShardReader:
    """Reads a shard: its documents in order, or one stretch of its ids."""

    def __init__(self, folder: str, shard: int):
        store, base = open_store(folder)
        self.file = store.open_input_file(f"{base}/shard-{shard:06d}.pfr")
        size = self.file.size()
        foot = self.file.read_at(_FOOT.size, size - _FOOT.size)
        blocks, docs, self.total, self.index, magic = _FOOT.unpack(foot)
        if magic != MAGIC:
            raise ValueError(f"shard {shard} of {folder} is not whole")
        data = self.file.read_at(size - _FOOT.size - self.index, self.index)
        self.starts = np.frombuffer(data, "<u8", blocks).astype(np.int64)
        at = 8 * blocks
        self.docs = np.frombuffer(data, "<i8", docs, at)
        self.known = np.frombuffer(data, "u1", docs, at + 8 * docs).astype(bool)
        self.counts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only their blocks are read."""
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        ends = np.append(self.starts, self.index)
        low = int(ends[first])
        data = memoryview(self.file.read_at(int(ends[last + 1]) - low, low))
        found = [unpack_block(data, int(ends[b]) - low) for b in range(first, last + 1)]
        ids = np.concatenate(found)
        return ids[start - first * BLOCK : stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the shard, ids), some blocks at a time."""
        ends = np.cumsum(self.counts)
        held, low = np.empty(0, np.uint32), 0
        for doc, known, count, end in zip(
            self.docs.tolist(), self.known, self.counts.tolist(), ends.tolist(), strict=True
        ):
            start = end - count
            if end > low + len(held):
                stop = min(self.total, max(end, low + len(held) + 256 * BLOCK))
                more = self.ids(low + len(held), stop)
                held, low = np.concatenate([held[start - low :], more]), start
            yield doc if known else None, start, held[start - low : end - low]


def write_shards(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 1,
    fit: float = FIT,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the documents' ids to ``folder``; return (shard, docs, tokens, start).

    Two narrow scans size the shards and cut the ids' range; the texts are read once
    and shuffled once, as ids. ``start`` counts the ids of all shards before.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0]
    shards = parts_for(size, shard_bytes)
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    cuts = []
    if shards > 1:
        share = [i / shards for i in range(1, shards)]
        cuts = docs.agg(F.percentile_approx("doc_id", share, 100 * shards)).first()[0]
        cuts = sorted(set(cuts or []))
    encode = tokens.id_columns(tokenizer, end_id, "text")

    def code(batches):
        import pyarrow as pa

        for batch in encode(batches):
            doc_ids = batch.column("doc_id")
            shard = np.searchsorted(cuts, doc_ids.fill_null(0).to_numpy(), side="left")
            shard[doc_ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    coded = docs.mapInArrow(code, "doc_id long, ids binary, shard int")
    dealt = coded.repartitionById(len(cuts) + 1, "shard")
    ordered = dealt.sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
    kind = f"<u{tokens.id_width(tokenizer)}"

    def write(batches):
        writer, number = None, None
        for batch in batches:
            for doc, ids, own in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("ids"),
                batch.column("shard").to_pylist(),
                strict=True,
            ):
                if own != number:
                    if writer:
                        writer.close()
                        yield row(number, writer)
                    writer, number = ShardWriter(folder, own, fit), own
                writer.add(doc, np.frombuffer(ids.as_buffer(), kind).astype(np.uint32))
        if writer:
            writer.close()
            yield row(number, writer)

    def row(number, writer):
        import pyarrow as pa

        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([number], pa.int32()),
                "docs": pa.array([len(writer.docs)], pa.int64()),
                "tokens": pa.array([writer.total], pa.int64()),
            }
        )

    written = ordered.mapInArrow(write, "shard int, docs long, tokens long")
    listed = stage(written, "token-shards")  # a row for each file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32, shard."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for shard, base in zip(
                batch.column("shard").to_pylist(), batch.column("start").to_pylist(), strict=True
            ):
                rows = []
                for doc, start, ids in ShardReader(folder, shard).documents():
                    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
                    rows.append((doc, base + start, len(ids), crc, shard))
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        import pyarrow as pa

        names = ("doc_id", "start", "n_tokens", "ids_crc32", "shard")
        kinds = (pa.int64(),) * 4 + (pa.int32(),)
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=list(names))

    spread = shards.select("shard", "start")
    parts = max(1, spread.count())
    return spread.repartitionById(parts, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"
    )


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token shards and read back."""
    import public_tokenizers

    folder = f"{staging_dir(spark)}/tokens-{uuid.uuid4().hex}"
    path = public_tokenizers.path("word_bpe_49k.json")
    shards = write_shards(table(spark, sf_dir, "documents"), folder, path)
    return read_shards(shards, folder)
