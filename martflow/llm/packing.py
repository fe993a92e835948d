"""Operator 3, packing: cost-balanced sequences of bounded length.

A piece of ``n`` ids costs ``linear * n + quadratic * n * n``, the work of its dense
layers and of attention within it. Documents are dealt to shards by a hash, each
shard is packed by one task: pieces go, longest first, to the sequence of lowest cost
that has room for them. A document longer than a sequence is cut into whole sequences
and a rest. A shard has as many sequences as its ids need and no more, so that when
no sequence has room for a piece, the emptiest takes what it can and the rest waits for
its turn among the others.
A shard's padding is thus less than one sequence in all.

Shards are sized by bytes of text, so that one holds some millions of ids at any size
of the table; nothing but two sums reaches the driver.

Defined results: a null text is an empty one and has only the end id; a null
``doc_id`` is kept as null; repeated rows are packed each on its own; an empty table
gives no rows; other columns are ignored. The sequence ids are unique over all
shards, not consecutive. Reruns agree.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import tokens
from martflow.llm.common import parts_for, returning, table

CAPACITY = 2048
LINEAR = 1.0
QUADRATIC = 1.0 / 1024
SHARD_BYTES = 32 << 20
_SHARD_BITS = 32  # sequence ids: the shard above, the number in it below
COLUMNS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def pack_lengths(
    lengths: Iterable[int],
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start in it, length, sequence, offset in the sequence).

    ``lengths`` are of the documents 0, 1, ...; of equal pieces the earlier document
    goes first.
    """
    pieces, rests, sequences, total = [], [], 0, 0
    for doc, length in enumerate(lengths):
        whole = length // capacity
        for k in range(whole):
            pieces.append((doc, k * capacity, capacity, sequences, 0))
            sequences += 1
        if rest := length - whole * capacity:
            rests.append((rest, doc, whole * capacity))
            total += rest
    queue = [(-length, doc, start) for length, doc, start in rests]  # the longest first
    heapq.heapify(queue)
    opened = range(sequences, sequences - (-total // capacity))
    room = dict.fromkeys(opened, capacity)
    cost = dict.fromkeys(opened, 0.0)
    ready = [(0.0, s) for s in opened]  # by cost
    parked: list[tuple[int, float, int]] = []  # had no room, the emptiest first

    def put(doc: int, start: int, length: int, sequence: int) -> None:
        pieces.append((doc, start, length, sequence, capacity - room[sequence]))
        room[sequence] -= length
        cost[sequence] += linear * length + quadratic * length * length

    while queue:
        length, doc, start = heapq.heappop(queue)
        length = -length  # never more than the piece before
        while parked and -parked[0][0] >= length:
            _, paid, sequence = heapq.heappop(parked)
            heapq.heappush(ready, (paid, sequence))
        while ready and room[ready[0][1]] < length:
            paid, sequence = heapq.heappop(ready)
            if room[sequence]:
                heapq.heappush(parked, (-room[sequence], paid, sequence))
        if ready:
            sequence = ready[0][1]
            put(doc, start, length, sequence)
            heapq.heapreplace(ready, (cost[sequence], sequence))
        else:
            sequence = heapq.heappop(parked)[2]
            part = room[sequence]
            put(doc, start, part, sequence)
            heapq.heappush(queue, (part - length, doc, start + part))
    return pieces


def pack(
    documents: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    shard_bytes: int = SHARD_BYTES,
    **encoding: int,
) -> DataFrame:
    """The pieces of all documents (``doc_id``, ``text``); see the module.

    ``encoding`` bounds what a worker remembers and holds, as in ``tokens.id_columns``.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0]
    shards = parts_for(size, shard_bytes)
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    coded = docs.withColumn("shard", dealt).mapInArrow(
        tokens.id_columns(tokenizer, end_id, "text", **encoding), "doc_id long, shard int, ids binary"
    )
    width = tokens.id_width(tokenizer)

    def pack_shard(batches):
        import pyarrow as pa

        found = pa.Table.from_batches([b for b in batches if b.num_rows])
        number = found["shard"][0].as_py()
        doc_ids = found["doc_id"].to_pylist()
        ids = found["ids"].combine_chunks().to_pylist()
        del found
        order = sorted(
            range(len(ids)),
            key=lambda i: (-len(ids[i]), doc_ids[i] is not None, doc_ids[i] or 0, ids[i]),
        )
        lengths = [len(ids[i]) // width for i in order]
        rows = []
        for doc, start, length, sequence, offset in pack_lengths(
            lengths, capacity, linear, quadratic
        ):
            i = order[doc]
            own = np.frombuffer(ids[i], f"<u{width}", length, start * width)
            crc = zlib.crc32(own.astype("<u4"))
            key = (number << _SHARD_BITS) + sequence
            rows.append((doc_ids[i], start, length, crc, lengths[doc], key, offset))
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for at in range(0, len(rows), 50_000):
            columns = zip(*rows[at : at + 50_000], strict=True)
            columns = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def pack_task(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            yield from pack_shard(held)

    return coded.repartitionById(shards, "shard").mapInArrow(returning(pack_task), COLUMNS)


def op3_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2,048 ids."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), path)
