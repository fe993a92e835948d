"""Operator 7, token counts: a Viterbi pass that keeps counts and scores, not paths.

A unigram tokenizer cuts a word, a ``▁`` before it, into the pieces of the highest
sum of scores. Aho-Corasick finds all pieces that end at each character. The dynamic
programme carries the best score, the number of pieces on that path, and whether it
ends in an unknown character. Tie rules are those of the tokenizers library's Unigram
model: of equal paths the one whose last piece starts first stays; a character that is
no piece by itself may count as unknown, at the lowest score less 10, and gives way to
a piece at a tie; unknown characters in a row are one piece.

No piece holds a ``▁`` but in front, so words are cut on their own: each distinct word
of a batch once, and words met before are remembered within a bound.

The public vocabulary files hold no unigram model, and none is trained here: the
scores follow Zipf's law on the ranks of a public piece list.

Defined results: words stand between ASCII white space; a null or blank text has no
pieces and score 0; a null ``doc_id`` stays null; repeated rows are counted each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_KEPT_WORDS = 500_000
_KEPT_CHARS = 64
_ROWS = 2000


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file in their order, scored by rank.

    Control, byte and blank pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    pieces = [p for p in pieces if MARK not in p[1:]]
    return [(p, -math.log(rank)) for rank, p in enumerate(pieces, start=2)]


class PieceCounter:
    """Counts the pieces of words."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        if any(MARK in piece[1:] for piece, _ in vocabulary):
            raise ValueError(f"a piece with {MARK} inside would cross words")
        self.found = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, int, float]] = {}

    def word(self, word: str) -> tuple[int, int, float]:
        """Pieces, unknown characters and score of one word."""
        text = MARK + word
        length = len(text)
        best = [0.0] + [-math.inf] * length
        count = [0] * (length + 1)
        strange = [0] * (length + 1)
        last_unknown = [False] * (length + 1)
        at = 0  # ends up to here are settled but for nothing

        def close(end: int) -> None:
            if text[end - 1] in self.single:
                return
            score = best[end - 1] + self.unknown
            if score > best[end]:
                best[end] = score
                count[end] = count[end - 1] + (not last_unknown[end - 1])
                strange[end] = strange[end - 1] + 1
                last_unknown[end] = True

        for index, (size, score) in self.found.iter(text):
            end = index + 1
            while at < end - 1:  # no more pieces end before
                at += 1
                close(at)
            start = end - size
            score += best[start]
            if score > best[end]:
                best[end] = score
                count[end] = count[start] + 1
                strange[end] = strange[start]
        while at < length:
            at += 1
            close(at)
        return count[length], strange[length], best[length]

    def __call__(self, texts) -> dict[str, np.ndarray]:
        """Words, pieces, unknown characters and scores of an Arrow array of texts."""
        import pyarrow as pa
        import pyarrow.compute as pc

        rows = len(texts)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > _KEPT_WORDS:
            self.known = {}
        known, found = self.known, []
        for word in words:
            own = known.get(word)
            if own is None:
                own = self.word(word) if word else (0, 0, 0.0)
                if len(word) <= _KEPT_CHARS:
                    known[word] = own
            found.append(own)
        values = np.array(found, np.float64).reshape(len(words), 3)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        docs = np.repeat(np.arange(rows), np.diff(split.offsets.to_numpy()))
        blank = words.index("") if "" in words else -1

        def total(weights):
            return np.bincount(docs, weights=weights, minlength=rows)

        return {
            "n_words": total((codes != blank).astype(float)).astype(np.int64),
            "n_pieces": total(values[codes, 0]).astype(np.int64),
            "n_unknown": total(values[codes, 1]).astype(np.int64),
            "score": total(values[codes, 2]),
        }


_COUNTERS: dict[str, PieceCounter] = {}


def _counter(path: str) -> PieceCounter:
    """The counter of this Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(zipf_vocabulary(path))
    return _COUNTERS[path]


def piece_counts(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_pieces, n_unknown, score of each row, without a shuffle."""

    def count(batches):
        import pyarrow as pa

        counter = _counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                found = counter(part.column("text"))
                columns = [part.column("doc_id"), *map(pa.array, found.values())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *found])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(
        count, "doc_id long, n_words long, n_pieces long, n_unknown long, score double"
    )


def op7_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts of all documents."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_counts(table(spark, sf_dir, "documents"), path)
