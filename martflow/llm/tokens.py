"""Token ids of whole texts, by the tokenizers library, one call per distinct word.

The tokenizer drops white space before it merges, and no token crosses it, so a
text's ids are its words' ids in a row. Texts of a batch are split in Arrow, each
distinct word is encoded once, and the ids are gathered in numpy. A test holds the
result against encoding whole texts.
"""

from __future__ import annotations

import os
import re

import numpy as np

from martflow.llm.common import returning

# Words the pre-tokenizer leaves in one piece, but for one mark at the end. Neither
# composing nor lower-casing their letters depends on what stands around them.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-į]+[.,]?").fullmatch
_KEPT_WORDS = 500_000
_KEPT_CHARS = 64
_BYTES_AT_ONCE = 16 << 20
_WORDS_AT_ONCE = 200_000


class _Words:
    """Words and their ids, in the order they were learned."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # of the n-th word
        self.used = 0

    def keep(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        first, count = len(self.index), len(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + count + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[first + 1 : first + count + 1] = self.used + np.cumsum(lengths)
        self.used += len(ids)
        self.index.update(zip(words, range(first, first + count), strict=True))

    def spans(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[at], self.starts[at + 1] - self.starts[at]


class Encoder:
    """Encodes Arrow batches of texts and remembers words it has met.

    When it knows many words, it starts anew, and takes those it meets again over from
    what it knew: frequent words stay.
    """

    def __init__(self, path: str, kept_words: int = _KEPT_WORDS):
        self.kept_words = kept_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.ends = ends
        self.marks = {m: self._encode(m)[0] for m in ".,"}
        self.known, self.before = _Words(), _Words()

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _take_over(self, words: list[str]) -> None:
        """Words that were known before."""
        at = np.fromiter(map(self.before.index.__getitem__, words), np.int64, len(words))
        starts, lengths = self.before.spans(at)
        self.known.keep(words, lengths, _gather(self.before.flat, starts, lengths))

    def _missing(self, words) -> list[str]:
        """Those of some words that are not known, after taking over what was."""
        new = [w for w in words if w not in self.known.index]
        old = [w for w in new if w in self.before.index]
        if old:
            self._take_over(old)
            new = [w for w in new if w not in self.known.index]
        return new

    def _learn(self, words: list[str]) -> None:
        """Ids of new words: plain ones by their lower-case core, and a mark behind it."""
        odd, marked, cores = [], [], []
        for word in words:
            if _PLAIN(word) and len(word) <= _KEPT_CHARS:
                core = (word[:-1] if word[-1] in ".," else word).lower()
                cores.append(core)
                if core != word:
                    marked.append((word, core))
            else:
                odd.append(word)
        plain = self._missing(dict.fromkeys(cores))
        for at in range(0, len(plain), 500):
            some = plain[at : at + 500]
            ids = np.array(self._encode(" ".join(some)), np.uint32)
            last = np.flatnonzero(self.ends[ids])
            assert len(last) == len(some), "a plain word is one piece"
            self.known.keep(some, np.diff(last, prepend=-1), ids)
        if marked:
            at = np.fromiter((self.known.index[c] for _, c in marked), np.int64, len(marked))
            starts, lengths = self.known.spans(at)
            mark = np.array([self.marks.get(w[-1], 0) for w, _ in marked], np.uint32)
            has = np.array([w[-1] in ".," for w, _ in marked])
            ids = _gather(self.known.flat, starts, lengths, extra=has)
            lengths = lengths + has
            ids[(np.cumsum(lengths) - 1)[has]] = mark[has]
            self.known.keep([w for w, _ in marked], lengths, ids)
        if odd:
            found = self.tokenizer.encode_batch(odd, add_special_tokens=False)
            found = [e.ids for e in found]
            lengths = np.array([len(x) for x in found], np.int64)
            ids = np.array([i for x in found for i in x], np.uint32)
            self.known.keep(odd, lengths, ids)

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has; a null text has none."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary.to_pylist()

        if len(self.known.index) > self.kept_words:
            self.known, self.before = _Words(), self.known
        new = self._missing(words)
        self._learn(new)
        index = self.known.index
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        starts, lengths = self.known.spans(at)
        lengths = lengths.astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(lengths[codes], dtype=np.int64)])
        flat = np.empty(ends[-1], np.uint32)
        for low in range(0, len(codes), _WORDS_AT_ONCE):  # some at a time, to hold less
            own = codes[low : low + _WORDS_AT_ONCE]
            flat[ends[low] : ends[low + len(own)]] = _gather(
                self.known.flat, starts[own], lengths[own]
            )
        ends = ends[bounds]
        if any(len(w) > _KEPT_CHARS for w in new):  # long ones would fill memory
            self.known, self.before = _Words(), _Words()
        return flat, np.diff(ends)


def _gather(flat, starts, lengths, extra=None) -> np.ndarray:
    """Runs of ``flat`` in a row, each with one free place after it where ``extra``."""
    if extra is None:
        shift = np.cumsum(lengths) - lengths
        return flat[np.repeat(starts - shift, lengths) + np.arange(lengths.sum())]
    room = lengths + extra
    shift = np.cumsum(room) - room
    index = np.repeat(starts - shift, room) + np.arange(room.sum())
    return flat[np.minimum(index, len(flat) - 1)]


def _slices(batches, text_column: str, at_once: int):
    """Rows some megabytes of text at a time, whatever batches they come in."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            if held and size + part.column(text_column).nbytes > at_once:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.column(text_column).nbytes
    if held:
        yield pa.concat_batches(held)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, kept_words: int = _KEPT_WORDS) -> Encoder:
    """The encoder of this Python worker."""
    if (path, kept_words) not in _ENCODERS:
        _ENCODERS[path, kept_words] = Encoder(path, kept_words)
    return _ENCODERS[path, kept_words]


def id_columns(
    path: str,
    end_id: int,
    text_column: str,
    drop_text: bool = True,
    kept_words: int = _KEPT_WORDS,
    bytes_at_once: int = _BYTES_AT_ONCE,
):
    """A function for ``mapInArrow``: adds ``ids`` (little-endian bytes) to rows.

    Each id takes two bytes where the vocabulary allows it, else four. ``end_id``
    closes every document. A worker remembers twice ``kept_words`` at most, and holds some
    ten times ``bytes_at_once``: with less of both it is smaller and slower.
    """

    def add(batches):
        import pyarrow as pa

        encode = encoder(path, kept_words)
        kind = np.uint16 if len(encode.ends) <= 1 << 16 else np.uint32
        for part in _slices(batches, text_column, bytes_at_once):
            flat, counts = encode(part.column(text_column))
            ends = np.cumsum(counts)
            flat = np.insert(flat, ends, end_id).astype(kind)
            offsets = np.concatenate([[0], np.cumsum(counts + 1)]) * flat.itemsize
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                part.num_rows,
                [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)],
            ).cast(pa.binary())
            keep = [n for n in part.schema.names if not (drop_text and n == text_column)]
            columns = [part.column(n) for n in keep] + [ids]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids"])

    return returning(add)


def id_width(path: str) -> int:
    """Bytes each id takes in ``ids``."""
    return 2 if len(encoder(path).ends) <= 1 << 16 else 4
