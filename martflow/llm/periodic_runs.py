"""Operator 11, periodic runs of words by descending-LCP Kruskal.

A run of a text is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``LEAST_WORDS`` words and two periods long, that no
neighbouring word extends keeping the period.

The suffixes of a text are sorted by prefix doubling, many texts of a batch at once, and
neighbours in that order get the length of their longest common prefix (LCP). These
pairs are the edges of Kruskal's algorithm: by decreasing LCP they unite two classes of
suffixes, each an ordered set of positions. After a union by LCP value L the classes
hold positions that share L words at least, and two positions i < j that become
neighbours in the ordered set share exactly L. If their distance d is no more than L,
words i to j + L repeat with period d and cannot be extended to the right: they seed a
run, which is whole if the word before does not fit either. d is the smallest period,
for with a smaller one i + d' would have joined i's class earlier and stand between
them. A run with period q from s on is found once, as s and s + q become neighbours.
The smaller set goes into the larger one, so a text of n words takes O(n log n) steps
however it repeats; edges below half of ``LEAST_WORDS`` can seed no run and are left out.

Each row is worked on alone: nothing is shuffled, and a task holds some megabytes of
words, or one text.

Defined results: a null or empty text has no words and no runs; equal rows come out
equal; words are bytes between ASCII white space, whatever else they hold; an empty
table gives no rows; a null ``doc_id`` is kept, and its text is not made periodic; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import SPACES, table

LEAST_WORDS = 12
_WORDS_AT_ONCE = 300_000
_CHUNK = 512
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Positions:
    """An ordered set of positions in chunks, so that adding one moves a chunk at most."""

    __slots__ = ("chunks", "firsts", "size")

    def __init__(self, position: int):
        self.chunks = [[position]]
        self.firsts = [position]
        self.size = 1

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk

    def _chunk(self, position: int) -> int:
        return max(0, bisect_left(self.firsts, position) - 1)

    def around(self, position: int) -> tuple[int, int]:
        """The nearest members before and after a position that is no member; -1 for none."""
        at = self._chunk(position)
        chunk = self.chunks[at]
        place = bisect_left(chunk, position)
        before = chunk[place - 1] if place else -1
        if place < len(chunk):
            return before, chunk[place]
        return before, self.firsts[at + 1] if at + 1 < len(self.firsts) else -1

    def add(self, position: int) -> None:
        at = self._chunk(position)
        chunk = self.chunks[at]
        insort(chunk, position)
        self.firsts[at] = chunk[0]
        self.size += 1
        if len(chunk) > _CHUNK:
            half = len(chunk) // 2
            self.chunks[at : at + 1] = [chunk[:half], chunk[half:]]
            self.firsts[at : at + 1] = [chunk[0], chunk[half]]


def neighbours(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring suffixes that share ``least`` words or more: both places, their LCP.

    ``words`` are numbers of words; a number that occurs once ends what can be shared.
    Ranks by the first 1, 2, 4, ... words come from sorting the suffixes that are not
    told apart yet; all ranks together give the LCP.
    """
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    new = np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(words)), 0))
    rank = np.empty(len(words), np.int64)
    rank[order] = first
    levels = []  # ranks by 2 ** k words
    shift = 1
    slots = np.arange(len(words))  # places in the order that are open
    while True:
        levels.append(rank.astype(np.int32))
        # A class is open if it holds two suffixes or more.
        same = np.concatenate([rank[order[slots]][1:] == rank[order[slots]][:-1], [False]])
        slots = slots[same | np.concatenate([[False], same[:-1]])]
        if not len(slots):
            break
        suffixes = order[slots]
        old, behind = rank[suffixes], rank[suffixes + shift]
        by = np.lexsort((behind, old))
        suffixes, old, behind = suffixes[by], old[by], behind[by]
        order[slots] = suffixes
        new = np.concatenate([[True], (old[1:] != old[:-1]) | (behind[1:] != behind[:-1])])
        rank = rank.copy()
        rank[suffixes] = np.maximum.accumulate(np.where(new, slots, 0))
        shift *= 2

    left, right = order[:-1], order[1:]
    for k, level in enumerate(levels):  # cheap tests first
        if 1 << k > least:
            break
        close = level[left] == level[right]
        left, right = left[close], right[close]
    lcp = np.zeros(len(left), np.int64)
    for k in reversed(range(len(levels))):
        close = levels[k][left + lcp] == levels[k][right + lcp]
        lcp[close] += 1 << k
    enough = lcp >= least
    return left[enough], right[enough], lcp[enough]


def _root(parent: dict, place: int) -> int:
    while parent[place] != place:
        parent[place] = parent[parent[place]]
        place = parent[place]
    return place


def seeds(left: np.ndarray, right: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, L) of positions that become neighbours in a class, L at least their distance."""
    by = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    found = []
    for a, b, shared in zip(left[by].tolist(), right[by].tolist(), lcp[by].tolist(), strict=True):
        for place in (a, b):
            if place not in parent:
                parent[place] = place
                members[place] = Positions(place)
        a, b = _root(parent, a), _root(parent, b)
        if members[a].size < members[b].size:
            a, b = b, a
        parent[b] = a
        large, small = members[a], list(members.pop(b))
        last = len(small) - 1
        for n, place in enumerate(small):
            before, after = large.around(place)
            # Members of the small set may stand between.
            if before >= 0 and place - before <= shared and (n == 0 or small[n - 1] < before):
                found.append((before, place, shared))
            if after >= 0 and after - place <= shared and (n == last or small[n + 1] > after):
                found.append((place, after, shared))
        for place in small:
            large.add(place)
    return found


def runs_of(words: np.ndarray, ends: np.ndarray, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Runs of many texts at once: rows of (place, length, period), sorted.

    ``words`` holds the texts in a row. A word has a number of its own in each text, and
    each text ends, before ``ends``, with one that occurs once.
    """
    if not len(words):
        return np.empty((0, 3), np.int64)
    least = -(-least_words // 2)
    found = np.array(seeds(*neighbours(words, least)), np.int64).reshape(-1, 3)
    place, after, shared = found.T
    starts = np.concatenate([[0], ends[:-1]])
    fits = np.isin(place, starts, invert=True) & (words[place - 1] == words[after - 1])
    whole = ~fits & (after - place + shared >= least_words)
    place, after, shared = found[whole].T
    rows = np.stack([place, after - place + shared, after - place], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _slices(texts, at_once: int):
    """Texts (bytes) as lists of words, some at a time."""
    held, size = [], 0
    for text in texts:
        words = text.as_py().split() if text.is_valid else []
        if held and size + len(words) > at_once:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words) + 1
    if held:
        yield held


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, of each text apart and closed by an own one; the texts' ends."""
    numbers, ends, base = [], [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        numbers.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own) + 1
        numbers.append(base - 1)
        ends.append(len(numbers))
    return np.array(numbers, np.int64), np.array(ends, np.int64)


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words no run contains after its first period."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [w for w, n in zip(words, np.cumsum(steps).tolist()[:-1], strict=True) if n == 0]


def find_runs(documents: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, ``runs`` by start and period, and the ``collapsed`` text.

    The collapsed text holds the words that no run contains after its first period, with
    one space between them.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    def find(batches):
        import pyarrow as pa

        for batch in batches:
            at = 0
            for texts in _slices(batch.column("text").cast(pa.binary()), _WORDS_AT_ONCE):
                numbers, ends = _numbered(texts)
                rows = runs_of(numbers, ends, least_words)
                cuts = np.searchsorted(rows[:, 0], np.concatenate([[0], ends]))
                found, collapsed = [], []
                for n, words in enumerate(texts):
                    own = rows[cuts[n] : cuts[n + 1]].copy()
                    own[:, 0] -= ends[n - 1] if n else 0
                    found.append(
                        [dict(start=s, length=c, period=p) for s, c, p in own.tolist()]
                    )
                    collapsed.append(b" ".join(_kept(words, own)))
                kind = pa.list_(
                    pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.array(found, kind),
                        pa.array(collapsed, pa.binary()).view(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(texts)

    return docs.mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """Of the output of ``find_runs``: the longest run and digests of runs and text."""
    longest = F.array_min(
        F.transform(
            "runs",
            lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"]),
        )
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    length = -F.col("longest.shorter")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("-1000 * longest.shorter div longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _planted(doc_id: Column, text: Column) -> Column:
    """The text, made periodic from some word on where the hash of ``doc_id`` ends in 0."""
    drawn = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(drawn / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        first = g % n
        period = F.lit(1) + F.floor((n - first) / (F.lit(3) + g % 8))
        place = F.sequence(F.lit(0), n - 1)
        word = F.transform(
            place,
            lambda i: F.get(
                words,
                F.when(i >= first, first + (i - first) % period).otherwise(i).cast("int"),
            ),
        )
        return F.when(n > 0, F.array_join(word, " "))

    # The words are bound once by an array of one.
    words = F.array_remove(F.split(text, SPACES), "")
    bound = F.get(F.transform(F.array(words), periodic), F.lit(0))
    return F.when(F.coalesce(drawn % 10 == 0, F.lit(False)), bound).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, of which one in ten is made periodic."""
    documents = table(spark, sf_dir, "documents")
    planted = _planted(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return run_digests(find_runs(documents.select("doc_id", planted.alias("text"))))
