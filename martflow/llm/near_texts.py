"""Operator 6, near duplicates of texts: ProbMinHash, bands, verification.

A text is its set of five-word shingles, ASCII letters in lower case; a shingle that
stands ``n`` times weighs ``1 + ln n``; a text of fewer words is one shingle. For the
signature each shingle is a Poisson process at the rate of its weight whose arrivals
fall into random registers, and a register keeps the shingle that arrives first. A
shingle's process ends as soon as its time passes the last register to be settled, so
long texts cost little more than one arrival a shingle. Two texts agree in a register
with the probability Jaccard similarity of their weights.

1. Texts with equal words are one class from here on.
2. Signatures are cut into bands; classes that agree in a band share a bucket.
3. Each class of a bucket is held against the bucket's least class, if the signatures
   agree well enough, by the whole shingle sets. A pair links when its Jaccard or its
   probability Jaccard similarity is at least ``threshold``.
4. Links make components. In buckets that still hold several components, blocks of
   their members are held against each other, and pairs across components are verified
   likewise until the components are one; pairs within a component need no look. So no
   candidate is lost, and no pair is emitted but the links that unite components.

Bands and the agreement filter see probability Jaccard only, and candidates are pairs
that pass both. At 0.8 of it each misses a pair with a chance of about 0.005 %. A pair
whose plain Jaccard alone is at least ``threshold``, as when one text repeats many
shingles, links if it is a candidate, and may be missed else.

Nothing is collected: groups are split by joins and blocks, and the shingle sets are
made only for classes that share a bucket.

Defined results: a text without words links with nothing; a null ``doc_id`` is kept,
and a class of nulls only has a null class id; repeated rows are copies of each other
(``kept`` once); of a group the least ``doc_id`` stays, nulls last; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import returning, small_side, table
from martflow.llm.components import components
from martflow.plans.staging import stage

WORDS = 5
THRESHOLD = 0.8
BANDS = 25
BAND_ROWS = 5
# Signatures of a pair at a probability Jaccard of 0.8 agree less with a chance of 0.0054 %.
LEAST_AGREEMENT = 0.65
_BLOCK = 256
_ROWS = 500


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; different numbers stay different."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(texts, words: int = WORDS):
    """Of an Arrow array: (text number, shingle, times) in order, and keys of the words.

    A key is 16 bytes over all words of a text, empty for a text without words.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    rows = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    docs = np.repeat(np.arange(rows), np.diff(split.offsets.to_numpy()))
    kinds = pc.ascii_lower(coded.dictionary).cast(pa.large_binary()).to_pylist()
    if b"" in kinds:
        real = codes != kinds.index(b"")
        docs, codes = docs[real], codes[real]
    marks = np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), np.uint64, len(kinds))
    marks = marks[codes] if len(codes) else np.empty(0, np.uint64)
    counts = np.bincount(docs, minlength=rows)
    ends = np.cumsum(counts)
    raw = marks.tobytes()
    keys = [
        xxhash.xxh3_128_digest(raw[8 * (e - c) : 8 * e]) if c else b""
        for c, e in zip(counts.tolist(), ends.tolist(), strict=True)
    ]
    sizes = np.minimum(counts, words)
    starts = np.arange(len(docs))
    inside = starts + sizes[docs] <= ends[docs]  # not beyond the end of the text
    starts, own = starts[inside], docs[inside]
    padded = np.concatenate([marks, np.zeros(words, np.uint64)])
    with np.errstate(over="ignore"):
        shingle = _mix(sizes[own].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for k in range(words):
            part = np.where(k < sizes[own], padded[starts + k], np.uint64(0))
            shingle = _mix((shingle + part) * np.uint64(0x9FB21C651E98DF25) + np.uint64(k))
    order = np.lexsort((shingle, own))
    own, shingle = own[order], shingle[order]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(own)))
    return own[at], shingle[at], times, keys


def signatures(
    docs: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, registers: int
) -> np.ndarray:
    """ProbMinHash registers of the texts 0 to ``rows``, 32 bits each."""
    time = np.full(rows * registers, np.inf)
    held = np.zeros(rows * registers, np.uint32)
    doc, mark, rate = docs, shingle, weight
    value = (_mix(shingle) >> np.uint64(32)).astype(np.uint32)
    now = np.zeros(len(doc))
    with np.errstate(over="ignore"):
        state = _mix(mark + np.uint64(0xD1B54A32D192ED03))
        while len(doc):
            state = state + np.uint64(0x9E3779B97F4A7C15)
            drawn = _mix(state)
            uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            now = now - np.log(uniform) / rate
            place = _mix(drawn) % np.uint64(registers)
            place = doc * registers + place.astype(np.int64)
            np.minimum.at(time, place, now)
            won = time[place] == now
            held[place[won]] = value[won]
            latest = time.reshape(rows, registers).max(axis=1)
            active = now < latest[doc]
            doc, rate, now = doc[active], rate[active], now[active]
            state, value = state[active], value[active]
    return held.reshape(rows, registers)


def similarity(a: np.ndarray, a_times, b: np.ndarray, b_times) -> tuple[float, float]:
    """Jaccard and probability Jaccard similarity of sorted distinct shingles.

    ``a_times`` and ``b_times`` say how often each stands, None for once.
    """
    both, at, bt = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    union = len(a) + len(b) - len(both)
    if not union:
        return 0.0, 0.0
    plain = len(both) / union
    if not len(both) or (a_times is None and b_times is None):
        return plain, plain
    x = np.ones(len(a)) if a_times is None else 1 + np.log(a_times)
    y = np.ones(len(b)) if b_times is None else 1 + np.log(b_times)
    ax, by = x[at], y[bt]
    ratio = ax / by
    order = np.argsort(ratio)
    ratio, ax, by = ratio[order], ax[order], by[order]
    only_a, only_b = x.sum() - ax.sum(), y.sum() - by.sum()
    above = np.append(np.cumsum(ax[::-1])[::-1], 0.0) + only_a
    below = np.concatenate([[0.0], np.cumsum(by)]) + only_b
    first = np.searchsorted(ratio, ratio, "left")
    return plain, float(np.sum(1 / (above[first] / ax + below[first] / by)))


def _signed(batches):
    """For ``mapInArrow``: doc_id, text keys, class key and signature of each row."""
    import pyarrow as pa

    registers = BANDS * BAND_ROWS
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            docs, found, times, keys = shingles(part.column("text"))
            held = signatures(docs, found, 1 + np.log(times), part.num_rows, registers)
            held = held.astype("<u4")
            signs = [held[i].tobytes() if k else None for i, k in enumerate(keys)]
            columns = [part.column(n) for n in ("doc_id", "k1", "k2")]
            columns += [pa.array(keys, pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "k1", "k2", "words", "sign"])


def _with_text_keys(documents: DataFrame, *more: str) -> DataFrame:
    """96 bits of a text, found without Python."""
    text = F.col("text").cast("string")
    return documents.select(
        *more, F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"), text.alias("text")
    )


def _banded(batches):
    """For ``mapInArrow``: a row (bucket, band, id) for each band of a class."""
    import pyarrow as pa

    for batch in batches:
        ids = batch.column("id").to_numpy()
        held = np.frombuffer(b"".join(batch.column("sign").to_pylist()), "<u4")
        held = held.reshape(len(ids), BANDS, BAND_ROWS).astype(np.uint64)
        with np.errstate(over="ignore"):
            key = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            key = np.broadcast_to(key, held.shape[:2])
            for k in range(BAND_ROWS):
                key = _mix(key * np.uint64(0x9FB21C651E98DF25) + held[:, :, k])
        bands = np.tile(np.arange(BANDS, dtype=np.int32), len(ids))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key.reshape(-1).view(np.int64)),
                pa.array(bands),
                pa.array(np.repeat(ids, BANDS)),
            ],
            names=["bucket", "band", "id"],
        )


def _agreeing(batches):
    """For ``mapInArrow``: pairs (a, b) whose signatures agree well enough."""
    import pyarrow as pa

    for batch in batches:
        one = np.frombuffer(b"".join(batch.column("sign_a").to_pylist()), "<u4")
        two = np.frombuffer(b"".join(batch.column("sign_b").to_pylist()), "<u4")
        width = BANDS * BAND_ROWS
        same = (one.reshape(-1, width) == two.reshape(-1, width)).mean(axis=1)
        some = pa.array(same >= LEAST_AGREEMENT)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(some), batch.column("b").filter(some)], names=["a", "b"]
        )


def _shingled(batches):
    """For ``mapInArrow``: the shingle set of each class; times only where one repeats."""
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            docs, found, times, _ = shingles(part.column("text"))
            bounds = np.searchsorted(docs, np.arange(part.num_rows + 1)).tolist()
            sets, repeats = [], []
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                sets.append(found[low:high].astype("<u8").tobytes())
                own = times[low:high]
                repeats.append(own.astype("<u4").tobytes() if (own > 1).any() else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(sets, pa.binary()), pa.array(repeats, pa.binary())],
                names=["id", "shingles", "times"],
            )


def _verified(threshold: float):
    def verify(batches):
        import pyarrow as pa

        def numbers(data, kind):
            return None if data is None else np.frombuffer(data, kind)

        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("a", "b", "set_a", "times_a", "set_b", "times_b")), strict=True)
            links = []
            for a, b, set_a, times_a, set_b, times_b in rows:
                found = similarity(
                    numbers(set_a, "<u8"), numbers(times_a, "<u4"),
                    numbers(set_b, "<u8"), numbers(times_b, "<u4"),
                )
                if max(found) >= threshold - 1e-12:
                    links.append((a, b, *found))
            columns = list(zip(*links, strict=True)) if links else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["a", "b", "jaccard", "probability_jaccard"],
            )

    return verify


def _across(threshold: float):
    """For ``applyInPandas``: links between components, in two blocks of a bucket.

    Pairs that agree in an earlier band are left to that band's bucket. The most alike
    come first, and a pair whose components are united by then needs no look.
    """

    def compare(key, frame):
        import pandas as pd

        _, band, low, high = key
        one, two = frame[frame.block == low], frame[frame.block == high]
        signs = [np.frombuffer(b"".join(x.sign), "<u4") for x in (one, two)]
        signs = [x.reshape(-1, BANDS, BAND_ROWS) for x in signs]
        ids = [x.id.to_numpy() for x in (one, two)]
        held = [x.component.to_numpy() for x in (one, two)]
        pairs = []
        for i in range(len(one)):
            apart = held[1] != held[0][i]
            if low == high:
                apart &= ids[1] > ids[0][i]
            at = np.flatnonzero(apart)
            same = signs[1][at] == signs[0][i]
            alike = same.mean(axis=(1, 2))
            first = same.all(axis=2).argmax(axis=1) == band
            some = first & (alike >= LEAST_AGREEMENT)
            pairs += zip((-alike[some]).tolist(), [i] * int(some.sum()), at[some].tolist(), strict=True)
        root: dict[int, int] = {}

        def find(component):
            while component in root:
                component = root[component]
            return component

        sets = [_sets(x) for x in (one, two)]
        links = []
        for _, i, j in sorted(pairs):
            a, b = find(held[0][i]), find(held[1][j])
            if a != b:
                found = similarity(*sets[0][i], *sets[1][j])
                if max(found) >= threshold - 1e-12:
                    root[max(a, b)] = min(a, b)
                    links.append((ids[0][i], ids[1][j], *found))
        return pd.DataFrame(links, columns=["a", "b", "jaccard", "probability_jaccard"]).astype(
            {"a": "int64", "b": "int64", "jaccard": "float64", "probability_jaccard": "float64"}
        )

    return compare


def _sets(rows) -> list:
    """Shingles and times of each row of a pandas frame."""
    return [
        (np.frombuffer(s, "<u8"), None if t is None else np.frombuffer(t, "<u4"))
        for s, t in zip(rows.shingles, rows.times, strict=True)
    ]


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"), F.col("times").alias("times_a"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"), F.col("times").alias("times_b"))
    both = pairs.join(one, "a").join(two, "b")
    return both.mapInArrow(
        _verified(threshold), "a long, b long, jaccard double, probability_jaccard double"
    )


def near_duplicates(
    documents: DataFrame, threshold: float = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """The classes' rows and links.

    Rows: doc_id, k1 and k2 (of the text), class_id, n_copies, kept; one for each row.
    Links: a, b (class numbers), jaccard, probability_jaccard; enough of them to connect
    all that is near.
    """
    docs = _with_text_keys(documents, F.col("doc_id").cast("long").alias("doc_id"))
    signed = docs.mapInArrow(
        returning(_signed), "doc_id long, k1 long, k2 int, words binary, sign binary"
    ).withColumn("row", F.monotonically_increasing_id())
    signed = stage(signed, "near-signatures")

    # Texts with the same words are one class; it takes the text of its least key.
    worded = signed.filter("sign is not null")
    classes = worded.groupBy("words").agg(
        F.min("doc_id").alias("least_doc"),
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("k1", "k2")).alias("text"),
        F.first("sign").alias("sign"),
    )
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "near-classes")

    banded = classes.select("id", "sign").mapInArrow(_banded, "bucket long, band int, id long")
    banded = stage(banded, "near-bands")
    buckets = banded.groupBy("bucket").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("size"))
    buckets = stage(buckets.filter("size > 1"), "near-buckets")
    members = banded.join(buckets, "bucket")
    members = stage(members, "near-members")
    signs = classes.select("id", "sign")
    pairs = members.filter("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b"))
    pairs = _with_signs(pairs.distinct(), signs).mapInArrow(_agreeing, "a long, b long")
    pairs = stage(pairs, "near-pairs")

    shared = members.select("id").distinct()
    wanted = classes.join(shared, "id").select("id", "text.k1", "text.k2")
    sets = stage(_shingle_sets(documents, stage(wanted, "near-wanted")), "near-sets")
    links = stage(_verify(pairs, sets, threshold), "near-links")

    label = components(links)
    label = label.select(F.col("node").alias("id"), "component")
    labelled = members.join(label, "id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = mixed.filter("low != high").select("bucket")
    rest = labelled.join(mixed, "bucket").select("bucket", "band", "size", "id", "component")
    rest = stage(rest, "near-rest").join(signs, "id").join(sets, "id")
    links = stage(links.union(_block_links(rest, threshold)), "near-links")

    label = components(links).select(F.col("node").alias("id"), "component")
    placed = classes.select("id", "words", "least_doc", "copies").join(label, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    placed = stage(placed, "near-placed")
    groups = placed.groupBy("component").agg(
        F.min("least_doc").alias("class_id"), F.sum("copies").alias("n_copies")
    )
    placed = placed.join(groups, "component").select("words", "component", "class_id", "n_copies")

    rows = worded.select("doc_id", "k1", "k2", "words", "row").join(placed, "words")
    # Of the rows with the least id one stays: the first.
    keepers = rows.filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    keepers = keepers.groupBy("component").agg(F.min("row").alias("keeper"))
    kept = (F.col("row") == F.col("keeper")).alias("kept")
    rows = rows.join(keepers, "component")
    rows = rows.select("doc_id", "k1", "k2", "class_id", "n_copies", kept)
    blank = signed.filter("sign is null").select(
        "doc_id", "k1", "k2", F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("kept"),
    )
    return rows.union(blank), links


def _with_signs(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    one = signs.select(F.col("id").alias("a"), F.col("sign").alias("sign_a"))
    two = signs.select(F.col("id").alias("b"), F.col("sign").alias("sign_b"))
    return pairs.join(one, "a").join(two, "b")


def _shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles, times) of the wanted classes (id, k1, k2)."""
    keyed = _with_text_keys(documents)
    texts = keyed.join(small_side(wanted), ["k1", "k2"]).dropDuplicates(["id"]).select("id", "text")
    return texts.mapInArrow(returning(_shingled), "id long, shingles binary, times binary")


def _block_links(members: DataFrame, threshold: float) -> DataFrame:
    """Links across components of buckets, by pairs of blocks of their members."""
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "bucket", "band", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block", "id", "component", "sign", "shingles", "times",
    )
    return dealt.groupBy("bucket", "band", "low", "high").applyInPandas(
        _across(threshold), "a long, b long, jaccard double, probability_jaccard double"
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each group stays, with its columns as they are.

    Only keys are joined with the texts. Rows that share doc_id and text cannot be told
    apart by their key; they are few, and the one that stays is taken from among them.
    """
    rows, _ = near_duplicates(documents)
    key = ["doc_id", "k1", "k2"]
    keys = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("stay")
    )
    keys = keys.select([F.col(c).alias(f"key_{c}") for c in key] + ["rows", "stay"])
    keys = stage(keys.filter("rows != stay"), "near-keys")
    gone = stage(keys.filter("stay = 0").drop("rows", "stay"), "near-gone")
    shared = stage(keys.filter("stay > 0").drop("rows", "stay"), "near-shared")

    names = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    inner = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()],
    )
    inner = _with_text_keys(inner, "doc_id", *names.values()).drop("text")
    same = [F.col(c).eqNullSafe(F.col(f"key_{c}")) for c in key]
    gone, shared = small_side(gone), small_side(shared)
    left = inner.join(gone, same, "left_anti")
    alone = left.join(shared, same, "left_anti")
    first = left.join(shared, same, "left_semi").dropDuplicates(key)
    found = alone.union(first)
    return found.select([F.col(n).alias(c) for c, n in names.items()])


def op6_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates among all documents."""
    rows, _ = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.drop("k1", "k2")
