"""Operator 4, quality: a text classifier and hierarchical empirical Bayes over sites.

A logistic model reads a text: which of the common words of the labelled sample it
holds, and a few measures of its shape. It is fitted on about ``SAMPLE`` labelled
documents drawn by a hash of their id, so its size does not hang on the table's; the
vocabulary is the ``VOCABULARY`` words that most of those documents hold, of those in
``LEAST_DOCS`` or more, and of these the words that tell labels apart beyond chance.

Sites are two-level: a host, and paths on it. Labels are counted by path in one
aggregation. The rate of a host is its labels' rate shrunk towards the global rate, that
of a path is shrunk towards its host's, each as if ``strength`` more labels had the
parent's rate. The strengths are fitted by moments: the more hosts differ beyond what
chance gives, the less they are shrunk. A document with labels of its own is judged by
its site without them.

The classifier speaks of a document at the global rate. Its odds are moved by the odds
of the site against the global odds, for quality and for toxicity alike. A document is
kept if its quality is ``LEAST_QUALITY`` or more and its toxicity at most ``MOST_TOXIC``;
a target without any label decides nothing.

Defined results: a null text is an empty one; a null host or path is one of its own; a
site without labels has its parent's rate; labels that are null, or of documents that do
not exist, do not count; repeated labels count each; without any label all rates are 1/2
and all documents are kept; a null ``doc_id`` has no labels; repeated rows are judged
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import small_side, table
from martflow.plans.staging import stage

SAMPLE = 10_000
VOCABULARY = 20_000
LEAST_DOCS = 8
STEM = 5
LEAST_DEVIATION = 4.0  # standard deviations by which a word must tell labels apart
SEED = 4
TARGETS = ("quality", "toxic")
SHAPE = 9
MOST_EVIDENCE = 12.0  # log odds a text alone can give
LEAST_QUALITY = 0.5
MOST_TOXIC = 0.3  # a toxic document kept is worse than a clean one lost
_ROWS = 1000
_TRIM = string.punctuation + string.digits
_MOST_STRENGTH = 10_000.0


def _class(chars: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars.encode())] = True
    return found


_UPPER, _LOWER = _class(string.ascii_uppercase), _class(string.ascii_lowercase)
_DIGIT, _MARK = _class(string.digits), _class("#*$%&|<>=_~^@{}[]")
_SHOUT, _SPACE = _class("!?"), _class(" \t\n\x0b\x0c\r")


def read_texts(texts):
    """Of an Arrow array: (text number, word number) of distinct words, words, shapes.

    Words are trimmed of marks and digits and brought to lower case; the first letters
    of a longer one, with a star, count as a word too, so that its other forms tell.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    docs = np.repeat(np.arange(rows), np.diff(split.offsets.to_numpy()))
    plain = [w.strip(_TRIM).lower() for w in coded.dictionary.to_pylist()]
    stems = [f"{w[:STEM]}*" if len(w) > STEM else w for w in plain]
    words = list(dict.fromkeys([*plain, *stems]))
    number = {w: i for i, w in enumerate(words)}
    count = max(1, len(words))
    own = np.empty(0, np.int64)
    if len(codes):
        names = np.array([[number[w] for w in plain], [number[w] for w in stems]], np.int64)
        own = np.unique(docs * count + names[:, codes])

    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: rows + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]

    def share(marked):
        return np.diff(np.searchsorted(np.flatnonzero(marked[raw]), bounds))

    size = np.maximum(np.diff(bounds), 1)
    n_words = np.bincount(docs, minlength=rows)
    some = np.maximum(n_words, 1)
    letters = np.maximum(share(_UPPER) + share(_LOWER), 1)
    lines = pc.split_pattern(texts, "\n")
    line_doc = np.repeat(np.arange(rows), np.diff(lines.offsets.to_numpy()))
    line = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    line_kinds = int(line.max()) + 1 if len(line) else 1
    different = np.unique(line_doc * line_kinds + line) // line_kinds
    all_lines = np.maximum(np.bincount(line_doc, minlength=rows), 1)
    shape = [
        np.log1p(n_words),
        np.log1p(size / some),
        share(_UPPER) / letters,
        share(_DIGIT) / size,
        share(_MARK) / size,
        share(_SHOUT) / size,
        np.bincount(own // count, minlength=rows) / (2 * some),
        np.bincount(different, minlength=rows) / all_lines,
        share(_SPACE) / size,
    ]
    return own // count, own % count, words, np.stack(shape, 1)


@dataclass
class Classifier:
    """Logistic weights by word and by shape; a column for each target."""

    words: dict[str, int]
    word_weights: np.ndarray  # (words, targets)
    shape_mean: np.ndarray
    shape_scale: np.ndarray
    shape_weights: np.ndarray  # (shapes, targets)
    bias: np.ndarray

    def logits(self, texts) -> np.ndarray:
        docs, codes, words, shape = read_texts(texts)
        known = np.array([self.words.get(w, -1) for w in words], np.int64)
        own = known[codes] if len(codes) else codes
        docs, own = docs[own >= 0], own[own >= 0]
        out = self.bias + _standard(shape, self.shape_mean, self.shape_scale) @ self.shape_weights
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(docs, weights=self.word_weights[own, k], minlength=len(out))
        return np.clip(out, -MOST_EVIDENCE, MOST_EVIDENCE)


def _standard(shape, mean, scale):
    return np.clip((shape - mean) / scale, -5, 5)


def telling(docs: np.ndarray, words: np.ndarray, labels: np.ndarray, count: int) -> np.ndarray:
    """(words, targets): whether a word stands in yes and no documents unlike by chance."""
    out = np.zeros((count, labels.shape[1]), bool)
    for k in range(labels.shape[1]):
        yes, no = (labels[:, k] > 0.5), (labels[:, k] >= 0) & (labels[:, k] <= 0.5)
        held = [np.bincount(words[own[docs]], minlength=count) for own in (yes, no)]
        n = [max(1, int(own.sum())) for own in (yes, no)]
        rate = (held[0] + held[1]) / (n[0] + n[1])
        spread = np.sqrt(rate * (1 - rate) * (1 / n[0] + 1 / n[1]))
        out[:, k] = np.abs(held[0] / n[0] - held[1] / n[1]) >= LEAST_DEVIATION * spread + 1e-12
    return out


def fit(
    docs: np.ndarray, words: np.ndarray, shape: np.ndarray, labels: np.ndarray,
    vocabulary: list[str], steps: int = 600, rate: float = 0.1, ridge: float = 1e-5,
) -> Classifier:
    """Fit both targets with Adam on whole batches; labels below 0 are unknown."""
    count, targets = labels.shape
    used = telling(docs, words, labels, len(vocabulary))
    kept = np.flatnonzero(used.any(axis=1))
    number = np.full(len(vocabulary) + 1, -1)
    number[kept] = np.arange(len(kept))
    docs, words = docs[number[words] >= 0], number[words[number[words] >= 0]]
    used, vocabulary = used[kept], [vocabulary[i] for i in kept]
    mean, spread = shape.mean(0), shape.std(0) + 1e-6
    dense = _standard(shape, mean, spread)
    known = labels >= 0
    rates = ((labels * known).sum(0) + 0.5) / (known.sum(0) + 1)
    weights = [
        np.zeros((len(vocabulary), targets)),
        np.zeros((dense.shape[1], targets)),
        np.log(rates / (1 - rates)),
    ]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, steps + 1):
        score = dense @ weights[1] + weights[2]
        for k in range(targets):
            score[:, k] += np.bincount(docs, weights=weights[0][words, k], minlength=count)
        wrong = (1 / (1 + np.exp(-score.clip(-30, 30))) - labels) * known
        wrong /= np.maximum(known.sum(0), 1)
        by_word = [
            np.bincount(words, weights=wrong[docs, k], minlength=len(vocabulary))
            for k in range(targets)
        ]
        by_word = (np.stack(by_word, 1) + ridge * weights[0]) * used
        gradients = [by_word, dense.T @ wrong + ridge * weights[1], wrong.sum(0)]
        for weight, m, v, g in zip(weights, first, second, gradients, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Classifier(
        {w: i for i, w in enumerate(vocabulary)}, weights[0], mean, spread, weights[1], weights[2]
    )


def label_counts(labels: DataFrame) -> DataFrame:
    """(labelled_id, n_<target>, s_<target>): labels of a document and those that say yes."""
    aggregates = []
    for target in TARGETS:
        value = F.col(target).cast("int")
        aggregates += [
            F.count(value).alias(f"n_{target}"),
            F.coalesce(F.sum((value > 0).cast("int")), F.lit(0)).alias(f"s_{target}"),
        ]
    doc_id = F.col("doc_id").cast("long").alias("labelled_id")
    return labels.filter("doc_id is not null").groupBy(doc_id).agg(*aggregates)


def train(documents: DataFrame, counts: DataFrame, sample: int = SAMPLE) -> Classifier | None:
    """Fit the classifier on a bounded sample of the labelled documents; None without any."""
    span = 1 << 30
    labelled = counts.count()
    if not labelled:
        return None
    mark = F.pmod(F.xxhash64(F.lit(SEED), "labelled_id"), F.lit(span))
    drawn = small_side(stage(counts.filter(mark < min(span, span * sample // labelled + 1)), "site-drawn"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.join(drawn, F.col("doc_id") == F.col("labelled_id"))
    says = [F.when(F.col(f"n_{t}") > 0, F.col(f"s_{t}") / F.col(f"n_{t}")).otherwise(-1.0).alias(t) for t in TARGETS]

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            own, codes, words, shape = read_texts(batch.column("text"))
            offsets = np.searchsorted(own, np.arange(batch.num_rows + 1))
            listed = pa.DictionaryArray.from_arrays(
                pa.array(codes, pa.int64()), pa.array(words, pa.string())
            ).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *[batch.column(t) for t in TARGETS],
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), listed),
                    pa.array(shape.tolist(), pa.list_(pa.float64())),
                ],
                names=["doc_id", *TARGETS, "words", "shape"],
            )

    ddl = "doc_id long, quality double, toxic double, words array<string>, shape array<double>"
    found = stage(docs.select("doc_id", "text", *says).mapInArrow(features, ddl), "site-sample")
    words = found.select(F.explode("words").alias("word")).filter("word != ''")
    words = words.groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    words = words.filter(F.col("docs") >= LEAST_DOCS).orderBy(F.desc("docs"), "word")
    vocabulary = [r.word for r in words.limit(VOCABULARY).collect()]
    number = {w: i for i, w in enumerate(vocabulary)}

    def numbered(batches):
        import pyarrow as pa

        for batch in batches:
            held = [
                np.array([number[w] for w in own if w in number], "<i4").tobytes()
                for own in batch.column("words").to_pylist()
            ]
            columns = [batch.column(n) for n in ("doc_id", *TARGETS, "shape")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(held, pa.binary())], names=["doc_id", *TARGETS, "shape", "held"]
            )

    ddl = "doc_id long, quality double, toxic double, shape array<double>, held binary"
    rows = found.mapInArrow(numbered, ddl).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.doc_id, r.shape))
    return fit(
        np.repeat(np.arange(len(rows)), [len(r.held) // 4 for r in rows]),
        np.frombuffer(b"".join(r.held for r in rows), "<i4").astype(np.int64),
        np.array([r.shape for r in rows]),
        np.array([[r.quality, r.toxic] for r in rows]),
        vocabulary,
    )


def evidence(documents: DataFrame, model: Classifier | None, host: str, path: str) -> DataFrame:
    """(doc_id, host, path, logit_quality, logit_toxic); the texts are read once."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.col(path).cast("string").alias("path"),
        F.col("text").cast("string").alias("text"),
    )

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                if model is None:
                    logits = np.zeros((part.num_rows, len(TARGETS)))
                else:
                    logits = model.logits(part.column("text"))
                columns = [part.column(n) for n in ("doc_id", "host", "path")]
                columns += [pa.array(logits[:, k], pa.float64()) for k in range(len(TARGETS))]
                names = ["doc_id", "host", "path", *(f"logit_{t}" for t in TARGETS)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(
        judge, "doc_id long, host string, path string, logit_quality double, logit_toxic double"
    )


def strength(n: Column, s: Column, parent: Column) -> Column:
    """Aggregate: as how many labels the parent's rate counts, fitted by moments.

    Over groups with ``n`` labels, ``s`` of them yes, the squared distance of ``s / n``
    from the parent's rate ``p`` is ``p (1 - p) / n`` by chance alone, and
    ``p (1 - p) (1 + (n - 1) / (strength + 1)) / n`` if the groups' own rates differ.
    """
    chance = parent * (1 - parent)
    distance = F.sum(F.when(n > 0, (s - n * parent) * (s - n * parent) / n))
    by_chance = F.sum(F.when(n > 0, chance))
    slope = F.sum(F.when(n > 0, chance * (n - 1)))
    share = (distance - by_chance) / F.nullif(slope, F.lit(0.0))
    fitted = F.when(share <= 1 / (_MOST_STRENGTH + 1), _MOST_STRENGTH)
    fitted = fitted.when(share >= 0.5, 1.0).otherwise(1 / share - 1)
    return F.when(share.isNull(), _MOST_STRENGTH).otherwise(fitted)


def site_rates(paths: DataFrame) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """Label counts of each path beside its host's, and the global figures.

    The figures are three numbers a target: the global rate, and how many labels it
    counts for at a host, and a host's rate at a path. They are aggregates of the sites.
    """
    sums = [F.sum(f"{k}_{t}").alias(f"host_{k}_{t}") for k in "ns" for t in TARGETS]
    hosts = stage(paths.groupBy("host").agg(*sums), "site-hosts")
    totals = hosts.agg(*[F.sum(f"host_{k}_{t}").alias(f"{k}_{t}") for k in "ns" for t in TARGETS])
    totals = totals.first().asDict()
    rate = {t: ((totals[f"s_{t}"] or 0) + 0.5) / ((totals[f"n_{t}"] or 0) + 1) for t in TARGETS}
    at_host = hosts.agg(
        *[
            strength(F.col(f"host_n_{t}"), F.col(f"host_s_{t}"), F.lit(rate[t])).alias(t)
            for t in TARGETS
        ]
    ).first()
    hosts = hosts.withColumnRenamed("host", "of_host")
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    at_path = sites.agg(
        *[
            strength(
                F.col(f"n_{t}"),
                F.col(f"s_{t}"),
                _shrunk(F.col(f"host_s_{t}"), F.col(f"host_n_{t}"), at_host[t], F.lit(rate[t])),
            ).alias(t)
            for t in TARGETS
        ]
    ).first()
    return sites, {
        t: {"rate": rate[t], "host": at_host[t], "path": at_path[t], "labels": totals[f"n_{t}"] or 0}
        for t in TARGETS
    }


def _shrunk(s: Column, n: Column, k: float, parent: Column) -> Column:
    return (s + k * parent) / (n + k)


def _logit(rate: Column) -> Column:
    return F.ln(rate / (1 - rate))


def judge(
    documents: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    model: Classifier | None = None,
) -> DataFrame:
    """doc_id, the text's, the site's and the joint probability per target, kept."""
    counts = stage(label_counts(labels), "site-labels")
    model = model or train(documents, counts)
    judged = stage(evidence(documents, model, host, path), "site-evidence")
    own = judged.join(counts, F.col("doc_id") == F.col("labelled_id"), "left").drop("labelled_id")
    count_columns = [f"{k}_{t}" for k in "ns" for t in TARGETS]
    own = own.fillna(0, count_columns)
    paths = own.groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in count_columns])
    sites, figures = site_rates(stage(paths, "site-paths"))
    sites = stage(sites, "site-rates")
    renamed = {"host": "of_host", "path": "of_path"} | {c: f"path_{c}" for c in count_columns}
    sites = small_side(sites.withColumnsRenamed(renamed))
    found = own.join(
        sites, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    )
    columns = []
    for t in TARGETS:
        n, s, fitted = F.col(f"n_{t}"), F.col(f"s_{t}"), figures[t]
        rate = F.lit(fitted["rate"])
        others = [(F.col(f"{p}_s_{t}") - s, F.col(f"{p}_n_{t}") - n) for p in ("host", "path")]
        of_host = _shrunk(*others[0], fitted["host"], rate)
        of_path = _shrunk(*others[1], fitted["path"], of_host)
        joint = F.col(f"logit_{t}") + _logit(of_path) - _logit(rate)
        columns += [
            (1 / (1 + F.exp(-F.col(f"logit_{t}")))).alias(f"text_{t}"),
            of_path.alias(f"site_{t}"),
            (1 / (1 + F.exp(-joint))).alias(t),
        ]
    found = found.select("doc_id", *columns)
    good = F.lit(not figures["quality"]["labels"]) | (F.col("quality") >= LEAST_QUALITY)
    clean = F.lit(not figures["toxic"]["labels"]) | (F.col("toxic") <= MOST_TOXIC)
    return found.withColumn("kept", good & clean)


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of all documents; the host is the source, a path its language."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
