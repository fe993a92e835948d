"""Operator 8, language: a bidirectional recurrent network over the bytes of a text.

Two gated recurrent networks read the UTF-8 bytes of a text, one forwards, one
backwards, in stretches of ``STRETCH`` bytes; at every byte their states give
probabilities of the languages. Those of all letters of the whole text are averaged,
and the most likely language is the prediction, its average the score.

The network is trained in numpy by backpropagation through time on a bounded sample:
about ``SAMPLE`` documents of each language, drawn by a hash of their id, and
``EXCERPTS`` stretches of each. Only documents with a language and an id whose crc32,
modulo 4, is not 2 are drawn. The sample and the weights are of a fixed size, however
large the table is; prediction reads every byte of every text, without a shuffle.

Defined results: a text that is null or holds no letter is ``und``, with score 0; where
no document can be learned from, all are ``und``; ties go to the language that comes
first by code point; a null ``doc_id`` is not held out, and never learned from; repeated
rows are predicted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import returning, table

SAMPLE = 400
EXCERPTS = 4
STRETCH = 96
STATES = 8
STEPS = 200
BATCH = 256
RATE = 0.02
SEED = 8
LEAST_SCORE = 0.4
UNKNOWN = "und"
_AT_ONCE = 2048
_LETTERS = np.zeros(256, np.float32)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_ASCII_LETTER = re.compile("[A-Za-z]")


@dataclass
class Network:
    """Weights; the first axis of ``inputs``, ``states`` is the direction.

    The last axis of both holds the update, reset and candidate parts in a row.
    """

    languages: list[str]
    inputs: np.ndarray  # (2, 256, 3 * states): what each byte adds, biases included
    states: np.ndarray  # (2, states, 3 * states)
    outputs: np.ndarray  # (2 * states, languages)
    bias: np.ndarray  # (languages,)

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.outputs, self.bias]


def new_network(languages: list[str], size: int = STATES, seed: int = SEED) -> Network:
    draw = np.random.default_rng(seed)

    def random(*shape, scale):
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        languages,
        random(2, 256, 3 * size, scale=0.5),
        random(2, size, 3 * size, scale=size**-0.5),
        random(2 * size, len(languages), scale=size**-0.5),
        np.zeros(len(languages), np.float32),
    )


def loss_and_gradients(net: Network, data: np.ndarray, labels: np.ndarray, mask: np.ndarray):
    """Mean cross entropy over the masked bytes, and its gradients in order of weights.

    ``data`` (rows, bytes), ``labels`` (rows,), ``mask`` (rows, bytes).
    """
    rows, length = data.shape
    size = net.states.shape[1]
    both = np.stack([data.T, data.T[::-1]])  # (direction, step, row)
    way = np.array([[0], [1]])
    state = np.zeros((2, rows, size), net.inputs.dtype)
    kept, seen = [], []
    for t in range(length):
        add = net.inputs[way, both[:, t]]
        turn = state @ net.states
        gates = 0.5 * (1 + np.tanh(0.5 * (add[..., : 2 * size] + turn[..., : 2 * size])))
        update, reset = gates[..., :size], gates[..., size:]
        fresh = np.tanh(add[..., 2 * size :] + reset * turn[..., 2 * size :])
        kept.append((state, update, reset, fresh, turn[..., 2 * size :]))
        state = fresh + update * (state - fresh)
        seen.append(state)
    seen = np.stack(seen)  # (step, direction, row, state)
    ahead, back = seen[:, 0], seen[::-1, 1]
    joint = np.concatenate([ahead, back], axis=2)  # (byte, row, 2 * state)
    score = joint @ net.outputs + net.bias
    score -= score.max(axis=2, keepdims=True)
    chance = np.exp(score)
    chance /= chance.sum(axis=2, keepdims=True)
    weight = (mask.T / mask.sum()).astype(net.inputs.dtype)
    right = chance[:, np.arange(rows), labels]
    loss = -float((np.log(right + 1e-30) * weight).sum())

    wrong = chance
    wrong[:, np.arange(rows), labels] -= 1
    wrong = wrong * weight[:, :, None]
    flat = wrong.reshape(-1, wrong.shape[2])
    d_outputs = joint.reshape(len(flat), -1).T @ flat
    d_bias = flat.sum(axis=0)
    d_joint = wrong @ net.outputs.T
    d_seen = np.stack([d_joint[..., :size], d_joint[::-1, :, size:]], axis=1)

    d_states = np.zeros_like(net.states)
    d_adds = np.empty((2, length, rows, 3 * size), net.inputs.dtype)
    d_state = np.zeros_like(state)
    for t in range(length - 1, -1, -1):
        before, update, reset, fresh, turned = kept[t]
        d_state = d_state + d_seen[t]
        d_fresh = d_state * (1 - update) * (1 - fresh * fresh)
        d_update = d_state * (before - fresh) * update * (1 - update)
        d_reset = d_fresh * turned * reset * (1 - reset)
        d_adds[:, t] = np.concatenate([d_update, d_reset, d_fresh], axis=2)
        d_turn = np.concatenate([d_update, d_reset, d_fresh * reset], axis=2)
        d_states += before.transpose(0, 2, 1) @ d_turn
        d_state = d_state * update + d_turn @ net.states.transpose(0, 2, 1)
    d_inputs = np.stack([_by_byte(both[d], d_adds[d]) for d in range(2)])
    return loss, [d_inputs, d_states, d_outputs, d_bias]


def _by_byte(data: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """Sum the gradients of each byte."""
    flat = gradient.reshape(-1, gradient.shape[-1])
    order = np.argsort(data, axis=None, kind="stable")
    sorted_bytes = data.reshape(-1)[order]
    starts = np.flatnonzero(np.diff(sorted_bytes, prepend=-1))
    total = np.zeros((256, flat.shape[1]), flat.dtype)
    total[sorted_bytes[starts]] = np.add.reduceat(flat[order], starts, axis=0)
    return total


def train(
    stretches: list[tuple[str, bytes]],
    size: int = STATES,
    steps: int = STEPS,
    batch: int = BATCH,
    rate: float = RATE,
    seed: int = SEED,
) -> Network | None:
    """Fit a network to (language, bytes) rows with Adam; None if there are none."""
    if not stretches:
        return None
    stretches = sorted(stretches)
    languages = sorted({language for language, _ in stretches})
    data = np.zeros((len(stretches), STRETCH), np.int64)
    mask = np.zeros((len(stretches), STRETCH), np.float32)
    for i, (_, own) in enumerate(stretches):
        data[i, : len(own)] = np.frombuffer(own, np.uint8)
        mask[i, : len(own)] = _LETTERS[data[i, : len(own)]]
    labels = np.array([languages.index(language) for language, _ in stretches])
    by_language = [np.flatnonzero(labels == i) for i in range(len(languages))]
    net = new_network(languages, size, seed)
    draw = np.random.default_rng([seed, 1])
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        # languages alike, however many stretches each has
        rows = [draw.choice(own, -(-batch // len(languages))) for own in by_language]
        rows = np.concatenate(rows)
        if not mask[rows].any():
            continue
        _, gradients = loss_and_gradients(net, data[rows], labels[rows], mask[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        slower = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for weight, m, v, g in zip(net.weights(), first, second, gradients, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            fair = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            weight -= slower * fair
    return net


class Reader:
    """Predicts texts; gates are scaled ahead so that one tanh serves them."""

    def __init__(self, net: Network):
        size = net.states.shape[1]
        half = np.ones(3 * size, np.float32)
        half[: 2 * size] = 0.5
        self.languages, self.size = net.languages, size
        self.inputs = [np.ascontiguousarray(w * half) for w in net.inputs]
        self.states = [np.ascontiguousarray(w * half) for w in net.states]
        self.outputs = [net.outputs[:size], net.outputs[size:]]
        self.bias = net.bias

    def _run(self, data: np.ndarray, way: int) -> np.ndarray:
        """What one direction adds to the scores: (byte, row, language)."""
        length, rows = data.shape
        size, inputs, turns = self.size, self.inputs[way], self.states[way]
        state = np.zeros((rows, size), np.float32)
        out = np.empty((length, rows, len(self.languages)), np.float32)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            add = inputs[data[t]]
            turn = state @ turns
            gates = add[:, : 2 * size] + turn[:, : 2 * size]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            fresh = turn[:, 2 * size :]
            fresh *= gates[:, size:]
            fresh += add[:, 2 * size :]
            np.tanh(fresh, out=fresh)
            state -= fresh
            state *= gates[:, :size]
            state += fresh
            np.matmul(state, self.outputs[way], out=out[t])
        return out

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """Summed language probabilities over the letters of each text."""
        sizes = np.array([len(t) for t in texts])
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.repeat(np.cumsum(sizes) - sizes, pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low = starts + number * STRETCH
        lengths = np.minimum(sizes[owner] - number * STRETCH, STRETCH)
        total = np.zeros((len(texts), len(self.languages)))
        step = np.arange(STRETCH)
        for at in range(0, len(owner), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            inside = step[:, None] < lengths[part]
            index = np.minimum(low[part] + step[:, None], len(raw) - 1)
            data = np.where(inside, raw[index], 0)
            mask = _LETTERS[data]
            score = self._run(data, 0)
            score += self._run(data, 1)
            score += self.bias
            score -= score.max(axis=2, keepdims=True)
            np.exp(score, out=score)
            score *= (mask / score.sum(axis=2))[:, :, None]
            np.add.at(total, owner[part], score.sum(axis=0, dtype=np.float64))
        return total


def _fold(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def sample_stretches(documents: DataFrame, sample: int = SAMPLE) -> list[tuple[str, bytes]]:
    """(language, bytes) of the documents drawn to learn from; bounded by the parameters."""
    text = F.col("text").cast("string")
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        text.alias("text"),
    )
    usable = docs.filter((_fold() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    span = 1 << 30
    mark = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(span))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return []
    limits = F.create_map(
        *[F.lit(x) for r in counts for x in (r.lang, min(span, span * sample // r.n + 1))]
    )
    drawn = usable.filter(mark < F.element_at(limits, F.col("lang")))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for lang, text in zip(
                batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                if not has_letter(text):
                    continue
                data = text.encode()
                last = max(0, len(data) - STRETCH)
                starts = {last * k // (EXCERPTS - 1) for k in range(EXCERPTS)}
                rows += [(lang, data[s : s + STRETCH]) for s in sorted(starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                names=["lang", "data"],
            )

    found = drawn.select("lang", "text").mapInArrow(cut, "lang string, data binary")
    return [(r.lang, bytes(r.data)) for r in found.collect()]


def has_letter(text: str) -> bool:
    """Whether one of its characters is a letter; numerals like ``Ⅷ`` or ``²`` are none."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def _predicted(net: Network | None, text_column: str):
    """For ``mapInArrow``: put lang_pred and score behind the columns of a row."""

    def predict(batches):
        import pyarrow as pa

        reader = Reader(net) if net else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(text_column).to_pylist()
                known = [i for i, t in enumerate(texts) if reader and t and has_letter(t)]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    total = reader([texts[i].encode() for i in known])
                    share = total / total.sum(axis=1, keepdims=True)
                    best = share.argmax(axis=1)
                    for i, b, s in zip(known, best, share, strict=True):
                        names[i], scores[i] = reader.languages[b], float(s[b])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, "lang_pred", "score"],
                )

    return returning(predict)


def predict(documents: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    docs = docs.withColumn("held_out", F.coalesce(_fold() == 2, F.lit(False)))
    found = docs.mapInArrow(
        _predicted(net, "text"),
        "doc_id long, text string, held_out boolean, lang_pred string, score double",
    )
    return found.select("doc_id", "held_out", "lang_pred", "score")


def keep_known(documents: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows in a language that was learned, told well enough; their columns as they are."""
    net = train(sample_stretches(documents))
    names = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    inner = documents.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    text = names["text"]
    if dict(inner.dtypes)[text] != "string":
        text = "text"
        inner = inner.withColumn(text, F.col(names["text"]).cast("string"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields)
    found = inner.mapInArrow(_predicted(net, text), f"{ddl}, lang_pred string, score double")
    found = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return found.select([F.col(n).alias(c) for c, n in names.items()])


def op8_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, by a network trained on three of four folds."""
    documents = table(spark, sf_dir, "documents")
    return predict(documents, train(sample_stretches(documents)))
