import zlib

import numpy as np
import pytest

from martflow.llm import byte_language as lang

SCHEMA = "doc_id long, text string, lang string, source string, score string, lang_pred int"
EN = "the thing and that other of which is not there on the hill with them "
FR = "été élevé où l'élève a reçu une leçon près du château âgé naïf très "


def small_network(seed=1, languages=("en", "fr")):
    net = lang.new_network(list(languages), 3, seed)
    for i, weight in enumerate(net.weights()):
        weight += np.random.default_rng(i).standard_normal(weight.shape).astype(np.float32) * 0.1
    return net


def test_gradients_against_differences():
    net = small_network()
    net = lang.Network(net.languages, *[w.astype(np.float64) for w in net.weights()])
    draw = np.random.default_rng(2)
    data = draw.integers(0, 6, (4, 7))
    labels, mask = np.array([0, 1, 1, 0]), draw.random((4, 7)).round()
    _, gradients = lang.loss_and_gradients(net, data, labels, mask)
    for weight, gradient in zip(net.weights(), gradients, strict=True):
        places = list(np.ndindex(weight.shape))
        if weight.ndim == 3 and weight.shape[1] == 256:
            places = [p for p in places if p[1] < 7]
        for place in places[:: max(1, len(places) // 25)]:
            old, move = weight[place], 1e-5
            weight[place] = old + move
            up, _ = lang.loss_and_gradients(net, data, labels, mask)
            weight[place] = old - move
            down, _ = lang.loss_and_gradients(net, data, labels, mask)
            weight[place] = old
            assert gradient[place] == pytest.approx((up - down) / (2 * move), abs=1e-6)


def one_by_one(net, text):
    """Summed probabilities of a text, one byte and one gate at a time."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    size = net.states.shape[1]
    total = np.zeros(len(net.languages))
    for at in range(0, len(text), lang.STRETCH):
        part = text[at : at + lang.STRETCH]
        padded = part + b"\0" * (lang.STRETCH - len(part))
        states = []
        for way in range(2):
            state, own = np.zeros(size), []
            for byte in padded if way == 0 else padded[::-1]:
                add, turn = net.inputs[way][byte].astype(float), state @ net.states[way]
                update = sigmoid(add[:size] + turn[:size])
                reset = sigmoid(add[size : 2 * size] + turn[size : 2 * size])
                fresh = np.tanh(add[2 * size :] + reset * turn[2 * size :])
                state = (1 - update) * fresh + update * state
                own.append(state)
            states.append(own if way == 0 else own[::-1])
        for byte, ahead, back in zip(part, *states, strict=False):
            if chr(byte).isalpha() and byte < 128 or byte >= 128:
                score = np.exp(np.concatenate([ahead, back]) @ net.outputs + net.bias)
                total += score / score.sum()
    return total


def test_reader_against_one_byte_at_a_time():
    net = small_network()
    texts = [EN.encode() * 4, b"a", FR.encode(), b"x" * lang.STRETCH, "é1 2 日".encode()]
    got = lang.Reader(net)(texts)
    for text, own in zip(texts, got, strict=True):
        assert own == pytest.approx(one_by_one(net, text), rel=1e-4)


def rows():
    out = []
    for i in range(80):
        turned = (EN if i % 2 else FR)[i % 9 :]
        out.append((i, turned * (1 + i % 5), "en" if i % 2 else "fr", "s"))
    out += [(100, None, "en", "s"), (101, "", None, None), (102, "123 --- 4_5", "fr", "s")]
    out += [(103, EN * 3000, None, "s"), (None, FR, "fr", "s"), (104, "Ж", "en", "s")]
    out += [(105, EN, "en", "s")] * 3
    return out


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA)
    stretches = lang.sample_stretches(docs)
    held_out = {str(i) for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    net = lang.train(stretches, steps=60)
    got = lang.predict(docs, net).collect()
    assert len(got) == len(rows())
    by_id = {r.doc_id: r for r in got}
    assert {by_id[i].lang_pred for i in (100, 101, 102)} == {"und"}
    assert by_id[103].lang_pred == "en" and by_id[None].lang_pred == "fr"
    assert by_id[104].lang_pred in ("en", "fr")
    assert all(by_id[i].lang_pred == ("en" if i % 2 else "fr") for i in range(80))
    assert all(r.held_out == (str(r.doc_id) in held_out) for r in got)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.lang_pred != "und") for r in got)
    again = lang.predict(docs, lang.train(lang.sample_stretches(docs), steps=60)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_learns_from_the_other_folds_only(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA)
    before = sorted(lang.sample_stretches(docs))
    changed = [
        (i, t, "zz" if i is None or zlib.crc32(str(i).encode()) % 4 == 2 else n, s)
        for i, t, n, s in rows()
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in changed], SCHEMA)
    assert sorted(lang.sample_stretches(docs)) == before


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, EN, None, None, "x", 1)], SCHEMA)
    assert lang.train(lang.sample_stretches(docs)) is None
    assert lang.predict(docs, None).collect()[0].lang_pred == "und"
    empty = spark.createDataFrame([], SCHEMA)
    assert lang.predict(empty, lang.train(lang.sample_stretches(empty))).count() == 0
    assert lang.keep_known(empty).count() == 0


def test_stage_keeps_columns_and_rows(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA)
    kept = lang.keep_known(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(80)) <= ids and not ids & {100, 101, 102}


def test_held_out_accuracy_of_the_query(spark):
    import duckdb

    path = "/root/testdata/sf0.01/documents.parquet"
    want = dict(duckdb.sql(f"select doc_id, lang from '{path}'").fetchall())
    got = lang.op8_byte_language(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(want)
    held_out = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held_out]) >= 0.98


@pytest.mark.parametrize("text", ["²", "½", "² ½", "Ⅷ ①", "12 _ 3", "", "٣", "\n"])
def test_numerals_are_no_letters(spark, text):
    assert not lang.has_letter(text)
    docs = spark.createDataFrame([(1, text), (2, text + "é")], "doc_id long, text string")
    net = lang.Network(
        ["en", "fr"], np.zeros((2, 256, 6), np.float32), np.zeros((2, 2, 6), np.float32),
        np.zeros((4, 2), np.float32), np.zeros(2, np.float32),
    )
    found = {r.doc_id: r.lang_pred for r in lang.predict(docs, net).collect()}
    assert found[1] == "und" and found[2] in ("en", "fr")
