"""The recurrent network: exact gradients, all windows, held-out accuracy."""

import re
import zlib

import numpy as np
import pytest

from catalograph.llm import quality as Q
from catalograph.llm import toxicity as T
from catalograph.llm.labelled import share_of_ones, training_rows
from tests.llm.conftest import sentence

BOUNDS = T.TrainingBounds(steps=60, texts_a_step=64)


def sample(number):
    texts, labels = [], []
    for i in range(number):
        words = sentence(i, 30 + i % 90).split()
        if i % 3 == 0:
            words[(7 * i) % len(words)] = ("vile", "grotesk" + "abcdefgh"[i % 8] + "xyz"[i % 7 % 3])[i % 2]
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def net():
    return T.train(*sample(600), BOUNDS)


def grams_of(words, number):
    """n-gram hashes of the form of a word."""
    ends = np.cumsum(words.lengths)
    form = words.form[number]
    return words.grams[ends[form] - words.lengths[form]:ends[form]].tolist()


def test_words_are_read_by_form():
    words = T.read_words(["Ab cd, ab", "", "...", "ab-CD é"])
    assert words.counts.tolist() == [3, 0, 0, 3] and len(words.hashes) == 3
    assert words.form[0] == words.form[2] == words.form[3] and words.form[1] == words.form[4] != words.form[5]
    assert words.lengths.tolist() == [1, 1, 1]


def test_every_character_of_a_word_is_an_input():
    """Also those after the sixth: n-grams at every position, those at the ends apart from those inside."""
    words = T.read_words(["prefixgood prefixevil prefixgood abc xabcx abcx"])
    good, evil = grams_of(words, 0), grams_of(words, 1)
    assert set(good) != set(evil) and set(good) & set(evil) and good == grams_of(words, 2)
    assert len(good) == (10 - 3 + 1) + (10 - 5 + 1)
    whole, inner, begins = (set(grams_of(words, n)) for n in (3, 4, 5))
    assert not whole & inner and not whole & begins
    for place in range(10):
        other = "prefixgood"[:place] + "z" + "prefixgood"[place + 1:]
        assert set(grams_of(T.read_words([other]), 0)) != set(good)


def test_slices_read_the_same_words(monkeypatch):
    texts = [sentence(n, 200) + f" word{n}" for n in range(9)] + [""]
    whole = T.read_words(texts)
    monkeypatch.setattr(T, "_PART", 100)
    parts = T._in_slices(texts)
    for name in ("form", "counts", "hashes", "grams", "lengths"):
        assert (getattr(whole, name) == getattr(parts, name)).all()


@pytest.mark.parametrize("count", [0, 1, 47, 48, 49, 80, 81, 1000])
def test_windows_cover_and_overlap(count):
    first, size, text = T.windows(np.array([3, count, 0, 5]))
    mine = [(int(f) - 3, int(s)) for f, s, t in zip(first, size, text) if t == 1]
    expected = []
    at = 0
    while count and (not expected or sum(expected[-1]) < count):
        expected.append((at, min(T.WINDOW, count - at)))
        at += T.STRIDE
    assert mine == expected


def test_logits_equal_a_plain_network(net):
    texts = [sentence(4, 70), "vile words here", "one"]
    words = T.read_words(texts)
    first, size, _ = T.windows(words.counts)
    got = net.logits(net.gates(net.given(words), words.form), first, size)
    word = net.word_forms.rows(words.hashes)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    H = T.HIDDEN
    for k, (f, s) in enumerate(zip(first, size)):
        states = np.zeros((s, 2, H))
        for side in (0, 1):
            h = np.zeros(H)
            for t in range(s) if side == 0 else range(s - 1, -1, -1):
                grams = net.piece_forms.rows(np.array(grams_of(words, f + t), np.uint64))
                x = np.concatenate((net.words[word[words.form[f + t]]], net.pieces[grams].mean(0))) @ net.inputs + net.bias
                x, b = x[side * 3 * H:(side + 1) * 3 * H], h @ net.recurrent[side]
                z, r = sigmoid(x[:H] + b[:H]), sigmoid(x[H:2 * H] + b[H:2 * H])
                h = z * h + (1 - z) * np.tanh(x[2 * H:] + r * b[2 * H:])
                states[t, side] = h
        a = np.exp((states * net.attend).sum((1, 2)))
        pooled = (a[:, None, None] * states).sum(0) / a.sum()
        assert got[k] == pytest.approx((pooled * net.out).sum() + net.base[0], abs=1e-3)


def test_gradients_by_differences(net, monkeypatch):
    texts, labels = sample(6)
    words = T.read_words(texts)
    known = T.Known(words.form, net.word_forms.rows(words.hashes), net.piece_forms.rows(words.grams), words.lengths)
    first = np.concatenate(([0], np.cumsum(words.counts)[:-1]))
    size = np.minimum(words.counts, T.WINDOW)
    label = np.array(labels, np.float32)

    class All:
        random = staticmethod(lambda shape: np.ones(shape))
    grad = T._step(net, known, first, size, label, np.ones(6, np.float32), All, 0.0)

    def loss():
        logit = net.logits(net.gates(net.given(words), words.form), first, size).astype(float)
        return (np.logaddexp(0, logit) - label * logit).mean()
    rng = np.random.default_rng(0)
    for name in net.names:
        value = getattr(net, name)
        places = np.argsort(-np.abs(grad[name]).ravel())[:4] if name in ("words", "pieces") else \
            rng.integers(0, value.size, 4)
        for place in places:
            old = value.flat[place]
            value.flat[place] = old + 3e-2
            up = loss()
            value.flat[place] = old - 3e-2
            down = loss()
            value.flat[place] = old
            assert (up - down) / 6e-2 == pytest.approx(grad[name].flat[place], abs=2e-3, rel=0.15)


def test_learns(net):
    texts, labels = sample(900)
    scores = net.scores(texts[600:])
    assert ((scores >= 0.5) == np.array(labels[600:])).mean() > 0.95
    assert net.scores([" ".join([sentence(5, 5000), "vile", sentence(6, 5000)])])[0] > net.scores([sentence(5, 5000)])[0]


def test_scores_do_not_depend_on_the_batch(net):
    texts = [sentence(i, 10 + 37 * i) for i in range(30)] + ["", "...", "vile"]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=1e-5)
    assert ((together >= 0) & (together <= 1)).all()


def test_long_texts_are_scored_in_parts(net, monkeypatch):
    texts = [sentence(1, 3000) + " vile " + sentence(2, 2000), "", sentence(3, 40)]
    whole = net.scores(texts)
    monkeypatch.setattr(T, "_PART", 300)
    monkeypatch.setattr(T, "_WINDOWS", 7)
    assert np.allclose(net.scores(texts), whole, atol=1e-5)


def test_rows(spark, documents, net):
    frame = documents([(1, "a vile thing"), (1, "a vile thing"), (None, None), (3, ""), (4, sentence(1, 50000))], extra=True)
    rows = {(r.id, r.score, r.predicted) for r in T.score_toxicity(frame, net).collect()}
    assert len(rows) == 4 and T.score_toxicity(frame, net).count() == 5
    assert all((p == 1) == (s >= 0.5) for _, s, p in rows)
    kept = T.drop_toxic(frame, net)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, p in rows if p == 0}
    assert T.score_toxicity(documents([]), net).collect() == [] and T.drop_toxic(documents([]), net).collect() == []


def test_training_rows_leave_out_the_held_out_fold(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(60)] + [(None, "no id"), (61, None), (5, "text 5")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (61, 1), (5, 0), (7, None)],
                                   "doc_id long, toxic int")
    texts, ys = training_rows(docs, labels, "toxic", 100, 100, 1000)
    fold = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    assert [int(re.sub(r"\D", "", t)) for t in texts] == fold and ys == [i % 2 for i in fold]
    few = training_rows(docs, labels, "toxic", 3, 4, 1000)
    assert len(few[0]) == 7 and sum(few[1]) == 3


def test_without_labels(spark, documents):
    docs = documents([(1, "some text"), (2, "")])
    net = T.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in T.score_toxicity(docs, net).collect()] == [0, 0]
    one = T.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert [r.predicted for r in T.score_toxicity(docs, one).collect()] == [0, 0]


def test_held_out_labels_do_not_enter_the_fit(spark, documents):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, int(i % 4 == 0)) for i in range(200) if i not in held]
    same = [spark.createDataFrame(rows + [(i, y) for i in held] + more, "doc_id long, toxic int")
            for y, more in ((0, []), (1, rows[:1] * 50 + [(None, 1)]))]
    shares = [share_of_ones(labels, "toxic") for labels in same]
    assert shares == [sum(y for _, y in rows) / len(rows)] * 2
    docs = documents([(i, sentence(i, 20) + " vile" * int(i % 4 == 0)) for i in range(200)])
    bounds = T.TrainingBounds(steps=4)
    assert len({float(T.fit(docs, labels, bounds=bounds).base[0]) for labels in same}) == 1
    assert Q.fit(docs, same[0], "toxic").base == Q.fit(docs, same[1], "toxic").base


def test_long_labelled_texts_are_learnt_from(spark, documents):
    long = " ".join(f"word{i:05d}" for i in range(3000))
    docs = documents([(i, long if i % 2 else f"text {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    fold = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    every, ys = training_rows(docs, labels, "toxic", 100, 100, 100 * len(long))
    assert ys == [i % 2 for i in fold] and every == [long if y else f"text {i}" for i, y in zip(fold, ys)]
    # the bound takes whole rows: four of the long texts fit its half
    some, ys = training_rows(docs, labels, "toxic", 100, 100, 2 * (4 * len(long) + 5))
    assert [t for t, y in zip(some, ys) if y] == [long] * 4 and ys.count(0) == [i % 2 for i in fold].count(0)
    ys = [i % 2 for i in fold]
    fitted = Q.fit(docs, labels, "toxic")
    values = [Q.statistics(long if i % 2 else f"text {i}") for i in fold]
    plain = Q.train(values, ys, sum(ys) / len(ys))
    assert np.allclose(fitted.weights, plain.weights) and fitted.weights.any()
