"""Hierarchical empirical Bayes against a plain computation, and held-out accuracy."""

import math
from collections import defaultdict

import numpy as np
import pytest

from catalograph.llm import quality as Q
from catalograph.llm.tables import table
from tests.llm.conftest import sentence


def texts(number):
    out, labels = [], []
    for i in range(number):
        good = i % 4 != 0
        text = sentence(i, 20 + i % 60)
        out.append(text if good else (" | ".join(text.split()), text.upper() + "!!", "the " * 40, "%%% " + text)[i // 4 % 4])
        labels.append(int(good))
    return out, labels


@pytest.fixture(scope="module")
def classifier():
    return Q.train(*texts(800))


def test_classifier_separates_unseen_texts(classifier):
    given, labels = texts(1200)
    found = classifier.evidence(given[800:])
    assert ((found >= 0.5) == np.array(labels[800:])).mean() > 0.97
    assert ((found >= Q.LEAST_SHARE) & (found <= 1 - Q.LEAST_SHARE)).all()
    assert classifier.evidence([]).shape == (0,)


def test_statistics():
    values = dict(zip(Q.FEATURES, Q.statistics("The the\nthe %%% A1\n")))
    assert values["words"] == pytest.approx(math.log(6)) and values["distinct words"] == 4 / 5
    assert values["commonest word"] == 2 / 5 and values["repeated neighbours"] == 1 / 5
    assert values["longest run of marks"] == 3 and values["lines a word"] == 3 / 5 and values["distinct lines"] == 1
    assert len(Q.statistics("")) == len(Q.FEATURES) and all(map(math.isfinite, Q.statistics("")))


def test_statistics_of_parts(monkeypatch):
    text = sentence(3, 3000).replace("stone", "stone stone\n%%")
    whole = Q.statistics(text)
    cut = Q.cut_at_space
    monkeypatch.setattr(Q, "cut_at_space", lambda t: cut(t, 100))
    parts = Q.statistics(text)
    for name, a, b in zip(Q.FEATURES, whole, parts):
        if "line" not in name:  # a line that is cut counts as two
            assert a == pytest.approx(b), name


def plain(rows):
    """{place: (host share, path share)} by the formulas over Python lists."""
    host, path = defaultdict(list), defaultdict(list)
    for h, p, e in rows:
        host[h].append(e)
        path[h, p].append(e)
    n, s = len(rows), sum(e for _, _, e in rows)

    def weight(groups, parents):
        sizes = [len(g) for g, _ in groups]
        number = len(groups) - parents
        within = sum(sum((x - np.mean(g)) ** 2 for x in g) for g, _ in groups)
        between = sum(len(g) * (np.mean(g) - m) ** 2 for g, m in groups)
        squares = sum(k * k / t for k, t in zip(sizes, parents_of))
        if number < 1 or n <= number + 1 or n - squares <= 0:
            return 1e6
        spread = within / (n - number - 1)
        excess = (between - number * spread) / (n - squares)
        return float(np.clip(spread / excess, 1, 1e6)) if excess > 0 else 1e6
    parents_of = [n for _ in host]
    a = weight([(g, s / n) for g in host.values()], 1)
    parents_of = [len(host[h]) for h, _ in path]
    b = weight([(g, np.mean(host[h])) for (h, _), g in path.items()], len(host))
    out = []
    for h, p, e in rows:
        up = (sum(host[h]) - e + a * s / n) / (len(host[h]) - 1 + a)
        out.append((up, (sum(path[h, p]) - e + b * up) / (len(path[h, p]) - 1 + b)))
    return out


def rows():
    given, _ = texts(240)
    out = [(i, t, f"host{i % 5 if i % 4 else 0}", ("en", "de", None)[i % 3]) for i, t in enumerate(given)]
    return out + [(1000, None, None, None), (1001, "", None, "en"), (None, sentence(1, 30), "host1", "en"),
                  (7, given[7], "host2", "de"), (7, given[7], "host2", "de"), (1002, sentence(4, 40000), "rare", "fr")]


def test_scores_equal_the_plain_computation(spark, documents, classifier):
    given = rows()
    evidence = classifier.evidence([t or "" for _, t, _, _ in given])
    expected = plain([(h, p, e) for (_, _, h, p), e in zip(given, evidence)])
    got = Q.score_quality(documents(given, extra=True), classifier).collect()
    key = lambda r: (r[0] is None, r[0] or 0, round(r[1], 6))
    wanted = sorted(((i, e, h, p) for (i, _, _, _), e, (h, p) in zip(given, evidence, expected)), key=key)
    for r, w in zip(sorted(got, key=key), wanted):
        assert r.id == w[0]
        assert (r.evidence, r.host_share, r.path_share) == pytest.approx(w[1:], abs=1e-6)
        share = min(max(w[3], 0.001), 0.999)
        logit = math.log(w[1] / (1 - w[1])) - math.log(classifier.prior / (1 - classifier.prior)) + math.log(share / (1 - share))
        assert r.score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-6)
    assert len(got) == len(given)


def test_many_sparse_sites(documents, classifier):
    given, _ = texts(300)
    given = [(i, t, f"host{i % 170 if i % 3 else 0}", f"path{i % 7}") for i, t in enumerate(given)]
    evidence = classifier.evidence([t for _, t, _, _ in given])
    expected = plain([(h, p, e) for (_, _, h, p), e in zip(given, evidence)])
    got = {r.id: (r.host_share, r.path_share) for r in Q.score_quality(documents(given), classifier).collect()}
    assert len(got) == 300 and all(got[i] == pytest.approx(w, abs=1e-6) for (i, *_), w in zip(given, expected))


def test_keep_good(documents, classifier):
    frame = documents(rows(), extra=True)
    kept = Q.keep_good(frame, classifier)
    assert kept.columns == frame.columns
    scored = Q.score_quality(frame, classifier)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.id) for r in scored.where("score >= 0.5").collect())


def test_empty(spark, documents, classifier):
    assert Q.score_quality(documents([]), classifier).collect() == [] and Q.keep_good(documents([]), classifier).collect() == []
    blank = Q.fit(documents([(1, "a b")]), spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.evidence for r in Q.score_quality(documents([(1, "a b")]), blank).collect()] == [0.5]


def test_held_out_fold_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    from catalograph.llm.quality_queries import op10_quality_classifier
    found = op10_quality_classifier(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    assert found.selectExpr("avg(int(predicted = quality))").first()[0] > 0.9


def test_keep_good_of_many_sites(documents, classifier, monkeypatch):
    """Beyond the broadcast bound large sites are joined apart; the same rows stay."""
    rows = [(n, ("good words here " if n % 3 else "x9 x9 ") * (n % 7), f"host{n % 40}" if n % 4 else None, None if n % 5 == 0 else "en")
            for n in range(200)]
    frame = documents(rows, extra=True)
    near = Q.keep_good(frame, classifier)
    monkeypatch.setattr(Q, "BROADCAST_SITES", 0)
    apart = Q.keep_good(frame, classifier)
    assert apart.columns == near.columns and sorted(map(str, apart.collect())) == sorted(map(str, near.collect()))
