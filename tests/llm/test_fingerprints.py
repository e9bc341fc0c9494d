"""SimHash votes, edited texts and radius search against plain computations."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import fingerprints as S
from tests.llm.conftest import sentence


def as_int(print_):
    return int.from_bytes(bytes(print_), "big")


def test_votes_are_those_of_the_terms(monkeypatch):
    text = "Ab cd ab, x1 é cd"
    rows = np.zeros((1, S.ROWS))
    S._votes([text], [0], rows)
    alone = np.zeros((1, S.ROWS))
    for part in ("ab cd", "ab x1", "é cd"):
        S._votes([part], [0], alone)
    for part in ("cd ab", "x1 é"):  # the pairs across, without their words
        S._votes([part], [0], alone)
        minus = np.zeros((1, S.ROWS))
        for word in part.split():
            S._votes([word], [0], minus)
        alone -= minus
    assert np.allclose(rows, alone)
    votes = rows[0] @ S._signs()
    assert (np.unpackbits(S.fingerprints([text])[0]) == (votes > 1e-9)).all()


def test_short_texts_have_fingerprints_of_their_own():
    texts = [f"w{i}" for i in range(10_000)] + [f"first{i} second{i}" for i in range(10_000)]
    prints = S.fingerprints(texts)
    assert len(set(map(bytes, prints))) == len(texts)
    # unrelated texts are far apart, and every bit is used
    far = S.likeness(prints, np.roll(prints, 1, 0))
    assert 0.2 < far.min() and far.max() < 0.8 and 0.49 < far.mean() < 0.51
    share = np.unpackbits(prints, axis=1).mean(0)
    assert 0.47 < share.min() and share.max() < 0.53


def test_equal_texts_and_batches():
    texts = [sentence(i, 3 + 40 * i) for i in range(20)] + ["", " .. ", sentence(3, 123), "ONE two", "one, TWO"]
    whole = S.fingerprints(texts)
    assert all((S.fingerprints([t])[0] == p).all() for t, p in zip(texts, whole))
    assert (whole[3] == whole[22]).all() and (whole[23] == whole[24]).all()
    assert as_int(whole[20]) == as_int(whole[21]) == 0
    assert (S.fingerprints(texts[::-1])[::-1] == whole).all()


def test_long_texts_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(S, "_PART", 200)
    texts = [sentence(1, 4000), sentence(2, 10)]
    assert (S.fingerprints(texts) == [S.fingerprints([t])[0] for t in texts]).all()


def test_likeness_follows_the_text():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(60)]
    own = S.fingerprints(texts)
    half = S.fingerprints([S.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])])
    near, far = S.likeness(own, half), S.likeness(own, np.roll(own, 1, 0))
    assert S.likeness(own, own).min() == 1 and near.mean() > 0.62 and 0.45 < far.mean() < 0.56
    assert (near > far).mean() > 0.95


@pytest.mark.parametrize("task_bytes", [50, 400, 1 << 25])
def test_edited(documents, task_bytes):
    given = [(7 * i, sentence(i, i % 9)) for i in range(40)] + [(1, None), (2, ""), (3, "é日\U0001F600x"), (400, "Last one"), (14, "tie"), (14, "tie"),
                                                               (None, "without id"), (500, sentence(3, 20000))]
    got = S.compare_edited(documents(given, extra=True), task_bytes).collect()
    found = Counter((r.id, r.n_chars, r.edited_sha256) for r in got)
    assert sum(found.values()) == len(given)
    # rows of one id may come in either order: try both
    ties = [r for r in given if r[0] == 14]
    rest = [r for r in given if r[0] != 14]
    options = []
    for order in set(itertools.permutations(ties)):
        rows = sorted(rest, key=lambda r: -1 if r[0] is None else r[0])
        at = next(i for i, r in enumerate(rows) if r[0] is not None and r[0] > 14)
        rows[at:at] = order
        texts = [t or "" for _, t in rows]
        options.append(Counter((i, len(t), hashlib.sha256(S.edited(t, n).encode()).hexdigest())
                               for (i, _), t, n in zip(rows, texts, texts[1:] + texts[:1])))
        if options[-1] == found:
            by = {(i, hashlib.sha256(S.edited(t, n).encode()).hexdigest()):
                  (S.fingerprints([t])[0], S.fingerprints([S.edited(t, n)])[0], S.fingerprints([n])[0])
                  for (i, _), t, n in zip(rows, texts, texts[1:] + texts[:1])}
            for r in got:
                own, other, after = by[r.id, r.edited_sha256]
                assert (r.high % 2**64) << 64 | r.low % 2**64 == as_int(own)
                assert (r.edited_high % 2**64) << 64 | r.edited_low % 2**64 == as_int(other)
                assert r.near_edited == 1 - bin(as_int(own) ^ as_int(other)).count("1") / 128
                if r.id != 14:
                    assert r.near_next == 1 - bin(as_int(own) ^ as_int(after)).count("1") / 128
    assert found in options


def test_edited_of_one_and_none(documents):
    (row,) = S.compare_edited(documents([(5, "abcd")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1
    assert S.compare_edited(documents([])).collect() == []


@pytest.mark.parametrize("block", [3, 4096])
def test_all_within_the_radius_are_counted(spark, block):
    rng = random.Random(6)
    values = []
    for _ in range(15):
        at = rng.getrandbits(128)
        for _ in range(12):
            values.append(at)
            for _ in range(rng.choice((0, 1, 2, 3, 4))):
                at ^= 1 << rng.randrange(128)
    signed = lambda v: (v + 2**63) % 2**64 - 2**63
    frame = spark.createDataFrame([(i, signed(v >> 64), signed(v & 2**64 - 1)) for i, v in enumerate(values)], "id int, high long, low long")
    got = {r.id: r.n_near for r in S.with_near(frame, block=block).collect()}
    assert got == {i: sum(bin(v ^ w).count("1") <= 3 for w in values) - 1 for i, v in enumerate(values)}


@pytest.mark.parametrize("radius", [0, 2, 3, 4, 5, 11, 12, 13, 20])
def test_keys_are_shared_within_the_radius(radius):
    masks = [left << 64 | right for left, right in S.key_masks(radius)]
    assert min(bin(m).count("1") for m in masks) >= 10
    rng = random.Random(radius)
    for number in range(3000):
        if number % 2:  # bits crowded into few places are the hard case
            pool = [rng.randrange(128) // 8 * 8 + k for k in range(8) for _ in range(3)]
        else:
            pool = range(128)
        flipped = sum(1 << p for p in set(rng.sample(pool, min(radius, len(pool)))))
        assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("block", [3, 4096])
def test_all_within_the_radius_of_edited_texts(spark, block):
    rng = random.Random(16)
    values = []
    for _ in range(8):
        at = rng.getrandbits(128)
        for _ in range(14):
            values.append(at)
            for p in rng.sample(range(128), rng.choice((0, 1, 4, 9, 13, 14))):
                at ^= 1 << p
    signed = lambda v: (v + 2**63) % 2**64 - 2**63
    frame = spark.createDataFrame([(i, signed(v >> 64), signed(v & 2**64 - 1)) for i, v in enumerate(values)], "id int, high long, low long")
    got = {r.id: r.n_near for r in S.with_near(frame, S.EDITED, block).collect()}
    assert got == {i: sum(bin(v ^ w).count("1") <= S.EDITED for w in values) - 1 for i, v in enumerate(values)}


def test_lightly_edited_copies_are_counted(spark, tmp_path):
    from catalograph.llm.fingerprint_queries import op9_fingerprints

    rng = random.Random(26)
    words = [f"w{i}" for i in range(3000)]
    given = []
    for number in range(60):
        text = [rng.choice(words) for _ in range(340)]
        given.append((2 * number, " ".join(text)))
        for place in rng.sample(range(340), 1 + number % 3):
            text[place] = rng.choice(words)
        given.append((2 * number + 1, " ".join(text)))
    spark.createDataFrame(given, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    near = [r.n_near for r in op9_fingerprints(spark, str(tmp_path)).collect()]
    assert len(near) == 120 and max(near) == 1 and sum(near) >= 0.9 * 120


def test_a_large_group_of_one_id_is_spread(documents, spark, monkeypatch):
    """Equal ids are ranged by their text's hash; the ends of the ranges meet whatever their number."""
    written, kept = S.written, []
    monkeypatch.setattr(S, "written", lambda df, label: kept.append(written(df, label)) or kept[-1])
    given = [(5, sentence(n, 6) + f" {n}") for n in range(300)] + [(None, sentence(n, 5)) for n in range(20)] + [(9, "last")]
    got = S.compare_edited(documents(given), 400).collect()
    assert len(got) == len(given)
    parts = kept[0].where("ends = 'first'").count()
    assert parts > 10
    # each text is followed by one text, and follows one
    halves = Counter(r.edited_sha256 for r in got)
    rows = sorted(((r[0] if r[0] is not None else -1, spark_hash(spark, r[1]), r[1]) for r in given))
    texts = [t for *_, t in rows]
    assert halves == Counter(hashlib.sha256(S.edited(t, n).encode()).hexdigest() for t, n in zip(texts, texts[1:] + texts[:1]))


_hashes: dict[str, int] = {}


def spark_hash(spark, text):
    if text not in _hashes:
        texts = [sentence(n, 6) + f" {n}" for n in range(300)] + [sentence(n, 5) for n in range(20)] + ["last"]
        frame = spark.createDataFrame([(t,) for t in texts], "t string")
        _hashes.update({r.t: r.h for r in frame.selectExpr("t", "xxhash64(t) AS h").collect()})
    return _hashes[text]


def test_rows_without_a_fingerprint_keep_their_place(spark):
    rows = spark.createDataFrame([(1, 5, 6), (2, 5, 6), (3, None, 6), (4, None, None)] + [(n, 77, 88) for n in range(10, 60)],
                                 "id long, high long, low long")
    got = {r.id: r.n_near for r in S.with_near(rows).collect()}
    assert got == {1: 1, 2: 1, 3: None, 4: None} | {n: 49 for n in range(10, 60)}


def test_large_classes_are_joined_apart(spark):
    from catalograph.llm.tables import join_classes
    rows = spark.createDataFrame([("hot",)] * 50 + [(f"k{n}",) for n in range(2000)] + [("none",), (None,)], "k string")
    classes = rows.where("k <> 'none'").groupBy("k").count().withColumn("v", F.length("k"))
    inner = join_classes(rows, classes, ["k"], "count")
    assert inner.count() == 2050 and inner.where("k = 'hot' AND v = 3 AND count = 50").count() == 50
    left = join_classes(rows, classes, ["k"], "count", "left")
    assert left.count() == 2052 and left.where("v IS NULL").count() == 2
