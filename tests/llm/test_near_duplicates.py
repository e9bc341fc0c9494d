"""SimHash near duplicates against a plain computation."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from catalograph.llm import near_duplicates as N
from catalograph.llm.components import components
from tests.llm.conftest import sentence


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{place: least id} by union of all pairs at three bits or fewer."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i][1] ^ prints[j][1]).count("1") <= 3:
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(prints))]


def test_every_five_positions_hold_a_quadruple():
    assert len(N.QUADRUPLES) == 14
    for five in itertools.combinations(range(8), 5):
        assert any(set(q) <= set(five) for q in N.QUADRUPLES)


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "One two", "ONE Two thrée", "É a b \x0b c d",
                                  "a b c d", sentence(3, 40000), "x " * 20, "z" * 70000])
def test_fingerprint(text):
    assert N.fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("part", [1, 7, 50])
def test_fingerprint_of_parts(monkeypatch, part):
    monkeypatch.setattr(N, "_PART", part)
    for text in ("", " a", "one two", "a b c", " x y  z w \n v", sentence(4, 500)):
        assert N.fingerprint(text.encode()) == plain_fingerprint(text)


def test_hash_is_that_of_spark(spark):
    from pyspark.sql import functions as F
    row = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == N.fingerprint(b"One two\tthree")


@pytest.mark.parametrize("block", [3, 4096])
def test_links_connect_what_all_pairs_connect(spark, block):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):  # chains of small steps, so components are wider than the radius
            values.add(at)
            for _ in range(rng.choice((1, 2, 3, 4, 5))):
                at ^= 1 << rng.randrange(64)
    prints = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in prints], "fingerprint long")
    links = N.fingerprint_links(frame, block=block)
    got = {r.node % 2**64: r.root % 2**64 for r in components(links).collect()}
    expected = plain_components([(i, v) for i, v in enumerate(prints)])
    classes = {}
    for v, least in zip(prints, expected):
        classes.setdefault(least, set()).add(v)
    found = {}
    for v in prints:
        found.setdefault(got.get(v, v), set()).add(v)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, found.values()))


def rows():
    base = sentence(1, 300)
    words = base.split()
    out = [(10 + i, " ".join(words[:i * 20] + ["changed"] + words[i * 20 + 1:])) for i in range(12)]
    out += [(100 + i, sentence(50 + i, 60)) for i in range(20)]
    out += [(5, base), (4, base.upper()), (4, base.upper()), (300, None), (301, ""), (302, " \n"), (None, "alone here now"),
            (None, base), (400, "one"), (401, "one two"), (401, "one two"), (402, sentence(9, 30000))]
    return out


def test_near_duplicates(documents):
    given = rows()
    got = sorted(((r.id is None, r.id or 0, r.fingerprint % 2**64, r.component_id)
                  for r in N.near_duplicates(documents(given, extra=True)).collect()), key=repr)
    prints = [(i, plain_fingerprint(t)) for i, t in given]
    expected = sorted(((i is None, i or 0, p, c) for (i, p), c in zip(prints, plain_components(prints))), key=repr)
    assert got == expected


def test_keep_one(documents):
    given = rows()
    frame = documents(given, extra=True)
    kept = N.keep_one(frame)
    assert kept.columns == frame.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    prints = [(i, plain_fingerprint(t)) for i, t in given]
    least = plain_components(prints)
    assert len(got) == len(set(got)) == len({(c, p if c is None else 0) for c, (_, p) in zip(least, prints)})
    by_id = dict(zip([i for i, _ in given], least))
    assert all(i is None or by_id[i] == i for i, _ in got)


def test_empty_table(documents):
    assert N.near_duplicates(documents([])).collect() == []
    assert N.keep_one(documents([])).collect() == []
