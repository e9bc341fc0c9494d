"""The prefix trie against a plain one."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import conversation_trie as C
from catalograph.llm.conversation_trie_queries import op12_conversation_trie
from tests.llm.conftest import sentence

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(conversations):
    """Nodes of {conv: [(role, text), ...]} by sets of members, subtrees by comparing prefixes."""
    members = defaultdict(list)
    for conv in sorted(conversations):
        turns = tuple(conversations[conv])
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    below = defaultdict(list)
    for node in members:
        for depth in range(len(node) + 1):
            below[node[:depth]].append(node)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    rows = []
    for node, convs in members.items():
        ends = [c for c in convs if len(conversations[c]) == len(node)]
        rows.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node],
                     sum(not children[n] for n in below[node]), sum((len(members[n]) - 1) * words[n] for n in below[node]),
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def rebuilt(rows):
    """Rows (conv, turn, role, text) without equal turns, as the contract rebuilds them."""
    own = defaultdict(list)
    for conv, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        for name in ("conv", "place", "a", "b", "depth", "kind", "words", "part", "leaf", "n_convs", "k1"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def trie(df, rebuild=True):
    turns = C.ordered_turns(df)
    convs = turns.where("place = 0").select("conv")
    found = C.prefix_trie(convs, C.borrowed_heads(turns) if rebuild else turns)
    return sorted(map(tuple, found.collect()), key=str)


def conversations(number):
    rows = []
    for conv in range(number):
        texts = [sentence(conv % 3, 4), sentence(conv % 5, 3), *(sentence(conv * 7 + t, 5) for t in range(conv % 6))]
        rows += [(conv, t, "user" if t % 2 else "assistant", text) for t, text in enumerate(texts)]
    return rows


@pytest.mark.parametrize("shown", ["chunks", "tight sketch", "whole"])
def test_against_plain(spark, monkeypatch, shown):
    if shown == "chunks":  # many chunks and blocks, and parts that end within a conversation
        monkeypatch.setattr(C, "CHUNK", 2)
    if shown == "tight sketch":  # nearly every estimate is too high
        monkeypatch.setattr(C, "BLOCK", 64)
        monkeypatch.setattr(C, "MOST_CELLS", 64)
    rows = conversations(150)
    assert trie(frame(spark, rows, extra=True)) == plain_trie(rebuilt(rows))


def test_long_conversations(spark, monkeypatch):
    """Two conversations share a long beginning; they span several parts, batches, chunks and blocks."""
    monkeypatch.setattr(C, "CHUNK", 16)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rows = [(conv, t, "user", f"turn {t} says {'x ' * (t % 4)}" + ("" if t < 300 else str(conv))) for conv in (40, 41, 47) for t in range(420)]
        rows += [(conv, t, "user", "same words here") for conv in range(60, 75) for t in range(30)]
        assert trie(frame(spark, rows), rebuild=False) == plain_trie({c: [(r[2], r[3]) for r in rows if r[0] == c] for c in {r[0] for r in rows}})
        assert trie(frame(spark, rows)) == plain_trie(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no id"), (3, None, "user", "null first"), (3, 0, None, None), (3, 1, "", ""), (7, 5, "user", ""),
            (7, 9, "user", "a b c\td\x0be"), (-21, 0, "user", "below zero"), (-20, 1, "user", "x y"), (20, 0, "user", "z " * 50_000),
            (21, 0, "user", "z " * 50_000), (21, 1, "assistant", "fin")]
    for rebuild in (True, False):
        got = trie(frame(spark, rows, extra=True), rebuild)
        by_conv = defaultdict(list)
        for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
            by_conv[r[0]].append((r[2] or "", r[3] or ""))
        expected = dict(by_conv)
        if rebuild:
            for c, turns in by_conv.items():
                h = zlib.crc32(str(c).encode()) % 4
                base = c - int(np.fmod(c, 20))
                expected[c] = by_conv.get(base, [])[:h] + turns[h:]
        assert got == plain_trie(expected)


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "user", "a b"), (1, 0, "user", "a b"), (2, 0, "user", "a b")]
    assert trie(frame(spark, rows), rebuild=False) == plain_trie({1: [("user", "a b")] * 2, 2: [("user", "a b")]})
    tied = [(5, 0, "user", text) for text in ("one", "two", "three")]
    assert trie(frame(spark, tied), rebuild=False) == trie(frame(spark, tied[::-1]), rebuild=False)


def test_empty_and_single(spark):
    assert trie(frame(spark, [])) == []
    only = [(9, t, "user", f"t{t}") for t in range(3)]
    assert trie(frame(spark, only), rebuild=False) == plain_trie({9: [("user", f"t{t}") for t in range(3)]})


def test_borrowing_reads_the_first_turns(spark):
    turns = C.ordered_turns(frame(spark, conversations(45)))
    got = {r.conv: r.n for r in C.borrowed_heads(turns).groupBy("conv").agg(F.count("*").alias("n")).collect()}
    assert got == {c: len(t) for c, t in rebuilt(conversations(45)).items() if t}


def test_sketch_never_underestimates(spark):
    """Every prefix of several conversations keeps an estimate above one, whatever the width."""
    rows = conversations(60)
    turns = C.ordered_turns(frame(spark, rows))
    chunks = C._chunks(turns.where("place = 0").select("conv"), turns)
    carry = C._Carry(chunks)
    screened = C._screened(chunks, carry, C.BLOCK, C._sketch(chunks, carry, C.BLOCK))
    counts = screened.groupBy("a", "b", "depth").agg(F.count("*").alias("n"), F.collect_set("kind").alias("kinds"))
    assert counts.where("n > 1 AND kinds <> array('shared')").count() == 0
    assert screened.where("kind <> 'shared'").count() > 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_conversation_trie(spark, sf)
    assert got.columns == COLUMNS
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(rebuilt(rows))
