"""Byte-pair encoding and decoding against the library."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalograph.llm import byte_pairs as B
from tests.llm.conftest import sentence

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def codec():
    return B._codec(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def same(codec, library, texts):
    for text, packed in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == ids_of(library, text), text[:80]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


TEXTS = ["", " ", "a", " a  b ", "\n", "a\x00b\tc\r\n", "Hello, World! It's 12,345.67", "über die STRASSE ß", "don't'S we'LL 'tis",
         "日本語のテキスト🙂\U000E0001 한국어", "a <|endoftext|>b<|startoftext|> <|ENDOFTEXT|><|endoftext|><|end", "ΑΣ ΣΑΣ. İstanbul Ǆ",
         "é ́<|endoftext|>́x 가", "a" * 4097, "ab" * 700, "-" * 1000 + "=" * 333, "the" * 400, "x\x1cy\x85z\xa0w v",
         "!?" * 500, "http://www.example.org/path?q=1&r=2", "日" * 300, "ñ" * 130, sentence(1, 3000), "0" * 300, "\U00010D50ᲉꟋ ՘֋⺚"]


def test_texts(codec, library):
    same(codec, library, TEXTS)


def test_every_character(codec, library):
    chars = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x1F000), *range(0xE0000, 0xE0200))]
    texts = [" ".join(f"A{c}b{c}" for c in chars[at:at + 16000]) for at in range(0, len(chars), 16000)]
    same(codec, library, texts)


def test_every_composition(codec, library):
    apart = [unicodedata.normalize("NFD", chr(c)) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.decomposition(chr(c))]
    same(codec, library, [" ".join(apart[at:at + 2000]) for at in range(0, len(apart), 2000)])


def test_random_runs(codec, library):
    rng = random.Random(5)
    alphabets = ["a", "ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "-=_", "!?.", "éèñü", "ингато", "日本語文字"]
    same(codec, library, ["".join(rng.choice(a) for _ in range(rng.randint(1, 900))) for a in alphabets for _ in range(25)])


def test_words_run_together(codec, library):
    same(codec, library, [sentence(n, 400).replace(" ", "") for n in range(20)])


@pytest.mark.parametrize("leaf,window", [(1, 1), (3, 1), (7, 2), (64, 1)])
def test_small_leaves_and_windows(monkeypatch, codec, library, leaf, window):
    monkeypatch.setattr(B, "LEAF", leaf)
    monkeypatch.setattr(B, "WINDOW", window)
    rng = random.Random(leaf)
    words = ["".join(rng.choice(a) for _ in range(rng.randint(2, 120))) for a in ("a", "ab", "aeinrsth", "-=", "日本") for _ in range(30)]
    for word, packed in zip(words, codec._packed(words)):
        assert np.frombuffer(packed, "<u4").tolist() == ids_of(library, word), word


def test_parts_and_cache(monkeypatch, library):
    monkeypatch.setattr(B, "_PART", 50)
    monkeypatch.setattr(B, "_CACHED_WORDS", 5)
    same(B.Codec(PATH), library, TEXTS)


def test_decode_any_ids(codec, library):
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(49_500) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_rows(documents, library):
    given = list(enumerate(TEXTS)) + [(0, ""), (None, "no id"), (50, None), (51, sentence(7, 60000)), (52, "q" * 200_000)]
    got = B.round_trip(documents(given, extra=True), PATH).collect()
    expected = [(i, ids_of(library, t or "")) for i, t in given]
    expected = [(i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)) for i, ids in expected]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.id, r.n_tokens, bytes(r.packed), r.text) for r in got), key=key) == sorted(expected, key=key)
    assert B.round_trip(documents([]), PATH).collect() == []


def test_columns(spark):
    frame = spark.createDataFrame([("a b",), (None,)], "t string")
    ids = frame.select(B.encode_column(PATH, frame["t"]).alias("ids"))
    assert [r[0] for r in ids.select(B.decode_column(PATH, ids["ids"])).collect()] == ["a</w> b</w>", ""]


def test_query_digests(spark, library):
    from catalograph.llm.byte_pair_queries import op11_bpe
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
