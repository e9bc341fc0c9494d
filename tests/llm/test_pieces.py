"""Encoding and decoding against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from catalograph.llm import pieces as P
from tests.llm.conftest import sentence

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return P._codec(PATH)


TEXTS = ["", " ", "  ", "a", " a  b ", "\n", "\n\n a\n", "▁x ▁▁y", "a\x00b\tc\r\n", "Hello, World! It's 12,345.67", "über die Straße",
         "日本語のテキスト🙂\U000E0001", "<s>hello</s><unk><0x0A>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "the" * 400, "é́ ñ ﬁ",
         " " * 500, "x" + " " * 333 + "y", "-" * 1000, "ab" * 700, "http://www.example.org/path?q=1&r=2", " a　b",
         sentence(1, 3000), "=" * 77 + " " * 17 + "#", "\n" * 50, " \n \n ", "0" * 300]


def test_texts(codec, library):
    ids = codec.encode(TEXTS)
    for text, found in zip(TEXTS, ids):
        assert found.tolist() == library.encode(text), text[:50]
        assert codec.decode(found.tolist()) == library.decode(found.tolist())


def test_random_texts(codec, library):
    rng = random.Random(4)
    alphabets = ["ab", "the in", "aeiou  ", " \n", "=-_*/.", "abcdefghijklmnopqrstuvwxyz    ", "ÀÉñüßabc ", "한글 日本", "01 ,.", "▁ x"]
    texts = ["".join(rng.choice(rng.choice((a, a, a, rng.choice(alphabets)))) for _ in range(rng.randint(0, 90)))
             for a in alphabets for _ in range(150)]
    assert [i.tolist() for i in codec.encode(texts)] == library.encode(texts)


def test_spaces_of_any_number(codec, library):
    texts = [before + " " * n + after for n in range(0, 140) for before in ("", "x") for after in ("", "t", "\n")]
    assert [i.tolist() for i in codec.encode(texts)] == library.encode(texts)


def test_decode_any_ids(codec, library):
    rng = random.Random(2)
    for _ in range(400):
        ids = [rng.choice((rng.randrange(3, 259), rng.randrange(259, 32000), rng.randrange(3, 259))) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids), ids
    assert codec.decode([]) == ""
    with pytest.raises(IndexError):
        codec.decode([40_000])


def test_parts_and_cache(monkeypatch, library):
    monkeypatch.setattr(P, "_PART", 50)
    monkeypatch.setattr(P, "_CACHED_WORDS", 5)
    small = P.Codec(PATH)
    assert [i.tolist() for i in small.encode(TEXTS)] == library.encode(TEXTS)


def test_rows(documents, library):
    given = list(enumerate(TEXTS)) + [(0, ""), (None, "no id"), (50, None), (51, sentence(7, 60000))]
    got = P.round_trip(documents(given, extra=True), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    expected = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in given]
    assert sorted(((r.id, r.ids, r.text) for r in got), key=key) == sorted(expected, key=key)
    assert P.round_trip(documents([]), PATH).collect() == []


def test_columns(spark):
    frame = spark.createDataFrame([("a b",), (None,)], "t string")
    ids = frame.select(P.encode_column(PATH, frame["t"]).alias("ids"))
    assert [r[0] for r in ids.select(P.decode_column(PATH, ids["ids"])).collect()] == ["a b", ""]


def test_query_digests(spark, library):
    from catalograph.llm.piece_queries import op6_sentencepiece
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op6_sentencepiece(spark, sf).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
