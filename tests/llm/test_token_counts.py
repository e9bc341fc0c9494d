"""The automaton against greedy longest match and against the tokenizers library."""

import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers.models import WordPiece

from catalograph.llm import token_counts as C
from tests.llm.conftest import sentence


def greedy(word, pieces):
    at, total = 0, 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:  # pieces with the mark can only match at the start, others only inside
                at, total = end, total + 1
                break
        else:
            return 1
    return total


def test_against_greedy_on_random_vocabularies():
    rng = random.Random(3)
    for _ in range(300):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        pieces |= {C.MARK + "".join(rng.choice("abc") for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 6))}
        automaton = C.Automaton(sorted(pieces))
        for _ in range(40):
            word = C.MARK + "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == greedy(word, pieces), (word, pieces)


@pytest.fixture(scope="module")
def pieces():
    return C.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def words(text):
    for chunk in text.split():
        word = ""
        for char in chunk:
            ascii_mark = char.isascii() and char.isprintable() and not char.isalnum() and char != " "
            if ascii_mark or unicodedata.category(char).startswith("P"):
                if word:
                    yield word
                yield char
                word = ""
            else:
                word += char
        if word:
            yield word


TEXTS = ["", None, " \n\t", "Hello, world! It's naïve - isn't it?", "über die Straße gehen", "a_b-c  d...", "日本語 のテキスト",
         "\U0001F600 \U000E0001x", "x" * 5000, sentence(2, 60000), "rôle $%& €5 ▁marked"]


def test_against_the_library(pieces):
    ids = {p if p.startswith(C.MARK) else "##" + p: i for i, p in enumerate(pieces)}
    model = WordPiece({**ids, "[UNK]": len(ids)}, unk_token="[UNK]", max_input_chars_per_word=10**6)
    counter = C.ChunkCounts(C.Automaton(pieces))
    for text in TEXTS:
        assert counter.of(text or "") == sum(len(model.tokenize(C.MARK + w)) for w in words(text or ""))


def test_cache_is_bounded(pieces, monkeypatch):
    monkeypatch.setattr(C, "_CACHED_WORDS", 10)
    counter = C.ChunkCounts(C.Automaton(pieces))
    text = " ".join(f"word{i} w{i}" for i in range(200))
    assert counter.of(text) == C.ChunkCounts(C.Automaton(pieces)).of(text)
    assert len(counter) <= 10


def test_rows(documents, pieces):
    given = list(enumerate(TEXTS)) + [(0, ""), (None, "no id"), (3, TEXTS[3])]
    got = sorted(((r.id is None, r.id or 0, r.n_tokens) for r in C.token_counts(documents(given, True), pieces).collect()))
    counter = C.ChunkCounts(C.Automaton(pieces))
    assert got == sorted((i is None, i or 0, counter.of(t or "")) for i, t in given)
    assert C.token_counts(documents([]), pieces).collect() == []
