"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for pieces that begin a word (they carry the word mark) and one
for pieces inside a word. Every node has a failure link, to where matching goes on once the longest pieces
below it are popped, and the number of pieces popped on the way, both precomputed. Counting a word reads
each character once and adds those numbers; no piece is ever built. As in word-piece encoding, a word with
a part that no piece matches counts as one unknown token.
"""

from __future__ import annotations

import re
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import cut_at_space, text_slices

MARK = "▁"  # begins the first piece of a word
_LOST = -1
_CACHED_WORDS, _CACHED_CHARS = 200_000, 48


def read_vocabulary(path: str) -> tuple[str, ...]:
    """The ordinary pieces of a sentencepiece model file; control, unknown and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple(model.id_to_piece(i) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))


class Automaton:
    """Node 0 is the root of a word's start, node 1 that of its inside."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for piece in pieces:
            node = 0 if piece.startswith(MARK) else 1
            for char in piece:
                if char not in self.next[node]:
                    self.next[node][char] = len(self.next)
                    self.next.append({})
                    whole.append(False)
                node = self.next[node][char]
            if node > 1:
                whole[node] = True
        self.fail = [_LOST] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque((0, 1))
        while queue:
            parent = queue.popleft()
            for char, node in self.next[parent].items():
                if whole[node]:
                    self.fail[node], self.popped[node] = 1, 1
                else:
                    back, popped = self.fail[parent], self.popped[parent]
                    while back != _LOST and char not in self.next[back]:
                        popped, back = popped + self.popped[back], self.fail[back]
                    if back != _LOST:
                        self.fail[node], self.popped[node] = self.next[back][char], popped
                queue.append(node)

    def count(self, word: str) -> int:
        """Pieces of a word that begins with the word mark; 1 where it cannot be covered, 0 if it is empty."""
        if not word:
            return 0
        following, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for char in word:
            while char not in following[node]:
                total += popped[node]
                node = fail[node]
                if node == _LOST:
                    return 1
            node = following[node][char]
        while node != 1:  # at the end: pop what is still open
            total += popped[node]
            node = fail[node]
            if node == _LOST:
                return 1
        return total


def _is_punctuation(char: str) -> bool:
    return "!" <= char <= "/" or ":" <= char <= "@" or "[" <= char <= "`" or "{" <= char <= "~" \
        or unicodedata.category(char)[0] == "P"


class ChunkCounts(dict):
    """Tokens of a run of text without white space, remembered for short runs, within a fixed size."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton
        self.plain = re.compile(r"[^\W_]+").fullmatch

    def __missing__(self, chunk: str) -> int:
        count = self.automaton.count
        if self.plain(chunk):
            total = count(MARK + chunk)
        else:
            total, start = 0, 0
            for place, char in enumerate(chunk):
                if _is_punctuation(char):
                    if place > start:
                        total += count(MARK + chunk[start:place])
                    total += count(MARK + char)
                    start = place + 1
            if start < len(chunk):
                total += count(MARK + chunk[start:])
        if len(chunk) <= _CACHED_CHARS:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[chunk] = total
        return total

    def of(self, text: str) -> int:
        return sum(sum(map(self.__getitem__, part.split())) for part in cut_at_space(text))


_counters: dict[int, ChunkCounts] = {}


def _counter(pieces: tuple[str, ...]) -> ChunkCounts:
    """One automaton a worker process and vocabulary."""
    key = hash(pieces)
    if key not in _counters:
        _counters.clear()
        _counters[key] = ChunkCounts(Automaton(pieces))
    return _counters[key]


def count_column(pieces: tuple[str, ...], text: Column) -> Column:
    """Number of word-piece tokens (long) of a text column; null counts as empty, with 0 tokens.

    Words are separated by white space, and each punctuation character is a word of its own.
    """

    @F.arrow_udf("long")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(pieces)
        for column in columns:
            yield pa.array(np.fromiter((counter.of(t) for texts in text_slices(column) for t in texts), np.int64))

    return of(text)


def token_counts(docs: DataFrame, pieces: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens)`` per row of ``docs``: repeated rows stay, an empty table gives none.

    Null, empty and white-space texts have 0 tokens; a text of any length is counted whole. Other columns of
    ``docs`` are not read, whatever their names.
    """
    return docs.select(F.col(id_col).alias("id"), count_column(pieces, F.col(text_col)).alias("n_tokens"))
