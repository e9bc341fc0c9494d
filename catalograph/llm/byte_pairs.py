"""BPE encoding and decoding of a word-level vocabulary, long unsplit text by tree concatenation.

A text is normalised and cut into words that no token crosses. A word of up to ``LEAF`` bytes is one leaf. A longer
run without a border is halved into leaves, which are encoded side by side, and the halves are joined level by
level up a tree, all joins of a level together. A join encodes anew a window of a few tokens on both sides of it. When
the first token of the window comes out as it was, the left side agrees; when the last one does, so does the
right, and the window replaces what it covers. Until then it grows on the side that disagrees.

This is exact. Merging by (rank, place) gives a token sequence if and only if it gives every two adjacent tokens
when they stand alone: before the first merge across a border the parts on both sides of it are merged as they
would be alone. A window that agrees at both ends leaves every adjacent pair as one encoding or another made it.

Leaves and windows are rows of a matrix; in a round each row merges its leftmost pair of the least rank. Rows are
linked lists (next and previous place), so nothing moves and only two ranks a row are looked up again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from catalograph.llm.tables import text_slices

LEAF = 64        # bytes of a leaf
WINDOW = 4       # tokens on each side of a join at first
END = "</w>"
FIRST_MARK = "\u0300"  # all text below is composed
_NEVER = np.iinfo(np.int32).max
_CACHED_WORDS = 400_000
_PART = 1 << 20  # characters of one text that are normalised and cut at a time


class Characters:
    """Lower case and class of characters as the file's own normaliser and splitter give them, asked for once a
    block of 256 code points, so both follow the Unicode version of the file's library."""

    BLOCK = 256

    def __init__(self, tokenizer: Tokenizer):
        self._normal, self._split = tokenizer.normalizer, tokenizer.pre_tokenizer
        self._compose = normalizers.NFC()
        self._known: set[str] = set()
        self._lower: dict[int, str] = {}
        self._odd: set[str] = {"Σ"}  # Python's lower() looks at its neighbours
        self._of = {"L": [], "N": [], "S": []}
        self.words = re.compile(r"(?!)")
        self.space = re.compile(r"(?!)")
        self.learn({"a"})

    def _class(self, char: str) -> str:
        found = [word for word, _ in self._split.pre_tokenize_str(f"a{char}!")]
        if len(found) == 3:
            return "N"
        if len(found) == 1 or len(found[0]) > 1:
            return "L"
        return "S" if len(found[1]) == 1 else "O"

    def _ranges(self, kind: str) -> str:
        """The characters of a class as ranges of a pattern."""
        codes = np.array(sorted(map(ord, self._of[kind])))
        cuts = np.flatnonzero(np.diff(codes) > 1) + 1
        return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in np.split(codes, cuts)) if len(codes) else ""

    def learn(self, chars: set[str]) -> None:
        for block in {ord(c) // self.BLOCK for c in chars}:
            for code in range(block * self.BLOCK, (block + 1) * self.BLOCK):
                char = chr(code)
                self._known.add(char)
                if 0xD800 <= code < 0xE000:
                    continue
                kind = self._class(char)
                if kind in self._of:
                    self._of[kind].append(char)
                if kind != "S":
                    self._lower[code] = self._normal.normalize_str(char)
                    if self._lower[code] != char.lower():
                        self._odd.add(char)
        letters, numbers, spaces = (self._ranges(k) for k in "LNS")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")
        self.space = re.compile(f"[{spaces}]")

    def normal(self, text: str) -> str:
        """NFC and lower case, character by character; white space is left, as no word holds any."""
        chars = set(text)
        if max(chars) >= FIRST_MARK:
            text = self._compose.normalize_str(text)
            chars = set(text)
        if not chars <= self._known:
            self.learn(chars - self._known)
        text = text.lower() if self._odd.isdisjoint(chars) else text.translate(self._lower)
        chars = set(text)
        if not chars <= self._known:
            self.learn(chars - self._known)
        return text


class Codec:
    """Encoder and decoder of one tokenizer file: byte symbols, merges by rank, a word end that counts as a letter."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        kinds = [n.get("type") for n in (given["normalizer"] or {}).get("normalizers", [])]
        if (model["type"] != "BPE" or model["end_of_word_suffix"] != END or model["continuing_subword_prefix"]
                or model["dropout"] or model["ignore_merges"] or model["unk_token"] or given["decoder"]
                or kinds != ["NFC", "Replace", "Lowercase"]
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in given["added_tokens"])):
            raise ValueError(f"{path}: only byte pairs with word ends, NFC and lower case are supported")
        self.characters = Characters(Tokenizer.from_file(path))
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.borders = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.names = {i: name for name, i in (vocabulary | self.special).items()}
        # the printable stand-ins of bytes: those that print stand for themselves, the others follow from 256 on
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in own]
        stand = {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}
        self.inner = np.array([vocabulary[stand[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[stand[b] + END] for b in range(256)], np.int32)
        byte_of = {c: b for b, c in stand.items()}
        self.symbols: list[np.ndarray | None] = [None] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            ends = name.endswith(END)
            found = self.inner[[byte_of[c] for c in (name.removesuffix(END) if ends else name)]]
            if ends:
                found[-1] = self.last[byte_of[name.removesuffix(END)[-1]]]
            self.symbols[i] = found
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order.astype(np.int32), np.int32(_NEVER))
        self.known: dict[str, bytes] = {}

    # ------------------------------------------------------------ merging

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; a pair with a missing symbol (below 0) has none."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) << 32 | right)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def merge(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Tokens of each row of symbols, rows of like width together."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(rows)
        widths = np.fromiter(map(len, rows), np.int64, len(rows))
        classes = np.ceil(np.log2(np.maximum(widths, 2))).astype(int)
        for kind in np.unique(classes):
            numbers = np.flatnonzero(classes == kind)
            step = max(1, (1 << 21) >> int(kind))  # bounds the matrix, not what is merged
            for start in range(0, len(numbers), step):
                some = numbers[start:start + step]
                for number, tokens in zip(some.tolist(), self._matrix([rows[n] for n in some.tolist()], widths[some])):
                    out[number] = tokens
        return out

    def _matrix(self, rows: list[np.ndarray], widths: np.ndarray) -> list[np.ndarray]:
        wide = int(widths.max(initial=1)) + 1  # the last column stands for no neighbour
        symbols = np.full((len(rows), wide), -1, np.int32)
        symbols[np.arange(wide) < widths[:, None]] = np.concatenate(rows) if len(rows) else 0
        ranks = np.full((len(rows), wide), _NEVER, np.int32)
        ranks[:, :-1] = self._rank(symbols[:, :-1], symbols[:, 1:])
        after = np.broadcast_to(np.minimum(np.arange(1, wide + 1), wide - 1), symbols.shape).copy()
        before = np.broadcast_to(np.arange(-1, wide - 1), symbols.shape).copy()  # -1: the last column, which is empty
        before[:, 0] = wide - 1
        going = np.arange(len(rows))
        while len(going):
            at = ranks[going].argmin(1) if len(going) < len(rows) else ranks.argmin(1)
            best = ranks[going, at]
            open_ = best < _NEVER
            going, at, best = going[open_], at[open_], best[open_]
            if not len(going):
                break
            gone = after[going, at]
            next_, previous = after[going, gone], before[going, at]
            symbols[going, at] = self.merged[best]
            symbols[going, gone] = -1
            ranks[going, gone] = _NEVER
            after[going, at] = next_
            before[going, next_] = at
            before[going, wide - 1] = wide - 1
            ranks[going, at] = self._rank(symbols[going, at], symbols[going, next_])
            ranks[going, previous] = self._rank(symbols[going, previous], symbols[going, at])
        kept = symbols >= 0
        flat, ends = symbols[kept], np.cumsum(kept.sum(1))[:-1]
        return np.split(flat, ends)

    def join(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Tokens of each left and right text together, from the tokens of either."""
        done = [left for left, _ in pairs]
        taken = [0] * len(pairs)             # tokens of the right side that are part of ``done``
        back, ahead = [WINDOW] * len(pairs), [WINDOW] * len(pairs)
        waiting = list(range(len(pairs)))
        while waiting:
            windows = []
            for n in waiting:
                window = np.concatenate((done[n][max(0, len(done[n]) - back[n]):], pairs[n][1][taken[n]:taken[n] + ahead[n]]))
                windows.append(np.concatenate([self.symbols[t] for t in window.tolist()]))
            still = []
            for n, found in zip(waiting, self.merge(windows)):
                left, right = done[n], pairs[n][1]
                if len(left) > back[n] and found[0] != left[-back[n]]:
                    back[n] *= 2
                    still.append(n)
                    continue
                end = min(len(right), taken[n] + ahead[n])
                agreed = end == len(right) or found[-1] == right[end - 1]
                parts = [left[:max(0, len(left) - back[n])], found]
                done[n] = np.concatenate(parts + [right[end:]] if agreed else parts)
                if not agreed:  # what is done now ends inside the right side: go on from there
                    taken[n], back[n], ahead[n] = end, WINDOW, min(ahead[n] * 2, 64)
                    still.append(n)
            waiting = still
        return done

    def tree(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """Tokens of each word of symbols: leaves side by side, then joins level by level."""
        cuts = [[word[at:at + LEAF] for at in range(0, len(word), LEAF)] for word in words]
        found = iter(self.merge([leaf for leaves in cuts for leaf in leaves]))
        nodes = [[next(found) for _ in leaves] for leaves in cuts]
        tall = [n for n, parts in enumerate(nodes) if len(parts) > 1]
        while tall:
            joined = iter(self.join([(nodes[n][i], nodes[n][i + 1]) for n in tall for i in range(0, len(nodes[n]) - 1, 2)]))
            for n in tall:
                odd = nodes[n][-1:] if len(nodes[n]) % 2 else []
                nodes[n] = [next(joined) for _ in range(len(nodes[n]) // 2)] + odd
            tall = [n for n in tall if len(nodes[n]) > 1]
        return [parts[0] for parts in nodes]

    # ------------------------------------------------------------ texts

    def _packed(self, words: list[str]) -> list[bytes]:
        rows = []
        for word in words:
            raw = np.frombuffer(word.encode(), np.uint8)
            row = self.inner[raw]
            row[-1] = self.last[raw[-1]]
            rows.append(row)
        return [tokens.astype("<u4").tobytes() for tokens in self.tree(rows)]

    def _parts(self, text: str) -> Iterator[str]:
        """A text in parts that begin at white space, where neither a word nor a composition is cut."""
        start = 0
        while len(text) - start > _PART:
            found = self.characters.space.search(text, start + _PART)
            if not found:
                break
            yield text[start:found.start()]
            start = found.start()
        yield text[start:] if start else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian 32-bit numbers, as the library gives them."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for number, text in enumerate(texts):
            for part in self._parts(text):
                for place, piece in enumerate(self.borders.split(part)):
                    if place % 2:
                        waiting.append((number, [piece]))
                    elif piece:
                        normal = self.characters.normal(piece)  # first: it may learn characters the words need
                        waiting.append((number, self.characters.words.findall(normal)))
                        size += len(piece)
                if size > _PART:
                    self._take(waiting, out)
                    waiting, size = [], 0
        self._take(waiting, out)
        return [b"".join(parts) for parts in out]

    def _take(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if not waiting:
            return
        if len(self.known) > _CACHED_WORDS or not self.known:
            self.known = {name: np.array([i], "<u4").tobytes() for name, i in self.special.items()}
        seen: set[str] = set().union(*(words for _, words in waiting))
        new = [w for w in seen if w not in self.known]
        self.known.update(zip(new, self._packed(new)))
        for number, words in waiting:
            out[number].append(b"".join(map(self.known.__getitem__, words)))
        for word in new:
            if len(word) > LEAF:
                del self.known[word]

    def decode(self, ids) -> str:
        """Names of the tokens with a space between; ids outside the vocabulary have none."""
        names = self.names
        try:
            return " ".join([names[i] for i in ids])
        except KeyError:
            return " ".join([names[i] for i in ids if i in names])


def _codec(path: str) -> Codec:
    """One codec a worker process and file."""
    if path not in _codecs:
        _codecs.clear()
        _codecs[path] = Codec(path)
    return _codecs[path]


_codecs: dict[str, Codec] = {}


# ---------------------------------------------------------------- over DataFrames

def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4").astype(np.int32)


def encode_column(path: str, text: Column) -> Column:
    """Ids (array of int) of a text column; null counts as empty, with no id."""

    @F.arrow_udf("array<int>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for column in columns:
            yield pa.array([_numbers(ids) for texts in text_slices(column) for ids in codec.encode(texts)], pa.list_(pa.int32()))

    return of(text)


def decode_column(path: str, ids: Column) -> Column:
    """Text of a column of ids; a null list is an empty text, an id outside the vocabulary adds nothing."""

    @F.arrow_udf("string")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for column in columns:
            yield pa.array([codec.decode(x.as_py() or ()) for x in column], pa.string())

    return of(ids)


def round_trip_column(path: str, text: Column) -> Column:
    """Struct (packed, text) of a text column: ids as little-endian 32-bit numbers and the text decoded from them."""

    @F.arrow_udf("packed binary, text string")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for column in columns:
            packed, texts = [], []
            for some in text_slices(column):
                found = codec.encode(some)
                packed += found
                texts += [codec.decode(np.frombuffer(ids, "<u4").tolist()) for ids in found]
            yield pa.StructArray.from_arrays([pa.array(packed, pa.binary()), pa.array(texts, pa.string())], ["packed", "text"])

    return of(text)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, packed, text)`` per row of ``docs``: repeated rows stay, an empty table gives none.

    Null and empty texts have no ids and decode to the empty text. A text of any length is one row; it is cut at
    white space only to bound what is held at once. Other columns are not read, whatever their names.
    """
    return (docs.select(F.col(id_col).alias("id"), round_trip_column(path, F.col(text_col)).alias("p"))
            .select("id", (F.octet_length("p.packed") / 4).cast("long").alias("n_tokens"), "p.packed", "p.text"))
