"""SentencePiece encoding and decoding of byte-pair models, by vectorised merge rounds.

A text is cut into words that no piece of the model crosses. The distinct words of many texts are laid out as
one flat array of symbols. In a round every word looks up the ranks of its neighbouring pairs, takes the
best rank (a segmented minimum), merges the leftmost pairs of that rank, all words at once, and
the array is compacted; words without a mergeable pair leave. The library merges the best pair of a word
one by one, leftmost first. All pairs of the best rank are merged in the same round only where that gives the
same result: where no pair that the merged piece can form has as good a rank. Else one pair a round is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from catalograph.llm.tables import text_slices

MARK = "▁"
_NEVER = np.iinfo(np.int32).max
_CACHED_WORDS, _CACHED_CHARS = 300_000, 40
_PART = 1 << 20  # characters of one text that are cut into words at a time


class Codec:
    """Encoder and decoder of one model file: byte-pair merges, byte fallback, no normalisation but the marks."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto.ParseFromString(model.serialized_model_proto())
        rules, kinds = proto.normalizer_spec, proto.SentencePiece
        if (proto.trainer_spec.model_type != proto.trainer_spec.BPE or rules.precompiled_charsmap or not rules.add_dummy_prefix
                or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
                or not proto.trainer_spec.byte_fallback
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)):
            raise ValueError(f"{path}: only plain byte-pair models with byte fallback and a leading mark are supported")
        names = [p.piece for p in proto.pieces]
        normal = [i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL]
        self.size = len(names)
        self.byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(names[i][3:-1], 16)] = i
        self.bytes_of = [b""] * self.size
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.bytes_of[i] = bytes((int(names[i][3:-1], 16),))
            elif p.type == kinds.UNKNOWN:
                self.bytes_of[i] = proto.trainer_spec.unk_surface.encode()
            elif p.type == kinds.NORMAL:
                self.bytes_of[i] = names[i].replace(MARK, " ").encode()
        # symbols: pieces by id, then characters that only occur inside longer pieces
        symbols = {names[i]: i for i in normal}
        for i in normal:
            for char in names[i]:
                symbols.setdefault(char, len(names) + len(symbols))
        if any(MARK in names[i].lstrip(MARK) for i in normal):
            raise ValueError(f"{path}: a piece crosses words")
        self.symbol_of_code = np.full(0x110000, -1, np.int32)
        for name, symbol in symbols.items():
            if len(name) == 1:
                self.symbol_of_code[ord(name)] = symbol
        scores = np.array([proto.pieces[i].score for i in normal])
        rank = dict(zip(normal, np.unique(-scores, return_inverse=True)[1].tolist()))
        keys, values, ranks = [], [], []
        for i in normal:
            for cut in range(1, len(names[i])):
                left, right = symbols.get(names[i][:cut]), symbols.get(names[i][cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(i)
                    ranks.append(rank[i])
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.pair_values = np.append(np.array(values, np.int32)[order], -1)
        self.pair_ranks = np.append(np.array(ranks, np.int32)[order], _NEVER)
        best = np.full(max(symbols.values()) + 1, _NEVER, np.int64)
        np.minimum.at(best, np.array(keys, np.int64) >> 32, ranks)
        np.minimum.at(best, np.array(keys, np.int64) & 0xFFFFFFFF, ranks)
        # a merged piece that can at once form a pair of the same or a better rank is merged alone
        self.alone = np.array([rank.get(i, 0) >= best[i] if i < len(best) else False for i in range(self.size)])
        inner = {c for i in normal if len(names[i]) > 1 for c in names[i]}
        line = "" if "\n" in inner else "\n"  # a line break that no piece holds is a word by itself
        self.words = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + (f"|{line}" if line else ""))
        self.cut = re.compile(f"(?<=[^{MARK}]){MARK}")
        self.known: dict[str, bytes] = {}
        spaces = [len(names[i]) for i in normal if not names[i].strip(MARK)]
        self.run = self._run_length(max(spaces, default=1))

    # ------------------------------------------------------------ merging

    def _pairs(self, symbols: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of the pairs that begin at ``places``."""
        left, right = symbols[places].astype(np.int64), symbols[places + 1].astype(np.int64)
        key = np.where((left < 0) | (right < 0), -1, left << 32 | right)
        at = np.searchsorted(self.pair_keys, key)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], _NEVER), self.pair_values[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Final symbols of all words in order, with their word, and for each the code of its first character."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        symbols = self.symbol_of_code[codes]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), _NEVER, np.int32)
        value = np.zeros(len(symbols), np.int32)
        fresh = np.flatnonzero(word[1:] == word[:-1])
        while len(symbols):
            rank[fresh], value[fresh] = self._pairs(symbols, fresh)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            ended = np.repeat(best == _NEVER, sizes)
            if ended.any():
                done.append((word[ended], symbols[ended], codes[ended]))
                going = ~ended
                word, symbols, codes, rank, value = word[going], symbols[going], codes[going], rank[going], value[going]
                sizes, best = sizes[best != _NEVER], best[best != _NEVER]
                if not len(symbols):
                    break
            chosen = rank == np.repeat(best, sizes)
            places = np.flatnonzero(chosen)
            first = np.concatenate(([True], word[places[1:]] != word[places[:-1]]))
            # in a run of overlapping pairs every second one is merged, from the left
            joined = np.concatenate(([False], places[1:] == places[:-1] + 1)) & ~first
            begin = np.flatnonzero(~joined)
            nth = np.arange(len(places)) - np.repeat(begin, np.diff(np.append(begin, len(places))))
            alone = self.alone[value[places]]
            if alone.any():  # one such pair in a word makes its round a round of the leftmost pair
                alone = np.isin(word[places], word[places[alone]])
            merged = places[np.where(alone, first, nth % 2 == 0)]
            symbols[merged] = value[merged]
            keep = np.ones(len(symbols), bool)
            keep[merged + 1] = False
            # the pair of a merged symbol and the one before it are new
            rank[merged] = rank[merged + 1]
            place = np.cumsum(keep) - 1
            word, symbols, codes, rank, value = word[keep], symbols[keep], codes[keep], rank[keep], value[keep]
            now = place[merged]
            last = np.concatenate((word[1:] != word[:-1], [True]))
            rank[last] = _NEVER
            near = np.zeros(len(word) + 1, bool)
            near[now] = near[now - 1] = True  # before the first symbol is the spare place at the end
            fresh = np.flatnonzero(near[:-1] & ~last)
        if not done:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        word, symbols, codes = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(word, kind="stable")
        return word[order], symbols[order], codes[order]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word as packed 32-bit numbers; symbols without a piece become their bytes."""
        word, symbols, codes = self.merge(words)
        odd = (symbols < 0) | (symbols >= self.size)
        if odd.any():
            size = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
            size[~odd] = 1
            raw = "".join(map(chr, codes[odd].tolist())).encode("utf-8", "replace")
            word = np.repeat(word, size)
            ids = np.repeat(symbols, size)
            ids[np.repeat(odd, size)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        else:
            ids = symbols
        packed = ids.astype("<i4").tobytes()
        ends = (4 * np.searchsorted(word, np.arange(len(words)), side="right")).tolist()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _run_length(self, longest: int) -> int:
        """Marks after which a run of marks always begins anew, or 0 if there is no such number here."""
        whole = self._ids([MARK * longest])[0]
        for rest in range(1, 2 * longest + 2):
            if self._ids([MARK * (longest + rest)])[0] != whole + self._ids([MARK * rest])[0]:
                return 0
        return longest

    # ------------------------------------------------------------ texts

    def _parts(self, text: str) -> Iterator[str]:
        """The marked text in parts between words."""
        marked, start = MARK + text.replace(" ", MARK), 0
        while len(marked) - start > _PART:
            found = self.cut.search(marked, start + _PART)
            if not found:
                break
            yield marked[start:found.start()]
            start = found.start()
        yield marked[start:] if start else marked

    def _split(self, word: str) -> Iterator[str]:
        """A long run of marks in blocks that the model treats alike; the last block stays with what follows."""
        marks = len(word) - len(word.lstrip(MARK))
        whole = max(0, marks // self.run - 1) if self.run and marks > 4 * self.run else 0
        for _ in range(whole):
            yield MARK * self.run
        yield word[whole * self.run:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library's ``encode`` gives them."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for number, text in enumerate(texts):
            for part in self._parts(text) if text else ():
                found = self.words.findall(part)
                if max(map(len, found)) > _CACHED_CHARS:
                    found = [p for w in found for p in (self._split(w) if len(w) > _CACHED_CHARS else (w,))]
                waiting.append((number, found))
                size += len(part)
                if size > _PART:
                    self._take(waiting, out)
                    waiting, size = [], 0
        self._take(waiting, out)
        return [np.frombuffer(b"".join(parts), "<i4") for parts in out]

    def _take(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if len(self.known) > _CACHED_WORDS:
            self.known.clear()
        seen: set[str] = set()
        for _, words in waiting:
            seen.update(words)
        new = [w for w in seen if w not in self.known]
        if new:
            self.known.update(zip(new, self._ids(new)))
        for number, words in waiting:
            out[number].append(b"".join(map(self.known.__getitem__, words)))
        for word in [w for w in new if len(w) > _CACHED_CHARS]:
            del self.known[word]

    def decode(self, ids) -> str:
        """Text of ids, as the library's ``decode`` gives it: a byte that is no UTF-8 becomes one U+FFFD."""
        ids = list(ids)
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if ids and raw[:1] == b" " and self._begins_with_mark(ids):
            raw = raw[1:]
        return raw.decode("utf-8", "one_by_one")

    def _begins_with_mark(self, ids: list[int]) -> bool:
        first = next((i for i in ids if self.bytes_of[i]), None)
        return first is not None and self.byte_ids[0x20] != first


def _one_by_one(error: UnicodeError):
    return "�", error.start + 1


def _codec(path: str) -> Codec:
    """One codec a worker process and file."""
    if path not in _codecs:
        import codecs
        codecs.register_error("one_by_one", _one_by_one)
        _codecs.clear()
        _codecs[path] = Codec(path)
    return _codecs[path]


_codecs: dict[str, Codec] = {}


# ---------------------------------------------------------------- over DataFrames

def _listed(arrays: list[np.ndarray]) -> pa.Array:
    sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, pa.int32()))


def encode_column(path: str, text: Column) -> Column:
    """Ids (array of int) of a text column; null counts as empty, with no id."""

    @F.arrow_udf("array<int>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for column in columns:
            yield _listed([ids for texts in text_slices(column) for ids in codec.encode(texts)])

    return of(text)


def decode_column(path: str, ids: Column) -> Column:
    """Text of a column of ids; a null list is an empty text. An id outside the model raises."""

    @F.arrow_udf("string")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for column in columns:
            yield pa.array([codec.decode(x.as_py() or ()) for x in column], pa.string())

    return of(ids)


def round_trip_column(path: str, text: Column) -> Column:
    """Struct (ids, text) of a text column: its ids, and the text decoded from them, in one pass."""

    @F.arrow_udf("ids array<int>, text string")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for column in columns:
            ids = [i for texts in text_slices(column) for i in codec.encode(texts)]
            texts = pa.array([codec.decode(i.tolist()) for i in ids], pa.string())
            yield pa.StructArray.from_arrays([_listed(ids), texts], ["ids", "text"])

    return of(text)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, text)`` per row of ``docs``: repeated rows stay, an empty table gives none.

    Null and empty texts have no ids and decode to the empty text. Other columns are not read.
    """
    return (docs.select(F.col(id_col).alias("id"), round_trip_column(path, F.col(text_col)).alias("p"))
            .select("id", "p.ids", "p.text"))
