"""Toxicity: a bidirectional gated recurrent network with attention pooling over words.

The input of a word is the embedding of the word joined with the mean embedding of all its character n-grams
(``GRAMS`` characters from every position, those at the word's ends marked as such), so every character counts and unseen
forms of known parts are recognised. A text is
cut into overlapping windows of words; each window is read in both directions, the states are pooled by
attention into one logit, and the text's score is the sigmoid of its largest window logit. All windows of
a text are scored, whatever its length; the arithmetic is numpy over many windows at once.

Training is numpy as well: the window with the largest logit of each text carries the text's label (multiple
instances), gradients run back through time, and Adam updates the weights. It sees a bounded sample of
labelled rows (``TrainingBounds``); scoring has no bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.labelled import share_of_ones, training_rows
from catalograph.llm.tables import cut_at_space, text_slices

WINDOW, STRIDE = 48, 32
GRAMS = (3, 5)                # characters of an n-gram
HIDDEN, WIDTH = 8, 8          # states a direction; numbers of a word and of a character embedding
_PART, _WINDOWS = 1 << 18, 4096  # characters read, and windows scored, at a time
SLOT_BITS = 20                # of the table that finds a form's row
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))


@dataclass(frozen=True)
class TrainingBounds:
    """What the driver may gather to learn from: so many toxic and so many other labelled rows, taken by a
    hash of the id, whole texts of ``chars`` characters together at most (see ``training_rows``)."""

    toxic: int = 1200
    other: int = 3600
    chars: int = 48_000_000
    least_texts: int = 5  # a word or piece of fewer texts is unknown
    steps: int = 150
    texts_a_step: int = 192
    rate: float = 0.02
    dropped: float = 0.2
    forms_rate: float = 0.25
    weak: float = 1.0


# ---------------------------------------------------------------- words as numbers

_classes: dict[str, np.ndarray] = {}


def _is_letter() -> np.ndarray:
    if "letter" not in _classes:
        _classes["letter"] = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _classes["letter"]


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_classes.get("power", ())) < length:
        size = max(1 << 16, 1 << (length - 1).bit_length())
        for name, base in (("power", _PRIME), ("inverse", _INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _classes[name] = np.multiply.accumulate(out)
    return _classes["power"][:length], _classes["inverse"][:length]


def _mixed(hashes: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    x = hashes ^ (np.asarray(salt, np.uint64) * np.uint64(0x632BE59BD9B4E019))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of texts by their distinct forms: the form of each word, words per text, hash of each form, and
    the hashes of each form's n-grams one form after the other with their number."""

    form: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray
    grams: np.ndarray
    lengths: np.ndarray


def read_words(texts: list[str]) -> Words:
    """Words are runs of letters and digits of the lower-cased text. An n-gram is hashed with whether it begins or ends
    its word; a word shorter than the least size is one n-gram."""
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    codes = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _is_letter()[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes)))))
    powers, inverses = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * powers[:len(codes)], out=sums[1:])

    def part(a, b, salt):
        return _mixed((sums[b] - sums[a]) * inverses[a], salt)

    hashes, first, form = np.unique(part(starts, ends, 1), return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    owners, grams = [], []
    for size in GRAMS:
        number = np.maximum(ends - starts - size + 1, int(size == GRAMS[0]))
        owner = np.repeat(np.arange(len(starts)), number)
        begin = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        end = np.minimum(begin + size, ends[owner])
        owners.append(owner)
        grams.append(part(begin, end, 10 * size + 2 * (begin == starts[owner]) + (end == ends[owner])))
    owner, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owner, kind="stable")
    return Words(form.astype(np.int32), counts, hashes, gram[order], np.bincount(owner, minlength=len(starts)))


def _means(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean of each run of ``lengths`` rows; every run has a row."""
    if not len(lengths):
        return np.zeros((0, values.shape[1]), np.float32)
    return np.add.reduceat(values, np.cumsum(lengths) - lengths, axis=0) / lengths[:, None].astype(np.float32)


def _some_at_a_time(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of about ``_PART`` characters in order, with the text each belongs to; no word is cut."""
    owner, parts, size = [], [], 0
    for number, text in enumerate(texts):
        for part in cut_at_space(text, _PART):
            owner.append(number)
            parts.append(part)
            size += len(part)
            if size >= _PART:
                yield owner, parts
                owner, parts, size = [], [], 0
    if parts:
        yield owner, parts


def windows(counts: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts of so many words: first word, number of words, text of each window.

    They start every ``stride`` words until one reaches the text's end; a text without words has none.
    """
    offsets = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
    number = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - window) // stride)), 0)
    text = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    first = offsets[text] + nth * stride
    return first, np.minimum(window, offsets[text] + counts[text] - first), text


@dataclass
class Forms:
    """Known forms: row of a hash, 0 for unknown ones. Of two forms for one slot the more frequent is known."""

    slots: np.ndarray
    checks: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, often: np.ndarray) -> tuple[Forms, np.ndarray]:
        """Also the places in ``hashes`` of rows 1, 2, ..."""
        order = np.argsort(-often, kind="stable")
        slot = (hashes[order] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        first = np.sort(np.unique(slot, return_index=True)[1])
        slots = np.zeros(1 << SLOT_BITS, np.int32)
        slots[slot[first]] = np.arange(1, len(first) + 1)
        checks = np.zeros(len(first) + 1, np.uint32)
        checks[1:] = hashes[order[first]].astype(np.uint32)
        return cls(slots, checks), order[first]

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        found = self.slots[hashes >> np.uint64(64 - SLOT_BITS)]
        return np.where(self.checks[found] == hashes.astype(np.uint32), found, 0)


# ---------------------------------------------------------------- the network

@dataclass
class Network:
    """Weights. Gates are ordered z, r, n; the last axis of ``inputs`` is both directions' gates."""

    word_forms: Forms
    piece_forms: Forms
    words: np.ndarray       # (known words + 1, WIDTH); row 0, for unknown words, is zero
    pieces: np.ndarray
    inputs: np.ndarray      # (2 * WIDTH, 6 * HIDDEN)
    bias: np.ndarray        # (6 * HIDDEN,)
    recurrent: np.ndarray   # (2, HIDDEN, 3 * HIDDEN)
    attend: np.ndarray      # (2, HIDDEN)
    out: np.ndarray         # (2, HIDDEN)
    base: np.ndarray        # (1,)
    window: int = WINDOW
    stride: int = STRIDE
    names: tuple = field(default=("words", "pieces", "inputs", "bias", "recurrent", "attend", "out", "base"), repr=False)

    @classmethod
    def fresh(cls, word_forms: Forms, piece_forms: Forms, seed: int = 8) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(word_forms, piece_forms, normal(len(word_forms.checks), WIDTH, scale=0.1),
                   normal(len(piece_forms.checks), WIDTH, scale=0.1),
                   normal(2 * WIDTH, 6 * HIDDEN, scale=0.35), np.zeros(6 * HIDDEN, np.float32),
                   normal(2, HIDDEN, 3 * HIDDEN, scale=0.3), normal(2, HIDDEN, scale=0.3),
                   normal(2, HIDDEN, scale=0.5), np.full(1, -1.0, np.float32))

    def given(self, words: Words) -> np.ndarray:
        """Input of each form: the word's embedding and the mean one of its n-grams, (forms, 2 * WIDTH)."""
        parts = _means(self.pieces[self.piece_forms.rows(words.grams)], words.lengths)
        return np.concatenate((self.words[self.word_forms.rows(words.hashes)], parts), 1)

    def gates(self, given: np.ndarray, form: np.ndarray) -> np.ndarray:
        """Input part of all gates of each word, (words, 6 * HIDDEN)."""
        return given[form] @ self.inputs + self.bias

    def logits(self, gates: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """One logit a window. Windows are sorted by size, so a step runs over a leading part of them."""
        if not len(first):
            return np.zeros(0, np.float32)
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        longest = int(size[0])
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # windows with more than t words
        marks = np.zeros((2, longest, len(first)), np.float32)  # attention and output part of each state
        for side in (0, 1):
            state = np.zeros((len(first), HIDDEN), np.float32)
            heads = np.stack((self.attend[side], self.out[side]), 1)
            both = slice(side * 3 * HIDDEN, side * 3 * HIDDEN + 2 * HIDDEN)
            new = slice(side * 3 * HIDDEN + 2 * HIDDEN, (side + 1) * 3 * HIDDEN)
            for t in range(longest) if side == 0 else range(longest - 1, -1, -1):
                n = live[t]
                row = gates[first[:n] + t]
                h = state[:n]
                back = h @ self.recurrent[side]
                g = row[:, both] + back[:, :2 * HIDDEN]
                g *= 0.5
                np.tanh(g, out=g)
                g += 1
                g *= 0.5
                fresh = back[:, 2 * HIDDEN:] * g[:, HIDDEN:]
                fresh += row[:, new]
                np.tanh(fresh, out=fresh)
                h -= fresh
                h *= g[:, :HIDDEN]
                h += fresh
                marks[:, t, :n] += (h @ heads).T
        marks[0][np.arange(longest)[:, None] >= size] = -np.inf
        weight = np.exp(marks[0] - marks[0].max(0))
        found = (weight * marks[1]).sum(0) / weight.sum(0) + self.base[0]
        out = np.empty(len(first), np.float32)
        out[order] = found
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of each text, 0 to 1. A text without words scores as one window without evidence.

        Words are read and windows are scored a bounded number at a time, however long a text is.
        """
        given, form, counts, forms = [], [], np.zeros(len(texts), np.int64), 0
        for owner, parts in _some_at_a_time(texts):
            words = read_words(parts)
            given.append(self.given(words))
            form.append(words.form + forms)
            forms += len(words.hashes)
            np.add.at(counts, owner, words.counts)
        given = np.concatenate(given) if given else np.zeros((0, 2 * WIDTH), np.float32)
        form = np.concatenate(form) if form else np.zeros(0, np.int32)
        first, size, text = windows(counts, self.window, self.stride)
        best = np.full(len(texts), -np.inf, np.float32)
        for at in range(0, len(first), _WINDOWS):
            some = slice(at, at + _WINDOWS)
            begin, end = int(first[at]), int((first[some] + size[some]).max())
            logits = self.logits(self.gates(given, form[begin:end]), first[some] - begin, size[some])
            np.maximum.at(best, text[some], logits)
        best[np.isneginf(best)] = min(float(self.base[0]), -1.0)
        return 1 / (1 + np.exp(-best.astype(np.float64)))


# ---------------------------------------------------------------- training

def _runs(lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the chosen ones of runs that lie one after the other."""
    size = lengths[chosen]
    begin = (np.cumsum(lengths) - lengths)[chosen]
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


@dataclass
class Known:
    """Words of training texts as rows of the embeddings: the form of each word, and of each form the word's row and
    the rows of its n-grams one form after the other with their number."""

    form: np.ndarray
    word: np.ndarray
    grams: np.ndarray
    lengths: np.ndarray

    def part(self, form: np.ndarray) -> Known:
        """These words alone, with the forms they have."""
        forms, form = np.unique(form, return_inverse=True)
        return Known(form, self.word[forms], self.grams[_runs(self.lengths, forms)], self.lengths[forms])


def _step(net: Network, words: Known, first: np.ndarray, size: np.ndarray, label: np.ndarray,
          weight: np.ndarray, rng, dropped: float) -> dict[str, np.ndarray]:
    """Gradients of the weighted log loss over one window per text; a share of the words is unknown."""
    n, longest = len(first), int(size.max())
    place = np.minimum(first[None, :] + np.arange(longest)[:, None], len(words.form) - 1)
    live = (np.arange(longest)[:, None] < size).astype(np.float32)  # (T, n)
    form = words.form[place]
    row = words.word[form]
    row[rng.random((longest, n)) < dropped] = 0
    given = np.concatenate((net.words[row], _means(net.pieces[words.grams], words.lengths)[form]), 2)
    gates = given @ net.inputs + net.bias
    states = np.zeros((2, longest, n, HIDDEN), np.float32)
    kept = {}
    for side in (0, 1):
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(longest) if side == 0 else range(longest - 1, -1, -1):
            x = gates[t, :, side * 3 * HIDDEN:(side + 1) * 3 * HIDDEN]
            back = h @ net.recurrent[side]
            zr = 1 / (1 + np.exp(-(x[:, :2 * HIDDEN] + back[:, :2 * HIDDEN])))
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            fresh = np.tanh(x[:, 2 * HIDDEN:] + r * back[:, 2 * HIDDEN:])
            kept[side, t] = (h, z, r, fresh, back[:, 2 * HIDDEN:])
            m = live[t][:, None]
            h = m * ((1 - z) * fresh + z * h) + (1 - m) * h
            states[side, t] = h
    mark = sum(states[s] @ net.attend[s] for s in (0, 1))
    value = sum(states[s] @ net.out[s] for s in (0, 1))
    mark = np.where(live > 0, mark, -np.inf)
    alpha = np.exp(mark - mark.max(0))
    alpha /= alpha.sum(0)
    pooled = (alpha * value).sum(0)
    logit = pooled + net.base[0]
    d_logit = (1 / (1 + np.exp(-logit)) - label) * weight / weight.sum()
    d_value = alpha * d_logit
    d_mark = alpha * (value - pooled) * d_logit
    grad = {name: np.zeros_like(getattr(net, name)) for name in net.names}
    grad["base"][0] = d_logit.sum()
    d_gates = np.zeros_like(gates)
    for side in (0, 1):
        grad["attend"][side] = np.einsum("tn,tnh->h", d_mark, states[side])
        grad["out"][side] = np.einsum("tn,tnh->h", d_value, states[side])
        d_states = d_mark[..., None] * net.attend[side] + d_value[..., None] * net.out[side]
        carried = np.zeros((n, HIDDEN), np.float32)
        for t in range(longest - 1, -1, -1) if side == 0 else range(longest):
            h, z, r, fresh, back_n = kept[side, t]
            m = live[t][:, None]
            d = d_states[t] + carried
            d_fresh = d * m * (1 - z) * (1 - fresh * fresh)
            d_z = d * m * (h - fresh) * z * (1 - z)
            d_r = d_fresh * back_n * r * (1 - r)
            d_back = np.concatenate((d_z, d_r, d_fresh * r), 1)
            d_gates[t, :, side * 3 * HIDDEN:(side + 1) * 3 * HIDDEN] = np.concatenate((d_z, d_r, d_fresh), 1)
            grad["recurrent"][side] += h.T @ d_back
            carried = d * (m * z + (1 - m)) + d_back @ net.recurrent[side].T
    flat = d_gates.reshape(-1, 6 * HIDDEN)
    grad["bias"] = flat.sum(0)
    grad["inputs"] = given.reshape(-1, 2 * WIDTH).T @ flat
    d_given = (d_gates @ net.inputs.T)
    np.add.at(grad["words"], row.ravel(), d_given[..., :WIDTH].reshape(-1, WIDTH))
    d_form = np.zeros((len(words.lengths), WIDTH), np.float32)
    np.add.at(d_form, form.ravel(), d_given[..., WIDTH:].reshape(-1, WIDTH))
    np.add.at(grad["pieces"], words.grams, np.repeat(d_form / words.lengths[:, None], words.lengths, 0))
    return grad


def _known(hashes: np.ndarray, all_: np.ndarray, ones: np.ndarray, share: float, least: int) -> tuple[Forms, np.ndarray]:
    """Forms that at least ``least`` texts hold, and the shrunken log odds of label 1 by row."""
    many = all_ >= least
    odds = np.log((ones + 4 * share) / (all_ - ones + 4 * (1 - share)))[many] - np.log(share / (1 - share))
    forms, places = Forms.of(hashes[many], all_[many])
    return forms, np.concatenate(([0], odds[places])).astype(np.float32)


def _in_slices(texts: list[str]) -> Words:
    """``read_words`` of many texts, a few at a time; the n-grams of a form are kept once."""
    words, hashes, grams, lengths = [], [], [], []
    counts, known = np.zeros(len(texts), np.int64), np.zeros(0, np.uint64)
    for owner, some in _some_at_a_time(texts):
        part = read_words(some)
        np.add.at(counts, owner, part.counts)
        words.append(part.hashes[part.form])
        new = np.flatnonzero(~np.isin(part.hashes, known))
        hashes.append(part.hashes[new])
        lengths.append(part.lengths[new])
        grams.append(part.grams[_runs(part.lengths, new)])
        known = np.union1d(known, hashes[-1])
    if not words:
        return Words(np.zeros(0, np.int32), counts, known, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order, size = np.argsort(np.concatenate(hashes)), np.concatenate(lengths)
    form = np.searchsorted(known, np.concatenate(words)).astype(np.int32)
    return Words(form, counts, known, np.concatenate(grams)[_runs(size, order)], size[order])


def train(texts: list[str], labels: list[int], bounds: TrainingBounds = TrainingBounds(), seed: int = 8,
          share: float | None = None) -> Network:
    """Fit a network. Without texts, or with one label only, the base rate alone is learnt.

    ``share`` of label 1 among all labelled rows (if known) replaces that of the balanced steps at the end.
    """
    rng = np.random.default_rng(seed)
    label = np.asarray(labels, np.float32)
    found = _in_slices(texts)
    counts = found.counts
    used = np.flatnonzero(counts > 0)
    if not len(used) or label[used].min() == label[used].max():
        nothing = Forms.of(np.zeros(0, np.uint64), np.zeros(0))[0]
        net = Network.fresh(nothing, nothing, seed)
        net.words[:], net.pieces[:], net.out[:] = 0, 0, 0
        rate = float(np.clip(label.mean(), 0.01, 0.99)) if len(label) else 0.01
        net.base[0] = np.log(rate / (1 - rate))
        return net
    # Forms of too few texts teach nothing but those texts, so they stay unknown.
    owner = np.repeat(np.arange(len(counts)), counts)
    pairs = np.unique(owner * len(found.hashes) + found.form)  # text and form, once each
    of, form = pairs // len(found.hashes), pairs % len(found.hashes)
    all_ = np.bincount(form, minlength=len(found.hashes))
    ones = np.bincount(form, label[of], minlength=len(found.hashes))
    grams, gram = np.unique(found.grams, return_inverse=True)
    share_ = float(label.mean())
    words, word_odds = _known(found.hashes, all_, ones, share_, bounds.least_texts)
    pieces, piece_odds = _known(grams, np.bincount(gram, np.repeat(all_, found.lengths)), np.bincount(gram, np.repeat(ones, found.lengths)),
                                share_, bounds.least_texts)
    net = Network.fresh(words, pieces, seed)
    for value, odds in ((net.words, word_odds), (net.pieces, piece_odds)):
        value[:, 0] = np.sign(odds) * np.maximum(np.abs(odds) - bounds.weak, 0)
    net.words[0], net.pieces[0] = 0, 0
    known = Known(found.form, words.rows(found.hashes), pieces.rows(found.grams), found.lengths)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    positive, negative = used[label[used] == 1], used[label[used] == 0]
    moments = {name: (np.zeros_like(getattr(net, name)), np.zeros_like(getattr(net, name))) for name in net.names}
    means = {name: np.zeros(getattr(net, name).shape) for name in net.names}
    for step in range(1, bounds.steps + 1):
        third = bounds.texts_a_step // 3
        chosen = np.concatenate((rng.choice(positive, min(third, len(positive)), replace=False),
                                 rng.choice(negative, min(2 * third, len(negative)), replace=False)))
        part = known.part(np.concatenate([known.form[offsets[i]:offsets[i + 1]] for i in chosen]))
        first, size, text = windows(counts[chosen])
        given = np.concatenate((net.words[part.word], _means(net.pieces[part.grams], part.lengths)), 1)
        logit = net.logits(net.gates(given, part.form), first, size)
        best = np.lexsort((-logit, text))[np.concatenate(([0], np.flatnonzero(np.diff(text)) + 1))]
        # the gradient runs through the chosen windows alone
        first, size = first[best], size[best]
        inside = part.part(part.form[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())])
        grad = _step(net, inside, np.cumsum(size) - size, size, label[chosen], np.ones(len(chosen), np.float32), rng,
                     bounds.dropped)
        rate = bounds.rate * min(1.0, step / 20) * (1 - 0.7 * step / bounds.steps)
        for name, (m, v) in moments.items():
            g = grad[name]
            m += 0.1 * (g - m)
            v += 0.002 * (g * g - v)
            value = getattr(net, name)
            value -= rate * (bounds.forms_rate if name in ("words", "pieces") else 1) * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.998**step)) + 1e-7)).astype(np.float32)
            if name in ("words", "pieces"):
                value *= 1 - 0.05 * rate
                value[0] = 0
        if 2 * step > bounds.steps:  # the weights used are the mean of those of the second half
            for name in net.names:
                means[name] += getattr(net, name)
    for name in net.names:
        setattr(net, name, (means[name] / (bounds.steps - bounds.steps // 2)).astype(np.float32))
    if share is not None and 0 < share < 1:
        net.base += np.float32(np.log(share / (1 - share)) - np.log(label[chosen].mean() / (1 - label[chosen].mean())))
    return net


# ---------------------------------------------------------------- over DataFrames

def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", bounds: TrainingBounds = TrainingBounds(),
        id_col: str = "doc_id", text_col: str = "text") -> Network:
    texts, ys = training_rows(docs, labels, label_col, bounds.toxic, bounds.other, bounds.chars, id_col, text_col)
    return train(texts, ys, bounds, share=share_of_ones(labels, label_col, id_col))


def score_column(net: Network, text: Column) -> Column:
    """Score (double, 0 to 1) of a text column; null counts as empty. Every window counts."""

    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [net.scores(texts) for texts in text_slices(column)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return of(text)


def score_toxicity(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, predicted)`` per row of ``docs``; repeated rows stay, an empty table gives none.

    Null and empty texts, and texts without a letter or digit, have the low score of a text without evidence.
    Other columns of ``docs`` are not read, whatever their names.
    """
    scored = docs.select(F.col(id_col).alias("id"), score_column(net, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(docs: DataFrame, net: Network, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, all columns unchanged."""
    return docs.where(score_column(net, F.col(text_col)) < threshold)
