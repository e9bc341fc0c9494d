"""Document quality by hierarchical empirical Bayes.

A classifier on surface statistics of the text gives each document its own evidence. Grouped sums of that
evidence give every host, and every path of a host, a posterior share of good documents: a path is shrunk
towards its host and a host towards the whole corpus, by prior weights estimated from the spread between
hosts and between paths (method of moments), so sparse sites follow the global prior. A document's quality
combines its evidence with the posterior of its site, which leaves out the document itself.

The classifier is fitted on a bounded sample of labelled rows; all site statistics cover all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.labelled import share_of_ones, training_values
from catalograph.llm.tables import cut_at_space, text_slices, written

STEPS = 12          # a statistic is read in so many steps, borders are quantiles of the training rows
LEAST_SHARE = 0.02  # evidence stays within this distance of 0 and 1
FEATURES = ("words", "word length", "distinct words", "commonest word", "repeated neighbours", "letters",
            "upper case", "digits", "marks", "longest run of marks", "lines a word", "distinct lines")

_kinds: list[np.ndarray] = []


def _kind_of_codes() -> np.ndarray:
    """0 other, 1 lower or caseless letter, 2 upper-case letter, 3 digit, 4 white space, 5 plain punctuation."""
    if not _kinds:
        kind = np.zeros(0x110000, np.uint8)
        for code in range(0x110000):
            char = chr(code)
            if char.isupper():
                kind[code] = 2
            elif char.isalpha():
                kind[code] = 1
            elif char.isdigit():
                kind[code] = 3
            elif char.isspace():
                kind[code] = 4
            elif char in ".,;:'\"()-?":
                kind[code] = 5
        _kinds.append(kind)
    return _kinds[0]


def statistics(text: str) -> list[float]:
    """The values of ``FEATURES``, over the whole text, read in parts of about a million characters that end before white
    space. A run of odd characters or a line that lies in two parts counts as two."""
    kinds = np.zeros(6, np.int64)
    words, lines = Counter(), set()
    number = length = repeated = line_count = run = 0
    last = None
    for part in cut_at_space(text):
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kind_of_codes()[codes]
        kinds += np.bincount(kind, minlength=6)
        odd = np.flatnonzero(np.diff(np.concatenate(([0], (kind == 0).view(np.int8), [0]))))
        if len(odd):
            run = max(run, int((odd[1::2] - odd[::2]).max()))
        found = part.split()
        words.update(found)
        number += len(found)
        length += sum(map(len, found))
        repeated += sum(a == b for a, b in zip(found, found[1:])) + (bool(found) and found[0] == last)
        last = found[-1] if found else last
        split = part.split("\n")
        line_count += len(split)
        lines.update(map(hash, split))
    size, count = max(1, len(text)), max(1, number)
    commonest = max(words.values(), default=0)
    return [np.log1p(number), length / count, len(words) / count, commonest / count, repeated / count,
            kinds[1:3].sum() / size, kinds[2] / size, kinds[3] / size, kinds[0] / size, min(run, 50),
            line_count / count, len(lines) / max(1, line_count)]


@dataclass
class Classifier:
    """Logistic regression on the steps of each statistic."""

    borders: np.ndarray  # (features, STEPS - 1)
    weights: np.ndarray  # (features, STEPS)
    base: float
    prior: float         # share of label 1 that the evidence includes

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 by the text alone; a text without words counts as one of no word."""
        if not texts:
            return np.zeros(0)
        values = np.array([statistics(t) for t in texts])
        logit = np.full(len(texts), self.base)
        for k, (border, weight) in enumerate(zip(self.borders, self.weights)):
            logit += weight[np.searchsorted(border, values[:, k])]
        return np.clip(1 / (1 + np.exp(-logit)), LEAST_SHARE, 1 - LEAST_SHARE)


def train(texts: list, labels: list[int], prior: float | None = None, rounds: int = 400) -> Classifier:
    """Penalised maximum likelihood from texts or their ``statistics``. ``prior`` is the share of label 1 among all labelled rows."""
    label = np.asarray(labels, float)
    share = float(np.clip(label.mean() if prior is None and len(label) else 0.5 if prior is None else prior, 0.01, 0.99))
    n = len(FEATURES)
    if not len(label) or label.min() == label.max():
        return Classifier(np.zeros((n, STEPS - 1)), np.zeros((n, STEPS)), float(np.log(share / (1 - share))), share)
    values = np.array([statistics(t) if isinstance(t, str) else t for t in texts])
    borders = np.quantile(values, np.linspace(0, 1, STEPS + 1)[1:-1], axis=0).T
    step = np.stack([np.searchsorted(b, values[:, k]) for k, b in enumerate(borders)], 1)
    # rows are weighted to the true share of the labels
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean()))
    weights, base = np.zeros((n, STEPS)), float(np.log(share / (1 - share)))
    m, v = np.zeros((n, STEPS)), np.zeros((n, STEPS))
    for turn in range(1, rounds + 1):
        logit = base + weights[np.arange(n), step].sum(1)
        error = (1 / (1 + np.exp(-logit)) - label) * weight / weight.sum()
        grad = np.stack([np.bincount(step[:, k], error, STEPS) for k in range(n)]) + 2e-4 * weights
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        weights -= 0.05 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
        base -= 2.0 * error.sum()
    return Classifier(borders, weights, base, share)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", ones: int = 3000, zeros: int = 3000,
        id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Learn from at most ``ones`` + ``zeros`` labelled rows (see ``training_values``): tasks read their whole texts,
    the driver gathers ``FEATURES`` only."""
    values, ys = training_values(docs, labels, label_col, ones, zeros, statistics_column, id_col, text_col)
    return train(values, ys, share_of_ones(labels, label_col, id_col))


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([statistics(t) for texts in text_slices(column) for t in texts], pa.list_(pa.float64()))

    return of(text)


def evidence_column(classifier: Classifier, text: Column) -> Column:
    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [classifier.evidence(texts) for texts in text_slices(column)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return of(text)


# ---------------------------------------------------------------- sites

def _prior_weight(groups: int, rows: float, squares: float, between: float, within: float) -> float:
    """Rows that the parent's share is worth: within over between variance, by the method of moments.

    ``between`` is the sum over groups of n (mean - parent's mean)^2, ``squares`` the sum of n^2 / rows.
    """
    if groups < 2 or rows <= groups or rows - squares <= 0:
        return 1e6
    spread = within / (rows - groups)
    excess = (between - (groups - 1) * spread) / (rows - squares)
    return float(np.clip(spread / excess, 1.0, 1e6)) if excess > 0 else 1e6


@dataclass(frozen=True)
class Priors:
    """The whole corpus: share of good documents, and what host's and corpus's shares weigh in rows."""

    share: float
    host: float
    path: float


def sites(rows: DataFrame) -> tuple[DataFrame, Priors]:
    """From ``(host, path, evidence)`` rows: sums of each path and its host, and the estimated priors.

    One row per (host, path); null hosts and paths are sites of their own.
    """
    paths = written(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s"),
                                                      F.sum(F.col("evidence") * F.col("evidence")).alias("q")), "paths")
    hosts = written(paths.groupBy("host").agg(
        F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum("q").alias("host_q"), F.count("*").alias("paths"),
        F.sum(F.col("n") * F.col("n") / 1.0).alias("nn"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("sm")), "hosts")
    total = hosts.agg(
        F.count("*").alias("hosts"), F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.sum("host_q").alias("q"),
        F.sum("paths").alias("paths"), F.sum(F.col("host_n") * F.col("host_n") / 1.0).alias("nn"),
        F.sum(F.col("host_s") * F.col("host_s") / F.col("host_n")).alias("sm"), F.sum("sm").alias("path_sm"),
        F.sum(F.col("nn") / F.col("host_n")).alias("path_nn")).first()
    if not total["n"]:
        priors = Priors(0.5, 1e6, 1e6)
    else:
        n, s = total["n"], total["s"]
        host = _prior_weight(total["hosts"], n, total["nn"] / n, total["sm"] - s * s / n, total["q"] - total["sm"])
        path = _prior_weight(total["paths"] - total["hosts"] + 1, n, total["path_nn"], total["path_sm"] - total["sm"],
                             total["q"] - total["path_sm"])
        priors = Priors(s / n, host, path)
    found = paths.join(hosts.select(F.col("host").alias("h"), "host_n", "host_s"), F.col("host").eqNullSafe(F.col("h")))
    return written(found.select("host", "path", "n", "s", "host_n", "host_s"), "sites"), priors


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _posterior(evidence: Column, n: Column, s: Column, host_n: Column, host_s: Column, priors: Priors,
               prior: float) -> tuple[Column, Column, Column]:
    """Host's and path's share without the document itself, and the document's combined probability."""
    host = (host_s - evidence + priors.host * priors.share) / (host_n - 1 + priors.host)
    path = (s - evidence + priors.path * host) / (n - 1 + priors.path)
    share = F.greatest(F.lit(0.001), F.least(F.lit(0.999), path))
    logit = _logit(evidence) - float(np.log(prior / (1 - prior))) + _logit(share)
    return host, path, 1 / (1 + F.exp(-logit))


def _null_safe(left: DataFrame, host: Column, path: Column, known: DataFrame) -> DataFrame:
    return left.join(known, host.eqNullSafe(known["site_host"]) & path.eqNullSafe(known["site_path"]))


BROADCAST_SITES = 100_000  # rows of about 100 bytes


def _with_sites(docs: DataFrame, host: Column, path: Column, known: DataFrame) -> DataFrame:
    """``docs`` with the columns of their site; texts of a site that many documents share never move.

    Up to ``BROADCAST_SITES`` sites are broadcast. Of more than that the fewer than 1,000 that hold over a thousandth of all
    documents each are, and the others' documents meet their site by a shuffle without a hot key.
    """
    if known.count() <= BROADCAST_SITES:
        return _null_safe(docs, host, path, F.broadcast(known))
    large = F.col("site_n") * 1000 > known.agg(F.sum("site_n")).first()[0]
    same = host.eqNullSafe(known["site_host"]) & path.eqNullSafe(known["site_path"])
    hot = docs.join(F.broadcast(known.where(large)), same, "left")
    rest = hot.where("site_n IS NULL").select(*[docs[f"`{c}`"] for c in docs.columns])
    return hot.where("site_n IS NOT NULL").unionByName(_null_safe(rest, host, path, known.where(~large)))


def _named(known: DataFrame) -> DataFrame:
    return known.select(*[F.col(c).alias(f"site_{c}") for c in known.columns])


def score_quality(docs: DataFrame, classifier: Classifier, host_col: str = "source", path_col: str = "lang",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, evidence, host_share, path_share, score)`` per row of ``docs``; a score below 0.5 is a rejection.

    Null and empty texts have the evidence of a text without words; null hosts and paths are sites of their own.
    Repeated rows count as often as they occur; an empty table gives no row. No other column is read.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"),
                               evidence_column(classifier, F.col(text_col)).alias("evidence")), "evidence")
    known, priors = sites(rows)
    joined = _null_safe(rows, rows["host"], rows["path"], _named(known))
    host, path, score = _posterior(F.col("evidence"), F.col("site_n"), F.col("site_s"), F.col("site_host_n"),
                                   F.col("site_host_s"), priors, classifier.prior)
    return joined.select("id", "evidence", host.alias("host_share"), path.alias("path_share"), score.alias("score"))


def keep_good(docs: DataFrame, classifier: Classifier, threshold: float = 0.5, host_col: str = "source",
              path_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score is at least ``threshold``, all columns unchanged.

    The text is scored once for the site sums and once for the decision, so that of a large site is never shuffled.
    Null and empty texts, null hosts and paths and repeated rows count as in ``score_quality``; an empty table gives none.
    """
    rows = docs.select(F.col(host_col).alias("host"), F.col(path_col).alias("path"),
                       evidence_column(classifier, F.col(text_col)).alias("evidence"))
    known, priors = sites(rows)
    known = _named(known)
    joined = _with_sites(docs, docs[host_col], docs[path_col], known)
    own = evidence_column(classifier, docs[text_col])
    carried = "site_of_row"
    while carried in docs.columns:
        carried += "_"
    scored = joined.select(*[docs[f"`{c}`"] for c in docs.columns], F.struct(own.alias("e"), joined["site_n"].alias("n"), joined["site_s"].alias("s"),
                                                                      joined["site_host_n"].alias("hn"), joined["site_host_s"].alias("hs")).alias(carried))
    part = F.col(carried)
    _, _, score = _posterior(part["e"], part["n"], part["s"], part["hn"], part["hs"], priors, classifier.prior)
    return scored.where(score >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
