"""Quality by pairwise ranking: a Bradley-Terry model over text features.

A document's strength is linear in its features. From preference pairs (a good and a bad labelled
document) the weights are learned by logistic loss on the difference of the two feature vectors. The
threshold is a quantile of the learned strengths: the share of bad documents among the labels lies
below it. Strengths map to (0, 1) by a logistic curve that puts the threshold at ``KEEP_AT``.

Features come from the text alone. They are computed once for all documents and stored; learning reads
those of at most ``LABELLED`` labelled documents, chosen by a hash of the id, which bounds what
the driver sees. Scores use features of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    group_of,
    id_and_text,
    ids,
    map_texts,
    stored,
    texts,
    window_hashes,
    word_hashes,
    words_of,
)

KEEP_AT = 0.7
LABELLED = 20_000
PAIRS = 100_000
STEPS, RATE, RIDGE = 300, 0.5, 1e-3
FOLDS, HELD_OUT = 4, 2

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?"
_STOPS = b".,;:"
FEATURES = (
    "log_words",
    "short",
    "word_length",
    "symbols",
    "bars",
    "marks",
    "stops",
    "digits",
    "upper",
    "wide_upper",
    "distinct",
    "neighbours",
    "repeated_windows",
    "top_word",
    "log_lines",
    "repeated_lines",
    "byte_entropy",
)


def _share(text: bytes, alphabet: bytes, of: int) -> float:
    return (len(text) - len(text.translate(None, alphabet))) / of


def features(text: bytes) -> list[float]:
    """What the ranking sees of one text; an empty text gives zeros."""
    words = words_of(text)
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    h = word_hashes(words)
    windows = window_hashes(h, min(5, n))
    distinct_windows = len(np.unique(windows))
    distinct, counts = np.unique(h, return_counts=True)
    letters = max(1, size - len(text.translate(None, _UPPER + _LOWER)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    p = histogram[histogram > 0] / size
    return [
        np.log1p(n),
        1.0 / n,
        size / n,
        _share(text, _SYMBOLS, n),
        _share(text, b"|", n),
        _share(text, _MARKS, n),
        _share(text, _STOPS, n),
        _share(text, _DIGITS, n),
        _share(text, _UPPER, letters),
        float(_share(text, _UPPER, letters) > 0.5),
        len(distinct) / n,
        float((h[1:] == h[:-1]).sum()) / n,
        1.0 - distinct_windows / len(windows),
        float(counts.max()) / n,
        np.log1p(len(lines)),
        1.0 - len(set(lines)) / max(1, len(lines)),
        float(-(p * np.log2(p)).sum()),
    ]


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id and ``features`` of every row."""

    def rows(batch) -> Iterator[dict]:
        yield {"doc_id": ids(batch), "features": [features(t) for t in texts(batch)]}

    return map_texts(id_and_text(docs), "doc_id bigint, features array<double>", rows)


@dataclass(frozen=True)
class Ranking:
    """Strength = (features - mean) / spread . weights; ``threshold`` is the strength of KEEP_AT."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = ((x - self.mean) / self.spread) @ self.weights
        base = np.log(KEEP_AT / (1 - KEEP_AT))
        return 1.0 / (1.0 + np.exp(-np.clip(strength - self.threshold + base, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, seed: int = 7) -> Ranking:
    """Learn from preference pairs. Without both kinds of labels all documents tie and are kept."""
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if good.all() or not good.any():
        return Ranking(np.zeros(k), np.ones(k), np.zeros(k), 0.0)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = (x - mean) / spread
    rng = np.random.default_rng(seed)
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    difference = z[rng.choice(winners, PAIRS)] - z[rng.choice(losers, PAIRS)]
    weights, pace = np.zeros(k), np.zeros(k)
    for _ in range(STEPS):
        wrong = 1.0 / (1.0 + np.exp(np.clip(difference @ weights, -30, 30)))
        slope = wrong @ difference / PAIRS - RIDGE * weights
        pace = 0.9 * pace + slope
        weights = weights + RATE * pace * 0.1
    strength = np.sort(z @ weights)
    at = len(losers)  # as many documents below the threshold as there are bad ones
    return Ranking(mean, spread, weights, float((strength[at - 1] + strength[at]) / 2))


def learn(featured: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on a bounded sample of labelled documents that are not held out."""
    usable = labels.select("doc_id", "quality").filter(
        F.col("quality").isin(0, 1)
        & F.col("doc_id").isNotNull()
        & (group_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(LABELLED)
    rows = featured.join(chosen, "doc_id").select("features", "quality", "doc_id")
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(LABELLED).toPandas()
    x = np.array(sample["features"].to_list(), float).reshape(-1, len(FEATURES))
    return fit(x, sample["quality"].to_numpy() == 1)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score in 0 to 1, predicted (1 if score >= 0.7); one row per input row.

    Learns from ``labels`` (doc_id, quality) but never from rows whose group is held out. Empty and
    NULL texts are scored by features of zero. A NULL doc_id is scored and not held out.
    """
    featured = stored(document_features(docs), "quality-features")
    ranking = learn(featured, labels)

    def rows(batch) -> Iterator[dict]:
        x = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
        yield {"doc_id": ids(batch), "score": ranking.score(x)}

    scored = map_texts(featured, "doc_id bigint, score double", rows)
    held_out = F.coalesce(group_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= KEEP_AT).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns.

    Rows without a doc_id cannot be looked up and stay.
    """
    bad = quality_scores(docs, labels).filter("predicted = 0").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
