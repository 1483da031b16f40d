"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are words and beginnings of words, each with its share of the text's
words, up to ``1 / SCALE``; the ``FEATURES`` that tell toxic from other labelled texts most are kept.
Labels say only whether a text is toxic; its grade of severity comes from the
sample: 0 for others, and for toxic ones 1 or 2, whether the share of words that
mark toxic texts is below or above its median among them. One weight for each
feature serves all thresholds: a text's grade is at least ``k`` with probability
``1 / (1 + exp(threshold[k] - weights . features))``. The expected grade is the
severity; a text is toxic if grade 1 or more is likelier than not.

Labels are learned from outside the held-out fold only.

Defined results: null and empty texts have no features, and the severity of such;
a text of any length counts whole; without labels of both classes nothing is
toxic and severity is 0; repeated rows score alike; further columns stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataline.llm.common import ROW, Shared, alnum_words, map_rows, packed, utf8_list
from strataline.llm.training import SAMPLE, labelled_sample

FEATURES = 2_048
LEAST_TEXTS = 3
BEGINNING = 4
MARKER = 2.0
"""Log odds from which a feature marks toxic texts."""
SCALE = 100.0
STEPS = 300
PENALTY = 1e-4
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("severity", T.DoubleType()),
        T.StructField("p_toxic", T.DoubleType()),
    ]
)


def counts(text: bytes | None) -> tuple[Counter, int]:
    """How often each word and each beginning (marked by a blank) stands in a text; its words."""
    words = Counter(alnum_words(text))
    total = sum(words.values())
    for word, n in list(words.items()):
        words[word[:BEGINNING] + b" "] += n
    return words, total


class Model:
    """Features, their weights and the thresholds."""

    def __init__(self, features: list[bytes], weights: np.ndarray, thresholds: np.ndarray):
        self.index = {f: k for k, f in enumerate(features)}
        self.weights, self.thresholds = weights, thresholds

    def vector(self, text: bytes | None) -> tuple[list[int], list[float], int]:
        found, total = counts(text)
        index = self.index
        at = [(index[f], n) for f, n in found.items() if f in index]
        return [k for k, _ in at], [min(1.0, SCALE * n / total) for _, n in at], total

    def grades(self, text: bytes | None) -> tuple[int, float, float]:
        """Words, expected grade, probability of grade 1 or more."""
        at, values, total = self.vector(text)
        if not self.index:
            return total, 0.0, 0.0
        level = float(np.dot(self.weights[at], values)) if at else 0.0
        upper = 1 / (1 + np.exp(np.clip(self.thresholds - level, -700, 700)))
        return total, float(upper.sum()), float(upper[0])


def _choose(toxic: list[Counter], other: list[Counter]) -> tuple[list[bytes], set[bytes]]:
    """The features with the largest difference between the classes; those that mark toxic texts."""
    n1, n0 = len(toxic), len(other)
    in1, in0 = Counter(), Counter()
    for found, seen in ((toxic, in1), (other, in0)):
        for words in found:
            seen.update(words.keys())
    odds = {
        f: np.log((in1[f] + 0.5) / (n1 + 1)) - np.log((in0[f] + 0.5) / (n0 + 1))
        for f in in1 | in0
        if in1[f] + in0[f] >= LEAST_TEXTS
    }
    apart = {f: abs(in1[f] / n1 - in0[f] / n0) for f in odds}
    kept = sorted(odds, key=lambda f: (-apart[f], f))[:FEATURES]
    return kept, {f for f in odds if odds[f] >= MARKER and not f.endswith(b" ")}


def _fit(x: np.ndarray, grade: np.ndarray, n_grades: int, by_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds, by Adam on the mean log likelihood; ``by_row`` weighs the texts."""
    parts = [np.zeros(x.shape[1]), np.arange(n_grades - 1) * 1.0]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    above = np.stack([grade >= k for k in range(1, n_grades)], axis=1).astype(np.float64)
    for step in range(1, STEPS + 1):
        weights, raw = parts
        # The first threshold is free; each later one lies above the one before.
        thresholds = np.cumsum(np.r_[raw[:1], np.exp(raw[1:] - 1)])
        upper = 1 / (1 + np.exp(np.clip(thresholds[None, :] - (x @ weights.astype(np.float32))[:, None], -30, 30)))
        wide = np.concatenate([np.ones((len(x), 1)), upper, np.zeros((len(x), 1))], axis=1)
        p = np.maximum(wide[np.arange(len(x)), grade] - wide[np.arange(len(x)), grade + 1], 1e-9)
        slope = upper * (1 - upper)
        by_threshold = np.zeros_like(upper)
        for k in range(n_grades - 1):
            by_threshold[:, k] = by_row * slope[:, k] * ((grade == k + 1) * 1.0 - (grade == k) * 1.0) / p
        gradient = by_threshold.sum(axis=1)
        g_weights = x.T @ gradient.astype(np.float32) / len(x) - PENALTY * weights
        g_threshold = -by_threshold.mean(axis=0)
        g_raw = np.r_[g_threshold.sum(), np.cumsum(g_threshold[::-1])[::-1][1:] * np.exp(raw[1:] - 1)]
        for part, g, (m, v) in zip(parts, (g_weights, g_raw), moments, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            part += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, raw = parts
    return weights, np.cumsum(np.r_[raw[:1], np.exp(raw[1:] - 1)])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = SAMPLE,
) -> Model:
    """Train on at most ``per_class`` labelled texts of each class."""
    toxic, other, share = labelled_sample(documents, labels, label, doc_id, text, per_class)
    if len(toxic) < LEAST_TEXTS or len(other) < LEAST_TEXTS:
        return Model([], np.zeros(0), np.full(2, np.inf))
    found = [counts(t) for t in toxic + other]
    features, markers = _choose([f for f, _ in found[: len(toxic)]], [f for f, _ in found[len(toxic) :]])
    marked = np.array([sum(n for f, n in words.items() if f in markers) / max(1, total) for words, total in found])
    grade = np.zeros(len(found), np.int64)
    grade[: len(toxic)] = 1 + (marked[: len(toxic)] > np.median(marked[: len(toxic)]))
    model = Model(features, np.zeros(len(features)), np.zeros(0))
    x = np.zeros((len(found), len(features)), np.float32)
    for row, t in zip(x, toxic + other, strict=True):
        at, values, _ = model.vector(t)
        row[at] = values
    by_row = np.where(grade > 0, share / np.mean(grade > 0), (1 - share) / np.mean(grade == 0))
    model.weights, model.thresholds = _fit(x, grade, 3, by_row)
    return model


def with_severity(documents: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The other columns (``row``), the text if wanted, ``n_words``, ``severity`` and ``p_toxic``."""
    shared = Shared(documents.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = shared.get()
        for batch in batches:
            found = [own.grades(t) for t in utf8_list(batch)]
            yield {name: [f[k] for f in found] for k, name in enumerate(RESULT.names)}

    return map_rows(documents.select(*packed(documents, text)), RESULT, work, [ROW, "text"] if keep_text else [ROW])
