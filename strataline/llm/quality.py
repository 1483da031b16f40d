"""Quality scores from how well two zstandard dictionaries compress a text.

One dictionary is trained on good labelled texts and one on bad ones, both without
the lines that several texts of the sample share. A text is cut into pieces of
``PIECE`` bytes, so that a long text does not become its own dictionary, and each
piece is compressed with either. What the good dictionary saves over the bad one, over the
text's length, is the only measure. It is calibrated by isotonic regression on labelled
texts the dictionaries have not seen, weighted to the shares of the classes among all
labels: the score is the share of good texts among those measured alike, drawn a
little to the share among all, and never falls as the measure rises.

Labels are learned from outside the held-out fold only; no column but the text
enters a score.

Defined results: null and empty texts save nothing and have the curve's value there; a
text of any length is scored whole; without labels of both classes every score is
the share of good labels (0.5 without any); repeated rows score alike; further
columns stay as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import ROW, Shared, map_rows, packed, unpacked, utf8_list
from strataline.llm.training import SAMPLE, labelled_sample

DICTIONARY_BYTES = 1 << 17
PIECE = 512
LEVEL = 3
LEAST_BYTES = 16
"""Added to a text's length, so that a few bytes decide little."""
THRESHOLD = 0.3
SCORE = T.StructType([T.StructField("score", T.DoubleType())])


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    texts = [t for t in texts if t]
    try:
        size = min(DICTIONARY_BYTES, max(256, sum(map(len, texts)) // 4))
        return zstandard.train_dictionary(size, texts, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


class Measure:
    """Compresses texts with both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.dictionaries = good, bad

    def start(self) -> Measure:
        self.compressors = []
        for content in self.dictionaries:
            trained = zstandard.ZstdCompressionDict(content)
            trained.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=trained,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )
        return self

    def saved(self, text: bytes | None) -> float:
        """How many bytes fewer the good dictionary takes than the bad one, over the length."""
        text = text or b""
        good, bad = self.compressors
        pieces = [text[at : at + PIECE] for at in range(0, len(text), PIECE)]
        return sum(len(bad.compress(p)) - len(good.compress(p)) for p in pieces) / (len(text) + LEAST_BYTES)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a curve from ``x`` to the mean of ``y`` that never falls, by pooling neighbours that do.

    Each pool is level from its least to its greatest ``x``, and has one more row of weight
    1 at ``share``, so that no score is quite 0 or 1; between pools the curve is straight.
    """
    values, at = np.unique(x, return_inverse=True)
    sums, weights = np.bincount(at, weight * y), np.bincount(at, weight)
    pools: list[list[float]] = []
    for value, total, n in zip(values, sums, weights, strict=True):
        pools.append([value, value, total, n])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, end, total, n = pools.pop()
            pools[-1] = [pools[-1][0], end, pools[-1][2] + total, pools[-1][3] + n]
    knots = np.array([edge for pool in pools for edge in pool[:2]])
    levels = np.array([(pool[2] + share) / (pool[3] + 1) for pool in pools for _ in range(2)])
    return knots, np.maximum.accumulate(levels)


class Scorer:
    """The fitted measure and curve, or one score for all texts."""

    def __init__(self, measure: Measure | None, curve: tuple[np.ndarray, np.ndarray] | None, constant: float):
        self.measure, self.curve, self.constant = measure, curve, constant

    def scores(self, texts: list[bytes | None]) -> list[float]:
        if self.measure is None or not texts:
            return [self.constant] * len(texts)
        return np.interp([self.measure.saved(t) for t in texts], *self.curve).tolist()


def fit(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = SAMPLE,
) -> Scorer:
    """Train on at most ``per_class`` labelled texts of each class: half for dictionaries, half for the curve."""
    good, bad, share = labelled_sample(documents, labels, label, doc_id, text, per_class)
    if len(good) < 2 or len(bad) < 2:
        return Scorer(None, None, share)
    halves = [(x[: math.ceil(len(x) / 2)], x[math.ceil(len(x) / 2) :]) for x in (good, bad)]
    seen = Counter(line for half, _ in halves for t in half for line in set(t.split(b"\n")))
    own = [[b"\n".join(x for x in t.split(b"\n") if seen[x] == 1) for t in half] for half, _ in halves]
    measure = Measure(*map(_dictionary, own)).start()
    held = halves[0][1], halves[1][1]
    x = np.array([measure.saved(t) for half in held for t in half])
    y = np.repeat([1.0, 0.0], [len(held[0]), len(held[1])])
    weight = np.where(y == 1, share / np.mean(y), (1 - share) / np.mean(1 - y))
    return Scorer(Measure(*measure.dictionaries), isotonic(x, y, weight, share), share)


def with_scores(documents: DataFrame, scorer: Scorer, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The other columns (``row``), the text if wanted, and its ``score``."""
    shared = Shared(documents.sparkSession, scorer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = shared.get()
        if own.measure:
            own.measure.start()
        for batch in batches:
            yield {"score": own.scores(utf8_list(batch))}

    return map_rows(documents.select(*packed(documents, text)), SCORE, work, [ROW, "text"] if keep_text else [ROW])


def keep_good(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents with a score of at least ``threshold``, with their columns."""
    scored = with_scores(documents, fit(documents, labels, doc_id, text), text, keep_text=True)
    return unpacked(scored.where(F.col("score") >= threshold), documents.columns, text)
