"""Classifiers: held-out accuracy on the driver's tables, and defined results at the edges."""

import zlib

import numpy as np
import pytest
import zstandard

from strataline.llm import quality, toxicity
from strataline.llm.common import ROW
from strataline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held_out_rows(spark, name, label):
    scored = QUERIES[name](spark, DATA)
    return [
        (r.predicted, r[label])
        for r in scored.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").collect()
    ]


def test_quality_on_held_out_labels(spark):
    rows = held_out_rows(spark, "op2_quality", "quality")
    good, bad = [p for p, y in rows if y], [p for p, y in rows if not y]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_toxicity_on_held_out_labels(spark):
    rows = held_out_rows(spark, "op9_toxicity", "toxic")
    toxic, other = [p for p, y in rows if y], [p for p, y in rows if not y]
    assert np.mean(toxic) > 0.85 and np.mean(other) < 0.01


def test_held_out_labels_change_nothing(spark, docs):
    texts = [("fine words stand here " if k % 2 else "BAD!! $$$ NOISE!! ") * 9 + str(k) for k in range(60)]
    rows = [(k, k % 2, 1 - k % 2) for k in range(60)]
    turned = [(k, q, t) if zlib.crc32(str(k).encode()) % 5 else (k, 1 - q, 1 - t) for k, q, t in rows]
    frame = docs(texts)
    for fit, apply, column in (
        (quality.fit, quality.with_scores, "score"),
        (toxicity.fit, toxicity.with_severity, "severity"),
    ):
        found = [
            {r.doc_id: r[column] for r in apply(frame, fit(frame, labels(spark, x))).select(f"{ROW}.doc_id", column).collect()}
            for x in (rows, turned)
        ]
        assert found[0] == found[1]


def test_ordinal_fit_orders_thresholds_and_grades():
    rng = np.random.default_rng(3)
    level = rng.normal(size=800) * 2
    grade = (level + rng.logistic(size=800) > -1).astype(int) + (level > 2)
    weights, thresholds = toxicity._fit(level[:, None].astype(np.float32), grade, 3, np.ones(800))
    assert weights[0] > 0 and thresholds[0] < thresholds[1]
    model = toxicity.Model([b"x"], np.array([2.0]), np.array([1.0, 3.0]))
    words, severity, p = model.grades(b"x")
    assert words == 1
    upper = 1 / (1 + np.exp(np.array([1.0, 3.0]) - 2.0))
    assert severity == pytest.approx(upper.sum()) and p == pytest.approx(upper[0])


def test_awkward_documents(spark, awkward, nothing):
    known = labels(spark, [(1, 1, 0), (4, 0, 1), (5, 1, 0), (6, 0, 1), (None, 1, 1), (2, None, None), (3, 1, 7)])
    for given in (known, known.limit(0)):
        scored = quality.with_scores(awkward, quality.fit(awkward, given)).collect()
        assert len(scored) == awkward.count() and all(0 <= r.score <= 1 for r in scored)
        graded = toxicity.with_severity(awkward, toxicity.fit(awkward, given)).collect()
        assert len(graded) == awkward.count() and all(0 <= r.severity <= 2 for r in graded)
        kept = quality.keep_good(awkward, given)
        assert kept.schema == awkward.schema
    assert {r.score for r in scored} == {0.5} and {r.severity for r in graded} == {0.0}
    assert quality.keep_good(nothing, known).collect() == []
    assert toxicity.with_severity(nothing, toxicity.fit(nothing, known)).collect() == []


def test_long_text_is_scored_in_pieces():
    measure = quality.Measure(b"good words " * 90, b"BAD!! " * 90).start()
    one = measure.saved(b"good words " * 50)
    assert one > 0
    assert measure.saved(b"good words " * 50_000) == pytest.approx(one, abs=0.05)


def test_isotonic_curve_is_the_least_squares_one():
    rng = np.random.default_rng(6)
    x, y, w = np.round(rng.normal(size=60), 1), rng.integers(0, 2, 60) * 1.0, rng.uniform(0.5, 2, 60)
    values = np.unique(x)
    mean = np.array([np.average(y[x == v], weights=w[x == v]) for v in values])
    weight = np.array([w[x == v].sum() for v in values])
    # The highest of the lowest means of all runs that begin at or before, and end at or after, a value.
    n = len(values)
    level = [max(min(np.average(mean[a : b + 1], weights=weight[a : b + 1]) for b in range(k, n)) for a in range(k + 1)) for k in range(n)]
    pools = {round(v, 9): weight[np.isclose(level, v)].sum() for v in level}
    share = 0.3
    expected = [(v * pools[round(v, 9)] + share) / (pools[round(v, 9)] + 1) for v in level]
    knots, levels = quality.isotonic(x, y, w, share)
    assert np.interp(values, knots, levels) == pytest.approx(np.maximum.accumulate(expected))


def test_quality_scores_from_the_definition(spark, docs):
    """A score, from the two dictionaries and the curve alone."""
    texts = [("fine words stand here " if k % 2 else "BAD!! $$$ NOISE!! ") * (1 + k % 40) + str(k) for k in range(200)]
    frame, known = docs(texts), labels(spark, [(k, (k % 2) ^ (k % 11 == 0), 0) for k in range(200)])
    scorer = quality.fit(frame, known)
    found = {r.doc_id: r.score for r in quality.with_scores(frame, scorer).select(f"{ROW}.doc_id", "score").collect()}
    packers = [
        zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False,
            write_checksum=False, write_dict_id=False,
        )
        for content in scorer.measure.dictionaries
    ]
    for k, text in enumerate(texts):
        raw = text.encode()
        good, bad = (sum(len(p.compress(raw[a : a + 512])) for a in range(0, len(raw), 512)) for p in packers)
        saved = (bad - good) / (len(raw) + 16)
        knots, levels = scorer.curve
        left, right = np.searchsorted(knots, saved, side="right") - 1, np.searchsorted(knots, saved, side="right")
        if left < 0 or right >= len(knots):
            expected = levels[0] if left < 0 else levels[-1]
        else:
            expected = levels[left] + (levels[right] - levels[left]) * (saved - knots[left]) / (knots[right] - knots[left])
        assert found[k] == pytest.approx(expected, abs=1e-9)
    assert len(set(found.values())) > 3


def test_severity_from_the_definition(spark, docs):
    """Grades, from features, weights and thresholds alone."""
    rng = np.random.default_rng(2)
    words = ["kind", "plain", "usual", "vile", "vilest", "nasty"]
    texts = [" ".join(rng.choice(words, size=30, p=[0.3, 0.3, 0.3, 0.04, 0.03, 0.03] if k % 3 else [0.1] * 3 + [0.3, 0.2, 0.2])) for k in range(150)]
    frame, known = docs(texts), labels(spark, [(k, 1, int(k % 3 == 0)) for k in range(150)])
    model = toxicity.fit(frame, known)
    rows = toxicity.with_severity(frame, model).select(f"{ROW}.doc_id", "n_words", "severity", "p_toxic").collect()
    for r in rows:
        own = texts[r.doc_id].split()
        level = 0.0
        for feature, at in model.index.items():
            beginning = feature.endswith(b" ")
            n = sum(w[:4].encode() == feature[:-1] if beginning else w.encode() == feature for w in own)
            level += model.weights[at] * min(1.0, 100 * n / len(own)) if n else 0.0
        above = [1 / (1 + np.exp(t - level)) for t in model.thresholds]
        assert r.n_words == 30 and r.p_toxic == pytest.approx(above[0]) and r.severity == pytest.approx(sum(above))
    assert model.thresholds[0] < model.thresholds[1]
