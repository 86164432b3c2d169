from __future__ import annotations

import itertools

import numpy as np
import pytest
from conftest import frame, prose
from vecloom.llm import crf


@pytest.mark.parametrize("seed", range(3))
def test_marginals_equal_all_paths(seed):
    rng = np.random.default_rng(seed)
    bounds = np.array([0, 0, 5, 6, 6, 13])
    emission, moves = rng.normal(scale=2, size=13), rng.normal(size=(2, 2))
    p, expected_moves = crf.marginals(emission, moves, bounds)
    total_moves = np.zeros((2, 2))
    for a, b in zip(bounds, bounds[1:]):
        weights, hits, steps = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(emission[a + t] * s for t, s in enumerate(path)) + sum(moves[s, t] for s, t in zip(path, path[1:])))
            weights += w
            hits += w * np.array(path)
            for s, t in zip(path, path[1:]):
                steps[s, t] += w
        if b > a:
            assert np.allclose(p[a:b], hits / weights)
        total_moves += steps / weights
    assert np.allclose(expected_moves, total_moves)


def test_long_products_stay_finite():
    rng = np.random.default_rng(0)
    p, _ = crf.marginals(rng.normal(scale=20, size=100_000), np.array([[3.0, -3], [-3, 3]]), np.array([0, 100_000]))
    assert np.isfinite(p).all() and ((p >= 0) & (p <= 1)).all()


def corpus():
    bad = ["nasty", "vile", "stemox", "stemuz", "stemal"]
    rows, labels = [], []
    for k in range(400):
        words = prose(1_000 + k, 40).split()
        toxic = k % 4 == 0
        if toxic:
            words[k % 40] = bad[(k // 4) % 5] + "."
            words[(k * 7 + 3) % 40] = bad[(k // 4 + 1) % 5].capitalize()
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_held_out_documents_and_spans(spark, texts):
    rows, labels = corpus()
    rows += [(5_000 + k, t) for k, (_, t) in enumerate(texts)] + [(9_000, "Some stemnew words"), (9_001, "NASTY!! vile word here nasty")]
    marks = spark.createDataFrame([(i, 1, y) for i, y in labels] + [(None, 1, 1), (3, 1, None), (5_000, 0, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    field = crf.fit_labelled(docs, marks)
    found = {r.doc_id: r for r in crf.tag(docs, field).collect()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found.values())
    held = {r.doc_id for r in docs.where(crf.held_out(docs.doc_id)).collect()}
    right = [(found[i].score >= 0.5) == bool(y) for i, y in labels if i in held]
    assert len(right) > 50 and np.mean(right) > 0.97
    assert all(found[5_000 + k].score < 0.5 for k in range(len(texts)))
    assert found[9_000].score >= 0.5  # an ending that no label shows
    spans = [(x.start, x.end) for x in found[9_001].spans]
    assert spans == [(0, 12), (23, 28)]
    assert not found[5_000].spans and found[5_000].score == found[5_001].score


def test_without_labels_or_rows(spark, odd, none):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    field = crf.fit_labelled(odd, marks)
    assert all(0 <= r.score <= 1 for r in crf.tag(odd, field).collect())
    assert crf.tag(none, field).count() == 0
