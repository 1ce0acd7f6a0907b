from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from text_cases import ODD, documents, labels, no_documents, odd_documents, words

from clickloom.llm import quality


def counted(text: str | None) -> list[int]:
    found = words(text, lower=False)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = {j for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return [len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)]


def test_counts_against_definition():
    texts = [t for _, t in ODD] + ["a b c d e f g h " * 3, "x\nx\n x\n\n\n", "a#b $ <c>", "q " * 9]
    found = quality.statistics(pa.array(texts, pa.string()))
    assert found.counts.tolist() == [counted(t) for t in texts]
    assert np.isfinite(found.ratios).all()


def test_forest_isolates_outliers():
    rng = np.random.default_rng(1)
    rows = np.vstack([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    score = quality.Forest.fit(rows).score(rows)
    assert score.argmax() == 500 and ((0 < score) & (score < 1)).all()


def test_threshold_needs_labels_that_differ():
    scores = np.array([0.1, 0.2, 0.8, 0.9])
    assert quality.calibrate(scores, np.array([True, True, False, False])) == pytest.approx(0.5)
    assert quality.calibrate(scores, np.ones(4, bool)) == float("inf")
    assert quality.calibrate(np.full(4, 0.5), np.array([True, True, False, False])) == float("inf")


def test_odd_rows(spark):
    found = quality.quality_rules(odd_documents(spark), labels(spark)).collect()
    assert sorted([r[1:6] for r in found]) == sorted([tuple(counted(t)) for _, t in ODD])
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in found)
    assert all(r.kept != r.base_failed for r in found)  # nothing more without labels
    assert quality.quality_rules(no_documents(spark), labels(spark)).count() == 0
    kept = quality.filter_quality(odd_documents(spark), labels(spark))
    assert kept.columns == odd_documents(spark).columns and kept.count() == sum(r.kept for r in found)


def test_junk_is_rejected(spark):
    rng = np.random.default_rng(2)
    plain = [" ".join(f"w{rng.integers(999)}" for _ in range(60)) for _ in range(300)]
    junk = [" ".join(f"w{rng.integers(999)}***" for _ in range(60)) for _ in range(60)]
    marks = labels(spark, [(n, int(n < 300), 0) for n in range(0, 360, 2)])
    found = quality.quality_rules(documents(spark, plain + junk), marks).collect()
    assert all(r.kept == (r.doc_id < 300) for r in found)
