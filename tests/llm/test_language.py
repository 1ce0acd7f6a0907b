from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from text_cases import no_documents, odd_documents

from clickloom.llm import language, queries

DATA = "/root/testdata/sf0.01"


def plain_ranking(text: str, size: int) -> list[tuple]:
    """(negative count, n-gram) by the definition, n-grams as lists of code points."""
    counts = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        for n in range(1, len(padded) - 1):
            counts[padded[n]] += 1
            counts[padded[n - 1 : n + 1]] += 1
            counts[padded[n - 1 : n + 2]] += 1
        counts[padded[-2:]] += 1
    code = {g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g)) for g in counts}
    return sorted((-n, code[g]) for g, n in counts.items())[:size]


def test_ranking_against_definition():
    for text in ("The cat, the CAT!", "Über Äpfel — ab a", "x", "中文 字中", "a1b2 aaaa"):
        code, _ = language.triples([text])
        assert language.ranking(code, 12).tolist() == [g for _, g in plain_ranking(text, 12)]


def test_out_of_place_distance():
    profiles = language.Profiles.of({"b": np.array([5, 7, 9]), "a": np.array([9, 8, 7])}, 3)
    assert profiles.identify(np.array([5, 9])) == ("b", pytest.approx(1 - 1 / 6))
    assert profiles.identify(np.array([1, 2])) == ("a", 0.0)  # a tie
    assert profiles.identify(np.zeros(0, np.int64)) == ("und", 0.0)


def test_odd_rows(spark):
    found = language.identify_languages(odd_documents(spark)).collect()
    assert len(found) == 10
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in found) and by_id[None].held_out is False
    assert language.identify_languages(no_documents(spark)).count() == 0


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = queries.op2_rank_order_language(spark, DATA).where("held_out").collect()
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in found]) > 0.97
