from __future__ import annotations

import random

import numpy as np
import pytest
from text_cases import ODD, documents, no_documents, odd_documents, words

from clickloom.llm import queries, set_join
from clickloom.llm.components import components


def shingles(text, width):
    found = words(text)
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def plain_components(rows, width, similarity):
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, own) in enumerate(sets):
        for j, other in sets[:n]:
            both = len(own & other)
            if both and 100 * both >= similarity * (len(own) + len(other) - both):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted((i, len(s), find(i)) for i, s in sets)


def near_texts(seed: int):
    """Texts with copies, edits, chains of edits and shared passages of all sizes."""
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    texts = []
    for size in (1, 2, 3, 4, 8, 12, 20, 21, 30, 60, 61, 150, 400):
        base = rng.choices(vocabulary, k=size)
        for _ in range(12):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 1, 2, 4])):
                at = rng.randrange(len(base))
                change = rng.randrange(3)
                if change == 0:
                    base[at] = rng.choice(vocabulary).upper()
                elif change == 1:
                    base.insert(at, rng.choice(vocabulary))
                elif len(base) > 1:
                    del base[at]
    passage = rng.choices(vocabulary, k=50)
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(2, 12))) for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("width, similarity, seed", [(3, 90, 1), (3, 90, 2), (5, 80, 3), (2, 60, 4)])
def test_against_all_pairs(spark, width, similarity, seed):
    texts = near_texts(seed)
    found = set_join.jaccard_components(documents(spark, texts), width, similarity).collect()
    want = plain_components(list(enumerate(texts)), width, similarity)
    assert sorted(map(tuple, found)) == want
    assert len({c for _, _, c in want}) < len(texts)


@pytest.mark.parametrize("similarity", [90, 80, 55])
def test_linked_sets_share_a_signature(similarity):
    rng = np.random.default_rng(similarity)
    for size in [*range(1, 60), 150, 400]:
        for _ in range(4):
            one = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            keep = rng.random(len(one)) > rng.choice([0, 0.02, 0.06, 0.2])
            added = rng.integers(0, 1 << 62, rng.integers(0, 1 + size // 9)).astype(np.uint64)
            two = np.unique(np.concatenate([one[keep], added]))
            both = len(np.intersect1d(one, two))
            if both and 100 * both >= similarity * (len(one) + len(two) - both):
                shared = np.intersect1d(
                    set_join.signatures(one, similarity), set_join.signatures(two, similarity)
                )
                assert len(shared), (size, len(two))
                differing = np.unpackbits((set_join.parities(one) ^ set_join.parities(two)).view(np.uint8)).sum()
                assert differing <= len(one) + len(two) - 2 * both


@pytest.mark.parametrize("similarity", [84, 80, 55])
def test_linked_sets_share_a_first_shingle(similarity):
    rng = np.random.default_rng(similarity)
    for size in [*range(1, 60), 150, 400]:
        for _ in range(4):
            one = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            keep = rng.random(len(one)) > rng.choice([0, 0.02, 0.1, 0.2])
            added = rng.integers(0, 1 << 62, rng.integers(0, 1 + size // 9)).astype(np.uint64)
            two = np.unique(np.concatenate([one[keep], added]))
            known = np.sort(rng.choice(one, len(one) // 2, replace=False))
            common = known, rng.integers(3, 9, len(known))
            both = len(np.intersect1d(one, two))
            if both and 100 * both >= similarity * (len(one) + len(two) - both):
                firsts = [set_join.first_shingles(x, similarity, common) for x in (one, two)]
                assert len(np.intersect1d(*firsts)), (size, len(two))


def test_common_shingles_come_last(spark):
    rare = [" ".join(f"r{n}w{i}" for i in range(9)) for n in range(6)]
    docs = documents(spark, [f"{own} and these words stand in all of them" for own in rare])
    known, seen = set_join.common_shingles(docs, 5)
    assert len(known) == 4 and (np.diff(known.astype(object)) > 0).all() and set(seen) == {6}
    (_, own), *_ = set_join.shingle_sets(docs.toArrow()["text"].combine_chunks(), 5)
    first = set_join.first_shingles(own, 80, (known, seen))
    last = set_join.mix(known).view(np.int64)
    assert len(first) == len(own) - -(-len(own) * 80 // 100) + 1 and not set(first) & set(last)


def test_budgets_cover_the_difference():
    for low, high, exact, deletions in set_join.band_table(90, 3000):
        assert exact + 2 * deletions >= 2 * high * 10 // 190 + 1


def test_odd_rows(spark):
    found = sorted(map(str, set_join.jaccard_components(odd_documents(spark)).collect()))
    smallest = {6: 5}
    want = [(i, len(shingles(t, 3)), smallest.get(i, i)) for i, t in ODD]
    assert found == sorted(f"Row(doc_id={i}, n_shingles={n}, component_id={c})" for i, n, c in want)
    assert set_join.jaccard_components(no_documents(spark)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(n, n + 1) for n in range(100, 130)] + [(5, n) for n in range(6, 40)] + [(7, 7), (None, 1), (6, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()))
    assert found == {n: 100 for n in range(100, 131)} | {n: 5 for n in range(5, 40)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = queries.op9_ngram_jaccard_join(spark, folder).collect()
    assert sorted(map(tuple, found)) == plain_components(sorted(texts), 3, 90)


def test_unrelated_sets_share_nothing():
    """Segments that are empty in many sets bring no sets together."""
    rng = np.random.default_rng(5)
    for count in (5_000, 20_000):
        seen, shared = set(), 0
        for _ in range(count):
            own = set(set_join.signatures(np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64)), 90).tolist())
            shared += len(own & seen)
            seen |= own
        assert shared == 0


@pytest.mark.parametrize("similarity", [85, 90, 95])
def test_sets_that_agree_in_empty_segments_only_share_a_signature(similarity):
    rng = np.random.default_rng(6)
    for size in (3, 10, 11, 25, 60, 200):
        for _ in range(300):
            one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            changes = int(rng.integers(0, 2 * size * (100 - similarity) // (100 + similarity) // 2 + 1))
            other = np.unique(np.concatenate([one[changes:], rng.integers(0, 1 << 63, changes).astype(np.uint64)]))
            both = len(np.intersect1d(one, other))
            if 100 * both >= similarity * (len(one) + len(other) - both):
                x, y = (set_join.signatures(s, similarity) for s in (one, other))
                assert len(np.intersect1d(x, y)), (size, changes)


def test_repeated_rows_make_one_set(spark, monkeypatch):
    a = " ".join(f"w{n}" for n in range(100))
    b = a + " more"
    data = [(1, a)] * 60 + [(2, b)] * 60 + [(3, a + " else")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    seen = []
    stage = set_join.stage

    def counted(df, purpose):
        made = stage(df, purpose)
        if purpose == "sets":
            seen.append(made.count())
        return made

    monkeypatch.setattr(set_join, "stage", counted)
    found = set_join.jaccard_components(docs)
    assert {r.component_id for r in found.collect()} == {1} and found.count() == 121
    assert seen[0] == 3


@pytest.mark.parametrize("similarity", [60, 80, 90])
def test_sketches_leave_out_unlinked_sets_only(similarity):
    rng = np.random.default_rng(similarity)
    dropped = kept = 0
    for size in [*range(1, 40), 150, 400, 3000, 9000]:
        for _ in range(20):
            one = rng.integers(0, 1 << 62, size).astype(np.uint64)
            one[: size // 3] &= np.uint64(0xFFFF)  # some buckets are full
            one = np.unique(one)
            keep = rng.random(len(one)) > rng.choice([0, 0.05, 0.2, 0.9])
            added = rng.integers(0, 1 << 62, rng.integers(0, 1 + size // 3)).astype(np.uint64)
            two = np.unique(np.concatenate([one[keep], added]))
            x, y = (np.frombuffer(set_join.sketch(s), np.uint8) for s in (one, two))
            least = set_join.least_difference(x, y)
            both = len(np.intersect1d(one, two))
            assert least <= len(one) + len(two) - 2 * both
            linked = 100 * both >= similarity * (len(one) + len(two) - both)
            possible = least * (100 + similarity) <= (100 - similarity) * (len(one) + len(two))
            assert possible or not linked
            dropped, kept = dropped + (not possible), kept + (possible and not linked)
    assert dropped > kept


@pytest.mark.parametrize("width, similarity, seed", [(5, 80, 3), (2, 60, 4)])
def test_first_shingles_against_all_pairs(spark, width, similarity, seed):
    texts = near_texts(seed)
    found = set_join.jaccard_components(documents(spark, texts), width, similarity, by_first=True).collect()
    assert sorted(map(tuple, found)) == plain_components(list(enumerate(texts)), width, similarity)


def test_wide_bands_have_segments_of_both_kinds():
    table = set_join.band_table(80, 3000)
    for low, high, exact, deletions in table:
        assert exact + 2 * deletions >= 2 * high * 20 // 180 + 1
    assert any(exact for _, _, exact, _ in table) and any(deletions for _, _, _, deletions in table)


def doubled(rng, size, similarity):
    """Two sets that share all but the most that linked sets of about this size may lack."""
    one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    changes = int(rng.integers(0, 2 * size * (100 - similarity) // (100 + similarity) // 2 + 1))
    kept = one[rng.permutation(len(one))[changes:]]
    return one, np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, changes).astype(np.uint64)]))


def test_linked_sets_share_a_segment_whatever_is_common():
    rng = np.random.default_rng(8)
    pairs = [doubled(rng, size, 80) for size in (1, 2, 3, 5, 7, 9, 12, 16, 25, 60, 200, 900) for _ in range(150)]
    pairs += [(one, one[rng.random(len(one)) > 0.15]) for one, _ in pairs]
    known = np.unique(np.concatenate([set_join._wide_segments(one, 80) for one, _ in pairs[::3]]))
    common = known, rng.integers(3, 9, len(known))
    linked = 0
    for one, other in pairs:
        both = len(np.intersect1d(one, other))
        if both and 100 * both >= 80 * (len(one) + len(other) - both):
            x, y = (set_join.signatures(s, 80, common) for s in (one, other))
            assert len(np.intersect1d(x, y)), (len(one), len(other))
            linked += 1
    assert linked > 2000


def test_common_segments_bring_no_sets_together():
    """Long sets that have a sixth of their shingles in common, as from a frequent passage."""
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 63, 1000).astype(np.uint64)])) for _ in range(60)]
    known, seen = np.unique(np.concatenate([set_join._wide_segments(s, 80) for s in sets]), return_counts=True)
    common = known[seen >= set_join.COMMON], seen[seen >= set_join.COMMON]
    assert len(common[0])
    made = np.concatenate([set_join.signatures(s, 80, common) for s in sets])
    assert len(np.unique(made)) == len(made)
    # A set sends as many as it and a linked set may differ in and one more, in either band.
    assert len(made) <= len(sets) * 2 * (20 * (1200 + 1500) // 180 + 1)


def test_segments_of_documents_are_counted(spark):
    rare = [" ".join(f"r{n}w{i}" for i in range(40)) for n in range(6)]
    shared = " ".join(f"c{i}" for i in range(40))
    docs = documents(spark, [f"{own} {shared}" for own in rare])
    known, seen = set_join.common_shingles(docs, 5, 80)
    assert set_join.COMMON <= min(seen) and max(seen) == 6
    ((_, own),) = set_join.shingle_sets(docs.limit(1).toArrow()["text"].combine_chunks(), 5)
    assert np.isin(known[seen == 6], set_join._wide_segments(own, 80)).all()


def test_distinct_values_as_by_numpy():
    rng = np.random.default_rng(10)
    for size in (0, 1, 2, 50, 3000):
        values = rng.integers(0, 1 << 6, size).astype(np.uint64) << np.uint64(58)
        assert set_join._distinct(values).tolist() == np.unique(values).tolist()


def test_signatures_are_joined_without_sorting(spark, monkeypatch):
    plans = {}
    stage = set_join.stage

    def noted(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, purpose)

    monkeypatch.setattr(set_join, "stage", noted)
    set_join.jaccard_components(documents(spark, near_texts(3)[:40]), 5, 80, by_first=True)
    for purpose in ("signed", "members"):
        assert "ShuffledHashJoin" in plans[purpose] and "SortMergeJoin" not in plans[purpose]
