from __future__ import annotations

import numpy as np
import pytest

from clickloom.llm import queries, vector_search

SCHEMA = "vec_id bigint, embedding array<float>, label int, part string, rep string, block string"


def table(spark, vectors, first: int = 0):
    rows = [(first + n, None if v is None else [None if x is None else float(x) for x in v], 0, "", "", "")
            for n, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_nearest(vectors: dict[int, np.ndarray], every: int, neighbours: int):
    made = {}
    for q, v in vectors.items():
        if q % every:
            continue
        scores = [(-float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), i) for i, w in vectors.items() if i != q]
        made[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:neighbours]]
    return made


def found_by_query(df):
    made = {}
    for r in sorted(df.collect(), key=lambda r: r.rank):
        made.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return made


def test_copies_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = list(rng.normal(0, 1, (40, 4)).astype(np.float32))
    vectors += [vectors[10]] * 12 + [vectors[0]] * 3
    odd = [None, [], [0, 0, 0, 0], [1, None, 0, 0], [float("nan"), 1, 0, 0], [float("inf"), 1, 0, 0], [1, 2]]
    frame = table(spark, [*vectors, *odd]).unionAll(table(spark, vectors[:2]))
    want = plain_nearest({n: v.astype(float) for n, v in enumerate(vectors)}, 5, 5)
    found = found_by_query(vector_search.nearest(frame, every=5, recall=1.0))
    assert found.keys() == want.keys()
    for q, own in want.items():
        assert [i for i, _ in found[q]] == [i for i, _ in own]
        assert np.allclose([s for _, s in found[q]], [s for _, s in own], atol=1e-12)


def test_few_rows(spark):
    assert vector_search.nearest(table(spark, [])).count() == 0
    assert vector_search.nearest(table(spark, [None, [0.0]])).count() == 0
    assert vector_search.nearest(table(spark, [[1.0, 2.0]])).count() == 0
    rows = vector_search.nearest(table(spark, [[1.0, 2.0], [2.0, 1.0], [1.0, 2.0]])).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rows) == [(0, 1, 2), (0, 2, 1)]


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (12, 16))
    return np.concatenate([c + rng.normal(0, 0.25, (150, 16)) for c in centres])


def test_parts_are_balanced_and_learned(clustered):
    vectors = vector_search.unit(clustered)
    near = vector_search.neighbour_graph(vectors)
    part = vector_search.balanced_parts(near, vectors, 8)
    assert np.bincount(part, minlength=8).max() <= -(-len(vectors) * 21 // 160)
    assert (part[near] == part[:, None]).mean() > 0.6
    router = vector_search.fit_router(clustered, 8)
    # Probing 3 of 8 parts finds nearly all true neighbours.
    held = router.parts(vectors)[:, 0]
    probed = router.parts(vectors[:200], 3)
    assert np.mean([np.isin(held[near[n]], probed[n]).mean() for n in range(200)]) > 0.9


def test_recall(spark, clustered, monkeypatch):
    monkeypatch.setattr(vector_search, "PART_ROWS", 200)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 90)
    monkeypatch.setattr(vector_search, "BLOCK_QUERIES", 3)
    want = plain_nearest(dict(enumerate(clustered.astype(np.float32).astype(float))), 50, 5)
    found = found_by_query(vector_search.nearest(table(spark, clustered.astype(np.float32)), every=50))
    hits = sum(len({i for i, _ in own} & {i for i, _ in found[q]}) for q, own in want.items())
    assert hits / sum(map(len, want.values())) > 0.9


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = plain_nearest({r.vec_id: np.array(r.embedding) for r in rows}, 50, 5)
    found = found_by_query(queries.op8_learned_partitions(spark, folder))
    hits = sum(len({i for i, _ in own} & {i for i, _ in found[q]}) for q, own in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9
