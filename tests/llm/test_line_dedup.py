from __future__ import annotations

import os
from collections import defaultdict

import numpy as np
import pytest
from oracle_check import compare, connect
from text_cases import LOWER, documents, no_documents, odd_documents

from clickloom.llm import line_dedup, queries

DATA = "/root/testdata/sf0.001"


def plain_dedup(rows):
    holders, owner = defaultdict(int), {}
    keyed = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\n\v\f\r").translate(LOWER) for line in lines]
        keyed.append((i, lines, keys))
        for key in set(keys):
            holders[key] += 1
            owner[key] = max(owner.get(key, i), i)
    made = []
    for i, lines, keys in keyed:
        kept = [l for l, k in zip(lines, keys) if not (len(k) >= 40 and holders[k] >= 5 and owner[k] != i)]
        made.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(made)


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5, 5000):
        keys = rng.integers(0, 1 << 63, (2, size)).astype(np.uint64)
        hashed = line_dedup.MinimalPerfectHash.build(*keys)
        assert sorted(hashed.slots(*keys)) == list(range(size))
        other = rng.integers(0, 1 << 63, (2, 50)).astype(np.uint64)
        assert (hashed.slots(*other) < max(size, 1)).all()


def test_against_definition(spark):
    shared = "This line stands in many documents, é counts once"
    texts = [f"own {n}\n {shared.upper() if n % 2 else shared}\t\n{'x' * 39}\n\n{shared}" for n in range(7)]
    texts += ["y" * 40] * 4 + ["z" * 40 + "\r"] * 5 + ["é" * 20] * 6
    found = line_dedup.dedup_lines(documents(spark, texts)).collect()
    made = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found)
    assert made == plain_dedup(list(enumerate(texts)))
    assert sum(r.n_dropped for r in found) == 9 + 4 and found[0].source is not None


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted(map(str, found.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert line_dedup.dedup_lines(no_documents(spark)).count() == 0


def test_null_and_repeated_ids(spark):
    line = "a line of more than forty characters in all of them"
    for ids, dropped in (
        ([9, 9, 9, 9, 2], []),  # two documents
        ([1, 1, 2, 2, 3, 3, 4, 4, None, None], []),  # four, and rows that are none
        ([5, 5, 4, 3, 2, 1, None], [1, 2, 3, 4]),
        ([5] * 30 + [4, 3, 2, 1], [1, 2, 3, 4]),
    ):
        docs = spark.createDataFrame([(i, line) for i in ids], "doc_id bigint, text string").repartition(3)
        found = line_dedup.dedup_lines(docs).collect()
        assert sorted(r.doc_id for r in found if r.n_dropped) == dropped, ids


def test_repeated_rows_in_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 50, (2, 4000)).astype(np.uint64)
    ids = rng.integers(0, 12, 4000)
    whole = line_dedup.combine(*keys, ids, 5)
    parts = [line_dedup.combine(*keys[:, c], ids[c], 5) for c in np.array_split(np.arange(4000), 9)]
    joined = line_dedup.combine(
        *np.concatenate([np.repeat(p[0], p[2], axis=1) for p in parts], axis=1), np.concatenate([p[3] for p in parts]), 5
    )
    assert all((a == b).all() for a, b in zip((whole[0], whole[2], whole[3]), (joined[0], joined[2], joined[3])))


def test_repeated_ids_against_sql(spark, tmp_path):
    rng = np.random.default_rng(5)
    lines = [f"line number {n} that is longer than forty characters" for n in range(30)]
    data = [
        (int(rng.integers(0, 40)) if rng.random() > 0.1 else None, "\n".join(rng.choice(lines, 4)) + f"\nown {n}")
        for n in range(200)
    ]
    # One row of each id and text: the SQL gives one row a document.
    data = [(i, t) for n, (i, t) in enumerate(data) if i is not None and i not in [j for j, _ in data[:n]]]
    data += [(i, t) for i, t in data[:10]]
    spark.createDataFrame(data, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select distinct * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.oracle_sql()["op3_line_dedup"]).fetchall()
    found = queries.op3_line_dedup(spark, str(tmp_path)).distinct().collect()
    assert sorted(map(tuple, found)) == sorted(want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_query_against_sql(spark):
    sql = queries.oracle_sql()["op3_line_dedup"]
    rows, problem = compare(spark, connect(DATA), queries.op3_line_dedup, sql, DATA)
    assert rows and not problem
