from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from text_cases import LOWER, no_documents, odd_documents

from clickloom.llm import lexical_search, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranks(documents, items, top=10):
    """Ranks from the definition; documents and items are (id, text)."""
    counts = [(i, Counter(terms(t))) for i, t in documents]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    common = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for doc, c in counts:
            n = sum(c.values())
            m = 100 - 75 + (75 * n * total) // length
            score = sum(
                k
                * math.floor(1000 * math.log((2 * total + 2) / (2 * common[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, k in asked.items()
                if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=str)


def ranks(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_case(seed, documents=600, items=40):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(300)] + ["Äther", "Öl9", "42", "THE", "the", "中文"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]

    def text(longest):
        size = rng.randint(0, longest)
        return "".join(w + rng.choice([" ", ", ", ".\n", "_"]) for w in rng.choices(vocabulary, weights, k=size))

    found = [(n, text(60)) for n in range(documents)]
    found += [(1000 + n, found[n % 7][1]) for n in range(80)]  # copies
    found += [(3, found[3][1]), (None, found[5][1]), (None, None), (2000, ""), (2001, "-.- \n")]
    rng.shuffle(found)
    asked = [(n, text(30)) for n in range(items)]
    return found, asked + [asked[0], (7, "w1 w1 other"), (None, "w2"), (90, None), (91, ""), (92, "nowhere")]


def searched(spark, documents, items, **more):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(3)
    return ranks(lexical_search.rank_documents(docs, spark.createDataFrame(items, ITEMS), **more))


def test_against_definition(spark):
    documents, items = random_case(1)
    assert searched(spark, documents, items) == plain_ranks(documents, items)
    assert searched(spark, documents, items[:5], top=3) == plain_ranks(documents, items[:5], 3)


def test_several_sets_groups_and_blocks(spark, monkeypatch):
    documents, items = random_case(2)
    want = plain_ranks(documents, items)
    monkeypatch.setattr(lexical_search, "PAIRS", 150)
    assert searched(spark, documents, items) == want
    monkeypatch.setattr(lexical_search, "PAIRS", 250_000)
    # The search itself, with small trees, in this process.
    for cells, block, exact in ((400, 100, 1 << 53), (1 << 22, 64, 0)):
        monkeypatch.setattr(lexical_search, "CELLS", cells)
        monkeypatch.setattr(lexical_search, "EXACT", exact)
        rows = [(i, t) for i, t in items if terms(t)]
        found, _ = search_here(documents, rows, block)
        assert found == [r for r in want]


def search_here(documents, items, block, top=10):
    """Search without Spark; also the number of scores computed."""
    _, owner, hashes, repeats = lexical_search.counted(pa.array([t for _, t in items]))
    known, term = np.unique(hashes, return_inverse=True)
    total, doc, at, tf = lexical_search.counted(pa.array([t for _, t in documents], pa.string()), known)
    common = np.bincount(at.astype(np.int64), minlength=len(known))
    filled = int((total > 0).sum())
    single = np.array([math.floor(1000 * math.log((2 * filled + 2) / (2 * c + 1))) for c in common.tolist()])
    sizes = np.bincount(owner, minlength=len(items))
    packed = lexical_search.Items(
        np.concatenate([[0], np.cumsum(sizes)]), term, repeats * single[term], common, single,
        filled, int(total.sum()), np.ones(len(items), np.int64),
    )
    batches = [
        pa.RecordBatch.from_arrays(
            [
                pa.array([documents[n][0] for n in rows], pa.int64()),
                pa.array(total[rows]),
                pa.array([at[doc == n].tolist() for n in rows], pa.list_(pa.int32())),
                pa.array([tf[doc == n].tolist() for n in rows], pa.list_(pa.int32())),
            ],
            names=["doc_id", "n_terms", "terms", "counts"],
        )
        for rows in np.array_split(np.arange(len(documents)), max(1, len(documents) // block))
    ]
    scored = []
    add = lexical_search.Best.add

    class Counted(lexical_search.Best):
        def add(self, items, scores, *rest):
            scored.append(scores.size)
            add(self, items, scores, *rest)

    class Sent:
        value = packed

    before, lexical_search.Best = lexical_search.Best, Counted
    try:
        (made,) = lexical_search._search_batches(iter(batches), Sent, top)
    finally:
        lexical_search.Best = before
    found, rank = [], Counter()
    for row in made.to_pylist():
        item = items[row["item_number"]][0], row["item_number"]
        rank[item] += 1
        found.append((item[0], rank[item], row["doc_id"], row["score"]))
    return sorted(found, key=str), sum(scored)


def test_bounds_leave_most_pairs_out():
    rng = random.Random(3)
    topics = [[f"t{k}x{n}" for n in range(40)] for k in range(50)]
    documents = [(n, " ".join(rng.choices(topics[rng.randrange(50)], k=40))) for n in range(4000)]
    items = [(n, " ".join(rng.choices(topics[n], k=10))) for n in range(50)]
    found, scored = search_here(documents, items, 4000)
    assert found == plain_ranks(documents, items)
    assert scored < 0.1 * len(documents) * len(items)


def test_long_texts_in_parts():
    text = "Ab c9-é_x " * 3000 + "z" * 5000 + " end"
    want = Counter(terms(text))
    whole = lexical_search.counted(pa.array([text]))
    parts = list(lexical_search.terms_of(pa.array([text]), 1000))
    assert len(parts) > 10
    total = sum(int(p.count.sum()) for p in parts)
    assert total == whole[0][0] == sum(want.values())
    assert Counter(np.concatenate([p.hash for p in parts]).tolist()) == dict(zip(whole[2].tolist(), whole[3].tolist()))


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "plain texts and word7", "x", 3)], f"{ITEMS}, item string, rank int")
    docs = odd_documents(spark)
    want = plain_ranks([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(1, "plain texts and word7")])
    assert ranks(lexical_search.rank_documents(docs, items)) == want
    assert lexical_search.rank_documents(no_documents(spark), items).count() == 0
    assert lexical_search.rank_documents(docs, items.limit(0)).count() == 0


def test_query_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    found = queries.op11_dual_tree_search(spark, folder)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    want = con.execute(queries.oracle_sql()["op11_dual_tree_search"]).fetchall()
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert [kind for _, kind in found.dtypes] == ["bigint", "int", "bigint", "bigint"]
    assert ranks(found) == sorted(want, key=str)
