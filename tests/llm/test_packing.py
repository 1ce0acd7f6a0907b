from __future__ import annotations

import random
from collections import Counter, defaultdict

from text_cases import ODD, documents, no_documents, odd_documents, words

from clickloom.llm import packing, set_join


def plain_best_fit(items, capacity):
    bins, placed = [], []
    for size, source, cluster in items:
        fit = [(room, n) for n, (room, s, c) in enumerate(bins) if room >= size and not s & source and not c & cluster]
        number = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append((capacity, 0, 0))
        room, s, c = bins[number]
        bins[number] = room - size, s | source, c | cluster
        placed.append(number)
    return placed


def test_against_plain_best_fit():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([8, 30])
        items = [
            (rng.randint(1, capacity), rng.choice([0, 1, 2, 4]), rng.choice([0, 0, 1, 2, 4, 8])) for _ in range(60)
        ]
        items.sort(key=lambda item: -item[0])
        bins = packing.Bins(capacity)
        assert [bins.add(*item) for item in items] == plain_best_fit(items, capacity)


def check_packs(rows, sizes, capacity, clusters):
    """Packs are full runs without conflicts, and every token of every text is in one."""
    packs, seen = defaultdict(list), Counter()
    for r in rows:
        packs[r.pack_id].append(r)
        seen[r.doc_id] += r.n_tokens
    assert seen == sizes
    for own in packs.values():
        own.sort(key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(o.n_tokens for o in own[:n]) for n in range(len(own))]
        assert sum(r.n_tokens for r in own) <= capacity
        named = [r.source for r in own if r.source is not None]
        assert len(named) == len(set(named))
        copies = [clusters[r.doc_id] for r in own if clusters[r.doc_id]]
        assert len(copies) == len(set(copies))


def test_packs(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 70))) for _ in range(300)]
    texts += ["same text"] * 40
    rows = packing.pack_documents(documents(spark, texts), capacity=32, shard_rows=100).collect()
    sizes = Counter({n: len(words(t)) + 1 for n, t in enumerate(texts)})
    check_packs(rows, sizes, 32, {n: tuple(words(t)) for n, t in enumerate(texts)})
    assert all(r.first_token == 32 * r.chunk for r in rows)
    assert packing.pack_documents(documents(spark, texts), cluster="lang").count() == 340


def test_odd_rows(spark):
    rows = packing.pack_documents(odd_documents(spark)).collect()
    sizes = Counter()
    for i, t in ODD:
        sizes[i] += len(words(t)) + 1
    seen = Counter()
    for r in rows:
        seen[r.doc_id] += r.n_tokens
    assert seen == sizes
    assert packing.pack_documents(no_documents(spark)).count() == 0


def test_near_copies_are_a_cluster(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(200)}" for _ in range(60)]
    texts = [" ".join(base[:n] + ["other"] + base[n + 1 :]) for n in (0, 1, 58, 59)] * 6 + ["", None, "", "short"]
    texts += [" ".join(f"v{rng.randrange(200)}" for _ in range(30)) for _ in range(40)]
    docs = documents(spark, texts)
    rows = packing.pack_documents(docs, capacity=400, near=(5, 80)).collect()
    sizes = Counter({n: len(words(t)) + 1 for n, t in enumerate(texts)})
    component = {r.doc_id: r.component_id for r in set_join.jaccard_components(docs, 5, 80).collect()}
    assert len({component[n] for n in range(24)}) == 1
    check_packs(rows, sizes, 400, {n: (component[n],) if words(t) else () for n, t in enumerate(texts)})
    seen, expected = Counter(), Counter()
    for r in packing.pack_documents(odd_documents(spark), near=(5, 80)).collect():
        seen[r.doc_id] += r.n_tokens
    for i, t in ODD:
        expected[i] += len(words(t)) + 1
    assert seen == expected
    assert packing.pack_documents(no_documents(spark), near=(5, 80)).count() == 0
