from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from text_cases import ODD, documents, no_documents, odd_documents, words

from clickloom.llm import maxent_lm, queries


def check_base(rows, texts):
    """Counts and base scores by the formula, for (doc_id, text) rows."""
    tokens = [(i, [*words(t), "\n"]) for i, t in texts]
    counts = Counter(w for i, own in tokens if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in own)
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, own in tokens:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        want.append((str(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
    made = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(made) == sorted(want)


def test_odd_rows(spark):
    rows = maxent_lm.score_documents(odd_documents(spark)).collect()
    check_base(rows, ODD)
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert maxent_lm.score_documents(no_documents(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    held = next(n for n in range(100) if zlib.crc32(str(n).encode()) % 5 == 1)
    (row,) = maxent_lm.score_documents(documents(spark, ["a b"], first=held)).collect()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0


def test_packing_of_numbers():
    values = np.array([0, 1, 300, 70_000, 2**32 - 1], np.uint32)
    assert (maxent_lm.unpack(maxent_lm.pack(values), np.uint32) == values).all()
    for hashes in (np.zeros(0, np.uint64), np.array([0, 5, 2**63, 2**64 - 1], np.uint64)):
        assert (maxent_lm.unpack_sorted(maxent_lm.pack_sorted(hashes)) == hashes).all()


def test_contexts_stay_within_texts():
    hashes, classes, sizes = maxent_lm.token_stream(pa.array(["a b c", None, "b c"]))
    starts = np.cumsum(sizes) - sizes
    together = maxent_lm.contexts(hashes, classes, starts)
    for n, text in enumerate(["a b c", None, "b c"]):
        alone, kinds, size = maxent_lm.token_stream(pa.array([text], pa.string()))
        own = maxent_lm.contexts(alone, kinds, np.zeros(1, np.int64))
        assert (own == together[:, starts[n] : starts[n] + size[0]]).all()


def met_block(texts, held, shards=3):
    """One block of texts that has met its counts, and the totals by class."""
    block = maxent_lm._block([maxent_lm.token_stream(pa.array(texts))], list(range(len(texts))), held)
    names = [x.split()[0] for x in maxent_lm.BLOCKS.split(", ")]
    row = {**dict(zip(names, block)), "block": 0}
    (requests,) = maxent_lm._request_batches([pa.RecordBatch.from_pylist([row])], shards)
    own = [pa.Table.from_batches([requests.slice(n, 1)]) for n in range(requests.num_rows)]
    made = [r for part in own for r in maxent_lm._answer(part).to_pylist()]
    row["answers"] = [r for r in made if r["block"] >= 0]
    totals = [r for r in made if r["block"] < 0]
    return row, *(np.sum([r[n] for r in totals], axis=0) for n in ("class_tokens", "class_words"))


def class_of(word):
    return int(maxent_lm.token_stream(pa.array([word]))[1][0])


def test_token_chances_sum_to_one():
    """Over all words of the corpus, the end and one unknown word a class, after a known word."""
    learned = ["a b c d", "a b b", "a c", "b a b a", "d a c a b"]
    unknown, n = {}, 0
    while len(unknown) < maxent_lm.CLASSES - 1:
        unknown.setdefault(class_of(f"w{n}"), f"w{n}")
        n += 1
    probes = [f"a {w}" for w in ("a", "b", "c", "d", *unknown.values())]
    row, class_tokens, class_words = met_block([*learned, *probes], [False] * len(learned) + [True] * len(probes))
    weights = np.random.default_rng(1).normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)).astype(np.float32)
    made = maxent_lm.token_chances(row, weights, class_tokens, class_words)
    trust = np.full(maxent_lm.LEVELS, 0.4)
    chance = 10 ** maxent_lm.log_chances(made["model"], made["pair"], made["level"], trust)
    starts = np.cumsum(row["n_tokens"]) - row["n_tokens"]
    after_a = chance[starts[len(learned) :] + 1]
    # The end after "a": only its pair and its class part depend on the text's context.
    ending = [*learned, "a"]
    row, class_tokens, class_words = met_block(ending, [False] * len(learned) + [True])
    made = maxent_lm.token_chances(row, weights, class_tokens, class_words)
    end = 10 ** maxent_lm.log_chances(made["model"], made["pair"], made["level"], trust)[-1]
    # The class of the end has an unknown word's share, too, that no word takes.
    unmet = 0.6 * np.exp(made["model"][-1]) * 0.5 / (len(learned) + 0.5)
    assert math.isclose(after_a.sum() + end + unmet, 1, rel_tol=1e-5)


def plain_scores(texts):
    """Scores by definition with a class model of zero weights, for {doc_id: text}."""
    tokens = {i: [*words(t), "\n"] for i, t in texts.items()}
    learned = {i: own for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1}
    counts = Counter(w for own in learned.values() for w in own)
    pairs = Counter(p for own in learned.values() for p in zip(["\n", *own], own))
    kinds = {w: class_of(w) if w != "\n" else 0 for own in tokens.values() for w in own}
    mass = Counter()
    for w, c in counts.items():
        mass[kinds[w]] += c + 0.5

    def model(w):
        return (counts[w] + 0.5) / (mass[kinds[w]] + 0.5) / maxent_lm.CLASSES

    ratios = {}
    for own in learned.values():
        for v, w in zip(["\n", *own], own):
            pair = (pairs[v, w] - 1) / (counts[v] - 1) if counts[v] > 1 else 0
            ratio = 2 ** (round(2 * math.log2(pair / model(w))) / 2) if pair else 0
            ratios.setdefault((counts[v] - 1).bit_length(), [0]).append(ratio)
    shares, best = {0: 0}, 0
    for level in range(1, max(ratios, default=0) + 3):
        if level in ratios:
            grid = [n / 20_000 for n in range(20_000)]
            best = max(grid, key=lambda g: sum(math.log(1 - g + g * r) for r in ratios[level]))
        shares[level] = best
    found = {}
    for i, own in tokens.items():
        found[i] = 0
        for v, w in zip(["\n", *own], own):
            g = shares[counts[v].bit_length()]
            found[i] += math.log10((1 - g) * model(w) + (g * pairs[v, w] / counts[v] if g else 0))
    return found


def test_scores_by_definition(spark):
    rng = np.random.default_rng(3)
    made = {n: " ".join(rng.choice(list("abcdefgh") + ["ab", "cd"], rng.integers(0, 30))) for n in range(40)}
    made |= {50: "a b c d e f g h", 51: "a b c d e f g h", 52: "", 53: "never met"}
    rows = maxent_lm.score_documents(
        spark.createDataFrame(list(made.items()), "doc_id bigint, text string").repartition(3), rounds=0
    ).collect()
    want = plain_scores(made)
    assert len(rows) == len(want)
    for row in rows:
        assert math.isclose(row.score, want[row.doc_id], rel_tol=1e-3), row


def test_pairs_tell_words_of_a_class_apart(spark):
    """Words with equal endings are of one class; only pairs know which of them follows."""
    learned = ["red cat", "blue rat"] * 40
    spots = [n for n in range(400) if zlib.crc32(str(n).encode()) % 5 != 1][: len(learned)]
    held = [n for n in range(400) if zlib.crc32(str(n).encode()) % 5 == 1][:2]
    texts = list(zip(spots, learned)) + list(zip(held, ["red cat", "red rat"]))
    rows = maxent_lm.score_documents(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    score = {r.doc_id: r.score for r in rows}
    assert class_of("cat") == class_of("rat") and score[held[0]] > score[held[1]] + 1


def test_model_beats_base_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op10_maxent_lm(spark, folder).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_base(rows, texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert np.mean([r.score > r.base_score for r in held]) > 0.8
