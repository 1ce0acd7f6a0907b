"""Hashed maximum-entropy language model with class-factored softmax.

The chance of a token is that of its class in its context, times that of the token in
its class, and a feature for each pair of neighbouring words that the corpus holds.

* The class part is a maximum-entropy model over hashed features: the word before, the
  two words before and the classes of three words before (n-grams), the second word
  before and the classes of the second and third (skips), each a row of a weight table
  of fixed size. A word's class follows from its ending, so it needs no table.
* Without the pair, a token has its corpus share in its class. A pair (v, w) that occurs
  n(v, w) times has the weight log(1 + g n(v, w) / ((1 - g) n(v) m(w))), where m(w) is
  the chance by class and share. Then the softmax over all words of all classes has
  1 / (1 - g) as its sum, so the chance is (1 - g) m(w) + g n(v, w) / n(v): no sum over
  the vocabulary is made. Pairs are as many as the corpus has.
* How far pairs of v are trusted, g, depends on n(v) by powers of two. It is the best for
  all training tokens, each of which is left out of the counts that foretell it.

Texts are cut into blocks of about ``BLOCK_BYTES``. A block is written once: its sorted
distinct token hashes, and its texts as positions in that list. Everything else reads
blocks, so texts are split only once:

* Counts. A block sends its hashes, with their training counts, to shards by hash range.
  A shard adds up over all blocks and answers each block with the corpus counts of its
  hashes. A word or pair costs one entry per block, however often it occurs there.
* Training. Tasks start a round from the same weights, take AdaGrad steps over their
  blocks, and return the change of each touched row. Spark adds the changes, weighted by
  how often a row was used, and the next round starts from the mean.
* Scoring. Blocks meet their counts; the chances of each token by the class model and by
  pairs are written, with sums from which the trust in pairs is found, then added up.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold, mix, rows_of, sliced, words_of
from clickloom.sources.shared import discard, stage

BLOCK_BYTES = 4 << 20
SHARD_ENTRIES = 1 << 20
CLASSES = 16
BUCKETS = 1 << 14
ROUNDS = 2
RATE = 0.2
# Added to the sum of squared gradients: rows that are used rarely move little.
DAMPING = 400.0
STEP_TOKENS = 1 << 16

END = np.uint64(0x2545F4914F6CDD1D)
PAIR = np.uint64(0xD6E8FEB86659FD93)

# Trust in pairs: a level for each power of two of the first word's count. Tokens are
# summed by half powers of two of how much more likely the pair makes them; 0 is "no pair".
LEVELS = 64
RATIOS = 130
RATIO_ONE = 41
HALVINGS = 50

# Blocks meet their counts in so many portions, one after the other, each of which frees
# its shuffle: less disk at once.
PORTIONS = 2

BLOCKS = (
    "doc_id array<bigint>, held_out array<boolean>, n_tokens array<int>, entries bigint, "
    "vocabulary binary, classes binary, counts binary, tokens binary"
)
ANSWERS = (
    "block bigint, shard int, words int, known binary, class_tokens array<bigint>, class_words array<bigint>"
)
CHANCES = (
    "doc_id array<bigint>, held_out array<boolean>, n_tokens array<int>, n_known array<bigint>, "
    "base_score array<double>, model binary, pair binary, level binary, tally binary"
)
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def pack(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(blob: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their distances, whose leading bytes are mostly 0."""
    return pack(np.diff(hashes, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64))


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, tokens per text): the words of each text, then one end."""
    words = words_of(texts)
    size = len(words.hash) + len(words.count)
    hashes, classes = np.full(size, END), np.zeros(size, np.uint8)
    at = np.arange(len(words.hash)) + words.doc
    hashes[at] = words.hash
    last = words.data[words.end - 1].astype(np.uint64)
    long = words.end - words.start > 1
    before = np.where(long, words.data[np.maximum(words.end - 2, 0)], 0).astype(np.uint64)
    classes[at] = 1 + mix(last * np.uint64(256) + before) % np.uint64(CLASSES - 1)
    return hashes, classes, words.count + 1


def _block(parts: list, ids: list, held: list) -> list:
    hashes, classes, sizes = (np.concatenate(x) for x in zip(*parts))
    vocabulary, first, tokens = np.unique(hashes, return_index=True, return_inverse=True)
    learn = np.repeat(~np.array(held, bool), sizes)
    counts = np.bincount(tokens[learn], minlength=len(vocabulary))
    return [
        ids,
        held,
        sizes.tolist(),
        len(vocabulary) + len(tokens),  # pairs are as many as tokens at most
        pack_sorted(vocabulary),
        pack(classes[first]),
        pack(counts.astype(np.uint32)),
        pack(tokens.astype(np.uint32)),
    ]


def _block_batches(batches):
    schema = pa.schema(
        [
            ("doc_id", pa.list_(pa.int64())),
            ("held_out", pa.list_(pa.bool_())),
            ("n_tokens", pa.list_(pa.int32())),
            ("entries", pa.int64()),
            *[(name, pa.binary()) for name in ("vocabulary", "classes", "counts", "tokens")],
        ]
    )

    def one(parts, ids, held):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(_block(parts, ids, held), schema)], schema=schema
        )

    parts, ids, held, size = [], [], [], 0
    for batch in batches:
        for part in sliced(batch, "text"):
            parts.append(token_stream(part.column("text")))
            ids += part.column("doc_id").to_pylist()
            held += part.column("held_out").to_pylist()
            size += part.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield one(parts, ids, held)
                parts, ids, held, size = [], [], [], 0
    if parts:
        yield one(parts, ids, held)


def pairs_of(vocabulary: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Hash of each token of a block with the token before it, an end before a text."""
    words = vocabulary[tokens]
    return mix(mix(np.roll(words, 1) ^ PAIR) ^ words)  # a block's last token is an end


def _shard_edges(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where the hashes of each shard begin in sorted hashes."""
    shard = (hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1))


def _request_batches(batches, shards: int):
    """One row for each shard that holds hashes of the block: its words, then its pairs."""
    for batch in batches:
        for row in rows_of(batch):
            vocabulary = unpack_sorted(row["vocabulary"])
            counts, classes = unpack(row["counts"], np.uint32), unpack(row["classes"], np.uint8)
            tokens = unpack(row["tokens"], np.uint32)
            learn = np.repeat(~np.array(row["held_out"], bool), row["n_tokens"])
            pairs, where = np.unique(pairs_of(vocabulary, tokens), return_inverse=True)
            pair_counts = np.bincount(where[learn], minlength=len(pairs)).astype(np.uint32)
            word_edges, pair_edges = _shard_edges(vocabulary, shards), _shard_edges(pairs, shards)
            filled = np.flatnonzero(np.diff(word_edges) + np.diff(pair_edges))
            own_words = [slice(word_edges[s], word_edges[s + 1]) for s in filled]
            own_pairs = [slice(pair_edges[s], pair_edges[s + 1]) for s in filled]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(filled), row["block"])),
                    pa.array(filled, pa.int32()),
                    pa.array([vocabulary[c].tobytes() for c in own_words], pa.binary()),
                    pa.array([counts[c].tobytes() for c in own_words], pa.binary()),
                    pa.array([classes[c].tobytes() for c in own_words], pa.binary()),
                    pa.array([pairs[c].tobytes() for c in own_pairs], pa.binary()),
                    pa.array([pair_counts[c].tobytes() for c in own_pairs], pa.binary()),
                ],
                names=["block", "shard", "vocabulary", "counts", "classes", "pairs", "pair_counts"],
            )


def _numbers(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All numbers in a column of blobs, in the order of its rows."""
    parts = [np.zeros(0, dtype)]
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset :][: len(chunk) + 1]
        if offsets[-1] > offsets[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(dtype))
    return np.concatenate(parts)


def _totals(requests: pa.Table, hashes: str, counts: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of the counts of each different hash, a place where it is met, and its sum at all places."""
    given, every = _numbers(requests[counts], np.uint32), _numbers(requests[hashes], np.uint64)
    order = np.argsort(every)
    every = every[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    del every
    total = np.add.reduceat(given[order], np.flatnonzero(new), dtype=np.int64)
    known = np.empty(len(order), np.int64)
    known[order] = np.repeat(total, np.diff(np.flatnonzero(np.append(new, True))))
    return total, order[new], known


def _answer(requests: pa.Table) -> pa.Table:
    """Corpus counts for the requests of one shard, and the shard's totals by class."""
    total, first, words = _totals(requests, "vocabulary", "counts")
    kind = _numbers(requests["classes"], np.uint8)[first]
    class_tokens = np.zeros(CLASSES, np.int64)
    np.add.at(class_tokens, kind, total)
    class_words = np.bincount(kind[total > 0], minlength=CLASSES)
    pairs = _totals(requests, "pairs", "pair_counts")[2]
    n_words, n_pairs = (
        pc.binary_length(requests[name]).to_numpy().astype(np.int64) // 8 for name in ("vocabulary", "pairs")
    )
    parts = zip(np.split(words, np.cumsum(n_words)[:-1]), np.split(pairs, np.cumsum(n_pairs)[:-1]))
    rows, shard = len(n_words), requests["shard"][0].as_py()
    return pa.table(
        {
            "block": pa.array([*requests["block"].to_pylist(), -1], pa.int64()),
            "shard": pa.array([shard] * (rows + 1), pa.int32()),
            "words": pa.array([*n_words.tolist(), 0], pa.int32()),
            "known": pa.array([*(pack(np.concatenate(own)) for own in parts), b""], pa.binary()),
            "class_tokens": pa.array([None] * rows + [class_tokens.tolist()], pa.list_(pa.int64())),
            "class_words": pa.array([None] * rows + [class_words.tolist()], pa.list_(pa.int64())),
        }
    )


def contexts(tokens: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Feature buckets of every token (one row a feature); texts begin at ``starts``.

    Bucket 0 is left to the bias, which every token has.
    """
    past_tokens, past_classes = [], []
    for distance in (1, 2, 3):
        token, kind = np.full(len(tokens), END), np.zeros(len(tokens), np.uint64)
        token[distance:], kind[distance:] = tokens[:-distance], classes[:-distance]
        for offset in range(distance):  # before the text there are only ends
            at = starts + offset
            at = at[at < len(tokens)]
            token[at], kind[at] = END, 0
        past_tokens.append(token)
        past_classes.append(kind)
    (one, two, _), (first, second, third) = past_tokens, past_classes
    made = (
        one,
        two,
        mix(one) ^ two,
        (first * np.uint64(CLASSES) + second) * np.uint64(CLASSES) + third,
        second * np.uint64(CLASSES) + third,
    )
    rows = []
    for salt, value in zip(mix(np.arange(1, len(made) + 1, dtype=np.uint64)), made):
        rows.append((1 + mix(value ^ salt) % np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.stack(rows)


def class_logits(weights: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Logits by class and token: a row for each class, so that sums over classes are fast."""
    logits = weights[buckets[0]]
    for row in buckets[1:]:
        logits += weights[row]
    logits += weights[0]
    return np.ascontiguousarray(logits.T)


def _steps(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, class, text number) of the block's tokens, some texts at a time."""
    vocabulary = unpack_sorted(row["vocabulary"])
    classes = unpack(row["classes"], np.uint8)
    tokens = unpack(row["tokens"], np.uint32)
    sizes = np.array(row["n_tokens"], np.int64)
    ends = np.cumsum(sizes)
    part = ends // STEP_TOKENS
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    for a, b in zip(edges[:-1], edges[1:]):
        low, high = (ends[a] - sizes[a]), ends[b - 1]
        own = tokens[low:high]
        starts = ends[a:b] - sizes[a:b] - low
        yield contexts(vocabulary[own], classes[own], starts), classes[own], np.repeat(np.arange(a, b), sizes[a:b])


def _update(table: np.ndarray, squares: np.ndarray, gradient: np.ndarray) -> None:
    """An AdaGrad step; rows without a gradient stay as they are."""
    squares += gradient * gradient
    table -= RATE * gradient / np.sqrt(squares)


def _train_batches(batches, weights):
    """AdaGrad over the training texts of the blocks; change of each row that was used."""
    start = weights.value
    table, used = start.copy(), np.zeros(BUCKETS, np.int64)
    squares = np.full((BUCKETS, CLASSES), DAMPING, np.float32)
    for batch in batches:
        for row in rows_of(batch):
            held = np.array(row["held_out"], bool)
            for buckets, kind, text in _steps(row):
                learn = ~held[text]
                buckets, kind = buckets[:, learn], kind[learn]
                if not len(kind):
                    continue
                error = class_logits(table, buckets)
                error -= error.max(axis=0)
                np.exp(error, out=error)
                error /= error.sum(axis=0)
                error[kind, np.arange(len(kind))] -= 1
                error = error.astype(np.float64)
                gradient = np.zeros((BUCKETS, CLASSES), np.float32)
                for feature in buckets:
                    for c in range(CLASSES):
                        gradient[:, c] = np.bincount(feature, weights=error[c], minlength=BUCKETS)
                    _update(table, squares, gradient)
                    used += np.bincount(feature, minlength=BUCKETS)
                _update(table[:1], squares[:1], error.sum(axis=1, dtype=np.float32)[None])
                used[0] += len(kind)
    rows = np.flatnonzero(used)
    change = (table[rows] - start[rows]).astype(np.float64) * used[rows, None]
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int32()), pa.array(used[rows]), *[pa.array(change[:, c]) for c in range(CLASSES)]],
        names=["bucket", "used", *[f"c{c}" for c in range(CLASSES)]],
    )


def train(blocks: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weight table (buckets, classes) after some rounds over all training texts."""
    names = [f"c{c}" for c in range(CLASSES)]
    schema = "bucket int, used bigint, " + ", ".join(f"{n} double" for n in names)
    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    data = blocks.select("held_out", "n_tokens", "vocabulary", "classes", "tokens")
    context = blocks.sparkSession.sparkContext
    for _ in range(rounds):
        sent = context.broadcast(weights)
        steps = data.mapInArrow(functools.partial(_train_batches, weights=sent), schema)
        mean = steps.groupBy("bucket").agg(*[(F.sum(n) / F.sum("used")).alias(n) for n in names])
        change = mean.toPandas()  # a row a bucket at most
        weights = weights.copy()
        weights[change["bucket"]] += change[names].to_numpy(np.float32)
        sent.unpersist()
    return weights


def levels(counts: np.ndarray) -> np.ndarray:
    """Level of trust for words that occur so often: 0 for none, then one more for each doubling."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], LEVELS - 1)


def ratio_bins(pair: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Bin of how much more likely pairs make tokens than the model (natural log) does."""
    bins = np.zeros(len(pair), np.int64)
    met = pair > 0
    ratio = np.log2(pair[met]) - model[met] / np.log(2)
    bins[met] = np.clip(np.rint(2 * ratio) + RATIO_ONE, 1, RATIOS - 1)
    return bins


def best_trust(tally: np.ndarray) -> np.ndarray:
    """Share g of pairs by level that gives the tokens of a tally (level, bin) the highest chance.

    The chance is concave in g, so its slope is halved in on. Each level counts one token more
    that no pair foretells, so g stays below 1. A level without tokens has the share of the one
    below it; after a word that does not occur (level 0) there are no pairs.
    """
    ratio = 2.0 ** ((np.arange(RATIOS) - RATIO_ONE) / 2)
    ratio[0] = 0
    seen = tally.sum(axis=1)
    weighed = tally.astype(np.float64)
    weighed[:, 0] += 1
    low, high = np.zeros(LEVELS), np.ones(LEVELS)
    for _ in range(HALVINGS):
        share = (low + high) / 2
        slope = (weighed * (ratio - 1) / (1 - share[:, None] + share[:, None] * ratio)).sum(axis=1)
        low, high = np.where(slope > 0, share, low), np.where(slope > 0, high, share)
    low[0] = 0
    for level in range(1, LEVELS):
        if not seen[level]:
            low[level] = low[level - 1]
    return low


def token_chances(row: dict, weights: np.ndarray, class_tokens: np.ndarray, class_words: np.ndarray) -> dict:
    """A block's tokens by the class model (natural log), by pairs, and their levels of trust.

    The tally counts training tokens by level and ratio, each left out of the counts.
    """
    answers = sorted(row["answers"], key=lambda a: a["shard"])
    counts = [unpack(a["known"], np.int64) for a in answers]
    known = np.concatenate([c[: a["words"]] for a, c in zip(answers, counts)])
    pair_counts = np.concatenate([c[a["words"] :] for a, c in zip(answers, counts)])
    vocabulary, classes = unpack_sorted(row["vocabulary"]), unpack(row["classes"], np.uint8)
    tokens = unpack(row["tokens"], np.uint32)
    sizes = np.array(row["n_tokens"], np.int64)
    first = np.cumsum(sizes) - sizes

    log_count = np.log10(known + 0.5)
    by_class = np.log10(class_tokens + 0.5 * (class_words + 1))
    in_class = (log_count - by_class[classes]) * np.log(10)
    model, at = in_class[tokens], 0
    for buckets, kind, _ in _steps(row):
        logits = class_logits(weights, buckets)
        own = logits[kind, np.arange(len(kind))]
        top = logits.max(axis=0)
        model[at : at + len(kind)] += own - np.log(np.exp(logits - top).sum(axis=0)) - top
        at += len(kind)

    met = pair_counts[np.unique(pairs_of(vocabulary, tokens), return_inverse=True)[1]]
    before = known[np.roll(tokens, 1)]
    learn = np.repeat(~np.array(row["held_out"], bool), sizes)
    others, others_before = met[learn] - 1, before[learn] - 1
    bins = ratio_bins(others / np.maximum(others_before, 1), model[learn])
    total, words = int(class_tokens.sum()), int(class_words.sum())
    return {
        "n_known": np.add.reduceat((known > 0)[tokens].astype(np.int64), first),
        "base_score": np.add.reduceat(log_count[tokens], first) - sizes * np.log10(total + 0.5 * (words + 1)),
        "model": model.astype(np.float32),
        "pair": (met / np.maximum(before, 1)).astype(np.float32),
        "level": levels(before).astype(np.uint8),
        "tally": np.bincount(levels(others_before) * RATIOS + bins, minlength=LEVELS * RATIOS),
    }


def _chance_batches(batches, weights, class_tokens, class_words):
    names = [x.split()[0] for x in CHANCES.split(", ")]
    for batch in batches:
        for row in rows_of(batch):
            made = token_chances(row, weights.value, class_tokens, class_words)
            for name in ("model", "pair", "level", "tally"):
                made[name] = pack(made[name])
            values = {**{name: row[name] for name in ("doc_id", "held_out", "n_tokens")}, **made}
            types = [pa.list_(t) for t in (pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([values[n]], t) for n, t in zip(names, types + [pa.binary()] * 4)], names=names
            )


def _tally_batches(batches):
    """Sum of the tallies that a task sees, cells that are not 0."""
    total = np.zeros(LEVELS * RATIOS, np.int64)
    for batch in batches:
        for blob in batch.column("tally"):
            total += unpack(blob.as_py(), np.int64)
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "tokens"])


def fit_trust(chances: DataFrame) -> np.ndarray:
    """Trust in pairs by level, from the tallies of all blocks."""
    cells = chances.select("tally").mapInArrow(_tally_batches, "cell bigint, tokens bigint")
    tally = np.zeros(LEVELS * RATIOS)
    for row in cells.groupBy("cell").agg(F.sum("tokens").alias("tokens")).collect():  # 8,320 at most
        tally[row["cell"]] = row["tokens"]
    return best_trust(tally.reshape(LEVELS, RATIOS))


def log_chances(model: np.ndarray, pair: np.ndarray, level: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """Log10 chance of tokens."""
    share = trust[level]
    return np.log10((1 - share) * np.exp(model.astype(np.float64)) + share * pair)


def _score_batches(batches, trust: np.ndarray, total: int):
    for batch in batches:
        for row in rows_of(batch):
            kept = {n: unpack(row[n], t) for n, t in (("model", "f4"), ("pair", "f4"), ("level", "u1"))}
            sizes = np.array(row["n_tokens"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_id"], pa.int64()),
                    pa.array(row["held_out"], pa.bool_()),
                    pa.array(sizes),
                    pa.array(row["n_known"], pa.int64()),
                    pa.array(np.full(len(sizes), total)),
                    pa.array(row["base_score"], pa.float64()),
                    pa.array(np.add.reduceat(log_chances(**kept, trust=trust), np.cumsum(sizes) - sizes)),
                ],
                names=[x.split()[0] for x in SCORES.split(", ")],
            )


def score_documents(documents: DataFrame, held_fold: int = 1, folds: int = 5, rounds: int = ROUNDS) -> DataFrame:
    """Log10 probability of every text under a unigram base and under the model.

    Learns from documents whose crc32(doc_id as text) modulo ``folds`` is not
    ``held_fold``; a null doc_id learns. Null text counts as empty: one end token. Each
    row is scored, repeated ones too; no rows give no rows, and with nothing to learn
    from every token has the chance that the formula gives to unknown ones. Further
    columns are ignored. Weights depend slightly on how rows lie in blocks, counts and
    base scores do not.
    """
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(fold("doc_id", folds) == held_fold, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    blocks = docs.mapInArrow(_block_batches, BLOCKS).withColumn("block", F.monotonically_increasing_id())
    blocks = stage(blocks, "blocks")
    spark = blocks.sparkSession
    entries = blocks.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // SHARD_ENTRIES))
    requests = blocks.drop("doc_id", "entries").mapInArrow(
        functools.partial(_request_batches, shards=shards),
        "block bigint, shard int, vocabulary binary, counts binary, classes binary, "
        "pairs binary, pair_counts binary",
    )
    answers = stage(requests.groupBy("shard").applyInArrow(_answer, ANSWERS), "answers")
    sums = [
        F.coalesce(F.sum(F.col(name)[c]), F.lit(0)).alias(f"{name}{c}")
        for name in ("class_tokens", "class_words")
        for c in range(CLASSES)
    ]
    totals = np.array(answers.where("block < 0").agg(*sums).first(), np.int64)
    weights = spark.sparkContext.broadcast(train(blocks, rounds))
    replies = answers.where("block >= 0").groupBy("block")
    replies = replies.agg(F.collect_list(F.struct("shard", "words", "known")).alias("answers"))
    class_tokens, class_words = totals[:CLASSES], totals[CLASSES:]
    count = functools.partial(_chance_batches, weights=weights, class_tokens=class_tokens, class_words=class_words)
    portions = []
    for portion in range(PORTIONS):
        own = F.col("block") % PORTIONS == portion
        met = blocks.drop("counts", "entries").where(own).join(replies.where(own), "block")
        portions.append(stage(met.mapInArrow(count, CHANCES), "chances"))
    chances = functools.reduce(DataFrame.unionAll, portions)
    discard(blocks, answers)
    return chances.drop("tally").mapInArrow(
        functools.partial(_score_batches, trust=fit_trust(chances), total=int(class_tokens.sum())), SCORES
    )
