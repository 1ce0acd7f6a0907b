"""Toxicity by a convolutional text classifier, trained in numpy by Spark tasks.

A word's embedding is three rows, picked by hashes of the word and of its first four and
six bytes, so inflected and compound words share rows. Filters over one, two and three words slide over
the whole text; each filter's largest response goes into a logistic output. Filters
start from the log-odds of hashed words in toxic and other texts.

All labelled texts outside the held-out fold are learned from. They are dealt by hash to
shards, and shards to two halves; each half trains a network, in rounds: every shard of
the half goes on from the same weights, and Spark adds the changes, a mean for each row
over the shards that touched it. A half's labelled texts also calibrate the thresholds of
the network that has not seen them, by language. The language is guessed from function
words of the text alone. A score is the logistic of what the outputs exceed their
language's thresholds by, in the mean of both networks, so 0.5 is the threshold everywhere.
"""

from __future__ import annotations

import copy
import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import set_join
from clickloom.llm.common import Words, fold, plain, rows_of, runs, sliced, words_of
from clickloom.sources.shared import discard, stage

BUCKETS = 1 << 16
STEMS = (4, 6)
TABLES = 1 + len(STEMS)
COLUMNS = 8
WIDTHS = {1: 16, 2: 8, 3: 8}

# Labelled text of a shard, about. A shard's weights go on from those of the round before.
SHARD_BYTES = 2 << 20
HALVES = 2
ROUNDS = 4
# Changes of weights are added as whole numbers of this size, so their order does not matter.
UNIT = 2.0**-32
# Outputs are counted for thresholds in steps of this size, up to a limit.
STEP = 1 / 256
LIMIT = 64
# Text scored at once: the responses to its words fit a processor's cache.
SCORED_BYTES = 1 << 18
SCORED_WORDS = 1 << 16
BATCH = 32
RATE = 0.05
WORD_DROPOUT = 0.2
SMOOTHING = 2.0
# A language with fewer toxic calibration rows than this shares the common threshold.
LANGUAGE_ROWS = 8

FUNCTION_WORDS = {
    "en": "the and of to in that is for with as",
    "de": "der die das und ist nicht ein den von zu",
    "fr": "le la les des et est dans pour que un",
    "es": "el los las que de y en por con una",
}


class Texts(NamedTuple):
    """Words of texts as rows of the embedding tables, and the words of each text."""

    rows: np.ndarray
    count: np.ndarray
    language: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Texts:
        words, rows = hashed_words(texts)
        return cls(rows, words.count, languages(words.hash, words.doc, len(words.count)))

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.count) - self.count

    def parts(self, words: int) -> Iterator[Texts]:
        """Consecutive texts with about so many words."""
        first = self.first
        for a, b in runs(self.count, words):
            own = self.count[a:b]
            yield Texts(self.rows[:, first[a] : first[a] + own.sum()], own, self.language[a:b])


def hashed_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words of lower-cased texts, and the table rows of each (one line a table)."""
    words = words_of(pc.utf8_lower(plain(texts)), lower=False, letters=True, stems=STEMS)
    hashes = np.concatenate([words.hash[None], words.stems])
    return words, (hashes & np.uint64(BUCKETS - 1)).astype(np.uint16)


@functools.lru_cache(maxsize=1)
def _function_words() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the function words, and which languages have each."""
    lists = [words_of(pa.array([text]), lower=False, letters=True).hash for text in FUNCTION_WORDS.values()]
    every = np.unique(np.concatenate(lists))
    return every, np.stack([np.isin(every, own) for own in lists], axis=1)


def languages(hashes: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Number of the language with most function words in each text; the last one for none."""
    every, member = _function_words()
    at = np.minimum(np.searchsorted(every, hashes), len(every) - 1)
    hit = every[at] == hashes
    counts = np.stack(
        [np.bincount(doc[hit], weights=member[at[hit], n], minlength=size) for n in range(member.shape[1])], axis=1
    )
    return np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), member.shape[1])


class Network:
    """Embedding tables, filters (one block for each width and offset) and output weights."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables = [rng.normal(0, 0.02, (BUCKETS, COLUMNS)).astype(np.float32) for _ in range(TABLES)]
        self.filters = {
            (width, offset): rng.normal(0, 0.1, (TABLES * COLUMNS, n)).astype(np.float32)
            for width, n in WIDTHS.items()
            for offset in range(width)
        }
        self.bias = {width: np.zeros(n, np.float32) for width, n in WIDTHS.items()}
        self.output = np.full(sum(WIDTHS.values()), 0.1, np.float32)
        self.base = np.float32(-1)

    def start_from(self, seen: np.ndarray, texts: np.ndarray) -> None:
        """Put the words' log-odds in the first column, and let all filters look at it.

        ``seen`` has the texts of each kind (other, toxic) that have a word of a row, ``texts`` all of a kind.
        """
        share = (seen + SMOOTHING) / (texts + 1)[:, None]
        odds = np.log(share[1] / share[0]).reshape(TABLES, BUCKETS)
        for table, own in zip(self.tables, odds):
            table[:, 0] = (own - np.median(own)) / 2
        for block in self.filters.values():
            block[::COLUMNS] += 0.5

    def weights(self) -> np.ndarray:
        """All weights as rows: those of the tables, then the others, filled up with zeros."""
        others = [*self.filters.values(), *self.bias.values(), self.output, self.base]
        flat = np.concatenate([np.ravel(x) for x in others])
        flat = np.pad(flat, (0, -len(flat) % COLUMNS)).reshape(-1, COLUMNS)
        return np.concatenate([*self.tables, flat]).astype(np.float32)

    def changed(self, rows: np.ndarray, by: np.ndarray) -> Network:
        """A network whose rows of weights differ from this one's."""
        weights, net = self.weights(), copy.deepcopy(self)
        weights[rows] += by
        net.tables = list(weights[: TABLES * BUCKETS].reshape(TABLES, BUCKETS, COLUMNS))
        flat, at = weights[TABLES * BUCKETS :].reshape(-1), 0
        for group in (net.filters, net.bias):
            for name, value in group.items():
                group[name] = flat[at : at + value.size].reshape(value.shape)
                at += value.size
        net.output = flat[at : at + len(net.output)]
        net.base = flat[at + len(net.output)]
        return net

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([table[own] for table, own in zip(self.tables, rows)], axis=1)

    def responses(self, embedded: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Response of every filter at every word; ``left`` words remain in its text."""
        parts = []
        for width, bias in self.bias.items():
            total = embedded @ self.filters[width, 0] + bias
            for offset in range(1, width):
                shifted = embedded[offset:] @ self.filters[width, offset]
                shifted[left[:-offset] <= offset] = 0
                total[:-offset] += shifted
            parts.append(total)
        return np.concatenate(parts, axis=1)

    def logits(self, texts: Texts) -> np.ndarray:
        """Output for each text; a text without words has no response."""
        pooled = np.zeros((len(texts.count), len(self.output)), np.float32)
        filled = np.flatnonzero(texts.count)
        if len(filled):
            responses = self.responses(self.embed(texts.rows), words_left(texts.count))
            pooled[filled] = np.maximum(np.maximum.reduceat(responses, texts.first[filled], axis=0), 0)
        return (pooled @ self.output + self.base).astype(np.float64)


def words_left(count: np.ndarray) -> np.ndarray:
    """For each word, the words from it to the end of its text."""
    ends = np.cumsum(count)
    return np.repeat(ends, count) - np.arange(count.sum())


def train(net: Network, texts: Texts, toxic: np.ndarray, share: float, seed) -> None:
    """AdaGrad over batches of whole texts, once; words are left out at random as noise.

    ``share`` of all texts that the network learns from are toxic; both kinds weigh alike.
    """
    rng = np.random.default_rng(seed)
    squares: dict = {}

    def step(name, value, rows, gradient):
        total = squares.setdefault(name, np.full(value.shape, 1e-2, np.float32))
        total[rows] += gradient * gradient
        value[rows] -= RATE * gradient / np.sqrt(total[rows])

    weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
    first, columns = texts.first, len(net.output)
    width_of = np.concatenate([np.full(n, w) for w, n in WIDTHS.items()])
    order = rng.permutation(len(texts.count))
    for chosen in np.array_split(order, max(1, len(order) // BATCH)):
        picks = [first[i] + np.flatnonzero(rng.random(texts.count[i]) >= WORD_DROPOUT) for i in chosen]
        count = np.array([len(p) for p in picks])
        at = np.concatenate(picks).astype(np.int64)
        if not len(at):
            continue
        rows, left = texts.rows[:, at], words_left(count)
        embedded = net.embed(rows)
        responses = net.responses(embedded, left)
        starts = np.cumsum(count) - count
        best = np.zeros((len(chosen), columns), np.int64)
        for n in np.flatnonzero(count):
            best[n] = starts[n] + responses[starts[n] : starts[n] + count[n]].argmax(axis=0)
        pooled = np.maximum(responses[best, np.arange(columns)], 0) * (count > 0)[:, None]
        chance = 1 / (1 + np.exp(-np.clip(pooled @ net.output + net.base, -30, 30)))
        error = ((chance - toxic[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
        back = np.where(pooled > 0, error[:, None] * net.output, 0)

        into = np.zeros_like(embedded)
        for (width, offset), block in list(net.filters.items()):
            own = np.flatnonzero(width_of == width)
            spot = best[:, own] + offset
            live = (back[:, own] != 0) & (left[best[:, own]] > offset)
            n, c = np.nonzero(live)
            words, grads = spot[n, c], back[:, own][n, c]
            np.add.at(into, words, grads[:, None] * block.T[c])
            gradient = np.zeros_like(block.T)
            np.add.at(gradient, c, grads[:, None] * embedded[words])
            step((width, offset), block, slice(None), gradient.T)
        for width, bias in net.bias.items():
            step(("bias", width), bias, slice(None), back[:, width_of == width].sum(axis=0))
        step("output", net.output, slice(None), error @ pooled)
        touched = np.flatnonzero(into.any(axis=1))
        for side, table in enumerate(net.tables):
            used, where = np.unique(rows[side][touched], return_inverse=True)
            gradient = np.zeros((len(used), COLUMNS), np.float32)
            np.add.at(gradient, where, into[touched][:, side * COLUMNS : (side + 1) * COLUMNS])
            step(("table", side), table, used, gradient)
        net.base -= np.float32(RATE * error.sum())


def best_threshold(logits: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None) -> float:
    """Middle of the gap with the best F1 of the rows above it; an output may stand for several rows."""
    rows = np.ones(len(logits), np.int64) if rows is None else rows
    order = np.argsort(-logits, kind="stable")
    hits, ranked = np.cumsum((toxic * rows)[order]), logits[order]
    f1 = 2 * hits / (np.cumsum(rows[order]) + (toxic * rows).sum())
    f1[:-1][ranked[:-1] == ranked[1:]] = -1  # no cut between equal outputs
    best = int(np.argmax(f1))
    below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 1
    return float((ranked[best] + below) / 2)


class Classifier(NamedTuple):
    """Trained networks and, for each, the threshold of each language."""

    nets: list[Network]
    thresholds: np.ndarray

    def scores(self, texts: Texts) -> np.ndarray:
        excess = [net.logits(texts) - own[texts.language] for net, own in zip(self.nets, self.thresholds)]
        return 1 / (1 + np.exp(-np.clip(np.mean(excess, axis=0), -500, 500)))


SHARD = "shard int, toxic binary, count binary, spoken binary, words binary"


def _shard_words(rows: pa.Table) -> pa.Table:
    """One row with the words of a shard's texts, in the order of their ids."""
    rows = rows.sort_by("doc_id").combine_chunks()
    count, spoken, words = [], [], []
    for batch in rows.select(["text"]).to_batches():
        for part in sliced(batch, "text"):
            found, own = hashed_words(part.column("text"))
            count.append(found.count.astype(np.int32))
            spoken.append(languages(found.hash, found.doc, part.num_rows).astype(np.int8))
            words.append(own)
    shard = rows["shard"][0].as_py()
    blobs = [rows["toxic"].to_numpy().astype(np.int8), *map(np.concatenate, (count, spoken))]
    blobs.append(np.concatenate(words, axis=1))
    return pa.table(
        [
            pa.array([shard], pa.int32()),
            *[pa.array([b.tobytes()], pa.binary()) for b in blobs],
        ],
        names=["shard", "toxic", "count", "spoken", "words"],
    )


def _shards_of(batches) -> Iterator[tuple[int, int, Texts, np.ndarray]]:
    """(half, shard, texts, toxic) of each row that ``_shard_words`` made."""
    for batch in batches:
        for row in rows_of(batch):
            words = np.frombuffer(row["words"], np.uint16).reshape(TABLES, -1)
            count = np.frombuffer(row["count"], np.int32).astype(np.int64)
            texts = Texts(words, count, np.frombuffer(row["spoken"], np.int8))
            yield row["half"], row["shard"], texts, np.frombuffer(row["toxic"], np.int8).astype(np.int64)


def _seen_batches(batches):
    """Texts of each kind that have a word of a table's row."""
    for half, _, texts, toxic in _shards_of(batches):
        doc = np.repeat(np.arange(len(texts.count)), texts.count)
        for side, rows in enumerate(texts.rows):
            pairs = np.unique(doc * BUCKETS + rows)
            kind = toxic[pairs // BUCKETS]
            counts = [np.bincount(pairs[kind == k] % BUCKETS, minlength=BUCKETS) for k in (0, 1)]
            used = np.flatnonzero(counts[0] + counts[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), half, np.int32)),
                    pa.array((side * BUCKETS + used).astype(np.int32)),
                    *[pa.array(c[used]) for c in counts],
                ],
                names=["half", "row", "other", "toxic"],
            )


def _change_batches(batches, nets, shares: list[float], turn: int):
    """Changes of the rows of weights that a shard's texts touch in a round."""
    for half, shard, texts, toxic in _shards_of(batches):
        before = nets.value[half]
        net = copy.deepcopy(before)
        train(net, texts, toxic, shares[half], [shard, turn])
        change = net.weights().astype(np.float64) - before.weights()
        # The weights beyond the tables are touched by all shards.
        touched = np.append(change[: TABLES * BUCKETS].any(axis=1), np.ones(len(change) - TABLES * BUCKETS, bool))
        used = np.flatnonzero(touched)
        units = np.rint(change[used] / UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(used), half, np.int32)), pa.array(used.astype(np.int32)), *map(pa.array, units.T)],
            names=["half", "row", *[f"w{n}" for n in range(COLUMNS)]],
        )


def _output_batches(batches, nets):
    """Numbers of labelled texts by the output of the network that did not learn from them."""
    for half, _, texts, toxic in _shards_of(batches):
        net = (half + 1) % len(nets.value)
        logits = np.concatenate([nets.value[net].logits(part) for part in texts.parts(SCORED_WORDS)])
        logits = np.clip(logits, -LIMIT, LIMIT)
        cells = np.stack([texts.language, toxic, np.rint(logits / STEP)], axis=1).astype(np.int64)
        cells, rows = np.unique(cells, axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(rows), net)), *map(pa.array, cells.T), pa.array(rows)],
            names=["net", "language", "toxic", "output", "texts"],
        )


def train_networks(shards: DataFrame, texts: np.ndarray, rounds: int = ROUNDS) -> list[Network]:
    """A network for each half of the shards; ``texts`` has the texts of each half by kind."""
    context = shards.sparkSession.sparkContext
    nets = [Network(seed=7 + half) for half in range(len(texts))]
    seen = shards.mapInArrow(_seen_batches, "half int, row int, other bigint, toxic bigint")
    # A row for each row of the tables at most.
    seen = seen.groupBy("half", "row").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toPandas()
    for half, net in enumerate(nets):
        own, counts = seen[seen["half"] == half], np.zeros((2, TABLES * BUCKETS))
        counts[:, own["row"]] = own[["other", "toxic"]].to_numpy().T
        net.start_from(counts, texts[half])
    shares = [float(own[1] / own.sum()) for own in texts]
    names = [f"w{n}" for n in range(COLUMNS)]
    schema = "half int, row int, " + ", ".join(f"{n} bigint" for n in names)
    for turn in range(rounds):
        sent = context.broadcast(nets)
        changes = shards.mapInArrow(functools.partial(_change_batches, nets=sent, shares=shares, turn=turn), schema)
        mean = changes.groupBy("half", "row").agg(
            *[(F.sum(n) * UNIT / F.count("*")).cast("float").alias(n) for n in names]
        )
        change = mean.toPandas()  # a row for each row of weights at most
        for half, net in enumerate(nets):
            own = change[change["half"] == half]
            nets[half] = net.changed(own["row"].to_numpy(), own[names].to_numpy(np.float32))
        sent.unpersist()
    return nets


def calibrated(nets: list[Network], shards: DataFrame) -> Classifier:
    """Thresholds by language from the outputs for all labelled texts."""
    sent = shards.sparkSession.sparkContext.broadcast(nets)
    outputs = shards.mapInArrow(
        functools.partial(_output_batches, nets=sent),
        "net bigint, language bigint, toxic bigint, output bigint, texts bigint",
    )
    # Steps of the output, two kinds and the languages bound the rows.
    counts = outputs.groupBy("net", "language", "toxic", "output").agg(F.sum("texts").alias("texts")).toPandas()
    sent.unpersist()
    thresholds = np.zeros((len(nets), len(FUNCTION_WORDS) + 1))
    for net in range(len(nets)):
        own = counts[counts["net"] == net]
        thresholds[net] = best_threshold(own["output"].to_numpy() * STEP, own["toxic"].to_numpy(), own["texts"].to_numpy())
        for language, part in own.groupby("language"):
            logits, toxic, rows = part["output"].to_numpy() * STEP, part["toxic"].to_numpy(), part["texts"].to_numpy()
            if (toxic * rows).sum() >= LANGUAGE_ROWS and not toxic.all():
                thresholds[net, language] = best_threshold(logits, toxic, rows)
    return Classifier(nets, thresholds)


def _picked_batches(batches, wanted):
    """Rows whose id falls on a set bit."""
    for batch in batches:
        place = batch.column("place").to_numpy()
        held = (wanted.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        yield batch.select(["doc_id", "text"]).filter(pa.array(held))


def fit_classifier(
    documents: DataFrame, labels: DataFrame, held_fold: int = 0, folds: int = 5, shard_bytes: int = SHARD_BYTES
) -> Classifier | None:
    """Classifier from all labelled rows outside the held-out fold.

    A doc_id with several labels is toxic if one of them says so; a doc_id that repeats
    counts once. Each half of the labelled texts, by hash, trains one network and
    calibrates the other's thresholds. If a half has not both kinds, one network learns
    from all and its thresholds are of the same texts. Without toxic and other rows there
    is no classifier. The driver holds weights and counts of fixed size.
    """
    marks = (
        labels.where("doc_id is not null and toxic is not null")
        .where(fold("doc_id", folds) != held_fold)
        .groupBy("doc_id")
        .agg((F.max(F.col("toxic").cast("int")) > 0).cast("int").alias("toxic"))
    )
    kind = dict(documents.dtypes)["doc_id"]
    # Texts without a label stay out of the shuffle.
    marks = marks.select(F.col("doc_id").try_cast(kind).alias("doc_id"), "toxic").where("doc_id is not null")
    bits = documents.sparkSession.sparkContext.broadcast(set_join.id_filter(marks))
    picked = documents.select("doc_id", "text", set_join.id_place("doc_id").alias("place")).mapInArrow(
        functools.partial(_picked_batches, wanted=bits), f"doc_id {kind}, text string"
    )
    text = F.coalesce("text", F.lit(""))
    known = picked.join(marks, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(text).alias("text"))
    known = stage(known.withColumn("hash", F.xxhash64("doc_id")), "labelled")
    half = F.pmod("hash", F.lit(HALVES)).alias("half")
    totals = known.groupBy(half, "toxic").agg(F.count("*").alias("texts"), F.sum(F.octet_length("text")).alias("bytes"))
    texts, size = np.zeros((HALVES, 2)), 0
    for row in totals.collect():
        texts[row.half, row.toxic] = row.texts
        size += row.bytes
    if not texts.sum(axis=0).all():
        discard(known)
        return None
    if not texts.all():
        texts = texts.sum(axis=0, keepdims=True)
    count = HALVES * max(1, -(-size // (HALVES * shard_bytes)))
    shards = known.select("doc_id", "toxic", "text", F.pmod("hash", F.lit(count)).cast("int").alias("shard"))
    shards = shards.groupBy("shard").applyInArrow(_shard_words, SHARD)
    shards = stage(shards.withColumn("half", F.pmod("shard", F.lit(len(texts)))), "shards")
    discard(known)
    found = calibrated(train_networks(shards, texts), shards)
    discard(shards)
    return found


def _score_batches(batches, carried: list[str], classifier):
    for batch in batches:
        for part in sliced(batch, "text", SCORED_BYTES):
            if classifier.value is None:
                scores = np.zeros(part.num_rows)
            else:
                scores = classifier.value.scores(Texts.of(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(name) for name in carried],
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                ],
                names=[*carried, "score", "predicted"],
            )


def score_toxicity(documents: DataFrame, labels: DataFrame, held_fold: int = 0, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole text alone.

    held_out tells whether crc32(doc_id as text) modulo ``folds`` is ``held_fold`` (not
    for a null id); labels of these rows are not learned. Null text counts as empty and
    has a score too. Without toxic and other labels to learn from all scores are 0. Rows
    are scored one by one, repeated ids too; no rows give no rows; further columns are
    ignored.
    """
    docs = documents.select(
        "doc_id",
        F.coalesce(fold("doc_id", folds) == held_fold, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    sent = docs.sparkSession.sparkContext.broadcast(fit_classifier(docs, labels, held_fold, folds))
    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(
        functools.partial(_score_batches, carried=["doc_id", "held_out"], classifier=sent),
        f"doc_id {kind}, held_out boolean, score double, predicted int",
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, held_fold: int = 0, folds: int = 5) -> DataFrame:
    """The documents that are not predicted toxic, all columns unchanged."""
    names = documents.columns
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(fit_classifier(texts, labels, held_fold, folds))
    renamed = documents.toDF(*[f"c{i}" for i in range(len(names))])
    given = renamed.withColumn("text", F.col(f"c{names.index('text')}").cast("string"))
    types = ", ".join(f"{n} {t}" for n, t in renamed.dtypes)
    scored = given.mapInArrow(
        functools.partial(_score_batches, carried=renamed.columns, classifier=sent),
        f"{types}, score double, predicted int",
    )
    return scored.where("predicted = 0").select(*renamed.columns).toDF(*names)
