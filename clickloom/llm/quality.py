"""Quality rules with an isolation forest over rule statistics.

Each document gets the statistics that quality rules look at. A forest of random splits
isolates documents with unusual statistics in few steps; the mean path length gives an
anomaly score. There is a forest for each statistic and one for all of them together.
Labelled rows say from which score of a forest on documents are worth rejecting, and
which forests tell good from bad at all; the others are not used.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import mix, plain, sliced, words_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

# The forest and its threshold are fitted on at most this many labelled rows.
LABELLED_ROWS = 20_000
TREES = 64
TREE_ROWS = 256
DEPTH = 10
# Share of well-labelled rows that the threshold may reject.
FALSE_REJECTS = 0.002
# A forest is used if it then rejects at least this share of badly labelled rows.
MIN_GAIN = 0.05

RATIOS = (
    "word_length",
    "symbols_per_word",
    "dup_lines_share",
    "repeat_share",
    "upper_share",
    "marks_per_word",
    "digit_share",
    "ends_per_word",
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Statistics(NamedTuple):
    """Counts (documents x 5) and ratios (documents x 8) of some documents."""

    counts: np.ndarray
    ratios: np.ndarray


def _code_table(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(characters.encode(), np.uint8)] = True
    return table


SYMBOLS = _code_table("#*$%&|<>")
UPPER = _code_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = _code_table("0123456789")
MARKS = _code_table("!?;:_~^=+/\\@")
ENDS = _code_table(".,")


def repeated_words(words, width: int = WINDOW) -> np.ndarray:
    """For each text, the words that lie in a window of words found twice or more in it."""
    hashes, doc = words.hash, words.doc
    span = len(hashes) - width + 1
    if span < 1:
        return np.zeros(len(words.count), np.int64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    rolled = mix(doc[:span].astype(np.uint64))
    for i in range(width):
        rolled += hashes[i : i + span] * factors[i]
    inside = np.flatnonzero(doc[:span] == doc[width - 1 :])
    order = inside[np.argsort(rolled[inside], kind="stable")]
    same = rolled[order][1:] == rolled[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    change = np.zeros(len(hashes) + 1, np.int64)
    change[order[twice]] += 1
    np.subtract.at(change, order[twice] + width, 1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(words.count))


def repeated_lines(text: str) -> tuple[int, int]:
    """(lines with a word, those of them that equal an earlier line)."""
    worded = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(worded), len(worded) - len(set(worded))


def statistics(texts: pa.Array) -> Statistics:
    """Rule statistics of whole texts; nulls count as empty."""
    texts = plain(texts)
    words = words_of(texts, lower=False)
    data = words.data
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    offsets = offsets - offsets[0]

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    space = (data == 32) | ((data >= 9) & (data <= 13))
    word_chars = per_text(~space & ((data & 0xC0) != 0x80))
    symbols = per_text(SYMBOLS[data])
    lines = np.array([repeated_lines(t) for t in texts.to_pylist()], np.int64).reshape(-1, 2)
    repeated = repeated_words(words)
    counts = np.stack([words.count, word_chars, symbols, lines[:, 1], repeated], axis=1)
    n_words, n_chars = np.maximum(words.count, 1), np.maximum(word_chars, 1)
    ratios = np.stack(
        [
            word_chars / n_words,
            symbols / n_words,
            lines[:, 1] / np.maximum(lines[:, 0], 1),
            repeated / n_words,
            per_text(UPPER[data]) / n_chars,
            per_text(MARKS[data]) / n_words,
            per_text(DIGITS[data]) / n_chars,
            per_text(ENDS[data]) / n_words,
        ],
        axis=1,
    )
    return Statistics(counts, ratios)


def _mean_path(size) -> np.ndarray:
    """Mean length of an unsuccessful search among ``size`` rows."""
    size = np.maximum(np.asarray(size, float), 1)
    more = np.maximum(size - 1, 1)
    return np.where(size > 2, 2 * (np.log(more) + np.euler_gamma) - 2 * more / size, size - 1)


@dataclass(frozen=True)
class Forest:
    """Trees as heaps of (feature or -1, cut, path length at a leaf)."""

    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    unit: float

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = TREES, seed: int = 7) -> Forest:
        rng = np.random.default_rng(seed)
        size = (2 << DEPTH) - 1
        feature = np.full((trees, size), -1)
        cut, length = np.zeros((trees, size)), np.zeros((trees, size))
        take = min(TREE_ROWS, len(rows))
        for tree in range(trees):
            todo = [(0, 0, rows[rng.choice(len(rows), take, replace=False)])]
            while todo:
                node, depth, own = todo.pop()
                low, high = own.min(axis=0), own.max(axis=0)
                open_ = np.flatnonzero(high > low)
                if depth == DEPTH or not len(open_):
                    length[tree, node] = depth + _mean_path(len(own))
                    continue
                f = rng.choice(open_)
                at = rng.uniform(low[f], high[f])
                right = own[:, f] > at
                feature[tree, node], cut[tree, node] = f, at
                todo += [(2 * node + 1, depth + 1, own[~right]), (2 * node + 2, depth + 1, own[right])]
        return cls(feature, cut, length, float(_mean_path(take)) or 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, from 0 to 1; shorter paths score higher."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, length in zip(self.feature, self.cut, self.length):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                down = f >= 0
                if not down.any():
                    break
                right = rows[every, np.maximum(f, 0)] > cut[node]
                node = np.where(down, 2 * node + 1 + right, node)
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / self.unit)


def calibrate(scores: np.ndarray, good: np.ndarray, false_rejects: float = FALSE_REJECTS) -> float:
    """Score above which rows are rejected: best balance of labels within the false rejects.

    Infinite when labels of either kind are missing or the forest does not tell them
    apart, so that nothing is rejected.
    """
    if not good.any() or good.all():
        return float("inf")
    cuts = np.unique(scores)
    over_good = 1 - np.searchsorted(np.sort(scores[good]), cuts, "right") / good.sum()
    over_bad = 1 - np.searchsorted(np.sort(scores[~good]), cuts, "right") / (~good).sum()
    gain = np.where(over_good <= false_rejects, over_bad - over_good, -1)
    best = int(np.argmax(gain))
    if gain[best] < MIN_GAIN:
        return float("inf")
    return float((cuts[best] + cuts[best + 1]) / 2)


class Verdict(NamedTuple):
    """Forests that are used, with the columns they look at and their thresholds."""

    forests: list[tuple[list[int], Forest, float]]

    @classmethod
    def fit(cls, ratios: np.ndarray, good: np.ndarray) -> Verdict:
        every = list(range(ratios.shape[1]))
        forests = []
        for columns in [*[[c] for c in every], every]:
            forest = Forest.fit(ratios[:, columns])
            threshold = calibrate(forest.score(ratios[:, columns]), good)
            if np.isfinite(threshold):
                forests.append((columns, forest, threshold))
        return cls(forests)

    def margin(self, ratios: np.ndarray) -> np.ndarray:
        """Largest excess of a score over its threshold; positive rows are anomalous."""
        excess = np.full(len(ratios), -1.0)
        for columns, forest, threshold in self.forests:
            np.maximum(excess, forest.score(ratios[:, columns]) - threshold, out=excess)
        return excess


def _statistic_batches(batches, carried: list[str], verdict=None):
    for batch in batches:
        for part in sliced(batch, "text"):
            found = statistics(part.column("text"))
            columns = {name: part.column(name) for name in carried}
            columns |= {name: pa.array(found.counts[:, i]) for i, name in enumerate(COUNTS)}
            if verdict is None:
                columns["ratios"] = pa.array(list(found.ratios), pa.list_(pa.float64()))
            else:
                n_words, repeated = found.counts[:, 0], found.counts[:, 4]
                failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
                margin = verdict.value.margin(found.ratios)
                columns["base_failed"] = pa.array(failed)
                columns["kept"] = pa.array(~failed & (margin <= 0))
                columns["anomaly"] = pa.array(margin)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def fit_quality(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Verdict:
    """Forests and thresholds from at most ``rows`` labelled documents, the same on every run.

    A doc_id with several labels counts as good only if all of them say so. Documents
    that the plain rules reject anyway are left out. Without labelled documents nothing
    more is rejected.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("_good")
    )
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # ``rows`` bounds what is broadcast: 16 bytes a row.
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    stats = texts.mapInArrow(
        functools.partial(_statistic_batches, carried=["doc_id", "_good"]),
        f"doc_id {dict(texts.dtypes)['doc_id']}, _good {dict(texts.dtypes)['_good']}, {counts}, ratios array<double>",
    )
    tested = stats.where(
        f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words"
    )
    # A doc_id that repeats counts once, so ``rows`` bounds what the driver gets.
    once = tested.groupBy("doc_id").agg(F.min(F.struct("_good", "ratios")).alias("row"))
    rows_ = once.select("row.*").toPandas()
    if not len(rows_):
        return Verdict([])
    ratios = np.array(rows_["ratios"].tolist())
    order = np.lexsort(ratios.T)  # the order in which rows arrive does not matter
    ratios, good = ratios[order], rows_["_good"].to_numpy()[order] > 0
    return Verdict.fit(ratios, good)


def quality_rules(documents: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, n_words, counts, base_failed, kept, anomaly) of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, null has none. A document fails
    the plain rules with fewer than 20 words or with over 30 per cent of its words in
    repeated 8-word windows; others are kept unless a forest scores them over its
    threshold (anomaly is the largest excess). Rows are judged one by one, repeated ids
    too; no rows give no rows; further columns are ignored.
    """
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    verdict = documents.sparkSession.sparkContext.broadcast(fit_quality(documents, labels, labelled_rows))
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    return documents.mapInArrow(
        functools.partial(_statistic_batches, carried=["doc_id"], verdict=verdict),
        f"doc_id {dict(documents.dtypes)['doc_id']}, {counts}, "
        "base_failed boolean, kept boolean, anomaly double",
    )


def filter_quality(documents: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """The documents that the rules keep, all columns unchanged."""
    names = documents.columns
    verdict = documents.sparkSession.sparkContext.broadcast(fit_quality(documents, labels, labelled_rows))
    plain_names = documents.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    judged = plain_names.withColumn("text", F.col(text).cast("string"))
    types = ", ".join(f"{n} {t}" for n, t in plain_names.dtypes)
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    kept = judged.mapInArrow(
        functools.partial(_statistic_batches, carried=plain_names.columns, verdict=verdict),
        f"{types}, {counts}, base_failed boolean, kept boolean, anomaly double",
    ).where("kept")
    return kept.select(*plain_names.columns).toDF(*names)
