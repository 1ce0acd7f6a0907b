"""Ranked lexical search of all documents for a set of items, by two trees.

The score of a document for an item is a product of two sparse vectors: of the item, the
weight of each term times its repeats; of the document, the damped share of the term. All
coordinates are whole numbers from 0 on. So if a node of an item tree holds the largest
coordinates of its items, and a node of a document tree those of its documents, their
product bounds every score between them. A pair of nodes whose bound is below the weakest
kth score of its items is left out whole, and nothing that counts is lost.

Documents are searched where they lie, in blocks with a tree each; a task keeps the best
scores of the items over all its blocks. Kth scores among a sample of the documents are
lower bounds of the real ones and are known to all tasks before the search.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import SLICE_BYTES, Words, int_lists, plain, sliced, words_of
from clickloom.sources.shared import stage

# (Item text, term) pairs that are searched at once, which bounds what is broadcast.
# Beyond that, items are searched in several such sets.
PAIRS = 250_000

# Cells of the item matrix that a task has at a time.
CELLS = 1 << 22

# Documents of a tree and of its nodes; items of a node.
BLOCK, NODE, LEAF = 4096, 256, 32
CLUSTER = 8

# One in so many documents gives the first bounds.
SAMPLE = 32

# Scores below this are exact in doubles, however they are added up.
EXACT = 1 << 53

# Largest value of a document's coordinate, which is 1e9 tf / (1000 tf + 8 m) with m > 0.
LARGEST = 1_000_000


def _cuts(data: np.ndarray, limit: int) -> list[int]:
    """Places between terms of UTF-8 bytes, at least ``limit`` apart, with both ends."""
    edges = [0]
    while len(data) - edges[-1] > limit:
        at = edges[-1] + limit
        while at < len(data):
            window = data[at : at + 4096]
            inside = (window >= 128) | (((window | 32) >= 97) & ((window | 32) <= 122))
            gaps = np.flatnonzero(~(inside | ((window >= 48) & (window <= 57))))
            if len(gaps):
                at += int(gaps[0])
                break
            at += len(window)
        edges.append(min(at, len(data)))
    return [*edges, len(data)]


def terms_of(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Terms of texts; one long text comes in several parts, cut between terms."""
    if len(texts) == 1 and texts.nbytes > 2 * limit:
        data = np.frombuffer(plain(texts)[0].as_buffer(), np.uint8)
        edges = _cuts(data, limit)
        for start, end in zip(edges, edges[1:]):
            part = pa.array([data[start:end].tobytes()], pa.large_binary()).cast(pa.large_string())
            yield words_of(part, letters=True, digits=True)
    else:
        yield words_of(texts, letters=True, digits=True)


def counted(texts: pa.Array, known: np.ndarray | None = None) -> tuple:
    """Terms in each text; text, term and count of each different term of a text.

    A term is its hash, or with ``known`` (sorted hashes) its place there; others are only
    in the number of terms.
    """
    total = np.zeros(len(texts), np.int64)
    texts_at, terms, counts = [], [], []
    for words in terms_of(texts):
        total += words.count
        doc, term = words.doc, words.hash
        if known is not None:
            at = np.searchsorted(known, term)
            at[at == len(known)] = 0
            hit = known[at] == term if len(known) else np.zeros(len(term), bool)
            doc, term = doc[hit], at[hit].astype(np.uint64)
        order = np.lexsort((term, doc))
        doc, term = doc[order], term[order]
        new = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
        first = np.flatnonzero(np.append(True, new)[: len(doc)])
        texts_at.append(doc[first])
        terms.append(term[first])
        counts.append(np.diff(np.append(first, len(doc))))
    doc, term, count = map(np.concatenate, (texts_at, terms, counts))
    if len(texts_at) > 1:  # parts of one text
        term, place = np.unique(term, return_inverse=True)
        count = np.bincount(place, count, len(term)).astype(np.int64)
        doc = np.zeros(len(term), np.int64)
    return total, doc, term, count


def _item_batches(batches):
    for batch in batches:
        for part in sliced(batch, "text"):
            _, doc, term, count = counted(plain(part.column("text")))
            sizes = np.bincount(doc, minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("item"), int_lists(term.view(np.int64), sizes), int_lists(count, sizes)],
                names=["item", "terms", "counts"],
            )


def _document_batches(batches, known):
    for batch in batches:
        for part in sliced(batch, "text"):
            total, doc, term, count = counted(plain(part.column("text")), known.value)
            sizes = np.bincount(doc, minlength=part.num_rows)
            lists = [int_lists(v.astype(np.int32), sizes, pa.int32()) for v in (term, count)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(total), *lists],
                names=["doc_id", "n_terms", "terms", "counts"],
            )


class Items(NamedTuple):
    """Items of one search: pairs of item and term with their weight, and the totals."""

    first: np.ndarray  # of the pairs of each item
    term: np.ndarray
    weight: np.ndarray  # of the term times its repeats in the item
    common: np.ndarray  # documents with each term
    single: np.ndarray  # weight of each term
    documents: int
    length: int
    limit: np.ndarray  # scores below are not wanted, by item


class Group(NamedTuple):
    """Some items: their terms, weights by term and item, and largest weights of nodes."""

    items: np.ndarray
    columns: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    clusters: np.ndarray
    all: np.ndarray


def _telling(owner, term, weight, common, size: int) -> np.ndarray:
    """Order of owners by their most common term, then by their heaviest."""
    keys = []
    for value in (weight, common[term]):
        order = np.lexsort((value, owner))
        last = np.flatnonzero(np.append(owner[order][1:] != owner[order][:-1], True))[: len(order)]
        key = np.full(size, -1, np.int64)
        key[owner[order][last]] = term[order][last]
        keys.append(key)
    return np.lexsort(keys)


def groups_of(items: Items) -> Iterator[Group]:
    """Items in groups that fit the memory for a matrix, alike ones next to each other."""
    sizes = np.diff(items.first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = _telling(owner, items.term, items.weight, items.common, len(sizes))
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        end, pairs = at, 0
        # The pairs bound the number of different terms from above.
        while end < len(order) and (end == at or (end + 1 - at) * (pairs + sizes[order[end]]) <= CELLS):
            pairs += sizes[order[end]]
            end += 1
        chosen = order[at:end]
        at = end
        spans = [slice(items.first[i], items.first[i + 1]) for i in chosen]
        term = np.concatenate([items.term[s] for s in spans])
        weight = np.concatenate([items.weight[s] for s in spans])
        columns, place = np.unique(term, return_inverse=True)
        heaviest = max(int(items.weight[s].sum()) for s in spans)
        kind = np.float64 if heaviest * LARGEST < EXACT else np.int64
        weights = np.zeros((len(columns), len(chosen)), kind)
        weights[place, np.repeat(np.arange(len(chosen)), sizes[chosen])] = weight
        starts = np.arange(0, len(chosen), CLUSTER)
        clusters = np.maximum.reduceat(weights, starts, axis=1)
        # A node's largest weights together may exceed what an item has.
        wide = clusters.max(axis=1)
        if kind == np.float64 and int(wide.sum()) * LARGEST >= EXACT:
            weights, clusters, wide = (w.astype(np.int64) for w in (weights, clusters, wide))
        yield Group(chosen, columns, weights, starts, clusters, wide)


class Best:
    """Best scores of each item so far, and the documents that may be among them."""

    def __init__(self, limit: np.ndarray, top: int):
        self.top = top
        self.limit = np.maximum(limit, 1)
        self.scores = np.zeros((len(limit), top), np.int64)
        self.found: list[tuple] = []
        self.waiting = 0

    def add(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray, unset: np.ndarray) -> None:
        """Scores by item and document; ``unset`` tells which ids are null."""
        both = np.concatenate([self.scores[items], scores], axis=1)
        self.scores[items] = np.partition(both, both.shape[1] - self.top, axis=1)[:, -self.top :]
        self.limit[items] = np.maximum(self.limit[items], self.scores[items].min(axis=1))
        item, doc = np.nonzero(scores >= self.limit[items][:, None])
        if len(item):
            self.found.append((items[item], scores[item, doc], docs[doc], unset[doc]))
            self.waiting += len(item)
            if self.waiting > 1 << 20:
                self.found = [self.best()]
                self.waiting = len(self.found[0][0])

    def best(self) -> tuple:
        """The best of each item, larger scores and then smaller ids first, null ids last."""
        if not self.found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, score, doc, unset = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((doc, unset, -score, item))
        item, score, doc, unset = item[order], score[order], doc[order], unset[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = (place < self.top) & (score >= self.limit[item])
        return item[keep], score[keep], doc[keep], unset[keep]


def _highest(column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different columns and the largest value of each."""
    order = np.argsort(column, kind="stable")
    column, value = column[order], value[order]
    first = np.flatnonzero(np.append(True, column[1:] != column[:-1])[: len(column)])
    return column[first], np.maximum.reduceat(value, first) if len(first) else value


def search_block(
    group: Group, best: Best, doc: np.ndarray, column: np.ndarray, value: np.ndarray, ids, unset
) -> None:
    """Search documents 0, 1, ... of a block, given as sorted (doc, column, value) entries."""
    kind = group.weights.dtype
    value = value.astype(kind)
    limit = np.minimum.reduceat(best.limit[group.items], group.starts)

    def bounds(entries: slice, clusters: np.ndarray) -> np.ndarray:
        """Of clusters, those that may have a score from their weakest on in these documents."""
        columns, highest = _highest(column[entries], value[entries])
        return clusters[highest @ group.clusters[columns][:, clusters] >= limit[clusters]]

    columns, highest = _highest(column, value)
    if not len(columns) or highest @ group.all[columns] < limit.min():
        return
    everything = np.arange(len(group.starts))
    ends = np.searchsorted(doc, np.arange(0, len(ids) + LEAF, LEAF))
    for node in range(0, len(ids), NODE):
        first = node // LEAF
        last = min(first + NODE // LEAF, len(ends) - 1)
        in_node = bounds(slice(ends[first], ends[last]), everything)
        for leaf in range(first, last) if len(in_node) else ():
            entries = slice(ends[leaf], ends[leaf + 1])
            clusters = bounds(entries, in_node)
            if not len(clusters):
                continue
            columns, place = np.unique(column[entries], return_inverse=True)
            size = min(LEAF, len(ids) - leaf * LEAF)
            shares = np.zeros((len(columns), size), kind)
            shares[place, doc[entries] - leaf * LEAF] = value[entries]
            members = (clusters[:, None] * CLUSTER + np.arange(CLUSTER)).ravel()
            members = members[members < len(group.items)]
            weights = group.weights[columns][:, members]
            items = group.items[members]
            hopeful = shares.max(axis=1) @ weights >= best.limit[items]
            if hopeful.any():
                scores = weights[:, hopeful].T @ shares
                at = slice(leaf * LEAF, leaf * LEAF + size)
                best.add(items[hopeful], scores.astype(np.int64), ids[at], unset[at])
                limit = np.minimum.reduceat(best.limit[group.items], group.starts)


def _search_batches(batches, sent, top: int):
    items: Items = sent.value
    best = Best(items.limit, top)
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            terms = part.column("terms")
            sizes = np.diff(terms.offsets.to_numpy())
            doc = np.repeat(np.arange(part.num_rows), sizes)
            term = terms.flatten().to_numpy().astype(np.int64)
            tf = part.column("counts").flatten().to_numpy().astype(np.int64)
            n = part.column("n_terms").to_numpy()
            m = 100 - 75 + 75 * n * items.documents // items.length
            value = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
            # Alike documents next to each other.
            order = _telling(doc, term, value * items.single[term], items.common, part.num_rows)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            doc = rank[doc]
            sorted_entries = np.argsort(doc, kind="stable")
            doc, term, value = doc[sorted_entries], term[sorted_entries], value[sorted_entries]
            ids = part.column("doc_id")
            unset = ids.is_null().to_numpy(zero_copy_only=False)[order]
            ids = ids.fill_null(0).to_numpy()[order]
            for group in groups_of(items):
                column = np.searchsorted(group.columns, term)
                column[column == len(group.columns)] = 0
                hit = group.columns[column] == term
                search_block(group, best, doc[hit], column[hit], value[hit], ids, unset)
    item, score, doc, unset = best.best()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(item, pa.int32()),
            pa.array(doc, pa.int64(), mask=unset.astype(bool)),
            pa.array(score, pa.int64()),
        ],
        names=["item_number", "doc_id", "score"],
    )


def _search(vectors: DataFrame, items: Items, top: int) -> DataFrame:
    """(item_number, rank, doc_id, score) of the best documents of ``vectors``."""
    sent = vectors.sparkSession.sparkContext.broadcast(items)
    found = vectors.mapInArrow(
        functools.partial(_search_batches, sent=sent, top=top), "item_number int, doc_id bigint, score bigint"
    )
    first = Window.partitionBy("item_number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)


def _search_set(documents: DataFrame, rows: list, top: int) -> DataFrame:
    """(item, rank, doc_id, score) for some items, given as rows (item, terms, counts)."""
    spark = documents.sparkSession
    sizes = np.array([len(r.terms) for r in rows], np.int64)
    hashes = np.concatenate([np.array(r.terms, np.int64) for r in rows]).view(np.uint64)
    repeats = np.concatenate([np.array(r.counts, np.int64) for r in rows])
    known, term = np.unique(hashes, return_inverse=True)
    sent = spark.sparkContext.broadcast(known)
    vectors = stage(
        documents.mapInArrow(
            functools.partial(_document_batches, known=sent),
            "doc_id bigint, n_terms bigint, terms array<int>, counts array<int>",
        ),
        "vectors",
    )
    filled = vectors.where("n_terms > 0")
    total = filled.agg(F.count("*").alias("documents"), F.sum("n_terms").alias("length")).first()
    common = np.zeros(len(known), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        common[row["term"]] = row["count"]
    single = np.array(
        [math.floor(1000 * math.log((2 * total.documents + 2) / (2 * df + 1))) for df in common.tolist()], np.int64
    )
    items = Items(
        np.concatenate([[0], np.cumsum(sizes)]),
        term,
        repeats * single[term],
        common,
        single,
        total.documents,
        total.length or 1,
        np.ones(len(rows), np.int64),
    )
    held = vectors.where(F.size("terms") > 0)
    sample = held.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    for row in _search(sample, items, top).where(F.col("rank") == top).collect():
        items.limit[row.item_number] = row.score
    names = spark.createDataFrame([(n, r.item) for n, r in enumerate(rows)], "item_number int, item string")
    found = _search(held, items, top).join(F.broadcast(names), "item_number")
    return found.select("item", "rank", "doc_id", "score")


def rank_documents(documents: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every row of ``items``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
    lower-cased, of the whole text (null: none); they are compared by 64-bit hashes. Every
    row of ``documents`` is a document, repeated ids too; equal scores go by ascending
    doc_id, null ids last. Every row of ``items`` gets its ranks; items with equal texts
    are searched once. Scores of 0 are no result, so items without terms, or without
    documents that share one, have no rows. Other columns are ignored.

    Items are read in sets of about ``PAIRS`` terms, each of which reads the documents
    once; weights, document frequencies and first bounds of a set are broadcast.
    """
    spark = documents.sparkSession
    documents = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    asked = asked.withColumn("item", F.sha2("text", 256))
    different = asked.groupBy("item").agg(F.first("text").alias("text"))
    termed = stage(
        different.mapInArrow(_item_batches, "item string, terms array<bigint>, counts array<bigint>"), "items"
    ).where(F.size("terms") > 0)
    pairs = termed.agg(F.sum(F.size("terms"))).first()[0] or 0
    sets = math.ceil(pairs / PAIRS)
    found = spark.createDataFrame([], "item string, rank int, doc_id bigint, score bigint")
    for number in range(sets):
        rows = termed.where(F.pmod(F.xxhash64("item"), F.lit(sets)) == number).orderBy("item").collect()
        if rows:
            found = found.unionAll(_search_set(documents, rows, top))
    return asked.join(found, "item").select("item_id", "rank", "doc_id", "score")
