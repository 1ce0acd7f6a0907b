"""Nearest neighbours by learned partitions.

A sample of the vectors gets its neighbour graph, and the graph is cut into parts of
nearly equal size with few edges between them. A small network learns to tell a
vector's part, with the parts of its neighbours as soft answers. Every vector of the
table goes to its most probable part; a query goes to its several most probable parts
and is compared exactly with the vectors there. How many parts are probed is settled by
measuring recall against brute force on some queries over all vectors.

Equal vectors are one vector with several ids, so copies do not load a part. Parts are
cut into blocks of bounded size, and so are the queries that visit them.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources.shared import stage

NEIGHBOURS = 5
QUERY_EVERY = 50

# The graph and the network are fitted on at most so many vectors.
SAMPLE = 6_000
GRAPH_NEIGHBOURS = 10
PART_ROWS = 1_000
MAX_PARTS = 256
HIDDEN = 128
EPOCHS = 30

# Queries on which recall is measured for the number of probes, and the recall to reach.
MEASURED = 200
RECALL = 0.97

BLOCK_ROWS = 8_000
BLOCK_QUERIES = 2_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def neighbour_graph(vectors: np.ndarray, k: int = GRAPH_NEIGHBOURS) -> np.ndarray:
    """The k nearest other rows of each row, by cosine, in blocks."""
    k = min(k, len(vectors) - 1)
    near = np.empty((len(vectors), k), np.int64)
    for start in range(0, len(vectors), 1_000):
        own = vectors[start : start + 1_000] @ vectors.T
        own[np.arange(len(own)), start + np.arange(len(own))] = -np.inf
        near[start : start + len(own)] = np.argpartition(-own, k - 1, axis=1)[:, :k] if k else 0
    return near


def balanced_parts(near: np.ndarray, vectors: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Part of each row: nearly equal parts with many graph edges inside.

    Starts from balanced clusters; then rows move, those that gain most first, to the
    part of most of their neighbours while it has room.
    """
    size = len(near)
    room = -(-size * 21 // (20 * parts))
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(size, parts, replace=False)]
    part = np.zeros(size, np.int64)
    for _ in range(8):
        part = _fill(vectors @ centres.T, room)
        for p in range(parts):
            own = vectors[part == p].sum(axis=0)
            centres[p] = own / max(np.linalg.norm(own), 1e-12)
    for _ in range(20):
        edges = np.zeros((size, parts))
        np.add.at(edges, (np.repeat(np.arange(size), near.shape[1]), part[near].ravel()), 1)
        np.add.at(edges, (near.ravel(), np.repeat(part, near.shape[1])), 1)
        gain = edges - edges[np.arange(size), part][:, None]
        held = np.bincount(part, minlength=parts)
        moved = 0
        for row in np.argsort(-gain.max(axis=1), kind="stable"):
            open_gain = np.where(held < room, gain[row], -np.inf)
            target = int(np.argmax(open_gain))
            if open_gain[target] <= 0:
                continue
            held[part[row]] -= 1
            held[target] += 1
            part[row] = target
            moved += 1
        if moved < size // 200:
            break
    return part


def _fill(score: np.ndarray, room: int) -> np.ndarray:
    """Best part for each row with at most ``room`` rows a part, clearest choices first."""
    order = np.argsort(-score, axis=1)
    part, held = np.full(len(score), -1), np.zeros(score.shape[1], np.int64)
    for row in np.argsort(-score.max(axis=1), kind="stable"):
        target = next(p for p in order[row] if held[p] < room)
        part[row] = target
        held[target] += 1
    return part


class Router(NamedTuple):
    """A network with one hidden layer that gives the chance of each part."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        return np.maximum(vectors @ self.hidden + self.hidden_bias, 0) @ self.output + self.output_bias

    def parts(self, vectors: np.ndarray, probes: int = 1) -> np.ndarray:
        """Most probable parts of each row, best first; ties to the smaller number."""
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")[:, :probes]

    @classmethod
    def fit(cls, vectors: np.ndarray, answers: np.ndarray, seed: int = 7) -> Router:
        """Adam on the cross entropy to soft answers."""
        rng = np.random.default_rng(seed)
        width, parts = vectors.shape[1], answers.shape[1]
        values = [
            rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)),
            np.zeros(parts),
        ]
        means, squares, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(len(vectors)), max(1, len(vectors) // 128)):
                inner = np.maximum(vectors[rows] @ values[0] + values[1], 0)
                logits = inner @ values[2] + values[3]
                chance = np.exp(logits - logits.max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
                error = (chance - answers[rows]) / len(rows)
                back = (error @ values[2].T) * (inner > 0)
                gradients = [vectors[rows].T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0)]
                step += 1
                for value, mean, square, gradient in zip(values, means, squares, gradients):
                    mean += 0.1 * (gradient - mean)
                    square += 0.001 * (gradient * gradient - square)
                    value -= 0.003 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        return cls(*values)


def fit_router(vectors: np.ndarray, parts: int) -> Router:
    """Router over a balanced partition of the vectors' neighbour graph."""
    vectors = unit(vectors)
    near = neighbour_graph(vectors)
    part = balanced_parts(near, vectors, parts)
    answers = np.zeros((len(vectors), parts))
    rows = np.arange(len(vectors))
    answers[rows, part] += 1
    np.add.at(answers, (np.repeat(rows, near.shape[1]), part[near].ravel()), 1)
    return Router.fit(vectors, answers / answers.sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    """Rows of a list column as doubles."""
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def _route_batches(batches, router, probes: int):
    """Each row once for each of its most probable parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = np.asarray(batch.column("vector").flatten(), np.float64).reshape(batch.num_rows, -1)
        parts = router.value.parts(unit(vectors), probes)
        rows = pa.array(np.repeat(np.arange(len(parts)), parts.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [*[c.take(rows) for c in batch.columns], pa.array(parts.ravel(), pa.int32())],
            names=[*batch.schema.names, "part"],
        )


def best_rows(queries: np.ndarray, vectors: np.ndarray, ids: list, keep: int) -> list[list[tuple[float, int]]]:
    """For each query the ``keep`` best (score, id), ids of a vector in order, ties to smaller ids."""
    scores = unit(queries) @ unit(vectors).T
    size = min(keep, scores.shape[1])
    found = []
    for own in scores:
        least = np.partition(own, len(own) - size)[len(own) - size]
        ranked = [(-own[row], i) for row in np.flatnonzero(own >= least) for i in ids[row]]
        ranked.sort()
        found.append([(-score, i) for score, i in ranked[:keep]])
    return found


def _search_block(queries: pd.DataFrame, rows: pd.DataFrame, keep: int) -> pd.DataFrame:
    found = []
    if len(queries) and len(rows):
        found = best_rows(_matrix(queries["vector"]), _matrix(rows["vector"]), rows["ids"].tolist(), keep)
    flat = [pair for own in found for pair in own]
    return pd.DataFrame(
        {
            "query": np.repeat(queries["rep"].to_numpy(np.int64)[: len(found)], [len(own) for own in found]),
            "score": np.array([score for score, _ in flat], np.float64),
            "near": np.array([i for _, i in flat], np.int64),
        }
    )


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of rows that can be compared: the commonest length, no null, no
    non-finite component, not all zero, and an id. Ties of length go to the longer one."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("vector") == (first["size"] if first else 0))


def _blocks(counts: DataFrame, limit: int) -> dict[int, int]:
    """Number of blocks of each part; there are ``MAX_PARTS`` parts at most."""
    return {r["part"]: -(-r["count"] // limit) for r in counts.collect()}


def _blocks_here(blocks: dict[int, int]) -> Column:
    """Number of blocks of a row's part."""
    sizes = F.create_map(*[F.lit(x) for pair in (blocks or {-1: 1}).items() for x in pair])
    return F.coalesce(F.element_at(sizes, F.col("part")), F.lit(1))


def _block_of(blocks: dict[int, int]) -> Column:
    """Block of a row in its part, by hash."""
    return F.pmod(F.xxhash64("rep"), _blocks_here(blocks)).cast("int")


def _every_block(blocks: dict[int, int]) -> Column:
    return F.explode(F.sequence(F.lit(0), _blocks_here(blocks) - 1))


def nearest(
    embeddings: DataFrame, every: int = QUERY_EVERY, neighbours: int = NEIGHBOURS, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score): nearest other rows of each row whose id is divisible by ``every``.

    Scores are cosines in double precision; ties go to the smaller id. Vectors that are
    null, zero, hold null or non-finite components, or differ in length from most take no
    part. Rows that repeat an id with the same vector count once; with other vectors each
    is a row. All candidates are returned if there are fewer, none for a lone vector or an
    empty table. Further columns are ignored.
    """
    keep = neighbours + 1  # a query may find itself
    rows = stage(valid_vectors(embeddings).distinct(), "vectors")
    # Equal vectors are one; its smallest ids are all that can be among the nearest.
    order = Window.partitionBy("vector").orderBy("vec_id")
    ids = (
        rows.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= keep)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    reps = stage(ids.select(F.monotonically_increasing_id().alias("rep"), "vector", "ids"), "reps")
    asked = rows.where(F.col("vec_id") % every == 0)
    members = asked.join(reps.select("rep", "vector"), "vector").select("vec_id", "rep")
    members = stage(members, "members")
    queries = reps.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "vector")
    queries = stage(queries, "queries")

    size = reps.count()
    if not size:
        return members.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    parts = min(MAX_PARTS, -(-size // PART_ROWS))
    sample = reps.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toPandas()
    router = fit_router(_matrix(sample["vector"]), min(parts, len(sample)))
    probes = _enough_probes(reps, queries, router, keep, recall)
    sent = embeddings.sparkSession.sparkContext.broadcast(router)
    kinds = "rep bigint, vector array<double>"
    placed = reps.mapInArrow(
        functools.partial(_route_batches, router=sent, probes=1), f"{kinds}, ids array<bigint>, part int"
    )
    sought = queries.mapInArrow(
        functools.partial(_route_batches, router=sent, probes=probes), f"{kinds}, part int"
    )
    placed, sought = stage(placed, "placed"), stage(sought, "sought")

    row_blocks = _blocks(placed.groupBy("part").count(), BLOCK_ROWS)
    query_blocks = _blocks(sought.groupBy("part").count(), BLOCK_QUERIES)

    keys = ["part", "block", "turn"]
    held = placed.withColumn("block", _block_of(row_blocks)).withColumn("turn", _every_block(query_blocks))
    visits = sought.withColumn("turn", _block_of(query_blocks)).withColumn("block", _every_block(row_blocks))
    found = (
        visits.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInPandas(
            functools.partial(_search_block, keep=keep),
            "query bigint, score double, near bigint",
        )
    )
    # A query gets ``keep`` rows from each block that it visits.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "near")
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
    pairs = members.join(top, F.col("rep") == F.col("query")).where("near <> vec_id")
    last = Window.partitionBy("vec_id").orderBy(F.desc("score"), "near")
    return (
        pairs.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= neighbours)
        .select(F.col("vec_id").alias("query_id"), "rank", F.col("near").alias("vec_id"), "score")
    )


def _measure_batches(batches, router, queries, keep: int):
    """Best rows of this batch for every measured query: (query, score, place of its part)."""
    wanted, places = queries.value
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = unit(np.asarray(batch.column("vector").flatten(), np.float64).reshape(batch.num_rows, -1))
        part = router.value.parts(vectors)[:, 0]
        scores = wanted @ vectors.T
        size = min(keep, scores.shape[1])
        top = np.argpartition(-scores, size - 1, axis=1)[:, :size]
        query = np.repeat(np.arange(len(wanted)), size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query, pa.int32()),
                pa.array(scores[query, top.ravel()]),
                pa.array(places[query, part[top.ravel()]], pa.int32()),
            ],
            names=["query", "score", "place"],
        )


def _enough_probes(reps: DataFrame, queries: DataFrame, router: Router, keep: int, recall: float) -> int:
    """Fewest probes that find the wanted share of the measured queries' true nearest rows."""
    chosen = queries.orderBy(F.xxhash64("rep"), "rep").limit(MEASURED).toPandas()
    if not len(chosen):
        return 1
    wanted = unit(_matrix(chosen["vector"]))
    places = np.argsort(np.argsort(-router.logits(wanted), axis=1, kind="stable"), axis=1)
    context = reps.sparkSession.sparkContext
    best = reps.select("vector").mapInArrow(
        functools.partial(
            _measure_batches, router=context.broadcast(router), queries=context.broadcast((wanted, places)), keep=keep
        ),
        "query int, score double, place int",
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "place"))
    true = best.withColumn("rank", rank).where(F.col("rank") <= keep).groupBy("place").count().collect()
    counts = np.zeros(places.shape[1])
    for row in true:
        counts[row["place"]] = row["count"]
    return int(np.searchsorted(np.cumsum(counts) / counts.sum(), recall)) + 1
