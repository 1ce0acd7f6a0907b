"""Best-fit packing of documents into sequences, with conflicts.

A bin holds at most one document of a source and at most one of a duplicate cluster. Open
bins are ordered by the room they have left; each keeps a bitmap of its sources and one of
its clusters. A document goes to the tightest bin that has room and no conflict: the
search starts at the document's own length and goes on to the next larger room until a
compatible bin is found; a new bin is opened if there is none. Bins with equal room and
equal sources stand together, so a source in a third of all documents is passed over
in one step for each set of sources, not bin by bin.

Documents are packed in shards of bounded size, longest first. Shards are cut by hash, so
no source, cluster or id range loads one of them.
"""

from __future__ import annotations

import functools
import hashlib
from bisect import insort
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import set_join
from clickloom.llm.common import sliced, words_of
from clickloom.sources.shared import stage

CAPACITY = 2048
SHARD_ROWS = 2_000

PACKED = (
    "pack_id bigint, position int, start bigint, doc_id bigint, source string, "
    "chunk int, first_token bigint, n_tokens bigint"
)


class Bins:
    """Open bins ordered by room, with best-fit search under conflicts."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sources: list[int] = []
        self.clusters: list[int] = []
        # For each room left: bins in order, by their sources.
        self.by_room: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
        self.occupied = 0

    def _find(self, size: int, source: int, cluster: int) -> tuple[int, int] | None:
        """(room, bin) of the tightest compatible bin, the earliest one at a tie."""
        rest = self.occupied >> size << size
        while rest:
            low = rest & -rest
            room = low.bit_length() - 1
            best = None
            for sources, bins in self.by_room[room].items():
                if sources & source:
                    continue
                fit = next((b for b in bins if not self.clusters[b] & cluster), None)
                if fit is not None and (best is None or fit < best):
                    best = fit
            if best is not None:
                return room, best
            rest ^= low
        return None

    def add(self, size: int, source: int = 0, cluster: int = 0) -> int:
        """Number of the bin that the document goes to."""
        found = self._find(size, source, cluster)
        if found:
            room, number = found
            group = self.by_room[room][self.sources[number]]
            group.remove(number)
            if not group:
                del self.by_room[room][self.sources[number]]
                if not self.by_room[room]:
                    self.occupied ^= 1 << room
        else:
            room, number = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        left = room - size
        if left:
            insort(self.by_room[left].setdefault(self.sources[number], []), number)
            self.occupied |= 1 << left
        return number


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs more than once; none for null and single values."""
    counts = Counter(values)
    places: dict = {}
    return [
        1 << places.setdefault(v, len(places)) if v is not None and counts[v] > 1 else 0 for v in values
    ]


def _pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "cluster", "source", "n_tokens"], ignore_index=True, na_position="first")
    sources = [None if pd.isna(s) else s for s in rows["source"]]
    source_bits, cluster_bits = _bits(sources), _bits(rows["cluster"].tolist())
    sizes = rows["n_tokens"].to_numpy(np.int64)
    rest = sizes % capacity
    bins = Bins(capacity)
    placed = []
    for row in np.argsort(-rest, kind="stable"):
        if rest[row]:
            number = bins.add(int(rest[row]), source_bits[row], cluster_bits[row])
            placed.append((number, row, sizes[row] // capacity, rest[row]))
    number = len(bins.sources)
    for row in np.flatnonzero(sizes >= capacity):  # full chunks fill a bin each
        for chunk in range(sizes[row] // capacity):
            placed.append((number, row, chunk, capacity))
            number += 1
    at = np.array(placed, np.int64).reshape(-1, 4)
    at = at[np.argsort(at[:, 0], kind="stable")]
    first = np.searchsorted(at[:, 0], at[:, 0])
    before = np.concatenate([[0], np.cumsum(at[:, 3])])
    shard = int(rows["shard"].iloc[0])
    return pd.DataFrame(
        {
            "pack_id": (shard << 32) + at[:, 0],
            "position": np.arange(len(at)) - first,
            "start": before[:-1] - before[first],
            "doc_id": rows["doc_id"].to_numpy()[at[:, 1]],
            "source": [sources[row] for row in at[:, 1]],
            "chunk": at[:, 2],
            "first_token": at[:, 2] * capacity,
            "n_tokens": at[:, 3],
        }
    )


def _measure_batches(batches):
    for batch in batches:
        for part in sliced(batch, "text"):
            words = words_of(part.column("text"))
            digests = [
                hashlib.blake2b(words.hash[a:b].tobytes(), digest_size=16).hexdigest() if b > a else None
                for a, b in zip(words.first[:-1], words.first[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("source"),
                    pa.array(words.count + 1),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "source", "n_tokens", "cluster"],
            )


def _near_measured(docs: DataFrame, width: int, similarity: int) -> DataFrame:
    """Sizes of texts with their components of near copies; the join counts the words it reads."""
    found = set_join.jaccard_components(docs, width, similarity, sized=True, by_first=True)
    cluster = F.when(F.col("n_shingles") > 0, F.col("component_id").cast("string"))
    return found.select("doc_id", "source", (F.col("n_words") + 1).alias("n_tokens"), cluster.alias("cluster"))


def pack_documents(
    documents: DataFrame,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
    cluster: str | None = None,
    near: tuple[int, int] | None = None,
) -> DataFrame:
    """One row for each document, or each chunk of one, with its place in a pack.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` and one end for each text, so null and empty
    texts take one token. A text longer than ``capacity`` is cut: its full chunks fill
    packs of their own, the rest is packed. Columns: pack_id, position in the pack, start
    (tokens before it in the pack), doc_id, source, chunk, first_token (in the text),
    n_tokens. ``cluster`` names a column with duplicate clusters; without it, texts with
    the same words, A-Z lower-cased, are a cluster, and texts without words are in none.
    ``near`` (words a shingle, similarity in per cent) makes clusters of near copies instead:
    the components that the Jaccard join finds. A component of rows without an id is none.
    Null sources and clusters conflict with nothing. Repeated rows are packed each; no
    rows give no rows; further columns are ignored.
    """
    own = F.lit(None).cast("string") if cluster is None else F.col(cluster).cast("string")
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
        own.alias("given"),
    )
    if near is not None:
        measured = _near_measured(docs, *near)
    elif cluster is None:
        measured = docs.drop("given").mapInArrow(
            _measure_batches, "doc_id bigint, source string, n_tokens bigint, cluster string"
        )
    else:
        words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+"))
        measured = docs.select(
            "doc_id", "source", (F.coalesce(words, F.lit(0)) + 1).cast("bigint").alias("n_tokens"),
            F.col("given").alias("cluster"),
        )
    measured = stage(measured, "measured")
    shards = max(1, -(-measured.count() // shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)).cast("int")
    return (
        measured.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(functools.partial(_pack_shard, capacity=capacity), PACKED)
    )
