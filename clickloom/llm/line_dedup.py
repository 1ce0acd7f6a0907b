"""Removal of lines that many documents share, by a sharded minimal perfect hash.

Rows are written once as blocks of about ``BLOCK_BYTES`` of text. A block sends each
distinct key of its long lines, with the number of documents and the largest id in the
block, to a shard by hash range. A shard adds up over all blocks, keeps the keys of
enough documents, and builds a minimal perfect hash over them: a few bit arrays that
give each key a slot of its own, and by slot a fingerprint, the document count and the
largest id. Blocks then probe the arrays: the slot of a line's hash either holds its
fingerprint or the line is not frequent. No lines are joined, and a line costs one
entry per block, in however many documents it stands.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.llm.common import lines_of, mix, rows_of, sliced
from clickloom.sources.shared import stage

MIN_POINTS = 40
MIN_DOCUMENTS = 5
BLOCK_BYTES = 4 << 20
SHARD_ENTRIES = 1 << 20

LEVELS = 48
NO_ID = np.iinfo(np.int64).min

REQUESTS = "block bigint, shard int, keys binary, documents binary, listed binary, owners binary"
INDEX = "shard int, sizes array<bigint>, levels binary, fingerprints binary, counts binary, owners binary"
ANSWERS = "block bigint, keys binary, owners binary"


class MinimalPerfectHash:
    """Slots 0..n-1 for n distinct 128-bit keys.

    Each level is a bit array in which a key's bit is set if it alone falls there; keys
    that collide go on to the next level. A key's slot is the number of set bits before
    its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    @staticmethod
    def _place(first, second, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0xA24BAED4963EE407 % (1 << 64))
        spread = mix(first ^ seed) + second * (seed | np.uint64(1))
        return ((mix(spread) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> MinimalPerfectHash:
        levels = []
        while len(first):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(64, len(first) * 3 // 2)
            place = cls._place(first, second, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            rest = ~alone[place]
            first, second = first[rest], second[rest]
        return cls(levels)

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for keys that were not built in."""
        found = np.full(len(first), -1)
        todo, base = np.arange(len(first)), 0
        for level, alone in enumerate(self.levels):
            place = self._place(first[todo], second[todo], level, len(alone))
            rank = np.cumsum(alone)
            hit = alone[place]
            found[todo[hit]] = base + rank[place[hit]] - 1
            todo, base = todo[~hit], base + rank[-1]
        return found


def _rows_to_blocks(batches):
    """Whole rows as compressed Arrow streams of about ``BLOCK_BYTES`` of text."""

    def one(parts):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, parts[0].schema) as writer:
            for part in parts:
                writer.write_batch(part)
        packed = zstandard.compress(sink.getvalue(), 1)
        return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["rows"])

    parts, size = [], 0
    for batch in batches:
        for part in sliced(batch, "text"):
            parts.append(part)
            size += part.nbytes
            if size >= BLOCK_BYTES:
                yield one(parts)
                parts, size = [], 0
    if parts:
        yield one(parts)


def _parts(blob: bytes):
    """Batches of a block, each with its lines and ids; NO_ID for a null id."""
    with pa.ipc.open_stream(zstandard.decompress(blob)) as reader:
        for batch in reader:
            ids = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            yield batch, lines_of(batch.column("text")), ids


def _request_batches(batches, shards: int, min_points: int, min_documents: int):
    for batch in batches:
        for row in rows_of(batch):
            firsts, seconds, ids = [], [], []
            for _, lines, doc_ids in _parts(row["rows"]):
                wanted = (lines.length >= min_points) & (doc_ids[lines.doc] != NO_ID)
                firsts.append(lines.hash[wanted])
                seconds.append(lines.second[wanted])
                ids.append(doc_ids[lines.doc[wanted]])
            keys, documents, listed, owners = combine(
                *(np.concatenate(x) for x in (firsts, seconds, ids)), min_documents
            )
            shard = (keys[0] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
            edges = np.searchsorted(shard, np.arange(shards + 1))
            filled = np.flatnonzero(np.diff(edges))
            cuts = [slice(edges[s], edges[s + 1]) for s in filled]
            ends = np.concatenate([[0], np.cumsum(listed)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cuts), row["block"])),
                    pa.array(filled, pa.int32()),
                    pa.array([keys[:, c].tobytes() for c in cuts], pa.binary()),
                    pa.array([documents[c].astype(np.uint32).tobytes() for c in cuts], pa.binary()),
                    pa.array([listed[c].astype(np.uint8).tobytes() for c in cuts], pa.binary()),
                    pa.array([owners[ends[c.start] : ends[c.stop]].tobytes() for c in cuts], pa.binary()),
                ],
                names=["block", "shard", "keys", "documents", "listed", "owners"],
            )


def combine(first, second, ids, limit: int):
    """Distinct keys in order; of each, the number of ids, and its ``limit`` largest ids.

    Given for each key and id once or more; as (keys, ids of each, listed of each, listed
    ids). Of lists that were cut so, the union has ``limit`` ids if all ids were so many.
    """
    order = np.lexsort((~ids, second, first))
    first, second, ids = first[order], second[order], ids[order]
    new_key = np.ones(len(first), bool)
    new_key[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    fresh = new_key.copy()
    fresh[1:] |= ids[1:] != ids[:-1]
    first, second, ids, new_key = first[fresh], second[fresh], ids[fresh], new_key[fresh]
    at = np.flatnonzero(new_key)
    documents = np.diff(np.append(at, len(first)))
    rank = np.arange(len(first)) - np.repeat(at, documents)
    return np.stack([first[at], second[at]]), documents, np.minimum(documents, limit), ids[rank < limit]


def _keys(blobs) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, np.uint64).reshape(2, -1) for b in blobs], axis=1)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return keys[1] ^ mix(keys[0])


def _build_shard(requests, min_documents: int):
    """Arrays of one shard. Counts are of ids by block, so one in several blocks adds to each."""
    sent = _keys(requests["keys"])
    documents, listed, ids = (
        np.concatenate([np.frombuffer(b, kind) for b in requests[name]])
        for name, kind in (("documents", np.uint32), ("listed", np.uint8), ("owners", np.int64))
    )
    keys, _, listed, ids = combine(*np.repeat(sent, listed, axis=1), ids, min_documents)
    order = np.lexsort(sent[::-1])
    first = np.flatnonzero(np.append(True, (sent[:, order[1:]] != sent[:, order[:-1]]).any(axis=0))[: len(order)])
    documents = np.add.reduceat(documents[order].astype(np.int64), first) if len(first) else documents
    owners = ids[np.cumsum(listed) - listed]
    often = listed >= min_documents
    keys, documents, owners = keys[:, often], documents[often], owners[often]
    hashed = MinimalPerfectHash.build(*keys)
    slots = hashed.slots(*keys)
    order = np.argsort(slots)
    return pd.DataFrame(
        {
            "shard": requests["shard"].iloc[:1].tolist(),
            "sizes": [[len(level) for level in hashed.levels]],
            "levels": [b"".join(np.packbits(level).tobytes() for level in hashed.levels)],
            "fingerprints": [_fingerprint(keys)[order].tobytes()],
            "counts": [documents[order].astype(np.uint32).tobytes()],
            "owners": [owners[order].tobytes()],
        }
    )


def load_shard(row) -> tuple[MinimalPerfectHash, np.ndarray, np.ndarray]:
    """(hash, fingerprints, largest ids) of an index row."""
    levels, at = [], 0
    for size in row["sizes"]:
        width = -(-size // 8)
        bits = np.frombuffer(row["levels"], np.uint8, width, at)
        levels.append(np.unpackbits(bits, count=size).astype(bool))
        at += width
    return (
        MinimalPerfectHash(levels),
        np.frombuffer(row["fingerprints"], np.uint64),
        np.frombuffer(row["owners"], np.int64),
    )


def _probe_shard(requests, index):
    """Frequent keys of every block, as the arrays of the shard tell."""
    answers = []
    if len(index) and len(index["fingerprints"].iloc[0]):
        hashed, fingerprints, owners = load_shard(index.iloc[0])
    else:
        requests = requests.iloc[:0]
    for block, blob in zip(requests["block"], requests["keys"]):
        keys = _keys([blob])
        slots = hashed.slots(*keys)
        hit = (slots >= 0) & (fingerprints[slots] == _fingerprint(keys))
        if hit.any():
            answers.append((block, keys[:, hit].tobytes(), owners[slots[hit]].tobytes()))
    blocks, keys, owners = zip(*answers) if answers else ((), (), ())
    return pd.DataFrame(
        {
            "block": np.array(blocks, np.int64),
            "keys": np.array(keys, object),
            "owners": np.array(owners, object),
        }
    )


def _kept_batches(batches, schema: pa.Schema, min_points: int):
    """Rows of the blocks without the lines that are frequent and owned elsewhere."""
    for blocks in batches:
        for row in rows_of(blocks):
            answers = row["answers"] or []
            keys = _keys([a["keys"] for a in answers]) if answers else np.zeros((2, 0), np.uint64)
            owners = np.concatenate([np.frombuffer(a["owners"], np.int64) for a in answers] or [np.zeros(0, np.int64)])
            order = np.argsort(keys[0], kind="stable")
            keys, owners = keys[:, order], owners[order]
            for batch, lines, ids in _parts(row["rows"]):
                drop = np.zeros(len(lines.hash), bool)
                if len(owners):
                    long = np.flatnonzero(lines.length >= min_points)
                    at = np.searchsorted(keys[0], lines.hash[long])
                    ends = np.searchsorted(keys[0], lines.hash[long], "right")
                    while (open_ := at < ends).any():  # more than one turn only if first hashes collide
                        long, at, ends = long[open_], at[open_], ends[open_]
                        same = keys[1][at] == lines.second[long]
                        own = ids[lines.doc[long]]
                        drop[long] |= same & (owners[at] != own) & (own != NO_ID)
                        at = at + 1
                texts = batch.column("text").to_pylist()
                dropped = np.bincount(lines.doc[drop], minlength=len(texts))
                first = np.cumsum(lines.count) - lines.count
                for i in np.flatnonzero(dropped):
                    kept = [
                        line
                        for line, gone in zip(texts[i].split("\n"), drop[first[i] : first[i] + lines.count[i]])
                        if not gone
                    ]
                    texts[i] = "\n".join(kept)
                columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                columns["text"] = pa.array(texts, pa.string())
                columns["n_lines"], columns["n_dropped"] = pa.array(lines.count), pa.array(dropped)
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name].cast(f.type) for f in schema], schema=schema
                )


def _blocks(documents: DataFrame) -> DataFrame:
    blocks = documents.mapInArrow(_rows_to_blocks, "rows binary")
    return stage(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def dedup_lines(
    documents: DataFrame, min_points: int = MIN_POINTS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """All columns of the documents, the text without shared lines, n_lines and n_dropped.

    Texts are split at \\n; a null or empty text is one empty line, and a null text stays
    null. A line's key is the line without white space at both ends, A-Z lower-cased.
    Keys of ``min_points`` code points, found in ``min_documents`` different doc_ids, lose
    all their lines except in the largest doc_id that holds them (in all rows of that id,
    if it is repeated). A row without an id is no document: it does not count and keeps its
    lines. n_lines counts the lines before. An empty table gives no rows. Columns named
    n_lines or n_dropped are replaced.
    """
    docs = documents.drop("n_lines", "n_dropped").withColumn("text", F.col("text").cast("string"))
    added = [StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    schema = StructType([*docs.schema.fields, *added])
    blocks = _blocks(docs)
    spark = blocks.sparkSession
    sizes = blocks.agg(F.coalesce(F.sum(F.octet_length("rows")), F.lit(0))).first()[0]
    # A long line and its key take more than 40 bytes of a block, compressed or not.
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sizes // (MIN_POINTS * SHARD_ENTRIES)))
    requests = blocks.mapInArrow(
        functools.partial(
            _request_batches, shards=shards, min_points=min_points, min_documents=min_documents
        ),
        REQUESTS,
    )
    index = stage(
        requests.groupBy("shard").applyInPandas(
            functools.partial(_build_shard, min_documents=min_documents), INDEX
        ),
        "index",
    )
    answers = (
        requests.select("block", "shard", "keys")
        .groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInPandas(_probe_shard, ANSWERS)
    )
    replies = answers.groupBy("block").agg(F.collect_list(F.struct("keys", "owners")).alias("answers"))
    return blocks.join(replies, "block", "left").mapInArrow(
        functools.partial(_kept_batches, schema=to_arrow_schema(schema), min_points=min_points), schema
    )
