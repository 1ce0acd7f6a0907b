"""Folds, batch slicing and word hashing shared by the operators."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handled at once; a longer text is handled alone. Of it, arrays with a few bytes for
# each byte are made at once, larger ones in pieces.
SLICE_BYTES = 1 << 20
PIECE_BYTES = 1 << 20

MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(id_column: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % folds


def plain(column) -> pa.Array:
    """One array with 64-bit offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows (start, end) whose sizes add up to about ``limit``, one row at least."""
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
    for start, end in zip([0, *edges], [*edges, len(sizes)]):
        if end > start:
            yield start, end


def sliced(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for start, end in runs(sizes, limit):
        yield batch.slice(start, end - start)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dicts, made one at a time, for rows that hold large blobs."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, for places within a piece."""
    tables = []
    for base in (MULTIPLIER, INVERSE):
        steps = np.full(PIECE_BYTES + 1, base, np.uint64)
        steps[0] = 1
        tables.append(np.cumprod(steps))
    return tuple(tables)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values) -> np.ndarray:
    """Polynomial hash of the bytes of each span; spans ascend and do not overlap.

    ``values`` gives 64-bit numbers for bytes. The hash does not depend on where a span
    stands. Bytes are taken in pieces; a span that goes on in the next piece is carried.
    """
    power, inverse = _power_tables()
    found = np.zeros(len(start), np.uint64)
    for low in range(0, len(data), PIECE_BYTES):
        high = min(low + PIECE_BYTES, len(data))
        at = slice(np.searchsorted(end, low, "right"), np.searchsorted(start, high))
        if at.start >= at.stop:
            continue
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values(data[low:high]) * power[: high - low], out=sums[1:])
        first, last = np.maximum(start[at], low) - low, np.minimum(end[at], high) - low
        part = (sums[last] - sums[first]) * inverse[first]
        if start[at.start] < low:  # only the first span can have begun before
            part[:1] *= np.uint64(pow(MULTIPLIER, int(low - start[at.start]), 1 << 64))
        found[at] += part
    return mix(found)


def span_counts(marked: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Number of marked places in each span; spans ascend and do not overlap."""
    found = np.zeros(len(start), np.int64)
    for low in range(0, len(marked), PIECE_BYTES):
        high = min(low + PIECE_BYTES, len(marked))
        at = slice(np.searchsorted(end, low, "right"), np.searchsorted(start, high))
        if at.start < at.stop:
            sums = np.zeros(high - low + 1, np.int32)
            np.cumsum(marked[low:high], out=sums[1:])
            found[at] += sums[np.minimum(end[at], high) - low] - sums[np.maximum(start[at], low) - low]
    return found


def _byte_values(data: np.ndarray) -> np.ndarray:
    return data.astype(np.uint64) + np.uint64(1)


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return data + ((data >= 65) & (data <= 90)).view(np.uint8) * np.uint8(32)


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins and the last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of places that are inside, none over two texts."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Words(NamedTuple):
    """Words of several texts: byte span in ``data``, text number and 64-bit hash of each."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    count: np.ndarray
    stems: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Number of the first word of each text, and the number of all words."""
        return np.concatenate([[0], np.cumsum(self.count)])


def words_of(
    texts: pa.Array, lower: bool = True, letters: bool = False, stems: tuple = (), digits: bool = False
) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts, A-Z lower-cased if asked.

    With ``letters``, words are runs of ASCII letters and of characters beyond ASCII; with
    ``digits``, too, of ASCII digits as well.
    ``stems`` are numbers of leading bytes that get hashes, too (rows of ``Words.stems``).

    The hash is polynomial over the bytes, then mixed; it does not depend on where the
    word stands. Different words share a hash with a chance of about 2**-64 a pair.
    """
    texts = plain(texts)
    data, offsets = _text_bytes(texts)
    if lower:
        data = _lowered(data)
    if letters:
        inside = (data >= 128) | (((data | 32) >= 97) & ((data | 32) <= 122))
        if digits:
            inside |= (data >= 48) & (data <= 57)
    else:
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    start, end = _runs(inside, offsets)
    doc = np.searchsorted(offsets, start, "right") - 1
    hashed = span_hashes(data, start, end, _byte_values)
    leading = [span_hashes(data, start, np.minimum(end, start + n), _byte_values) for n in stems]
    return Words(data, start, end, doc, hashed, np.bincount(doc, minlength=len(texts)), np.array(leading))


def int_lists(values: np.ndarray, lengths, kind=pa.int64()) -> pa.Array:
    """A list column from concatenated values and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind, safe=False))


class Lines(NamedTuple):
    """Lines of several texts: byte span, stripped span, text number, length and key hashes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    second: np.ndarray
    count: np.ndarray


def lines_of(texts: pa.Array) -> Lines:
    """Lines of texts split at \\n; an empty text is one empty line.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
    lower-cased; ``length`` is its number of code points, ``hash`` and ``second`` are two
    independent 64-bit hashes of it.
    """
    texts = plain(texts)
    data, offsets = _text_bytes(texts)
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    count = np.bincount(owner, minlength=len(texts)) + 1
    first = np.cumsum(count) - count
    start, end = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
    at = np.arange(len(breaks)) + owner
    start[first], start[at + 1] = offsets[:-1], breaks + 1
    end[first + count - 1], end[at] = offsets[1:], breaks

    begins, ends = _runs(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)
    low, high = np.searchsorted(begins, start), np.searchsorted(ends, end, "right")
    filled = high > low
    key_start, key_end = start.copy(), start.copy()  # of a blank line: nothing, where it begins
    key_start[filled], key_end[filled] = begins[low[filled]], ends[high[filled] - 1]

    lowered = _lowered(data)
    hashes = [
        span_hashes(lowered, key_start, key_end, values)
        for values in (_byte_values, lambda piece: mix(_byte_values(piece)))
    ]
    return Lines(
        data,
        start,
        end,
        np.repeat(np.arange(len(texts)), count),
        span_counts((data & 0xC0) != 0x80, key_start, key_end),
        *hashes,
        count,
    )
