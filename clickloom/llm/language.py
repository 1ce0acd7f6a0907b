"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of 1 to 3 characters in order. A document's
own list is compared with each language's: every n-gram adds the number of places by
which it is out of place, or the length of the list if the language lacks it. The
language with the smallest sum wins.

N-grams lie within a word, with a space standing for its two edges. All of them follow
from the counts of (character before, letter, character after), one for each letter.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import fold, sliced

PROFILE = 300
SPACE = 32
BITS = 21
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def triples(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(code, text number) of (before, letter, after) for every letter, letters lower-cased."""
    codes = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) + 2 for c in codes], np.int64)
    joined = np.full(sizes.sum() + 1, SPACE, np.int64)
    start = np.cumsum(sizes) - sizes + 1
    for at, own in zip(start, codes):
        joined[at : at + len(own)] = own
    letter = _letters()[joined]
    joined[~letter] = SPACE
    at = np.flatnonzero(letter)
    code = (joined[at - 1] << (2 * BITS)) | (joined[at] << BITS) | joined[at + 1]
    return code, np.repeat(np.arange(len(texts)), sizes)[at]


def grams(code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of 1 to 3 characters and their counts, from distinct triples."""
    mask = (1 << BITS) - 1
    letter, after = (code >> BITS) & mask, code & mask
    ends = after == SPACE
    shorter = np.concatenate([letter, code >> BITS, (letter[ends] << BITS) | SPACE])
    weights = np.concatenate([counts, counts, counts[ends]])
    distinct, where = np.unique(shorter, return_inverse=True)
    summed = np.bincount(where, weights=weights, minlength=len(distinct)).astype(np.int64)
    return np.concatenate([code, distinct]), np.concatenate([counts, summed])


def ranking(code: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """N-grams of a text, most frequent first, ties by code."""
    found, counts = grams(*np.unique(code, return_counts=True))
    if len(found) > size:  # leave out what cannot be among the first ones
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.lexsort((found, -counts))][:size]


class Profiles(NamedTuple):
    """Languages, and for each n-gram of any profile its rank in each (or the list length)."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, lists: dict[str, np.ndarray], size: int = PROFILE) -> Profiles:
        languages = sorted(lists)
        every = np.unique(np.concatenate([lists[x] for x in languages] or [np.zeros(0, np.int64)]))
        ranks = np.full((len(every), len(languages)), -1, np.int64)
        for column, language in enumerate(languages):
            ranks[np.searchsorted(every, lists[language]), column] = np.arange(len(lists[language]))
        return cls(languages, every, ranks, size)

    def identify(self, own: np.ndarray) -> tuple[str, float]:
        """(language, score): the nearest profile, ties to the first name; 0 to 1, by distance."""
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = self.ranks[at]
        known = (self.grams[at] == own)[:, None] & (ranks >= 0)
        places = np.arange(len(own))[:, None]
        away = np.where(known, np.minimum(np.abs(ranks - places), self.size), self.size).sum(axis=0)
        best = int(np.argmin(away))
        return self.languages[best], 1.0 - float(away[best]) / (self.size * len(own))


def _count_batches(batches):
    """N-gram counts by language over the rows of a task."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for part in sliced(batch, "text"):
            languages = np.array(part.column("lang").to_pylist(), object)
            code, text = triples(part.column("text").to_pylist())
            for language in set(languages.tolist()):
                found, counts = np.unique(code[(languages == language)[text]], return_counts=True)
                if language in totals:
                    known, before = totals[language]
                    merged, where = np.unique(np.concatenate([known, found]), return_inverse=True)
                    weights = np.concatenate([before, counts])
                    found, counts = merged, np.bincount(where, weights=weights).astype(np.int64)
                totals[language] = found, counts
    for language, (code, counts) in totals.items():
        found, counts = grams(code, counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(found), pa.string()), pa.array(found), pa.array(counts)],
            names=["lang", "gram", "n"],
        )


def fit_profiles(documents: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles of all languages from all texts with a language.

    The driver gets ``size`` rows for each language.
    """
    known = documents.where("lang is not null and text is not null").select("lang", "text")
    counts = known.mapInArrow(_count_batches, "lang string, gram bigint, n bigint")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).toPandas()
    lists = {
        language: own.sort_values("rank")["gram"].to_numpy(np.int64) for language, own in top.groupby("lang")
    }
    return Profiles.of(lists, size)


def _identify_batches(batches, profiles):
    for batch in batches:
        for part in sliced(batch, "text"):
            code, text = triples(part.column("text").to_pylist())
            edges = np.searchsorted(text, np.arange(part.num_rows + 1))
            found = [
                profiles.value.identify(ranking(code[a:b], profiles.value.size))
                for a, b in zip(edges[:-1], edges[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )


def identify_languages(documents: DataFrame, held_fold: int = 0, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document, from its whole text alone.

    Profiles are learned from documents with a language whose crc32(doc_id as text)
    modulo ``folds`` is not ``held_fold``; a null doc_id learns. A text that is null or
    has no letter gets ``und`` and score 0, as all do if there is nothing to learn from.
    Equally near languages go to the first name. Rows are judged one by one; no rows give
    no rows; further columns are ignored.
    """
    docs = documents.select(
        "doc_id",
        F.coalesce(fold("doc_id", folds) == held_fold, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    profiles = fit_profiles(docs.where("not held_out"))
    sent = docs.sparkSession.sparkContext.broadcast(profiles)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.drop("lang").mapInArrow(
        functools.partial(_identify_batches, profiles=sent),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double",
    )
