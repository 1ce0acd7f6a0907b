"""Token counts of sections by offset-mapped attribution.

A document is encoded once, whole, since cutting it first would change its tokens. The
character spans of its tokens are then joined with the spans of its sections, both in
order, and every token is given to one section by a rule:

* ``most``: the section with most of the token's characters, the earlier one at a tie;
* ``first``: the section with the token's first character.

A character belongs to each token that holds one of its bytes. Sections are sentences
with the white space behind them; lines end sentences, too. Tokens often start with a
space, so the first token of a sentence mostly starts in the one before.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import sliced

RULES = ("most", "first")
SENTENCE_END = re.compile(r"[.!?]+[^\S\n]+|\n")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a vocabulary file of one base64 token and id a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(i) for token, i in map(bytes.split, file)}


class SpanEncoder:
    """Encoder that also gives the characters that each token covers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first character, character after the last) of the tokens of a text."""
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self.width[ids])
        data = np.frombuffer(text.encode(), np.uint8)
        # Number of the character that each byte belongs to.
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        start = character[ends - self.width[ids]] if len(ids) else ends
        stop = character[ends - 1] + 1 if len(ids) else ends
        return ids, start, stop


def sentence_ends(text: str) -> np.ndarray:
    """Character after the last of each sentence; an empty text has one empty sentence."""
    ends = [match.end() for match in SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array(ends, np.int64)


def attribute(start: np.ndarray, stop: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section, whether the token crosses a border) of tokens with the given spans.

    ``ends`` are the ends of sections that follow each other from character 0. Both lists
    are in order, so the join is a search for both ends of each token.
    """
    low = np.searchsorted(ends, start, "right")
    high = np.searchsorted(ends, stop - 1, "right")
    crosses = high > low
    section = low.copy()
    if rule == "most" and crosses.any():
        # The sections between are shorter than the token, so this loop is short.
        most = np.minimum(stop, ends[low]) - start
        for step in range(1, int((high - low).max()) + 1):
            at = np.flatnonzero(low + step <= high)
            own = low[at] + step
            share = np.minimum(stop[at], ends[own]) - ends[own - 1]
            better = share > most[at]
            section[at[better]], most[at[better]] = own[better], share[better]
    return section, crosses


@functools.lru_cache(maxsize=1)
def _encoder(ranks: tuple, pattern: str) -> SpanEncoder:
    return SpanEncoder(dict(ranks), pattern)


def _count_batches(batches, vocabulary, pattern: str, rule: str):
    encoder = _encoder(vocabulary.value, pattern)
    for batch in batches:
        for part in sliced(batch, "text"):
            rows, sections, characters, tokens, crossing, totals = [], [], [], [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                ids, start, stop = encoder.spans(text or "")
                ends = sentence_ends(text or "")
                section, crosses = attribute(start, stop, ends, rule)
                size = len(ends)
                rows.append(np.full(size, row))
                sections.append(np.arange(size))
                characters.append(np.diff(ends, prepend=0))
                tokens.append(np.bincount(section, minlength=size))
                crossing.append(np.bincount(section[crosses], minlength=size))
                totals.append(np.full(size, len(ids)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(np.concatenate(rows))),
                    *[
                        pa.array(np.concatenate(values).astype(np.int64))
                        for values in (sections, characters, tokens, crossing, totals)
                    ],
                ],
                names=["doc_id", "section", "n_chars", "n_tokens", "n_crossing", "doc_tokens"],
            )


def section_tokens(documents: DataFrame, vocabulary: str, pattern: str, rule: str = "most") -> DataFrame:
    """(doc_id, section, n_chars, n_tokens, n_crossing, doc_tokens) for every sentence of every text.

    n_tokens counts the tokens given to the sentence, n_crossing those of them that reach
    into another one, doc_tokens all tokens of the text, which its sentences add up to.
    ``vocabulary`` is a file on the driver, which is read there and sent to the tasks. Null
    counts as empty: one sentence without tokens. A sentence may get no token, if others
    hold most of its characters. Rows are encoded one by one, repeated ids too; no rows give no
    rows; further columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    ranks = tuple(sorted(read_ranks(vocabulary).items(), key=lambda entry: entry[1]))
    sent = documents.sparkSession.sparkContext.broadcast(ranks)
    return documents.mapInArrow(
        functools.partial(_count_batches, vocabulary=sent, pattern=pattern, rule=rule),
        f"doc_id {dict(documents.dtypes)['doc_id']}, section bigint, n_chars bigint, n_tokens bigint, "
        "n_crossing bigint, doc_tokens bigint",
    )
