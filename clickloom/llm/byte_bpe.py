"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library works on characters, a rank file on bytes. Each byte therefore has a visible
character of its own; the tokens of the rank file are spelled in these characters, and
every split of a token into two tokens is a merge with the rank of the token. So the
library merges the same pairs in the same order as one that works on bytes. Decoding goes
from ids to spelled tokens, back through the byte table, and only then to text, because a
character may be split over several tokens.

No piece of the split pattern goes on from a character into white space, so a text is
cut there into words with the white space before them, and a word that was encoded before
is remembered.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import int_lists, runs, sliced

# Longest part of a text, in characters, that is encoded at once; one run without a place
# to cut stays whole.
PART_CHARACTERS = 1 << 16

# Ids of consecutive rows that are decoded at once.
SLICE_IDS = 1 << 18

# Remembered words, twice so many at most, and the length of the longest.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 48

# Where a text may be cut, and the words between the cuts. Other white space than the four
# common kinds is left inside words: what counts as white space beyond them may differ
# from library to library.
CUT = re.compile(r"\S[ \n\t\r]")
# A run of letters is a word without the common marks behind it.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
WORD = re.compile(rf"\s*[{LETTERS}]+(?=[ \n.,;:!?]|$)|\s*\S+(?:[^\S \n\t\r]\s*\S*)*|\s+")


def byte_table() -> list[str]:
    """A visible character for each byte: itself in Latin-1, or one from U+0100 on."""
    shown = [chr(b).isprintable() and not chr(b).isspace() for b in range(256)]
    rest = iter(range(256, 512))
    return [chr(b) if shown[b] else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in id order; ids have to be 0, 1, 2 and so on."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [base64.b64decode(token) for token, _ in sorted(pairs, key=lambda pair: int(pair[1]))]
    if sorted(int(rank) for _, rank in pairs) != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks are not consecutive")
    if not {bytes([b]) for b in range(256)} <= set(tokens):
        raise ValueError(f"{path}: some bytes have no token")
    return tokens


def merges_of(tokens: Sequence[bytes]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens that make a token, earliest merge first."""
    known = set(tokens)
    return [
        (token[:at], token[at:])
        for token in tokens
        for at in range(1, len(token))
        if token[:at] in known and token[at:] in known
    ]


class Known(dict):
    """Ids of words, as bytes of 32-bit numbers; a word that is not there gets encoded."""

    def __init__(self, library):
        self.library = library
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.library.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class ByteCodec:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, tokens: Sequence[bytes], pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        table = byte_table()
        spell = {token: "".join(table[b] for b in token) for token in tokens}
        model = models.BPE(
            {spell[token]: number for number, token in enumerate(tokens)},
            [(spell[a], spell[b]) for a, b in merges_of(tokens)],
            ignore_merges=True,  # a piece that is a token needs no merges
        )
        self.library = Tokenizer(model)
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        byte_of = {character: byte for byte, character in enumerate(table)}
        self.spelled = [self.library.id_to_token(number) for number in range(len(tokens))]
        self.bytes = [bytes(byte_of[c] for c in token) for token in self.spelled]
        self.known = Known(self.library)
        self.length = np.array([len(token) for token in self.bytes], np.int64)

    def encode_array(self, text: str | None, part: int = PART_CHARACTERS) -> np.ndarray:
        """Ids of a whole text; null counts as empty."""
        known = self.known.__getitem__
        made = [b"".join(map(known, WORD.findall(p))) for p in parts(text or "", part)]
        return np.frombuffer(b"".join(made), np.int32)

    def offsets(self, text: str | None, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character spans of the tokens; tokens that share a character all span it."""
        data = np.frombuffer((text or "").encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        end = np.cumsum(self.length[ids])
        start = end - self.length[ids]
        return character[start].astype(np.int32), (character[end - 1] + 1).astype(np.int32)

    def decode_bytes(self, ids: Sequence[int] | np.ndarray) -> bytes:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: Sequence[int]) -> str:
        """Text of any ids; bytes that are no whole character become U+FFFD."""
        return self.decode_bytes(ids).decode(errors="replace")


def parts(text: str, limit: int = PART_CHARACTERS) -> Iterator[str]:
    """Consecutive parts of a text that are encoded alike alone and together.

    Cuts are made before white space, at the first such place behind ``limit`` characters.
    """
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + limit)
        end = cut.start() + 1 if cut else len(text)
        yield text[at:end]
        at = end


_codecs: dict[int, ByteCodec] = {}


def codec(tokens: Sequence[bytes], pattern: str) -> ByteCodec:
    """The codec of a rank file, made once in a process."""
    key = hash((pattern, *tokens))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteCodec(tokens, pattern)
    return _codecs[key]


def _encode_batches(batches, sent, pattern: str):
    bpe = codec(sent.value, pattern)
    for batch in batches:
        for part in sliced(batch, "text"):
            texts = part.column("text").to_pylist()
            ids = [bpe.encode_array(text) for text in texts]
            spans = [bpe.offsets(text, i) for text, i in zip(texts, ids)]
            sizes = [len(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *[
                        int_lists(np.concatenate(lists), sizes, pa.int32())
                        for lists in (ids, [s[0] for s in spans], [s[1] for s in spans])
                    ],
                ],
                names=["doc_id", "ids", "starts", "ends"],
            )


def _decode_batches(batches, sent, pattern: str, carried: list[str]):
    bpe = codec(sent.value, pattern)
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
        for start, end in runs(sizes, SLICE_IDS):
            part = batch.slice(start, end - start)
            ids = pc.fill_null(part.column("ids"), []).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes[start:end])
            blobs = [bpe.decode_bytes(row) for row in np.split(ids, ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in carried], pa.array(blobs, pa.binary())],
                names=[*carried, "decoded"],
            )


def encode_documents(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids, starts, ends): ids of every whole text and their character spans.

    ``ranks`` is the path of a rank file on the driver, which is read there and sent to
    the tasks (its size is the vocabulary's); each match of ``pattern`` is merged on its
    own. There are no special tokens. Null text counts as empty: no ids. Rows are encoded
    one by one, repeated ids too; no rows give no rows; further columns are ignored. A
    text is encoded in parts, so memory follows its ids, not the library's objects.
    """
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    return documents.mapInArrow(
        functools.partial(_encode_batches, sent=sent, pattern=pattern),
        f"doc_id {dict(documents.dtypes)['doc_id']}, ids array<int>, starts array<int>, ends array<int>",
    )


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """All columns of ``encoded`` with ``decoded``, the bytes that its ``ids`` stand for.

    Null ids count as none. The bytes of all ids of a row are joined before anything
    reads them as text, so characters split over tokens come out whole; ids that are not
    from a text may give bytes that are no text. An id that is not in the rank file is an
    error. A column ``decoded`` of the input is replaced.
    """
    carried = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join(f"`{c}` {kind}" for c, kind in encoded.dtypes if c in carried)
    sent = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    return encoded.select(*carried).mapInArrow(
        functools.partial(_decode_batches, sent=sent, pattern=pattern, carried=carried),
        f"{schema}, decoded binary",
    )
