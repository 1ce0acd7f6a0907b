"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a text, BPE ends in one certain piece. The table holds that piece:
an automaton gives the pieces that end at a place, and the right one is the piece that is
compatible with the last piece of the prefix before it. Two neighbouring pieces are
compatible if merging their characters would never have merged across their border; this
is found by undoing the merges of both, latest first, and looking for a piece that joins
what then stands at the border and comes earlier. From the last piece of the whole text,
the pieces are recovered backwards.

No piece has a space mark behind another character, so merges never cross into a space
mark, and each run of marks with the characters behind it is encoded on its own and
remembered. So are runs of line breaks and tabs, which are in no piece.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import int_lists, sliced

MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# Remembered words: twice so many at most, of at most so many characters.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 48

# Remembered pairs of pieces.
PAIRS = 1 << 18

NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Vocabulary(NamedTuple):
    """Pieces of a model in id order, with their scores and types, and the end id."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    end: int

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Vocabulary of a BPE model with byte fallback and no text normalization."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if (
            model.trainer_spec.model_type != proto.TrainerSpec.BPE
            or not model.trainer_spec.byte_fallback
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not normal.add_dummy_prefix
            or not normal.escape_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix
            or any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces)
        ):
            raise ValueError(f"{path}: only plain BPE models with byte fallback are supported")
        return cls(
            [p.piece for p in model.pieces],
            [p.score for p in model.pieces],
            [p.type for p in model.pieces],
            model.trainer_spec.eos_id,
        )


class PieceCodec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        pieces, types = vocabulary.pieces, vocabulary.types
        self.ids = {p: i for i, p in enumerate(pieces) if types[i] == NORMAL}
        order = sorted({-s for s, t in zip(vocabulary.scores, types) if t == NORMAL})
        place = {score: n for n, score in enumerate(order)}
        # When a piece is merged; characters are there before all merges.
        self.time = [
            -1 if len(p) == 1 or t != NORMAL else place[-s]
            for p, s, t in zip(pieces, vocabulary.scores, types)
        ]
        self.bytes = {int(BYTE_PIECE.fullmatch(p)[1], 16): i for i, p in enumerate(pieces) if types[i] == BYTE}
        self.parts: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            last = self._last_merge(piece)
            if len(piece) > 1 and last is None:
                continue  # BPE never ends in this piece
            self.parts[i] = last or (i, i)
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.by_words = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        # White space in no piece becomes bytes, which nothing merges with.
        bare = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        breaks = f"[{bare}]+|" if bare else ""
        self.words = re.compile(f"{breaks}{MARK}+[^{MARK}{bare}]*|[^{MARK}{bare}]+")
        # Ids as bytes of 32-bit numbers, which are cheap to join.
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.ending = array("i", [vocabulary.end]).tobytes()
        self.pairs: dict[int, bool] = {}
        self.output = [
            b"" if t == CONTROL else bytes([int(BYTE_PIECE.fullmatch(p)[1], 16)]) if t == BYTE
            else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode()
            for p, t in zip(pieces, types)
        ]

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """Ids of the two pieces that BPE merges last; None if it does not reach the piece."""
        if any(c not in self.ids for c in piece):
            return None
        symbols = [self.ids[c] for c in piece]
        last = None
        while len(symbols) > 1:
            texts = [self.vocabulary.pieces[s] for s in symbols]
            merges = [
                (self.time[m], n, m)
                for n, pair in enumerate(zip(texts, texts[1:]))
                if (m := self.ids.get(pair[0] + pair[1])) is not None
            ]
            if not merges:
                return None
            _, n, m = min(merges)
            last = symbols[n], symbols[n + 1]
            symbols[n : n + 2] = [m]
        return last

    def _compatible(self, left: int, right: int) -> bool:
        """Whether both pieces survive next to each other."""
        pieces, time, parts = self.vocabulary.pieces, self.time, self.parts
        limit = len(pieces)
        while True:
            joined = self.ids.get(pieces[left] + pieces[right])
            if joined is not None and time[joined] < limit:
                return False
            if time[left] > time[right]:
                # A merge of the same piece across the border comes after this one.
                limit = time[left]
                left = parts[left][1]
            elif time[right] >= 0:
                # A merge of the same piece across the border comes before this one.
                limit = time[right] + 1
                right = parts[right][0]
            else:
                return True

    def _prefix_table(self, word: str) -> list[int]:
        """Last piece of each prefix; -1 where it ends in a character without a piece."""
        last = [-1] * (len(word) + 1)
        pairs, size = self.pairs, len(self.time)
        for end, (length, piece) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length]
            if before >= 0:
                pair = before * size + piece
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self._compatible(before, piece)
                if not fits:
                    continue
            last[end] = piece
        return last

    def _encode_word(self, word: str) -> bytes:
        last, pieces = self._prefix_table(word), self.vocabulary.pieces
        ids: list[int] = []
        at = len(word)
        while at:
            piece = last[at]
            if piece < 0:
                ids += [self.bytes[b] for b in reversed(word[at - 1].encode("utf-8", "replace"))]
                at -= 1
            else:
                ids.append(piece)
                at -= len(pieces[piece])
        ids.reverse()
        return array("i", ids).tobytes()

    def _word(self, word: str) -> bytes:
        found = self.older.get(word) or self._encode_word(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.recent) >= REMEMBERED:
                self.recent, self.older = {}, self.recent
            self.recent[word] = found
        return found

    def encode_array(self, text: str | None) -> np.ndarray:
        """Ids of a text (null: of an empty one), then the end id."""
        parts = []
        if text:
            marked = MARK + text.replace(" ", MARK)
            words = self.words.findall(marked) if self.by_words else [marked]
            make = self._word
            parts = [self.recent.get(w) or make(w) for w in words]
        parts.append(self.ending)
        return np.frombuffer(b"".join(parts), np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_array(text).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD one by one."""
        blob = b"".join(map(self.output.__getitem__, ids))
        first = next((i for i in ids if self.vocabulary.types[i] != CONTROL), None)
        if first is not None and self.vocabulary.pieces[first].startswith(MARK):
            blob = blob[1:]
        try:
            return blob.decode()
        except UnicodeDecodeError:
            return _lenient(blob)


def _lenient(blob: bytes) -> str:
    made, at = [], 0
    while at < len(blob):
        for width in (1, 2, 3, 4):
            try:
                made.append(blob[at : at + width].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            made.append("�")
            width = 1
        at += width
    return "".join(made)


_codecs: dict[int, PieceCodec] = {}


def codec(vocabulary: Vocabulary) -> PieceCodec:
    """The codec of a vocabulary, made once in a process."""
    key = hash((vocabulary.end, *vocabulary.pieces))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = PieceCodec(vocabulary)
    return _codecs[key]


def _codec_batches(batches, carried: list[str], vocabulary):
    pieces = codec(vocabulary.value)
    for batch in batches:
        for part in sliced(batch, "text"):
            ids = [pieces.encode_array(t) for t in part.column("text").to_pylist()]
            sizes, flat = [len(i) for i in ids], np.concatenate(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in carried],
                    int_lists(flat, sizes, pa.int32()),
                    pa.array([pieces.decode(i.tolist()) for i in ids], pa.string()),
                ],
                names=[*carried, "ids", "decoded"],
            )


def encode_documents(documents: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded): ids of every whole text with the end id, and their text.

    ``model`` is the path of a vocabulary file on the driver, which is read there and sent
    to the tasks. Null text counts as empty: the end id alone. Rows are encoded one by
    one, repeated ids too; no rows give no rows; further columns are ignored.
    """
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(Vocabulary.read(model))
    return documents.mapInArrow(
        functools.partial(_codec_batches, carried=["doc_id"], vocabulary=sent),
        f"doc_id {dict(documents.dtypes)['doc_id']}, ids array<int>, decoded string",
    )
