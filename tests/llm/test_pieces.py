from __future__ import annotations

import hashlib
import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from text_cases import ODD, no_documents, odd_documents  # noqa: E402

from clickloom.llm import pieces, queries  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "e", "n", "th", " ", "  ", "é", "\n", "中", "\U0001f600", "1", "▁", "ing", "\t"]
PARTS += ["aaaa", "=", "<0x0A>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(pieces.Vocabulary.read(MODEL))


def test_random_texts(library, codec):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choices(codec.vocabulary.pieces, k=8)).replace("▁", " ") for _ in range(3000)]
    texts += ["a" * n for n in range(70)] + [" " * n for n in range(70)]
    for text in texts:
        ids = library.encode(text, add_eos=True)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids), text


def test_any_ids(library, codec):
    rng = random.Random(6)
    for _ in range(1000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_odd_rows(spark, library):
    found = pieces.encode_documents(odd_documents(spark), MODEL).collect()
    want = [(i, library.encode(t or "", add_eos=True)) for i, t in ODD]
    assert sorted((str(r.doc_id), r.ids) for r in found) == sorted((str(i), ids) for i, ids in want)
    assert all(r.decoded == library.decode(r.ids) for r in found)
    assert pieces.encode_documents(no_documents(spark), MODEL).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op5_piece_codec(spark, folder).collect():
        ids = library.encode(texts[row.doc_id] or "", add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
