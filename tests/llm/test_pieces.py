"""SentencePiece coding against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from clickloom.llm import pieces as module
from clickloom.llm.pieces import Pieces, decode_pieces, encode_pieces
from clickloom.llm.queries import QUERIES, vocabulary

from .samples import varied


@pytest.fixture(scope="module")
def model():
    return vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_file=model)


def odd_texts(count):
    pick = random.Random(11)
    common = ["the ", "tion", "ing", " is", "a", "  ", "\n", "é", "在", "的", "<s>", "</s>", " ⁇ ", "▁", "\t"]
    points = [*range(1, 0xD800), *range(0xE000, 0x1FFFF)]
    for i in range(count):
        n = pick.randrange(60)
        yield (
            "".join(pick.choice(common) for _ in range(n)),
            "".join(chr(pick.choice(points)) for _ in range(n // 4)),
            " " * n + "a" * pick.randrange(50) + " " * pick.randrange(40) + "日",
            "".join(chr(pick.randrange(97, 123)) for _ in range(n)),
        )[i % 4]


def check(coder, library, texts):
    for text, raw in zip(texts, coder.encode(texts), strict=True):
        ids = np.frombuffer(raw, coder.dtype).tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True)
        assert coder.decode(ids) == library.decode(ids)


def test_ids_and_texts_are_those_of_the_library(model, library):
    check(Pieces(model), library, ["", " ", "  ", *odd_texts(4000)])


def test_long_words(model, library):
    pick = random.Random(12)
    letters = "".join(chr(pick.randrange(97, 123)) for _ in range(30_000))
    signs = "".join(chr(pick.randrange(0x4E00, 0x9FFF)) for _ in range(30_000))
    check(Pieces(model), library, ["a" * 50_000, " " * 50_000, "ab" * 20_000, letters, signs, "\n" * 3000])


def test_one_merge_at_a_time_gives_the_same_ids(model, library, monkeypatch):
    monkeypatch.setattr(module, "ROUNDS", 1)
    check(Pieces(model), library, list(odd_texts(500)))


def test_a_full_cache_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(module, "CACHED_WORDS", 5)
    monkeypatch.setattr(module, "BATCH_CHARS", 100)
    check(Pieces(model), library, list(odd_texts(500)))


def test_decodes_any_ids_as_the_library(model, library):
    pick, coder = random.Random(13), Pieces(model)
    for _ in range(5000):
        ids = [pick.choice([0, 1, 2, pick.randrange(3, 259), pick.randrange(32000)]) for _ in range(pick.randrange(12))]
        assert coder.decode(ids) == library.decode(ids)


def test_other_models_are_refused(tmp_path, model):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as file:
        spec.ParseFromString(file.read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="BPE"):
        Pieces(str(tmp_path / "other.model"))


def test_documents(spark, documents, model, library):
    texts = varied(14, 8)
    got = decode_pieces(encode_pieces(documents(*texts), model), model).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r.doc_id - 1] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.text == library.decode(want)
    assert encode_pieces(documents("x").limit(0), model).collect() == []


def test_null_ids_repeated_rows_and_clashing_columns(spark, model):
    rows = spark.createDataFrame(
        [(None, "one two", b"x", 1), (7, "one two", b"y", 2), (7, "one two", b"y", 2), (8, None, None, 3)],
        "doc_id long, text string, ids binary, n_tokens long",
    )
    got = encode_pieces(rows, model).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 4), (7, 4), (7, 4), (8, 2)]
    nothing = spark.createDataFrame([(1, None, None)], "doc_id long, n_tokens long, ids binary")
    assert decode_pieces(nothing, model).first().text is None


def test_query(spark, library, tmp_path, documents):
    texts = ["Hello  wörld \U0001f600\n", None, "", "▁x"]
    documents(*texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_sentencepiece"](spark, str(tmp_path)).collect()}
    for doc, text in enumerate(texts, 1):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
