from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clickloom.llm import packing, tokens
from clickloom.llm.binary import exported
from clickloom.llm.elias_fano import EliasFano
from clickloom.llm.packing import pack
from clickloom.llm.tokens import Encoder

from .samples import sentences, varied


@pytest.fixture(scope="module")
def encode(tokenizer):
    model = Tokenizer.from_file(tokenizer)
    return lambda text, end: [*model.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_read_back_what_was_encoded(spark, documents, tokenizer, encode):
    texts = varied(8, 12)
    want, start = [], 0
    for doc, text in enumerate(texts, 1):
        ids = encode(text, 2)
        want.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    got = exported(documents(*texts), tokenizer).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_no_documents_no_files(spark, documents, tokenizer):
    assert exported(documents("x").limit(0), tokenizer).collect() == []
    assert pack(documents("x").limit(0), tokenizer).collect() == []


def test_pieces_hold_every_id_once_and_leave_no_gap(spark, documents, tokenizer, encode):
    texts = varied(9, 12)
    got = pack(documents(*texts), tokenizer).collect()
    ids = {doc: encode(text, 0) for doc, text in enumerate(texts, 1)}
    seen, sequences = {}, {}
    for r in got:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length > 0
        assert r.ids_crc32 == crc(piece) and r.doc_tokens == len(ids[r.doc_id])
        assert bytes(r.ids) == np.array(piece, "<u4").tobytes()
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen.keys() == ids.keys()
    for doc, pieces in seen.items():
        assert sum(n for _, n in pieces) == len(ids[doc])
    total = sum(map(len, ids.values()))
    assert sorted(sequences) == list(range(-(-total // 1024)))
    for number, pieces in sequences.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == 1024 or number == max(sequences)


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 1 << 40], list(range(0, 9000, 3))])
def test_elias_fano_selects_what_was_stored(values):
    kept = EliasFano.from_bytes(EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert kept.select(0, len(values)).tolist() == values
    for i in range(0, len(values), 97):
        assert kept.select(i).tolist() == [values[i]]


class Counted:
    """A pattern that counts the characters it looks through."""

    def __init__(self, pattern):
        self.pattern, self.seen = pattern, 0

    def findall(self, text):
        self.seen += len(text)
        return self.pattern.findall(text)


def test_words_that_come_often_are_cut_once(tokenizer, encode):
    coder = Encoder(tokenizer)
    coder.PIECE = Counted(coder.PIECE)
    texts = [f"{sentences(i, 300)}, done." for i in range(40)]
    got = [np.frombuffer(ids, coder.dtype).tolist() for ids in coder.encode(pa.array(texts))]
    assert [[*ids, 2] for ids in got] == [encode(text, 2) for text in texts]
    assert coder.PIECE.seen < sum(map(len, texts)) // 5


@pytest.mark.parametrize("batch", [1 << 20, 40])
def test_white_space_of_any_kind_is_coded_as_the_library_does(tokenizer, encode, monkeypatch, batch):
    monkeypatch.setattr(tokens, "BATCH_BYTES", batch)
    monkeypatch.setattr(tokens, "BATCH_WORDS", batch // 10)
    monkeypatch.setattr(tokens, "CACHED_PIECES", batch)
    signs = [" ", " ", "  ", "\n", "\t", "\xa0", " ", "a", "it's", "w.", "12", "é", "日本", "<|endoftext|>", "x" * 60]
    pick = random.Random(4)
    texts = ["", " ", "  ", " a", "a ", "a  b", "a   b", "a\n b", "a \n", "a\n  b"]
    texts += ["".join(pick.choice(signs) for _ in range(pick.randrange(20))) for _ in range(2000)]
    coder = Encoder(tokenizer)
    got = [np.frombuffer(ids, coder.dtype).tolist() for ids in coder.encode(pa.array(texts))]
    assert [[*ids, 2] for ids in got] == [encode(text, 2) for text in texts]


class Task:
    """Stands for the context of the first task of a stage."""

    @staticmethod
    def get():
        return Task()

    def partitionId(self):
        return 0


def test_packing_takes_a_large_batch_in_small_parts(spark, documents, tokenizer, encode, monkeypatch):
    docs = documents("x")
    steps, run = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, f, kind: steps.append(f) or run(rows, f, kind))
    pack(docs, tokenizer)
    monkeypatch.setattr(packing, "TaskContext", Task)
    texts = [f"{i} {sentences(i, 3_000)}" for i in range(1_500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_500), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    assert batch.nbytes > 16_000_000
    coded = list(steps[0](iter([batch])))
    ids = pa.Table.from_batches(coded)
    assert max(b["ids"].nbytes for b in coded) < ids["ids"].nbytes / 2
    assert ids["doc_id"].to_pylist() == list(range(1_500))
    assert ids["before"].to_pylist() == [0, *np.cumsum(ids["n"].to_numpy())[:-1].tolist()]
    for i in (0, 700, 1_499):
        assert np.frombuffer(ids["ids"][i].as_py(), "<u2").tolist() == encode(texts[i], 0)
    placed = ids.rename_columns(["part", "at", *ids.column_names[2:]]).select(["doc_id", "ids", "n", "at"])
    cut = list(steps[1](iter(placed.combine_chunks().to_batches())))
    pieces = pa.Table.from_batches(cut)
    assert max(b.nbytes for b in cut) < pieces.nbytes / 2
    assert b"".join(pieces["ids"].to_pylist()) == np.frombuffer(b"".join(ids["ids"].to_pylist()), "<u2").astype("<u4").tobytes()


def test_distinct_words_are_coded_a_part_at_a_time(tokenizer, encode):
    coder = Encoder(tokenizer)
    most, code = [], coder._encode_pieces
    coder._encode_pieces = lambda pieces: most.append(len(pieces)) or code(pieces)
    texts = [" ".join(f"w{i}x" for i in range(a, a + 40_000)) for a in range(0, 160_000, 40_000)]
    got = [np.frombuffer(ids, coder.dtype).tolist() for ids in coder.encode(pa.array(texts))]
    assert [[*ids, 2] for ids in got] == [encode(text, 2) for text in texts]
    assert len(most) > 1 and max(most) <= 60_000
    assert len(coder.young) + len(coder.old) <= 350_000
