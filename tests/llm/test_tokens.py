"""SentencePiece and packing against the libraries, text by text."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
import tokenizers
from pyspark.sql import functions as F
from small_corpus import frame, texts, words

from tablesync.llm import packing, pieces
from tablesync.session import Scratch

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "Bc", "é", " ", "  ", "\n", "\t", "'s", "1", "...", "\x1c", "\x85", "\xa0", "²", "日", "▁", "\x00", "ﬁ"]


def given() -> list[str | None]:
    rng = random.Random(3)
    return texts() + ["".join(rng.choices(PARTS, k=rng.randint(1, 12))) for _ in range(500)]


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.with_pieces(frame(spark, given()), PIECES).orderBy("doc_id").collect()
    for row, text in zip(rows, given(), strict=True):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(row.ids, "<u4").tolist() == ids, repr(text)[:100]
        assert row.decoded == library.decode(ids)
    digest = pieces.report(frame(spark, ["a b"]), PIECES).first()
    ids = library.encode("a b", add_bos=True, add_eos=True)
    assert digest.n_tokens == len(ids)
    assert digest.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_a_full_table_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_CHARS", 20)
    monkeypatch.setattr(packing, "TABLE_CHARS", 20)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table, byte_words = pieces.ChunkTable(PIECES), packing.WordTable(BYTES)
    whole = tokenizers.Tokenizer.from_file(BYTES)
    for text in filter(None, given()[:40]):
        assert np.frombuffer(table.encode(text)[0], "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert byte_words.encode(text)[:-1].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_empty_and_repeated(spark):
    assert pieces.report(frame(spark, []), PIECES).collect() == []
    assert len(pieces.report(frame(spark, ["x", "x"], [None, None]), PIECES).collect()) == 2
    scratch = Scratch(spark)
    assert packing.packed(frame(spark, []), scratch, BYTES).collect() == []
    scratch.clear()


def test_packing_is_a_round_trip(spark):
    rng = random.Random(8)
    given_texts = given() + [words(rng, 40)] * 300
    ids_of = list(range(len(given_texts)))
    ids_of[-2:] = [None, 5]
    whole = tokenizers.Tokenizer.from_file(BYTES)
    scratch = Scratch(spark)
    rows = packing.packed(frame(spark, given_texts, ids_of), scratch, BYTES).collect()
    scratch.clear()
    want = {}
    for i, text in zip(ids_of, given_texts):
        want.setdefault(i, []).append(whole.encode(text or "", add_special_tokens=False).ids + [0])
    sequences, documents = {}, {}
    for row in rows:
        ids = np.frombuffer(row.ids, "<u2")
        assert len(ids) == row.length and zlib.crc32(ids.astype("<u4").tobytes()) == row.ids_crc32
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
        documents.setdefault(row.doc_id, []).append((row.start, ids.tolist(), row.doc_tokens))
    for i, pieces_of in documents.items():
        if len(want[i]) == 1:
            joined = sum((ids for _, ids, _ in sorted(pieces_of)), [])
            assert joined == want[i][0] and {n for _, _, n in pieces_of} == {len(joined)}
    assert documents.keys() == want.keys()
    assert sum(r.length for r in rows) == sum(len(x) for many in want.values() for x in many)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == packing.WINDOW or (at < packing.WINDOW and at & (at - 1) == 0)


def test_scores_are_bm25():
    class Known:
        mean, idf = 4.0, np.linspace(0.5, 2.0, 1 << 16, dtype=np.float32)

    units = [np.array(u, np.uint16) for u in ([1, 2, 2, 3], [2, 9], [3, 3, 3, 40, 41, 42], [7])]
    shard = packing.Shard(units, Known)
    for seed in range(4):
        for other in range(4):
            score = sum(
                Known.idf[t] * f * (packing.K1 + 1)
                / (f + packing.K1 * (1 - packing.B + packing.B * len(units[other]) / Known.mean))
                for t in set(units[seed].tolist())
                if (f := units[other].tolist().count(t))
            )
            assert abs(shard.scores(seed)[other] - score) < 1e-5


def test_used_units_leave_the_index():
    """Entries of used units go, and the scores of the others stay as they are."""

    class Known:
        mean, idf = 40.0, np.linspace(0.5, 2.0, 1 << 16, dtype=np.float32)

    rng = np.random.default_rng(2)
    units = [rng.integers(1, 60, 40).astype(np.uint16) for _ in range(32)]
    shard, whole = packing.Shard(units, Known), packing.Shard(units, Known)
    left = np.array([0 if i % 2 else 40 for i in range(32)])
    unused = shard.unused(left)
    assert unused.tolist() == list(range(0, 32, 2)) and len(shard.unit) < len(whole.unit)
    for seed in range(32):
        assert (shard.scores(seed)[unused] == whole.scores(seed)[unused]).all()


@pytest.mark.parametrize("text", ["a\x1cb \x1f c", "it's  'll 12a\n\n b\t", "x" * 5 + " " * 9, "\x00\x7f ~!"])
def test_ascii_rule_is_the_whole_rule(text):
    assert packing.ASCII_WORD.findall(text) == packing.WORD.findall(text)


def test_theme_is_the_two_heaviest_terms():
    corpus = packing.Corpus.__new__(packing.Corpus)
    corpus.idf = np.ones(1 << 16, np.float32)
    for ids, want in [([5], (5, 5)), ([9, 4, 9], (9, 4)), ([7, 3, 5], (3, 5)), ([2, 8, 8, 2, 1], (2, 8))]:
        assert corpus.theme(np.array(ids, "<u2").tobytes()) == want


def test_neighbours_share_windows():
    class Known:
        mean, idf = 300.0, np.ones(1 << 16, np.float32)

    rng = np.random.default_rng(1)
    units = [rng.integers(1000 * (i % 3) + 1, 1000 * (i % 3) + 900, 256).astype(np.uint16) for i in range(24)]
    windows = packing.pack_units(units, Known)
    assert all(len({unit % 3 for unit, _, _ in window}) == 1 for window in windows)


@pytest.mark.parametrize("kind", ["smallint", "date", "decimal(12,2)", "string", "int"])
def test_packing_takes_keys_of_any_type(spark, kind):
    rows = spark.createDataFrame([("2024-01-05", "some text"), (None, "more")], "doc_id string, text string")
    key = F.year("doc_id") if kind in ("smallint", "int", "decimal(12,2)") else F.col("doc_id")
    rows = rows.withColumn("doc_id", key.cast(kind))
    scratch = Scratch(spark)
    found = packing.packed(rows, scratch, BYTES)
    assert found.schema["doc_id"].dataType == rows.schema["doc_id"].dataType
    keys = {r.doc_id for r in found.collect()}
    assert keys == {r.doc_id for r in rows.collect()}
    scratch.clear()
