"""Merge-type pieces: the same ids and text as the sentencepiece library gives."""

import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.llm import pieces

PATH = P.path("piece_bpe_32k.model")
MODEL = pieces.PieceModel.load(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "   ", "▁", "▁a", " ▁ ", "a  b", "\n\n \t", "\x00x", "héllo wörld", "中文字 テスト", "🎉👩‍👩‍👧", "12345 a1b2", "x" * 5000, " " * 3000 + "a", "<0x41>", "<s> </s> <unk>", "a　b", "￿", "é"]


@pytest.mark.parametrize("text", ODD)
def test_like_the_library(text):
    ids = MODEL.encode(text)
    assert ids == LIBRARY.encode(text)
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" ▁aeinrst'\n!1é日", max_size=80))
def test_any_text(text):
    ids = MODEL.encode(text)
    assert ids == LIBRARY.encode(text)
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 299) | st.integers(0, 31_999), max_size=12))
def test_any_ids(ids):
    """Broken and split bytes, begin and end, unknown."""
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_bounded_memory(monkeypatch):
    """Small memos and windows of places change no id."""
    monkeypatch.setattr(pieces, "CHUNK_LIMIT", 5)
    monkeypatch.setattr(pieces, "PAIR_LIMIT", 7)
    monkeypatch.setattr(pieces, "PLACES", 3)
    model = pieces.PieceModel(PATH)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("abcdefghiß  中") for _ in range(rng.randint(1, 60)))
        assert model.encode(text) == LIBRARY.encode(text)



def test_backtracking_by_small_vocabulary():
    """Over a vocabulary whose longest matches mislead, the pieces are those of plain merging."""
    model = object.__new__(pieces.PieceModel)
    model.__dict__.update(MODEL.__dict__)
    score = {"a": 0.0, "b": 0.0, "ab": -1.0, "ba": -2.0, "aba": -3.0, "bab": -4.0, "abab": -5.0, "aa": -2.0, "abba": -6.0}
    model.ids, model.score = {t: i for i, t in enumerate(score)}, score
    model.shorter, model.whole, model.fitting, model.longest_piece = {}, {}, {}, 4
    import ahocorasick

    model.automaton = ahocorasick.Automaton()
    for t in score:
        model.automaton.add_word(t[::-1], t)
    model.automaton.make_automaton()
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        assert model.pieces(text) == model.merged(text)


def test_documents(spark):
    rows = [(1, "hello world"), (2, None), (3, ""), (4, "x" * 9000 + " ende"), (None, "no id"), (1, "hello world")]
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id bigint, text string, ids string, n_tokens int")
    got = pieces.encode_documents(docs, PATH, keep_ids=True).collect()
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "")
        text = LIBRARY.decode(ids)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert pieces.encode_documents(docs.limit(0), PATH).count() == 0


def test_query(spark):
    got = {r.doc_id: r for r in pieces.op11_pieces(spark, "/root/testdata/sf0.001").collect()}
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(texts)
    for t in texts:
        ids = LIBRARY.encode(t.text or "")
        assert (got[t.doc_id].n_tokens, got[t.doc_id].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[t.doc_id].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
