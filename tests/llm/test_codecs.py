import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from support import ROWS, documents, empty
from tokenizers import Tokenizer

from millrace.llm import sentencepiece_codec as codec
from millrace.llm.piece_bpe import piece_bpe
from millrace.llm import word_bpe as word_bpe_module
from millrace.llm.word_bpe import word_bpe

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from(" \n▁.,0aeinrst"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_as_the_library(library, text):
    ids = library.encode(text)
    assert piece_bpe(PIECES).encode(text) == ids
    assert piece_bpe(PIECES).decode(ids) == library.decode(ids)


def test_pieces_joined_at_random(library):
    bpe, rng = piece_bpe(PIECES), random.Random(5)
    known = [p.replace("▁", " ") for p in bpe.id_of]
    for _ in range(4000):
        text = "".join(rng.choices(known, k=rng.randint(1, 6)))
        assert bpe.encode(text) == library.encode(text), text
    for n in range(120):
        for text in (" " * n, " " * n + "the", "a" + " " * n + "é b"):
            assert bpe.encode(text) == library.encode(text), text


def test_prefix_table_as_the_merges():
    bpe, rng = piece_bpe(PIECES), random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choices("abcdehinorstu", k=rng.randint(1, 14)))
        assert [bpe.pieces[i] for i in bpe._recover(text, bpe._prefix_table(text))] == bpe._merged(text)


def test_full_caches_change_nothing(library, monkeypatch):
    from millrace.llm import piece_bpe as module

    monkeypatch.setattr(module, "CACHE", 3)
    bpe = module.PieceBPE(PIECES)
    text = "one two three four five six seven one two three"
    assert bpe.encode(text) == library.encode(text)


def test_decode_any_ids(library):
    rng = random.Random(8)
    for _ in range(500):
        ids = [rng.randrange(3, 32000) if rng.random() < 0.6 else rng.randrange(3, 259) for _ in range(rng.randint(0, 12))]
        assert piece_bpe(PIECES).decode(ids) == library.decode(ids), ids


def test_round_trip_of_odd_rows(spark, library):
    out = codec.round_trip(documents(spark), PIECES).collect()
    wanted = []
    for doc, text, *_ in ROWS:
        ids = library.encode(text or "")
        wanted.append((doc, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))))
    assert sorted(map(tuple, out), key=str) == sorted(wanted, key=str)
    assert codec.round_trip(empty(spark), PIECES).count() == 0


def test_encode_then_decode(spark, library):
    docs = documents(spark)
    back = codec.decode(codec.encode(docs, PIECES), PIECES).collect()
    assert sorted([(r.doc_id, r.text) for r in back], key=str) == sorted([(d, library.decode(library.encode(t or ""))) for d, t, *_ in ROWS], key=str)


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from(" \n'<|>.,0aestlmv\x1c\x85　É"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_words_as_the_library(words, text):
    assert np.frombuffer(word_bpe(WORDS).encode(text), "<u4").tolist() == words.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [None, "", " ", "<|endoftext|>", "a<|startoftext|>b", "It's we'll I'd '''s !'s", "ÉCOLE ß İ ŉ Σ ΑΣ", "á é"])
def test_words_odd(words, text):
    assert np.frombuffer(word_bpe(WORDS).encode(text), "<u4").tolist() == words.encode(text or "", add_special_tokens=False).ids


def test_many_words_at_once_as_one_by_one(words, monkeypatch):
    texts = ["the", "The,", "it's!!", "  two words\n", "", "ÉCOLE", "<|endoftext|>", "x" * 100, "a\x1cb", "the", "日本語 thé"]
    for size in (1_000_000, 2):
        monkeypatch.setattr(word_bpe_module, "CACHE", size)
        bpe = word_bpe_module.WordBPE(WORDS)
        for _ in range(3):
            assert [np.frombuffer(ids, "<u4").tolist() for ids in bpe.many(texts)] == [words.encode(t, add_special_tokens=False).ids for t in texts]
            assert [bpe.encode(t) for t in texts] == bpe.many(texts)
