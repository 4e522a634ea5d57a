import random

import public_tokenizers
import pytest
import tiktoken

from cases import TEXTS, documents, plain
from martbrook.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(None, PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_as_the_library(ranks, library):
    encoder, pick = bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(2)
    signs = ["a", "b", "the", "ing", " ", " ", "  ", "\n", "\t", "\r", "é", "中", "😀", "1", "23", "!", "'s", "'ll", "Q", "\x00", "ſ", " ", "=-"]
    for _ in range(5000):
        text = "".join(pick.choice(signs) for _ in range(pick.randint(0, 14)))
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)
        assert encoder.decode(encoder.encode(text).tolist()) == text.encode()
    for _ in range(20000):
        text = "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(2, 14)))
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 50_000, "=-" * 20_000, "é" * 20_000, "ab" * 20_000])
def test_long_pieces_take_linear_time(ranks, text):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    ids = encoder.piece_ids(text)
    assert encoder.decode(ids) == text.encode()
    assert all(encoder.compatible(a, b) for a, b in zip(ids, ids[1:]))


def test_small_memos_change_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "PAIRS", 3)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    encoder.pieces.most = 4
    text = "thereof whereupon notwithstanding inasmuch " * 20
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    assert len(encoder.pieces) <= 4


def test_a_worker_keeps_the_memos_of_one_job(ranks):
    class Shared:
        value = ranks

    one, other = Shared(), Shared()
    first = bpe._encoder(("a", public_tokenizers.PATTERN), one)
    ids = first.encode("thereof whereupon").tolist()
    assert first.pieces and bpe._encoder(("a", public_tokenizers.PATTERN), one) is first
    second = bpe._encoder(("a", public_tokenizers.PATTERN), other)
    assert not (first.pieces or first.pieces.old or first.fits or first.old_fits)
    assert second.encode("thereof whereupon").tolist() == first.encode("thereof whereupon").tolist() == ids


def test_awkward_texts(spark, tmp_path, library):
    words = bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    docs = documents(spark, folder=tmp_path)
    encoded = bpe.encode(docs, words)
    assert plain(encoded) == [(i, library.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)]
    assert [bytes(r[1]) for r in plain(bpe.decode(encoded, words), "doc_id", "decoded")] == [(t or "").encode() for t in TEXTS]
    both = bpe.encode(docs, words, decoded=True)
    assert plain(both, "doc_id", "ids") == plain(encoded)
    assert [bytes(r[1]) for r in plain(both, "doc_id", "decoded")] == [(t or "").encode() for t in TEXTS]
    assert bpe.decode(bpe.encode(documents(spark, [], folder=tmp_path), words), words).count() == 0
    twice = bpe.encode(documents(spark, ["a b", "a b"], [None, None], tmp_path), words)
    assert plain(twice) == [(None, library.encode_ordinary("a b"))] * 2
    nothing = bpe.decode(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>"), words)
    assert bytes(nothing.first().decoded) == b""
