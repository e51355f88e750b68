import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from sheafmill.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_random_texts(coder, reference):
    rng = random.Random(2)
    letters = "abcdehilnorst THEan éüñß\n\t0123456789.,!?-'’漢字🙂½²\x00"
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert coder.encode(t).tolist() == reference.encode_ordinary(t)
    for _ in range(200):
        t = "".join(chr(rng.choice((rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)))) for _ in range(40))
        assert coder.encode(t).tolist() == reference.encode_ordinary(t)


@pytest.mark.parametrize("text", ["a" * 4000, "ab" * 3000, "the" * 2000, " " * 3000, "é" * 900, "<|endoftext|>", "abcdefghij" * 20000])
def test_long_pieces(coder, reference, text):
    assert coder.encode(text).tolist() == reference.encode_ordinary(text)


def test_backtracking_is_what_merging_gives(coder):
    rng = random.Random(4)
    for _ in range(800):
        piece = "".join(rng.choice("abcdefinorstuy ") for _ in range(rng.randint(1, 25)))
        assert coder.backtrack(piece) == bpe.merge(coder.ranks, piece.encode())


def test_memo_is_bounded(coder, monkeypatch, reference):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 50)
    monkeypatch.setattr(bpe, "MEMO_PAIRS", 50)
    text = " ".join(f"word{i}x{i * 7}" for i in range(500))
    assert coder.encode(text).tolist() == reference.encode_ordinary(text)
    assert len(coder) <= 51 and len(coder.pairs) <= 51


def test_round_trip(docs, corpus, reference):
    tokens = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    rows = tokens.collect()
    assert len(rows) == len(corpus) + 1
    assert all(r.ids == reference.encode_ordinary(corpus[r.doc_id] or "") for r in rows)
    assert all(bytes(r.bytes).decode() == (corpus[r.doc_id] or "") for r in bpe.decode(tokens, PATH).collect())


def test_empty(empty):
    assert bpe.decode(bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).count() == 0
