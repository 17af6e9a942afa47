"""Operator 8 on pieces of any length: equal to the library, in linear-logarithmic time, with a byte-bounded memory."""

import base64
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from landfall.llm import byte_bpe


@pytest.fixture(scope="module")
def codec():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return byte_bpe.Codec(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(codec, text):
    ids, at = codec.encode([text.encode()])
    return ids[at[0]:at[1]].tolist()


LETTERS = "etaoinshrdlucmfwypvbgkjqxz"


@pytest.mark.parametrize("make", [
    lambda r: "".join(r.choices(LETTERS, k=3_000)), lambda r: "a" * 5_001, lambda r: "ab" * 2_000 + "a",
    lambda r: "".join(r.choices("ab", k=4_000)), lambda r: "".join(r.choices("αβγδ中文字é", k=1_500)),
    lambda r: "=" * 777, lambda r: "".join(r.choices("the ing tion".replace(" ", ""), k=2_500)),
    lambda r: "".join(r.choices(["ing", "tion", "the", "er", "re", "on", "an"], k=1_200)), lambda r: "1" * 999, lambda r: " " * 3_000 + "x"])
def test_long_pieces_equal_the_library(codec, reference, make):
    for seed in range(4):
        text = make(random.Random(seed))
        assert ids_of(codec, text) == reference.encode_ordinary(text)


def test_pieces_around_the_limit(codec, reference):
    rng = random.Random(9)
    for size in range(byte_bpe.LONG - 3, byte_bpe.LONG + 4):
        text = "".join(rng.choices(LETTERS, k=size))
        assert ids_of(codec, text) == reference.encode_ordinary(text)


def test_time_of_a_long_run(codec, reference):
    text = "".join(random.Random(1).choices(LETTERS, k=200_000))
    began = time.process_time()
    ids = ids_of(codec, text)
    assert time.process_time() - began < 5
    assert ids == reference.encode_ordinary(text)


def test_memory_is_bounded_by_bytes(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_BYTES", 100_000)
    codec._restart()
    rng = random.Random(2)
    for _ in range(30):
        text = " ".join("".join(rng.choices(LETTERS, k=rng.choice([5, 300, 20_000]))) for _ in range(6))
        before = codec.held
        codec.encode([text.encode()])
        assert codec.held <= max(100_000, before) + len(text)
        assert sum(map(len, codec.pieces)) <= codec.held == sum(len(p.encode()) for p in codec.pieces)
    assert codec.known == len(codec.pieces)


def test_buffers_grow_by_doubling(codec):
    codec._restart()
    grown = set()
    for i in range(400):
        codec.encode([f" piece{i} xx{i * 7} zz{i}q".encode()])
        grown.add(len(codec.piece_ids))
    assert len(grown) < 20
    assert (np.diff(codec.piece_at[:codec.known + 1]) > 0).all()
