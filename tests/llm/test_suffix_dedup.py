"""Operator 11 against a brute force over all strings, and its pieces."""

import hashlib
import random

import numpy as np
import pytest

from llm_cases import EDGES, SF001
from landfall.llm import suffix_dedup as X
from landfall.llm.common import bucket_count, table


def brute(rows, length):
    """rows: (doc_id, text) with different ids (null last); (n_bytes, n_removed, n_spans, digest) per id."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = hashlib.md5(b[i:i + length]).digest()
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.setdefault(d, []).append((len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                                      hashlib.sha256(kept).hexdigest()))
    return {d: sorted(v) for d, v in out.items()}


def deduped(docs, **kw):
    out: dict = {}
    for r in X.suffix_dedup(docs, **kw).collect():
        out.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()))
    return {d: sorted(v) for d, v in out.items()}


@pytest.mark.parametrize("chunk_bytes, slice_bytes", [(2 << 20, 32 << 20), (3_000, 5_000)])
def test_edges(spark, documents, chunk_bytes, slice_bytes):
    rows = [r for r in EDGES if r[0] != 6] + [(30, "ab" * 300 + "c" * 400), (31, "ab" * 200), (32, "c" * 120), (33, "c" * 99), (34, "c" * 100)]
    got = deduped(documents(rows), chunk_bytes=chunk_bytes, slice_bytes=slice_bytes)
    assert got == brute([r[:2] for r in rows], 100)


def test_repeated_ids_and_empty_table(spark, documents):
    text = "".join(random.Random(3).choices("abcdefgh", k=500))
    rows = [(6, text), (6, text), (None, text), (None, "x" + text)]
    got = deduped(documents(rows, parts=1))
    assert sorted(n for _, n, _, _ in got[6]) == [0, 500]  # one of the two is first
    assert sorted(n for _, n, _, _ in got[None]) == [500, 500]
    assert deduped(documents(EDGES).limit(0)) == {}


@pytest.mark.parametrize("length", [16, 40, 100])
def test_random_overlaps(spark, documents, length):
    """Pieces of a few sources pasted together, with small edits, periodic runs and cuts at every offset."""
    rng = random.Random(length)
    pool = ["".join(rng.choices("abc ", k=rng.randrange(20, 700))) for _ in range(6)] + ["xyz" * 150, "é中" * 90]
    rows = []
    for d in range(160):
        t = ""
        for _ in range(rng.randrange(0, 5)):
            src = rng.choice(pool)
            i = rng.randrange(len(src))
            piece = src[i:i + rng.randrange(1, 400)]
            if rng.random() < 0.3 and piece:
                k = rng.randrange(len(piece))
                piece = piece[:k] + rng.choice("abcQ") + piece[k + 1:]
            t += piece + rng.choice(["", "", "#", str(d)])
        rows.append((d, t))
    assert deduped(documents(rows), length=length, chunk_bytes=4_000, slice_bytes=9_000) == brute(rows, length)


def test_given_table(spark):
    docs = table(spark, SF001, "documents")
    assert deduped(docs, chunk_bytes=100_000, slice_bytes=300_000) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 100)


def test_equal_strings_have_equal_anchors():
    rng = random.Random(1)
    same = bytes(rng.choices(b"abcd", k=100))
    chunk = X.Chunk([1, 2], [b"".join([bytes(rng.choices(b"abcd", k=77)), same, bytes(rng.choices(b"abcd", k=300))]),
                             b"".join([bytes(rng.choices(b"abcd", k=350)), same])], 100)
    every, lo = chunk.anchors()
    a, b = 77, int(chunk.bounds[1]) + 350
    i, j = (np.searchsorted(lo, p, "right") - 1 for p in (a, b))
    assert 0 <= every[i] - a == every[j] - b < chunk.w
    assert every[i + 1] - a == every[j + 1] - b <= 100 - X.GRAM


def test_segments_and_blocks_give_the_same(monkeypatch):
    texts = [bytes(random.Random(2).choices(b"abcdef", k=5_000)), b"z" * 700, b"", b"short", bytes(range(256)) * 2]
    whole = X.Chunk([1, 2, 3, 4, 5], texts, 100)
    anchors, starts = whole.anchors(), np.arange(0, whole.size - 100)
    keys = X.range_keys(whole.words, starts, 100, 100)
    # The definition, position by position.
    want = {}
    for d, text in enumerate(texts):
        for p in range(len(text) - (whole.w + X.GRAM - 1) + 1):
            at = whole.bounds[d] + p + np.arange(whole.w)
            h = (whole.words[at] * X._SPREAD) >> np.uint64(32)
            want.setdefault(int(at[np.argmin(h)]), int(whole.bounds[d]) + p)
    assert dict(zip(*(x.tolist() for x in anchors))) == want
    monkeypatch.setattr(X, "SEGMENT", 333)
    monkeypatch.setattr(X, "BLOCK", 77)
    assert all((a == b).all() for a, b in zip(anchors, whole.anchors()))
    assert all((a == b).all() for a, b in zip(keys, X.range_keys(whole.words, starts, 100, 100)))


def test_both_halves_of_a_key_follow_the_bytes():
    rng = random.Random(4)
    same = bytes(rng.choices(range(256), k=400))
    words = X.Chunk([1], [bytes(rng.choices(range(256), k=123)) + same + b"?" * 77 + same], 100).words
    a, sizes = np.arange(123, 423), np.arange(300) % 93 + 8
    for size in (100, sizes):
        first, second = X.range_keys(words, a, size, 100), X.range_keys(words, a + 477, size, 100)
        assert all((x == y).all() and len(set(x.tolist())) == 300 for x, y in zip(first, second))
    longer, marked = X.range_keys(words, a, sizes + 1, 104), X.range_keys(words, a, sizes, 100, np.ones(300, bool))
    assert not any((x == y).any() for x, y in zip(first, longer)) and not any((x == y).any() for x, y in zip(first, marked))


def test_covered():
    assert X.covered(7, np.array([1, 4]), np.array([3, 4])).tolist() == [False, True, True, False, False, False, False]
    assert X.covered(2, np.zeros(0, int), np.zeros(0, int)).tolist() == [False, False]


def test_bucket_count():
    assert bucket_count(0, 1 << 24, 100_000) == 8
    assert bucket_count(1 << 30, 1 << 24, 100_000) == 64
    assert bucket_count(100 << 40, 1 << 24, 100_000) == 100_000
