"""Operators 1, 2, 3, 5, 8 against brute force, on edge rows and on a whole small table."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from llm_cases import EDGES, PASSAGE, SF001
from landfall.llm import byte_bpe, exact_dedup, simhash_dedup, substring_dedup, token_counts
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 70


def by_id(rows):
    return sorted(rows, key=lambda r: (LAST if r[0] is None else r[0], str(r[1:])))


def brute_substring(rows, window=20):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: LAST if r[0] is None else r[0]):
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            key = tuple(words[a:a + window])
            if key in seen:
                gone[a:a + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_substring_edges(documents):
    rows = [(r[0], r[1]) for r in EDGES]
    got = substring_dedup.substring_dedup(documents(EDGES), chunk_bytes=2000)
    got = [tuple(r) for r in got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()]
    assert by_id(got) == by_id(brute_substring(rows))
    assert not substring_dedup.substring_dedup(documents(EDGES).limit(0)).count()


def test_substring_random(documents):
    rnd = random.Random(5)
    passages = [[f"p{rnd.randint(0, 9)}" for _ in range(rnd.randint(15, 70))] for _ in range(6)]
    rows = [(i, " ".join(sum((rnd.choice(passages) if rnd.random() < 0.5 else [f"w{rnd.randint(0, 999)}" for _ in range(9)]
                              for _ in range(rnd.randint(0, 9))), []))) for i in range(120)]
    out = substring_dedup.substring_dedup(documents(rows), chunk_bytes=3000)
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()]
    assert by_id(got) == by_id(brute_substring(rows))
    few = substring_dedup.substring_dedup(documents(rows), chunk_bytes=5000, slice_windows=64)  # many slices, crowded cells
    assert by_id([tuple(r) for r in few.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()]) == by_id(got)
    for r in out.where("n_removed > 0").collect():
        assert sum(s["to"] - s["from"] for s in r["removed"]) == r["n_removed"]


def test_substring_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in substring_dedup.op1_substring_dedup(spark, SF001).collect()]
    assert by_id(got) == by_id(brute_substring(rows))


def test_sketch_never_underestimates():
    """Windows of two chunks that share a passage are flagged in both, whatever else collides."""
    texts = [[f"a b {PASSAGE}".encode()], [f"{PASSAGE} c d".encode(), b"other words"]]
    n, w = 1, 20
    pieces = [b for i, t in enumerate(texts) for b in substring_dedup._sketch(iter([_chunk(i, t)]), w, n)]
    import pyarrow as pa
    table = pa.Table.from_batches(pieces)
    answers = [substring_dedup._merge(table.filter(pa.compute.equal(table["part"], p))) for p in (0, 1)]
    for i, t in enumerate(texts):
        sketch = [r for a in answers for r in a.to_pylist() if r["chunk"] == i]
        words = substring_dedup.Words(t)
        at, order, *_ = substring_dedup._candidates({"sketch": sketch}, words, w, n)
        assert len(at) >= 41  # all windows of the passage


def _chunk(i, texts):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array([i]), pa.array([texts], pa.list_(pa.binary()))], names=["chunk", "texts"])


def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min(ids, key=lambda i: LAST if i is None else i)
        first = True
        for i in ids:
            stays = i == keep and first
            first = first and not stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hash_", [exact_dedup.hash128, lambda c: F.substring(F.md5(c), 1, 1)], ids=["md5", "colliding"])
def test_exact_edges(documents, hash_):
    rows = [(r[0], r[1]) for r in EDGES] + [(20 + i, f"text {i % 40}") for i in range(200)] + [(None, "nobody"), (None, "nobody")]
    got = [tuple(r) for r in exact_dedup.exact_groups(documents(rows), content_hash=hash_).collect()]
    assert by_id(got) == by_id(brute_exact(rows))


def test_exact_rows(documents):
    docs = documents(EDGES)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    want = [(r[0]) for r in brute_exact([(r[0], r[1]) for r in EDGES]) if r[3]]
    assert by_id([(r["doc_id"],) for r in kept.collect()]) == by_id([(w,) for w in want])
    assert not exact_dedup.exact_dedup(docs.limit(0)).count()


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def brute_roots(prints, bits=3):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    every = sorted(root)
    for i, a in enumerate(every):
        for b in every[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in root}


def test_simhash_edges(documents):
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(400)]
    near = [(100 + i, " ".join(base[:k] + ["changed"] + base[k + 1:])) for i, k in enumerate(rnd.sample(range(400), 40))]
    rows = [(r[0], r[1]) for r in EDGES] + near
    found = simhash_dedup.simhash_components(documents(rows)).collect()
    prints = {brute_print(t) for _, t in rows}
    roots = brute_roots(prints)
    lead = {}
    for i, t in rows:
        r = roots[brute_print(t)]
        lead[r] = min(lead.get(r, LAST), i if i is not None else (1 << 63) - 1)
    want = [(i if i is not None else (1 << 63) - 1, brute_print(t), lead[roots[brute_print(t)]]) for i, t in rows]
    assert sorted((r["id"], r["fp"] % (1 << 64), r["lead"]["id"]) for r in found) == sorted(want)
    kept = simhash_dedup.near_dedup(documents(rows))
    assert kept.count() == len(lead) and kept.columns == documents(rows).columns
    assert not simhash_dedup.simhash_components(documents(rows).limit(0)).count()


@pytest.mark.parametrize("long_posting", [4096, 3], ids=["pairs", "flips"])
def test_links_connect_all(long_posting, monkeypatch):
    """Dense clusters: the links of the index connect what all pairs connect."""
    rnd = np.random.default_rng(1)
    centres = rnd.integers(0, 2**63, 12, dtype=np.uint64)
    prints = np.unique(np.concatenate([c ^ np.uint64(sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 5), False)))
                                       for c in centres for _ in range(40)], axis=None).astype(np.uint64))
    monkeypatch.setattr(simhash_dedup, "LONG_POSTING", long_posting)
    import pyarrow as pa
    masks = np.array(simhash_dedup._masks(3), np.int64).view(np.uint64)
    posted = sorted((s, int(p & masks[s]), int(p)) for s in range(56) for p in prints)
    batches = [pa.RecordBatch.from_arrays([pa.array([x[0] for x in posted[i:i + 500]], pa.int16()),
                                           pa.array(np.array([x[2] for x in posted[i:i + 500]], np.uint64).view(np.int64))],
                                          names=["set", "fp"]) for i in range(0, len(posted), 500)]
    got = {int(p): int(p) for p in prints}

    def find(x):
        while got[x] != x:
            x = got[x]
        return x
    for b in simhash_dedup._links(iter(batches), 3):
        for x, y in zip(b.column("a").to_numpy().view(np.uint64).tolist(), b.column("b").to_numpy().view(np.uint64).tolist()):
            p, q = find(x), find(y)
            got[max(p, q)] = min(p, q)
    assert {p: find(p) for p in got} == brute_roots([int(p) for p in prints])


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash_dedup.components(links).collect()}
    assert len({roots[i] for i in range(61)}) == 1 and roots[100] == roots[200] != roots[0]


def fuzz_texts():
    rnd = random.Random(1)
    alphabet = list("abcdefghijklmnopqrstuvwxyzABCDEFG0123456789 \n\t'''.,!?-<|>éßİΣςẞñ中文日本한🙂̈́²½٣Ⅷ\x1c\x85\xa0 ǅﬁ")
    out = [t or "" for _, t, _ in EDGES] + ["a<|startoftext|>b <|endoftext|>'s", "don't we'll 'rely 'llama ''s !'s 're've", "ab" * 700 + "'" * 600]
    return out + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]


def test_token_counts(documents):
    from tokenizers import Tokenizer
    texts = fuzz_texts()
    reference = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = [len(e.ids) for e in reference.encode_batch(texts, add_special_tokens=False)]
    got = token_counts.token_counts(documents([*enumerate(texts), (None, None)]), P.path("word_bpe_49k.json"))
    assert by_id([tuple(r) for r in got.collect()]) == by_id(
        [(i, len(t.encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, want))] + [(None, 0, 0, False)])
    assert not token_counts.token_counts(documents([(1, "x")]).limit(0), P.path("word_bpe_49k.json")).count()


def test_state_maps_compose():
    """Chunks of any length give the states and counts of one sequential run."""
    rnd = np.random.default_rng(0)
    classes = rnd.integers(0, 10, 5000).astype(np.uint8)
    state, sequential = 0, []
    for c in classes:
        state = token_counts._STEP[state * 16 + c]
        sequential.append(state)
    for lane in (1, 7, 256, 9000):
        assert token_counts.split_states(classes, lane).tolist() == sequential


def test_byte_bpe(documents):
    import base64

    import tiktoken
    texts = fuzz_texts()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents([*enumerate(texts), (None, None)])
    rows = byte_bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = "" if r["doc_id"] is None else texts[r["doc_id"]]
        assert r["ids"] == reference.encode_ordinary(text) and bytes(r["decoded"]) == text.encode() and r["n_tokens"] == len(r["ids"])
    some = byte_bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, digests=True).where("doc_id = 5").first()
    assert some["decoded_sha256"] == hashlib.sha256(PASSAGE.encode()).hexdigest()
    assert some["ids_sha256"] == hashlib.sha256(np.array(reference.encode_ordinary(PASSAGE), "<u4").tobytes()).hexdigest()
    assert not byte_bpe.encode_decode(docs.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count()
