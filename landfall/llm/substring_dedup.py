"""Operator 1, substring dedup: a count-min prefilter, then exact grouping of the windows it leaves.

A window is ``window`` consecutive words of one text. Every word covered by a
window whose word sequence also starts earlier (smaller document id, or earlier
in the same document) is removed; windows are judged on the input.

The texts are packed once into chunks of a few MB, one row each, in a table
bucketed by chunk, so that the three passes over it join per-chunk answers
without moving a text again:

1. every chunk sketches its windows: for both rows of the count-min sketch, the
   sorted cells it touches, cut by cell range into slices. One task merges a
   slice of all chunks' sketches and answers each chunk with one bit per cell:
   its merged count is two or more. Counts are never too low, so no repeated
   window is missed. The sketch has as many slices as the corpus needs and is
   never whole in one place;
2. windows with both bits set go by their 128-bit key to an exact grouping, at
   most one entry per chunk and key (a passage in a third of all documents is
   one entry per chunk). The answer says whether the key is repeated and which
   chunk has its first occurrence;
3. every chunk marks the covered words and writes what is left.

Defined cases: a null text has no words; a null id comes after every id; rows
that share an id come in the order in which they are stored; an empty table
gives an empty result; only the two named columns are read.

A chunk sends one piece of its sketch to every slice it touches, so pieces get
small as slices get many. The defaults (a task of under 1 GB) keep a few dozen
windows a piece up to about 1 TB of text; for 100 TB give ``chunk_bytes`` of
16 MB and ``slice_windows`` of 64 million. The rows are the same. Buckets of the
chunk table grow where ``bucket_bytes`` would ask for more of them than Spark
allows (``spark.sql.sources.bucketing.maxBuckets``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.common import BUCKET_BYTES, NULL_ID, Words, chunk_table, materialise, pack, table, unpack

WINDOW = 20
CHUNK_BYTES = 4 << 20       # text in one chunk
SLICE_WINDOWS = 4 << 20     # windows merged by one task
CELLS_PER_WINDOW = 16       # of one sketch row
CELL_BITS = (SLICE_WINDOWS * CELLS_PER_WINDOW - 1).bit_length()

_PIECE = "part int, chunk long, cells binary, many binary"
_ANSWER = "chunk long, part int, bits binary"
_ENTRY = "part int, chunk long, keys binary, ids binary, many binary"
_KEPT = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<from:long,to:long>>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start word and the two halves of the 128-bit key of every window of a chunk."""
    m = len(words) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    of = words.text_of_word()
    hashes = words.hashes()
    at = np.flatnonzero(of[:m] == of[window - 1:])
    keys = []
    for half, factor in ((0, 0x9E3779B97F4A7C15), (1, 0xC2B2AE3D27D4EB4F)):
        h, key, factor = np.ascontiguousarray(hashes[:, half]), np.zeros(m, np.uint64), np.uint64(factor)
        for j in range(window):
            key *= factor
            key += h[j:j + m]
        keys.append(_mix(key[at]))
    return at, keys[0], keys[1]


def _parts(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(40)) * np.uint64(n)) >> np.uint64(24)


def _cells(key: np.ndarray, n_slices: int, cell_bits: int) -> np.ndarray:
    """Slice and cell of each key in one sketch row, as one number."""
    return (_parts(key, n_slices) << np.uint64(cell_bits)) | (key & np.uint64((1 << cell_bits) - 1))


def _cut(sorted_parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    at = np.flatnonzero(np.concatenate([[True], sorted_parts[1:] != sorted_parts[:-1]])) if len(sorted_parts) else []
    for i, j in zip(at, [*at[1:], len(sorted_parts)]):
        yield int(sorted_parts[i]), int(i), int(j)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _sketch(batches: Iterator[pa.RecordBatch], window: int, n_slices: int,
            cell_bits: int = CELL_BITS) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        _, k0, k1 = _windows(Words(row["texts"]), window)
        out = []
        for r, key in enumerate((k0, k1)):
            cells, counts = np.unique(_cells(key, n_slices, cell_bits), return_counts=True)
            for part, i, j in _cut(cells >> np.uint64(cell_bits)):
                piece = (cells[i:j] & np.uint64((1 << cell_bits) - 1)).astype(np.uint32)
                out.append((r * n_slices + part, row["chunk"], pack(np.diff(piece, prepend=np.uint32(0))),
                            np.packbits(counts[i:j] > 1).tobytes()))
        if out:
            part, chunk, cells, many = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(chunk, pa.int64()), pa.array(cells, pa.binary()),
                 pa.array(many, pa.binary())], names=["part", "chunk", "cells", "many"])


def _merge(slice_: pa.Table) -> pa.Table:
    """Merge one slice of all sketches; one bit per cell and chunk: counted twice or more."""
    cells = [np.cumsum(unpack(x, np.uint32), dtype=np.uint32) for x in slice_.column("cells").to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(c)).astype(bool)
            for x, c in zip(slice_.column("many").to_pylist(), cells)]
    every = np.sort(np.concatenate(cells))
    repeated = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *(c[m] for c, m in zip(cells, many))]))
    bits = []
    for c in cells:
        at = np.searchsorted(repeated, c)
        found = (repeated[np.minimum(at, len(repeated) - 1)] == c) if len(repeated) else np.zeros(len(c), bool)
        bits.append(np.packbits(found).tobytes())
    return pa.table({"chunk": slice_.column("chunk"), "part": slice_.column("part"), "bits": pa.array(bits, pa.binary())})


def _candidates(row: dict, words: Words, window: int, n_slices: int, cell_bits: int = CELL_BITS):
    """The windows whose estimated count is two or more, ordered by key and then position.

    Returns the start words, the order, the two key halves in that order, and
    where each different key begins.
    """
    at, k0, k1 = _windows(words, window)
    bits = {x["part"]: x["bits"] for x in row["sketch"] or ()}
    keep = np.ones(len(at), bool)
    for r, key in enumerate((k0, k1)):
        cells, inverse = np.unique(_cells(key, n_slices, cell_bits), return_inverse=True)
        hit = np.zeros(len(cells), bool)
        for part, i, j in _cut(cells >> np.uint64(cell_bits)):
            hit[i:j] = np.unpackbits(np.frombuffer(bits[r * n_slices + part], np.uint8), count=j - i)
        keep &= hit[inverse]
    at, k0, k1 = at[keep], k0[keep], k1[keep]
    order = np.lexsort((k1, k0))  # stable: equal keys stay in the order of position
    k0, k1 = k0[order], k1[order]
    new = np.ones(len(order), bool)
    new[1:] = (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])
    return at, order, k0, k1, np.flatnonzero(new)


def _estimated(batches: Iterator[pa.RecordBatch], window: int, n_slices: int,
               cell_bits: int = CELL_BITS) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        words = Words(row["texts"])
        at, order, k0, k1, first = _candidates(row, words, window, n_slices, cell_bits)
        if not len(first):
            continue
        ids = np.array(row["ids"], np.int64)[words.text_of_word()[at[order[first]]]]
        counts = np.diff(first, append=len(order))
        k0, k1 = k0[first], k1[first]
        out = [(part, row["chunk"], pack(np.diff(k0[i:j], prepend=np.uint64(0))) , pack(k1[i:j]), pack(ids[i:j]),
                np.packbits(counts[i:j] > 1).tobytes()) for part, i, j in _cut(_parts(k0, n_slices))]
        part, chunk, key0, key1, ids, many = zip(*out)
        keys = [len(a).to_bytes(8, "little") + a + b for a, b in zip(key0, key1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(chunk, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(ids, pa.binary()), pa.array(many, pa.binary())], names=["part", "chunk", "keys", "ids", "many"])


def _group(entries: pa.Table) -> pa.Table:
    """Exact grouping by key; per chunk and key 0: not repeated, 1: first occurrence is here, 2: it is elsewhere."""
    split = [(x[8:8 + (n := int.from_bytes(x[:8], "little"))], x[8 + n:]) for x in entries.column("keys").to_pylist()]
    k0 = [np.cumsum(unpack(a, np.uint64), dtype=np.uint64) for a, _ in split]
    sizes = [len(x) for x in k0]
    k0, k1 = np.concatenate(k0), np.concatenate([unpack(b, np.uint64) for _, b in split])
    ids = np.concatenate([unpack(x, np.int64) for x in entries.column("ids").to_pylist()])
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n)
                           for x, n in zip(entries.column("many").to_pylist(), sizes)])
    chunk = np.repeat(entries.column("chunk").to_numpy(), sizes)
    order = np.lexsort((chunk, ids, k1, k0))
    new = np.ones(len(order), bool)
    new[1:] = (k0[order][1:] != k0[order][:-1]) | (k1[order][1:] != k1[order][:-1])
    count = np.diff(np.flatnonzero(new), append=len(order))
    state = np.empty(len(order), np.uint8)
    state[order] = np.where(new, np.where(np.repeat(count, count) > 1, 1, many[order]), 2)
    cuts = np.cumsum([0, *sizes])
    return pa.table({"chunk": entries.column("chunk"), "part": entries.column("part"),
                     "bits": pa.array([pack(state[i:j]) for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())})


def _remove(batches: Iterator[pa.RecordBatch], window: int, n_slices: int,
            cell_bits: int = CELL_BITS) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
    for row in _rows(batches):
        words = Words(row["texts"])
        gone = np.zeros(len(words) + 1, np.int64)
        at, order, k0, _, first = _candidates(row, words, window, n_slices, cell_bits)
        if len(first):
            states = {x["part"]: x["bits"] for x in row["exact"]}
            state = np.concatenate([unpack(states[part], np.uint8) for part, _, _ in _cut(_parts(k0[first], n_slices))])
            state = np.repeat(state, np.diff(first, append=len(order)))
            covered = state == 2
            covered |= state == 1
            covered[first[state[first] == 1]] = False  # the first occurrence of all
            begin = at[order[covered]]
            np.add.at(gone, begin, 1)
            np.add.at(gone, begin + window, -1)
        gone = np.cumsum(gone[:-1]) > 0
        n_removed, kept, removed = [], [], []
        for d, text in enumerate(row["texts"]):
            g = gone[words.bounds[d]:words.bounds[d + 1]]
            own = text.split()
            n_removed.append(int(g.sum()))
            if n_removed[-1]:
                own = [w for w, x in zip(own, g.tolist()) if not x]
                edge = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0))
                removed.append([{"from": a, "to": b} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist())])
            else:
                removed.append([])
            kept.append(b" ".join(own))
        ids = [None if i == NULL_ID else i for i in row["ids"]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.diff(words.bounds)), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), pa.array(removed, pa.list_(span))],
            names=["doc_id", "n_words", "n_removed", "kept", "removed"])


def _n_windows(texts: list[bytes], window: int) -> int:
    return sum(max(0, len(t.split()) - window + 1) for t in texts)


def _by_chunk(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(name))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    chunk_bytes: int = CHUNK_BYTES, slice_windows: int = SLICE_WINDOWS,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space), removed (spans of word numbers)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chunks, _ = chunk_table(docs, chunk_bytes, lambda texts: _n_windows(texts, window), bucket_bytes)
    windows = chunks.agg(F.sum("measure")).first()[0] or 0
    n = max(1, -(-windows // slice_windows))
    bits = min(32, (slice_windows * CELLS_PER_WINDOW - 1).bit_length())
    pieces = chunks.select("chunk", "texts").mapInArrow(lambda it: _sketch(it, window, n, bits), _PIECE)
    sketch = materialise(pieces.groupBy("part").applyInArrow(_merge, _ANSWER), "sketch")
    sketched = chunks.join(_by_chunk(sketch, "sketch"), "chunk", "left")
    entries = (sketched.select("chunk", "ids", "texts", "sketch")
               .mapInArrow(lambda it: _estimated(it, window, n, bits), _ENTRY))
    exact = materialise(entries.groupBy("part").applyInArrow(_group, _ANSWER), "exact")
    return (sketched.join(_by_chunk(exact, "exact"), "chunk", "left")
            .select("chunk", "ids", "texts", "sketch", "exact")
            .mapInArrow(lambda it: _remove(it, window, n, bits), _KEPT))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a 20-word window that also starts earlier are removed from every document."""
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i,
                   unnest(list_transform(range(1, len(ws) - 18), lambda k: array_to_string(ws[k:k + 19], ' '))) AS win
            FROM w WHERE len(ws) >= 20),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM windows) x
          WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM later) x),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM w),
kept AS (SELECT words.doc_id, count(gone.j) AS n_removed,
                string_agg(word, ' ' ORDER BY words.j) FILTER (gone.j IS NULL) AS text
         FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.j = gone.j GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
