"""Operator 8, byte-level BPE encoding and decoding in length-bucketed padded numpy matrices.

Texts are cut by the vocabulary's pattern; different pieces are encoded once
(a worker keeps a bounded dictionary of them). Pieces that are no token
themselves go, by byte length, into padded matrices of token ids, one row each.
Each round looks up the rank of every neighbouring pair in a hash table, every
row merges its leftmost pair of minimum rank, rows without such a pair are done,
and the matrix is compacted: each merging row has lost one id. A piece above
256 bytes is a row by itself, whose next pair comes from a heap and whose ids
are a linked list: the same merges in the same order, in time that grows with
its length (times a logarithm) and not with its square.

Decoding lays the tokens' bytes end to end.

Defined cases: a null text counts as empty (no ids); null and repeated ids are
passed on as they are; an empty table gives an empty result; only the two named
columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.common import byte_texts, slices, table

BATCH_BYTES = 2 << 20
MAX_PIECES = 400_000  # pieces that a worker remembers,
MAX_BYTES = 16 << 20  # and their bytes; both are looked at between batches
LONG = 256            # bytes from which a piece is a row of its own
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, LONG)
NONE = np.int32(2**31 - 1)


class Pairs:
    """Hash table from a pair of token ids to the id (and rank) of their merge: open addressing, linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [(ranks[t[:i]], ranks[t[i:]], new) for t, new in ranks.items() if len(t) > 1
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, new = np.array(pairs, np.int64).reshape(-1, 3).T
        self._dict: "dict | None" = None
        self.mask = (1 << max(4, int(4 * len(pairs)).bit_length())) - 1
        self.keys, self.values = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int32)
        keys, slot, left = (a << 32) | b, self._slot((a << 32) | b), np.arange(len(pairs))
        while len(left):
            free = self.keys[slot[left]] < 0
            self.keys[slot[left[free]]] = keys[left[free]]  # of several on one slot the last is in
            placed = self.keys[slot[left]] == keys[left]
            self.values[slot[left[placed]]] = new[left[placed]]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def as_dict(self) -> dict:
        """The same table for single look-ups, made when first needed."""
        if self._dict is None:
            full = self.keys >= 0
            self._dict = dict(zip(self.keys[full].tolist(), self.values[full].tolist()))
        return self._dict

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shape = a.shape
        keys = (a.reshape(-1).astype(np.int64) << 32) | b.reshape(-1).astype(np.int64)
        out = np.full(len(keys), NONE, np.int32)
        left = np.flatnonzero((a.reshape(-1) >= 0) & (b.reshape(-1) >= 0))
        slot = self._slot(keys[left])
        while len(left):
            found = self.keys[slot]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            left, slot = left[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)


class Codec:
    def __init__(self, vocabulary: bytes, pattern: str):
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, vocabulary.splitlines())}
        self.cut = regex.compile(pattern).findall
        self.pairs = Pairs(self.ranks)
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._restart()

    def _restart(self) -> None:
        self.pieces: dict[str, int] = {}
        self.known = self.held = 0                # pieces, and their bytes
        self.piece_at = np.zeros(1, np.int64)     # with room to grow, like the ids
        self.piece_ids = np.zeros(0, np.int32)

    def _merge_rows(self, m: np.ndarray, done: dict, row: np.ndarray) -> None:
        """Encode the rows of a padded matrix; ``done[row number] = ids``."""
        rank = self.pairs.look_up(m[:, :-1], m[:, 1:])
        while len(m):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(m), np.int64)
            value = rank[np.arange(len(m)), best] if rank.shape[1] else np.full(len(m), NONE)
            stop = value == NONE
            for r, ids in zip(row[stop].tolist(), m[stop]):
                done[r] = ids[ids >= 0]
            m, rank, row, best, value = m[~stop], rank[~stop], row[~stop], best[~stop], value[~stop]
            if not len(m):
                return
            each = np.arange(len(m))
            m[each, best] = value
            keep = np.ones(m.shape, bool)
            keep[each, best + 1] = False
            m = m[keep].reshape(len(m), -1)
            keep = np.ones(rank.shape, bool)
            keep[each, np.minimum(best + 1, rank.shape[1] - 1)] = False
            rank = rank[keep].reshape(len(m), -1)
            for at in (best - 1, best):
                ok = np.flatnonzero((at >= 0) & (at < rank.shape[1]))
                rank[ok, at[ok]] = self.pairs.look_up(m[ok, at[ok]], m[ok, at[ok] + 1])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """Encode one long piece: the leftmost pair of minimum rank from a heap, neighbours in a linked list."""
        n = len(ids)
        rank = self.pairs.look_up(ids[:-1], ids[1:])
        merged = self.pairs.as_dict().get
        at = np.flatnonzero(rank != NONE)
        heap = ((rank[at].astype(np.int64) << 32) | at).tolist()
        heapq.heapify(heap)
        ids, rank = ids.tolist(), [*rank.tolist(), -1]   # rank[i]: of the pair that begins at i now
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heapq.heappop(heap)
            i, low = top & 0xFFFFFFFF, top >> 32
            if rank[i] != low:   # the pair is gone
                continue
            j = after[i]
            ids[i], rank[j] = low, -1
            after[i] = k = after[j]
            ids[j] = -1
            if k < n:
                before[k] = i
                rank[i] = new = merged((low << 32) | ids[k], -1)
                if new >= 0:
                    heapq.heappush(heap, (new << 32) | i)
            else:
                rank[i] = -1
            h = before[i]
            if h >= 0:
                rank[h] = new = merged((ids[h] << 32) | low, -1)
                if new >= 0:
                    heapq.heappush(heap, (new << 32) | h)
        ids = np.array(ids, np.int32)
        return ids[ids >= 0]

    def _learn(self, pieces: list[str]) -> None:
        data = [p.encode("utf-8") for p in pieces]
        done: dict[int, np.ndarray] = {}
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(data):
            whole = self.ranks.get(p)
            if whole is not None:
                done[i] = np.array([whole], np.int32)
            elif len(p) > LONG:
                done[i] = self._merge_long(self.byte_id[np.frombuffer(p, np.uint8)])
            else:
                by_width.setdefault(WIDTHS[int(np.searchsorted(WIDTHS, len(p)))], []).append(i)
        for width, rows in by_width.items():
            joined = np.frombuffer(b"".join(data[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
            size = np.array([len(data[i]) for i in rows])
            m = np.where(np.arange(width) < size[:, None], self.byte_id[joined], np.int32(-1))
            self._merge_rows(m, done, np.array(rows))
        ids = [done[i] for i in range(len(data))]
        sizes = np.array([len(x) for x in ids])
        known, used = self.known, int(self.piece_at[self.known])
        self.piece_at = _grown(self.piece_at, known + 1 + len(ids))
        self.piece_ids = _grown(self.piece_ids, used + int(sizes.sum()))
        self.piece_at[known + 1:known + 1 + len(ids)] = used + np.cumsum(sizes)
        self.piece_ids[used:used + int(sizes.sum())] = np.concatenate(ids)
        self.known += len(ids)
        self.held += sum(map(len, data))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (and the last ends)."""
        if len(self.pieces) > MAX_PIECES or self.held > MAX_BYTES:
            self._restart()
        known = len(self.pieces)
        number = self.pieces.setdefault
        cut = [[number(p, len(self.pieces)) for p in self.cut(t.decode("utf-8"))] for t in texts]
        if len(self.pieces) > known:
            self._learn(list(self.pieces)[known:])
        of = np.concatenate([np.array(c, np.int64) for c in cut]) if cut else np.zeros(0, np.int64)
        ids = _laid_out(self.piece_at, self.piece_ids, of)
        ends = np.concatenate([[0], np.cumsum(self.piece_at[of + 1] - self.piece_at[of])])
        return ids, ends[np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts end to end, and where each begins (and the last ends)."""
        size = np.concatenate([[0], np.cumsum(self.token_at[ids + 1] - self.token_at[ids])])
        return _laid_out(self.token_at, self.token_bytes, ids), size[at]


def _laid_out(at: np.ndarray, values: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``values[at[w]:at[w + 1]]`` of every ``w``, end to end."""
    size = at[which + 1] - at[which]
    ends = np.cumsum(size)
    return values[np.repeat(at[which] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size`` of them; doubling, so that they are copied a few times in all."""
    if len(values) >= size:
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[:len(values)] = values
    return out


_codecs: dict = {}


def _code_batches(batches: Iterator[pa.RecordBatch], vocabulary: bytes, pattern: str, real: bool) -> Iterator[pa.RecordBatch]:
    key = hashlib.sha256(vocabulary + pattern.encode()).digest()
    if key not in _codecs:
        _codecs[key] = Codec(vocabulary, pattern)
    codec = _codecs[key]
    for batch in slices(batches, "text", BATCH_BYTES):
        ids, at = codec.encode(byte_texts(batch.column("text")))
        data, byte_at = codec.decode(ids, at)
        columns = [batch.column("doc_id"), pa.array(np.diff(at), pa.int64())]
        if real:
            columns += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                        pa.Array.from_buffers(pa.binary(), len(at) - 1,
                                              [None, pa.py_buffer(byte_at.astype(np.int32)), pa.py_buffer(data)])]
            names = ["doc_id", "n_tokens", "ids", "decoded"]
        else:
            little, data = ids.astype("<u4").tobytes(), data.tobytes()
            columns += [pa.array([hashlib.sha256(little[4 * i:4 * j]).hexdigest() for i, j in zip(at, at[1:])], pa.string()),
                        pa.array([hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(byte_at, byte_at[1:])], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encode_decode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (the bytes); with ``digests`` the SHA-256 of both instead of the values.

    ``vocabulary``: path of a rank file on the driver (its bytes are sent to the executors).
    """
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
              else "doc_id long, n_tokens long, ids array<int>, decoded binary")
    return docs.mapInArrow(lambda it: _code_batches(it, ranks.value, pattern, not digests), schema)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoding."""
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN, digests=True)
