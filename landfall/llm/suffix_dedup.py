"""Operator 11, suffix-array dedup: distributed prefix doubling over the texts' bytes.

Every byte covered by a ``length``-byte string that also starts earlier (smaller
document id, or earlier in the same document) is removed; strings are judged on
the input and never cross documents.

The positions that are ranked are a sparse subset. Of any ``w`` neighbouring
positions the one with the least hash of its next 8 bytes is an anchor, so equal
strings have anchors at equal places (w = 46 for 100 bytes: about every 23rd
position). An anchor's phrase runs to 8 bytes beyond the next anchor; the start
of a document is an anchor too, and its last phrase ends with the document.

1. *Base rank.* Phrases are grouped by a 104-bit key. A phrase that occurs once
   is unique, and so is whatever begins with it.
2. *Prefix doubling.* Anchor j of rank r[j], the class of its next h phrases,
   sends the pair (r[j], r[j + h]); sorted pairs are reranked and h doubles. An
   anchor drops out when its rank is unique (or r[j + h] is), or when its phrases
   reach past the strings that start in its own phrase. Of each class that got
   there, all members but the first hold only strings that also start earlier.
3. *What is left* are strings that start in first members and unique anchors.
   Equal ones among them have their first inner anchor at the same place and, from
   it on, the 55 bytes that all strings with this anchor hold. Only where two such
   anchors share those are the strings themselves grouped, by a 104-bit key. The
   first stays, the others start earlier elsewhere.

Texts are packed into chunks, one row each, in a table bucketed by chunk. In
every exchange a chunk sends each slice of the ranks at most one entry per
distinct key, with its first document and whether it has more (a phrase in a
third of all documents is one entry per chunk), and gets back one number per
entry. No round moves a text. Ranks are numbered slice by slice.

Defined cases: a null text is empty; a null id comes after every id; rows that
share an id come in the order in which they are stored; a text shorter than
``length`` is kept; an empty table gives an empty result; only the two named
columns are read. Two different phrases or strings with one 104-bit key are not
told apart (about 2e-6 for 1e13 of them).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.common import NULL_ID, chunk_table, discard, materialise, pack, table, unpack

LENGTH = 100
CHUNK_BYTES = 2 << 20    # text in one chunk
SLICE_BYTES = 16 << 20   # text whose ranks one task sorts
GRAM = 8
SEGMENT = 1 << 16        # positions looked at together
BLOCK = 1 << 15          # keys made together

_ENTRY = "part int, chunk long, keys binary, ids binary, many binary"
_RANKS = "chunk long, part int, ranks binary"
_STATE = "chunk long, active long, state binary"
_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def window_of(length: int) -> int:
    """Positions among which one anchor is chosen: the next anchor of a string's first one still lies inside it."""
    return max(1, (length - GRAM + 1) // 2)


# ------------------------------------------------------------------ hashes

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # the upper half of a product with it is the hash that chooses anchors


def range_keys(words: np.ndarray, starts: np.ndarray, sizes: "np.ndarray | int", longest: int,
               mark: "np.ndarray | None" = None) -> tuple[np.ndarray, np.ndarray]:
    """The 64 and 40 bits of a key of byte ranges of ``GRAM`` to ``longest`` bytes, of their sizes and marks.

    ``words`` has the 8 bytes at every position as one number. Every key takes
    as many of them; the last ones of a short range are its last 8 bytes again.
    """
    halves = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    sizes = np.broadcast_to(sizes, len(starts))
    for i in range(0, len(starts), BLOCK):
        own = slice(i, i + BLOCK)
        at, size = starts[own], sizes[own]
        seed = size.astype(np.uint64) * np.uint64(2) + (0 if mark is None else mark[own].astype(np.uint64))
        k0, k1 = _mix(seed + np.uint64(1)), _mix(seed + np.uint64(1 << 32))
        for step in range(0, longest, GRAM):
            word = words[at + np.minimum(step, size - GRAM)]
            k0 = (k0 ^ (k0 >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
            k1 = (k1 ^ (k1 >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + word
        halves[0][own], halves[1][own] = _mix(k0), _mix(k1) >> np.uint64(24)
    return halves


# ------------------------------------------------------------------ chunks and anchors

class Chunk:
    """The texts of a chunk, joined; ``bounds[d]:bounds[d + 1]`` is text d, ``words[p]`` the 8 bytes from p on."""

    def __init__(self, ids: list, texts: list, length: int):
        self.ids = np.array(ids, np.int64)
        self.data = np.frombuffer(b"".join([*texts, bytes(GRAM)]), np.uint8)
        self.size = len(self.data) - GRAM
        self.words = np.ndarray((self.size + 1,), "<u8", self.data, strides=(1,))
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.length, self.w = length, window_of(length)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchors, and for each the first position that has it (positions of one anchor are neighbours)."""
        need, low = self.w + GRAM - 1, np.uint64(0xFFFFFFFF)  # bytes from which a position's anchor is chosen
        found, since = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        previous = -1
        for begin in range(0, self.size, SEGMENT):
            x = self.words[begin:min(begin + SEGMENT + self.w - 1, self.size)].copy()
            if len(x) < self.w:
                break
            least = ((x * _SPREAD) & ~low) | np.arange(len(x), dtype=np.uint64)  # ties: the leftmost
            width = 1
            while width < self.w:
                step = min(width, self.w - width)
                least = np.minimum(least[:-step], least[step:])
                width += step
            # Positions with fewer bytes than that left in their text have none.
            d = np.arange(max(0, np.searchsorted(self.bounds, begin, "right") - 1), np.searchsorted(self.bounds, begin + len(least)))
            short = np.zeros(len(least) + 1, np.int32)
            np.add.at(short, np.clip(np.maximum(self.bounds[d], self.bounds[d + 1] - need + 1) - begin, 0, len(least)), 1)
            np.add.at(short, np.clip(self.bounds[d + 1] - begin, 0, len(least)), -1)
            room = np.cumsum(short[:-1]) == 0
            new = room.copy()   # where the anchor changes, or a text begins
            new[1:] &= (least[1:] != least[:-1]) | ~room[:-1]
            at = np.flatnonzero(new)
            anchor = (least[at] & low).astype(np.int64) + begin
            if len(at) and anchor[0] == previous:   # goes on from the segment before
                at, anchor = at[1:], anchor[1:]
            if len(at):
                previous = anchor[-1]
            found.append(anchor)
            since.append(at + begin)
        return np.concatenate(found), np.concatenate(since)


class State:
    """Anchors of a chunk with their ranks.

    ``lo``: the first position that has the anchor as its first inner one.
    ``rank`` 0 is unique; ``copied``: an earlier member of the class exists.
    """

    def __init__(self, ids, at, lo, text, last_end, base, rank, copied, h=1):
        self.ids, self.at, self.lo, self.text, self.last_end = ids, at, lo, text, last_end
        self.base, self.rank, self.copied, self.h = base, rank, copied, h

    @classmethod
    def of(cls, chunk: Chunk) -> "State":
        inner, lo = chunk.anchors()
        # The start of a text with anchors is one too, of no position's strings.
        first = np.searchsorted(inner, chunk.bounds)
        count, first, begin = np.diff(first), first[:-1], chunk.bounds[:-1]
        bare = (count > 0) & (np.append(inner, -1)[first] != begin)
        at, lo = np.insert(inner, first[bare], begin[bare]), np.insert(lo, first[bare], begin[bare])
        text = np.repeat(np.arange(len(begin)), count + bare)
        none = np.zeros(len(at), np.uint64)
        return cls(chunk.ids, at, lo, text, chunk.bounds[text + 1], none, none.copy(), np.zeros(len(at), bool))

    def _until(self, place: np.ndarray, at_end: np.ndarray) -> np.ndarray:
        """``place`` of the next anchor; ``at_end`` for the last one of a text."""
        last = np.append(self.text[1:] != self.text[:-1], [True][:len(self.text)])
        return np.where(last, at_end, np.append(place[1:], 0)[:len(place)])

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the phrases, and which of them end with their text."""
        following = self._until(self.at, np.full(len(self.at), -1))
        last = following < 0
        return np.where(last, self.last_end, following + GRAM) - self.at, last

    def strings(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the whole strings in each anchor's own phrase, as ranges."""
        end = np.minimum(self._until(self.at, self.last_end), self.last_end - length + 1)
        return self.at, np.maximum(end, self.at)

    def inner(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the whole strings whose first inner anchor this is, as ranges."""
        end = np.minimum(self._until(self.lo, self.last_end), self.last_end - length + 1)
        return self.lo, np.maximum(end, self.lo)

    def active(self, length: int) -> np.ndarray:
        """Indexes of anchors that are not unique and whose ``h`` phrases do not yet reach far enough."""
        n = len(self.at)
        j = np.flatnonzero(self.rank)
        beyond = np.minimum(j + self.h, n - 1)  # the anchor after the phrases, if it is in the same text
        inside = (j + self.h < n) & (self.text[beyond] == self.text[j])
        following = self.at[np.minimum(j + 1, n - 1)]
        return j[inside & (self.at[beyond] + GRAM < following + length - 1)]

    def dump(self) -> bytes:
        deltas = [pack(np.diff(x, prepend=0).astype(np.uint32)) for x in (self.at, self.text)]
        nears = [pack(x.astype(np.uint32)) for x in (self.last_end - self.at, self.at - self.lo)]
        return pickle.dumps((pack(self.ids), deltas, nears, pack(self.base), pack(self.rank), np.packbits(self.copied).tobytes(), self.h))

    @classmethod
    def load(cls, data: bytes) -> "State":
        ids, deltas, nears, base, rank, copied, h = pickle.loads(data)
        at, text = (np.cumsum(unpack(x, np.uint32).astype(np.int64)) for x in deltas)
        room, back = (unpack(x, np.uint32).astype(np.int64) for x in nears)
        return cls(unpack(ids, np.int64), at, at - back, text, at + room, unpack(base, np.uint64), unpack(rank, np.uint64),
                   np.unpackbits(np.frombuffer(copied, np.uint8), count=len(at)).astype(bool), h)


def covered(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` positions lie in one of the ranges, which are sorted and do not overlap."""
    edges = np.stack([begin, end], 1).ravel()
    return np.repeat(np.arange(len(edges) + 1) % 2 == 1, np.diff(edges, prepend=0, append=size))


# ------------------------------------------------------------------ one exchange: keys out, ranks back

def _slice(key: np.ndarray, n_slices: int) -> np.ndarray:
    return (((key >> np.uint64(40)) * np.uint64(n_slices)) >> np.uint64(24)).astype(np.int32)


class Keys:
    """The keys that a chunk sends: sorted by slice and key, equal ones together, in the order of position."""

    def __init__(self, k0: np.ndarray, k1: np.ndarray, n_slices: int, hashed: bool = True):
        if hashed:  # slices are ranges of the first half
            part = _slice(k0, n_slices)
            self.order = np.argsort(k0, kind="stable")
            a, b = k0[self.order], k1[self.order]
            if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
                self.order = np.lexsort((k1, k0))
        else:
            part = _slice(_mix(k0 * np.uint64(3) + k1), n_slices)
            self.order = np.lexsort((k1, k0, part))
        self.k0, self.k1, part = k0[self.order], k1[self.order], part[self.order]
        self.part = part
        new = np.ones(len(part), bool)
        new[1:] = (self.k0[1:] != self.k0[:-1]) | (self.k1[1:] != self.k1[:-1])
        self.first = np.flatnonzero(new)
        self.counts = np.diff(self.first, append=len(part))

    def pieces(self) -> Iterator[tuple[int, int, int]]:
        parts = self.part[self.first]
        at = np.flatnonzero(np.diff(parts, prepend=-1))
        for i, j in zip(at, [*at[1:], len(parts)]):
            yield int(parts[i]), int(i), int(j)

    def entries(self, chunk: int, ids: np.ndarray) -> "pa.RecordBatch | None":
        """``ids``: the document of every key."""
        rows = []
        for part, i, j in self.pieces():
            at = self.first[i:j]
            a, b = pack(np.diff(self.k0[at], prepend=np.uint64(0))), pack(self.k1[at])
            rows.append((part, chunk, len(a).to_bytes(8, "little") + a + b, pack(ids[self.order[at]]),
                         np.packbits(self.counts[i:j] > 1).tobytes()))
        if not rows:
            return None
        part, chunks, keys, ids, many = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(chunks, pa.int64()), pa.array(keys, pa.binary()),
                                           pa.array(ids, pa.binary()), pa.array(many, pa.binary())],
                                          names=["part", "chunk", "keys", "ids", "many"])

    def ranks(self, answers: "list | None") -> tuple[np.ndarray, np.ndarray]:
        """For every key its rank (0: it occurs once), and whether the same key comes earlier."""
        told = {x["part"]: x["ranks"] for x in answers or ()}
        value = np.concatenate([np.zeros(0, np.uint64)] + [unpack(told[part], np.uint64) for part, _, _ in self.pieces()])
        rank, earlier = np.empty(len(self.order), np.uint64), np.ones(len(self.order), bool)
        rank[self.order] = np.repeat(value >> np.uint64(1), self.counts)
        earlier[self.order[self.first]] = (value & np.uint64(1)) == 1
        return rank, earlier


def _rank(slice_: pa.Table, n_slices: int, round_: int) -> pa.Table:
    """Sort one slice of all entries and number its repeated keys: number * 2 + (the key comes earlier elsewhere), 0 if it occurs once."""
    split = [(x[8:8 + (n := int.from_bytes(x[:8], "little"))], x[8 + n:]) for x in slice_.column("keys").to_pylist()]
    k0 = [np.cumsum(unpack(a, np.uint64), dtype=np.uint64) for a, _ in split]
    sizes = [len(x) for x in k0]
    k0 = np.concatenate(k0)
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(slice_.column("many").to_pylist(), sizes)])
    by_key = np.argsort(k0)
    sorted_ = k0[by_key]
    again = np.zeros(len(k0), bool)
    again[1:] = sorted_[1:] == sorted_[:-1]
    some = by_key[again | np.append(again[1:], [False][:len(again)]) | (many[by_key] == 1)]  # the others occur once
    del by_key, sorted_, again
    k1 = np.concatenate([unpack(b, np.uint64) for _, b in split])
    del split
    ids = np.concatenate([unpack(x, np.int64) for x in slice_.column("ids").to_pylist()])[some]
    by_chunk = np.argsort(np.argsort(slice_.column("chunk").to_numpy())).astype(np.int32)
    order = some[np.lexsort((np.repeat(by_chunk, sizes)[some], ids, k1[some], k0[some]))]
    value = np.zeros(len(k0), np.uint64)
    new = np.ones(len(order), bool)
    new[1:] = (k0[order][1:] != k0[order][:-1]) | (k1[order][1:] != k1[order][:-1])
    count = np.diff(np.flatnonzero(new), append=len(order))
    number = np.cumsum(new, dtype=np.uint64) * np.uint64(n_slices) + np.uint64(slice_.column("part")[0].as_py())
    number = number * np.uint64(64) + np.uint64(round_)  # ranks of different rounds differ
    value[order] = np.where((np.repeat(count, count) > 1) | (many[order] == 1), number * np.uint64(2) + (~new).astype(np.uint64), np.uint64(0))
    cuts = np.cumsum([0, *sizes])
    return pa.table({"chunk": slice_.column("chunk"), "part": slice_.column("part"),
                     "ranks": pa.array([pack(value[i:j]) for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())})


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _exchange(rows: DataFrame, keys_of, name: str, n_slices: int, round_: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a column ``name``, the ranks of the keys that ``keys_of(row)`` gives (Keys, documents, ...); and the ranks' table."""
    def send(batches):
        for row in _rows(batches):
            found = keys_of(row)
            batch = found and found[0].entries(row["chunk"], found[1])
            if batch:
                yield batch

    ranked = (rows.mapInArrow(send, _ENTRY).groupBy("part")
              .applyInArrow(lambda slice_: _rank(slice_, n_slices, round_), _RANKS))
    ranked = materialise(ranked, "suffix-ranks")
    by_chunk = ranked.groupBy("chunk").agg(F.collect_list(F.struct("part", "ranks")).alias(name))
    return rows.join(by_chunk, "chunk", "left"), ranked


# ------------------------------------------------------------------ the steps

def _phrase_keys(row: dict, length: int, n: int):
    chunk = Chunk(row["ids"], row["texts"], length)
    state = State.of(chunk)
    sizes, last = state.phrases()
    return Keys(*range_keys(chunk.words, state.at, sizes, chunk.w + GRAM, last), n), chunk.ids[state.text], state


def _based(batches, length: int, n: int):
    """The state of every chunk after the base rank."""
    for row in _rows(batches):
        keys, _, state = _phrase_keys(row, length, n)
        state.rank, state.copied = keys.ranks(row["ranks"])
        state.copied &= state.rank != 0
        state.base = state.rank
        yield _state_row(row["chunk"], state, length)


def _state_row(chunk: int, state: State, length: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([len(state.active(length))]), pa.array([state.dump()], pa.binary())],
                                      names=["chunk", "active", "state"])


def _pairs(row: dict, length: int, n: int):
    """The rank pairs of a chunk's unfinished anchors; those before a unique anchor are unique themselves."""
    state = State.load(row["state"])
    j = state.active(length)
    after = state.rank[j + state.h]
    alone, j, after = j[after == 0], j[after != 0], after[after != 0]
    return Keys(state.rank[j], after, n, hashed=False), state.ids[state.text[j]], j, alone, state


def _doubled(batches, length: int, n: int):
    for row in _rows(batches):
        keys, _, j, alone, state = _pairs(row, length, n)
        rank, copied = keys.ranks(row["ranks"])
        state.rank[alone], state.copied[alone] = 0, False
        state.rank[j], state.copied[j] = rank, copied & (rank != 0)
        state.h *= 2
        yield _state_row(row["chunk"], state, length)


def _inner_keys(row: dict, length: int, n: int):
    """Of anchors that are the first inner one of strings not settled by step 2: the bytes that all its strings hold."""
    chunk, state = Chunk(row["ids"], row["texts"], length), State.load(row["state"])
    begin, end = state.strings(length)
    left = covered(chunk.size, begin[~state.copied], end[~state.copied])
    upto = np.concatenate([[0], np.cumsum(left, dtype=np.int32)])
    lo, hi = state.inner(length)
    inner = np.flatnonzero((upto[hi] > upto[lo]) & (state.base != 0))
    common = length - chunk.w + 1
    return Keys(*range_keys(chunk.words, state.at[inner], common, common), n), state.ids[state.text[inner]], inner, chunk, state, left


def _open_strings(row: dict, length: int, n: int):
    """The strings to be grouped: not settled, and what their first inner anchor's strings all hold occurs elsewhere."""
    keys, _, inner, chunk, state, left = _inner_keys(row, length, n)
    inner = inner[keys.ranks(row["inner"])[0] != 0]
    lo, hi = state.inner(length)
    at = np.flatnonzero(left & covered(chunk.size, lo[inner], hi[inner]))
    text = np.searchsorted(chunk.bounds, at, "right") - 1
    return Keys(*range_keys(chunk.words, at, length, length), n), chunk.ids[text], at, chunk, state


def _removed(batches, length: int, n: int):
    for row in _rows(batches):
        keys, _, at, chunk, state = _open_strings(row, length, n)
        cover = np.zeros(chunk.size + 1, np.int32)
        later = at[keys.ranks(row["strings"])[1]]
        begin, end = state.strings(length)
        copied = state.copied & (end > begin)
        for first, behind in ((later, later + 1), (begin[copied], end[copied])):
            np.add.at(cover, first, 1)
            np.add.at(cover, behind - 1 + length, -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        out = []
        for d, i in enumerate(row["ids"]):
            a, b = chunk.bounds[d], chunk.bounds[d + 1]
            g = gone[a:b]
            n_removed = int(np.count_nonzero(g))
            kept = chunk.data[a:b][~g].tobytes() if n_removed else row["texts"][d]
            spans = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if n_removed else 0
            out.append((None if i == NULL_ID else i, int(b - a), n_removed, spans, kept))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), [*[pa.int64()] * 4, pa.binary()])],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 chunk_bytes: int = CHUNK_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every document."""
    if length < 2 * GRAM:
        raise ValueError(f"strings of {length} bytes are too short for anchors of {GRAM}")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chunks, size = chunk_table(docs, chunk_bytes)
    n = max(1, -(-size // slice_bytes))
    phrases, ranks = _exchange(chunks, lambda row: _phrase_keys(row, length, n), "ranks", n, 1)
    state = materialise(phrases.mapInArrow(lambda it: _based(it, length, n), _STATE), "suffix-state")
    discard(ranks)
    round_ = 2
    while state.where("active > 0").limit(1).count():
        pairs, ranks = _exchange(state, lambda row: _pairs(row, length, n), "ranks", n, round_)
        doubled = materialise(pairs.mapInArrow(lambda it: _doubled(it, length, n), _STATE), "suffix-state")
        discard(state)
        discard(ranks)
        state, round_ = doubled, round_ + 1
    ready = chunks.join(state.select("chunk", "state"), "chunk")
    ready, _ = _exchange(ready, lambda row: _inner_keys(row, length, n), "inner", n, 1)
    ready, _ = _exchange(ready, lambda row: _open_strings(row, length, n), "strings", n, 1)
    return ready.mapInArrow(lambda it: _removed(it, length, n), _KEPT)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier are removed from every document."""
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
