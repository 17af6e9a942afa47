"""Operator 3, token counts by finite-state tokenizer compilation.

The tokenizer (a ``tokenizers`` JSON file: byte-level BPE with an end-of-word
suffix) is compiled into two deterministic transducers:

* the splitter reads code point classes and says where words start. It has nine
  states, so a chunk of text is a map from nine states to nine; all chunks run
  in lockstep from all states, the maps are composed by a parallel prefix scan,
  and a second lockstep run from the now known states annotates the text;
* the counter reads bytes (the last byte of a word is a symbol of its own). Its
  state is what the tokens of the rest of the word can still depend on: the
  longest suffix that may begin a token, and for every position in it the last
  token of the encoding up to there and the relative count. Every transition is
  annotated with the change in emitted tokens. The machine is finite, and its
  transitions are compiled when first met. After the end of a word it is in its
  start state, so the map of a chunk that holds a word's end is constant but for
  its head; heads are run from the composed states.

Token ids are never produced and no library tokenizer is called.

Defined cases: a null text counts as empty (no bytes, no tokens); null and
repeated ids are passed on as they are; an empty table gives an empty result;
only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.common import byte_texts, slices, table

LIMIT = 2048
BATCH_BYTES = 2 << 20
LANE = 256           # symbols in one chunk
MAX_STATES = 100_000  # the counter starts anew beyond, to bound a worker's memory

# Classes and states of the splitter for
# 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+
_SPACE, _LETTER, _NUMBER, _OTHER, _QUOTE, _SHORT, _R, _V, _E, _L = range(10)
_SPLIT_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
IN_SPACE, IN_WORD, IN_NUMBER, IN_OTHER, AT_QUOTE, AFTER_R, AFTER_V, AFTER_L, CLOSED = range(9)


def _split_table() -> np.ndarray:
    letters = (_LETTER, _SHORT, _R, _V, _E, _L)
    step = np.zeros((9, 16), np.uint8)
    for state in range(9):
        for c in letters:
            step[state, c] = IN_WORD
        step[state, _NUMBER], step[state, _OTHER], step[state, _QUOTE] = IN_NUMBER, IN_OTHER, AT_QUOTE
    step[[IN_OTHER, AT_QUOTE], _QUOTE] = IN_OTHER
    step[AT_QUOTE, [_SHORT, _R, _V, _L]] = CLOSED, AFTER_R, AFTER_V, AFTER_L
    step[[AFTER_R, AFTER_V], _E] = CLOSED
    step[AFTER_L, _L] = CLOSED
    return step.reshape(-1)


_STEP = _split_table()


def split_states(classes: np.ndarray, lane: int = LANE) -> np.ndarray:
    """The splitter's state after every code point, by state maps of chunks and a parallel prefix scan."""
    n = len(classes)
    lanes = -(-n // lane)
    padded = np.zeros(lanes * lane, np.uint8)
    padded[:n] = classes
    grid = np.ascontiguousarray(padded.reshape(lanes, lane).T)
    maps = np.repeat(np.arange(9, dtype=np.uint8)[None, :], lanes, axis=0)
    for symbols in grid:
        maps = _STEP[(maps << 4) + symbols[:, None]]
    shift = 1
    while shift < lanes:  # after round r, maps[i] is the map of the last 2**r chunks up to i
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift], axis=1)
        shift *= 2
    state = np.zeros(lanes, np.uint8)
    state[1:] = maps[:-1, IN_SPACE]
    out = np.empty((lane, lanes), np.uint8)
    for i, symbols in enumerate(grid):
        state = out[i] = _STEP[(state << 4) + symbols]
    return out.T.reshape(-1)[:n]


def word_starts(states: np.ndarray) -> np.ndarray:
    before = np.concatenate([[IN_SPACE], states[:-1]])
    after = np.concatenate([states[1:], [IN_SPACE]])
    run = (before == IN_WORD) | ((before >= AFTER_R) & (before <= AFTER_L))
    return ((states == IN_NUMBER) | (states == AT_QUOTE)
            | ((states == IN_OTHER) & (before != IN_OTHER) & (before != AT_QUOTE))
            | ((states == IN_WORD) & ~run)
            | ((states >= AFTER_R) & (states <= AFTER_L) & (after != CLOSED)))


def _byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_PAST = (-1, 0)  # a position at which no further token can begin


class Counter:
    """The counting transducer of one vocabulary. Symbols: a byte, or 256 + byte at the end of a word."""

    def __init__(self, spec: dict):
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or kinds != ["NFC", "Replace", "Lowercase"]
                or splits[0]["pattern"]["Regex"] != _SPLIT_PATTERN or splits[1]["type"] != "ByteLevel"):
            raise ValueError("not a tokenizer of the kind that is compiled here")
        vocab = model["vocab"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        symbols = {}
        for char, b in _byte_characters().items():
            symbols[vocab[char]], symbols[vocab[char + "</w>"]] = (b,), (256 + b,)
        self.token_of = {s: t for t, s in symbols.items()}  # symbol sequence -> token
        self.sequence = dict(symbols)
        self.merge = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            new = vocab[a + b]
            a, b = vocab[a], vocab[b]
            self.merge[a, b] = (rank, new)
            self.sequence[new] = self.sequence[a] + self.sequence[b]
            self.token_of[self.sequence[new]] = new
        self.prefixes = {s[:i] for s in self.token_of for i in range(1, len(s))}  # proper ones
        self.pairs: dict = {}
        self.whole: dict = {}
        self._restart()

    def _restart(self) -> None:
        self.ids = {((), ((None, 0),)): 0}
        self.states = [((), ((None, 0),))]
        self.column = np.full(512, -1, np.int64)
        self.width, self.used = 64, 0
        self.next = np.full((1024, self.width + 1), -1, np.int32)
        self.delta = np.zeros((1024, self.width + 1), np.int8)

    def encode(self, symbols: tuple) -> list[int]:
        """Plain merging, for the tests of token pairs at compile time."""
        ids = [self.token_of[s,] for s in symbols]
        while len(ids) > 1:
            best = min(((self.merge[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merge), default=None)
            if best is None:
                break
            i = best[1]
            ids[i:i + 2] = [self.merge[ids[i], ids[i + 1]][1]]
        return ids

    def _follows(self, last: "int | None", token: int) -> bool:
        """May ``token`` come right after ``last`` (None: at the start of a word)?"""
        if token not in self.whole:
            self.whole[token] = self.encode(self.sequence[token]) == [token]
        if last is None or not self.whole[token]:
            return self.whole[token]
        if (last, token) not in self.pairs:
            self.pairs[last, token] = self.encode(self.sequence[last] + self.sequence[token]) == [last, token]
        return self.pairs[last, token]

    def _compile(self, state: int, symbol: int) -> None:
        context, marks = self.states[state]  # marks[k]: last token and relative count k symbols back
        grown = context + (symbol,)
        for length in range(len(grown), 0, -1):
            token = self.token_of.get(grown[len(grown) - length:])
            if token is not None and marks[length - 1] is not _PAST and self._follows(marks[length - 1][0], token):
                count = marks[length - 1][1] + 1
                break
        else:
            raise ValueError("the merges are not those of a byte-pair vocabulary")
        if symbol >= 256:
            after = 0
        else:
            marks = ((token, 0), *((t, n - count) for t, n in marks))
            cut = next(i for i in range(len(grown) + 1) if i == len(grown) or grown[i:] in self.prefixes)
            grown = grown[cut:]
            # A position matters only where the symbols after it may begin a longer token.
            key = (grown, tuple(marks[k] if not k or grown[len(grown) - k:] in self.prefixes else _PAST
                                for k in range(len(grown) + 1)))
            after = self.ids.get(key)
            if after is None:
                after = self.ids[key] = len(self.states)
                self.states.append(key)
        if after >= len(self.next):
            self.next = np.vstack([self.next, np.full_like(self.next, -1)])
            self.delta = np.vstack([self.delta, np.zeros_like(self.delta)])
        self.next[state, self.column[symbol]] = after
        self.delta[state, self.column[symbol]] = count

    def _columns(self, symbols: np.ndarray) -> np.ndarray:
        """Columns of the transition table; column 0 leaves the state as it is."""
        new = np.flatnonzero((np.bincount(symbols, minlength=512) > 0) & (self.column < 0))
        if len(new):
            if self.used + len(new) > self.width:
                more = -(-(self.used + len(new) - self.width) // 64) * 64
                self.next = np.hstack([self.next, np.full((len(self.next), more), -1, np.int32)])
                self.delta = np.hstack([self.delta, np.zeros((len(self.delta), more), np.int8)])
                self.width += more
            self.column[new] = self.used + 1 + np.arange(len(new))
            self.used += len(new)
            self.symbol = np.zeros(self.width + 1, np.int64)
            self.symbol[self.column[self.column >= 0]] = np.flatnonzero(self.column >= 0)
        return self.column[symbols]

    def _run(self, grid: np.ndarray, state: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Lockstep over the rows of ``grid`` (steps x lanes of columns, 0: nothing to do); adds the counts to ``out``."""
        for i, columns in enumerate(grid):
            following = self.next[state, columns]
            idle = columns == 0
            missing = np.flatnonzero((following < 0) & ~idle)
            if len(missing):
                for key in np.unique(state[missing] * 1024 + columns[missing]).tolist():
                    self._compile(key // 1024, int(self.symbol[key % 1024]))
                following = self.next[state, columns]
            out[i] += self.delta[state, columns]
            state = np.where(idle, state, following)
        return state

    def changes(self, symbols: np.ndarray, lane: int = LANE) -> np.ndarray:
        """The change in emitted tokens at every symbol of a stream of whole words."""
        if len(self.states) > MAX_STATES:
            self._restart()
        n = len(symbols)
        lanes = -(-n // lane)
        columns = np.zeros(lanes * lane, np.int64)
        columns[:n] = self._columns(symbols)
        ends = np.zeros(lanes * lane, bool)
        ends[:n] = symbols >= 256
        ends = ends.reshape(lanes, lane)
        has_end = ends.any(axis=1)
        head = np.where(has_end, ends.argmax(axis=1) + 1, lane)  # symbols up to the first end of a word
        in_head = np.arange(lane)[:, None] < head[None, :]
        grid = np.ascontiguousarray(columns.reshape(lanes, lane).T)
        out = np.zeros((lane, lanes), np.int32)
        # Bodies: after the first end the state is the start state.
        end_state = self._run(np.where(in_head, 0, grid), np.zeros(lanes, np.int64), out)
        # Heads: each from the composed state before it; a chunk inside one long word passes its own state on.
        known = np.concatenate([[True], has_end[:-1]])
        start = np.concatenate([[0], end_state[:-1]])
        todo = np.arange(lanes)
        while len(todo):
            now = todo[known[todo]]
            longest = int(head[now].max())
            part = np.zeros((longest, len(now)), np.int32)
            heads = np.where(in_head[:longest, now], grid[:longest, now], 0)
            ended = self._run(heads, start[now], part)
            out[:longest, now] += part
            passed = now[~has_end[now]]
            nxt = passed + 1
            ok = nxt < lanes
            known[nxt[ok]] = True
            start[nxt[ok]] = ended[~has_end[now]][ok]
            todo = todo[~np.isin(todo, now)]
        return out.T.reshape(-1)[:n]


class Classes:
    """Lower case and class of code points, filled in as they are met."""

    def __init__(self):
        self.kind = np.full(0x110000, 255, np.uint8)
        self.lower = np.arange(0x110000, dtype=np.uint32)

    def of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.unique(points[self.kind[points] == 255])
        for p in new.tolist():
            low = chr(p).lower()
            low = low if len(low) == 1 else chr(p)
            self.lower[p] = ord(low)
            self.kind[p] = (_QUOTE if low == "'" else _SHORT if low in "stmd" else _R if low == "r" else _V if low == "v"
                            else _E if low == "e" else _L if low == "l" else _SPACE if regex.match(r"\s", low)
                            else _LETTER if regex.match(r"\p{L}", low) else _NUMBER if regex.match(r"\p{N}", low) else _OTHER)
        return self.lower[points], self.kind[points]


def count_tokens(texts: list[bytes], counter: Counter, classes: Classes) -> np.ndarray:
    """Token count of each text."""
    specials = np.zeros(len(texts), np.int64)
    clean = []
    for i, t in enumerate(texts):
        text = t.decode("utf-8")
        for special in counter.specials:
            if special in text:
                specials[i] += text.count(special)
                text = text.replace(special, "\n")
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("İ", "i̇")
        clean.append(text)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in clean])])
    points = np.frombuffer(("\n".join(clean) + "\n").encode("utf-32-le"), np.uint32)
    lower, kind = classes.of(points)
    states = split_states(kind)
    inside = states != IN_SPACE
    if not inside.any():
        return specials
    starts = word_starts(states)[inside]
    lower = lower[inside]
    data = np.frombuffer(lower.tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
    width = 1 + (lower >= 0x80) + (lower >= 0x800) + (lower >= 0x10000)
    ends = np.cumsum(width)
    symbols = data.astype(np.int64)
    symbols[ends[np.concatenate([starts[1:], [True]])] - 1] += 256
    total = np.concatenate([[0], np.cumsum(counter.changes(symbols))])
    byte_at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(inside)])[at]]
    return specials + np.diff(total[byte_at])


_compiled: dict = {}


def _count_batches(batches: Iterator[pa.RecordBatch], spec: bytes) -> Iterator[pa.RecordBatch]:
    key = hashlib.sha256(spec).digest()
    if key not in _compiled:
        _compiled[key] = (Counter(json.loads(spec)), Classes())
    for batch in slices(batches, "text", BATCH_BYTES):
        texts = byte_texts(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
             pa.array(count_tokens(texts, *_compiled[key]), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; ``tokenizer``: path of the JSON file on the driver (its bytes are sent)."""
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = docs.mapInArrow(lambda it: _count_batches(it, spec.value), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document as word_bpe_49k counts them."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
