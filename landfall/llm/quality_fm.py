"""Operator 4, quality classifier: a factorisation machine.

A text's features are its hashed words (log counts, scaled to unit length),
structure statistics and, as metadata, its stated length. The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

and the pairwise sum is computed in linear time as
``(|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2``.

Training uses at most ``sample`` labelled rows whose fold is not the held-out
one, taken in the order of a hash of the id: a bounded sample, so the model is
fitted by one process from the sample's features. Every text is scored whole.
Neither labels, language, source nor id is a feature.

Defined cases: a null or empty text has no words and zero statistics and gets
the score of such a text; a null id is in the held-out fold; rows that share an
id are scored by their own text; of several labels of an id a row counts as
good if at least half say so, and null labels are left out; without any label
of either kind every score is 0.5; an empty table gives an empty result; other
columns are not read by the scorer (the filter passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from landfall.llm.common import Words, byte_texts, every_column, slices, table

BUCKETS = 1 << 14
RANK = 8
SAMPLE = 8192        # labelled rows that the model is fitted on
FOLDS = 5
THRESHOLD = 0.3
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.02, 2e-5
BATCH_BYTES = 2 << 20

# Byte kinds for the structure statistics.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*b"abcdefghijklmnopqrstuvwxyz"]] = 1
_KINDS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
_KINDS[[*b"0123456789"]] = 3
_KINDS[[*b".,;:?'\"()-"]] = 4
_KINDS[[*b"!#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KINDS[10] = 6
_KINDS[[9, 11, 12, 13, 32]] = 7
_KINDS[128:] = 8
STATISTICS = ("log bytes", "log words", "word length", "short words", "long words", "upper", "digits", "punctuation",
              "symbols", "non-ascii", "lines per word", "repeated words", "top word", "words of symbols", "repeated lines",
              "line end stops", "stated length")


class Features:
    """Sparse rows (doc bounds, feature numbers, values) of several texts."""

    def __init__(self, texts: list[bytes], stated: np.ndarray, buckets: int):
        words = Words(texts)
        n = len(texts)
        index, distinct = words.dictionary()
        lowered = [w.lower() for w in distinct]
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in lowered), np.int64, len(lowered))
        of = words.text_of_word()
        keys, counts = np.unique(of * buckets + bucket[index] if len(of) else np.zeros(0, np.int64), return_counts=True)
        of_row = keys // buckets
        value = np.log1p(counts)
        norm = np.sqrt(np.bincount(of_row, value * value, minlength=n))
        self.rows = of_row
        self.index = keys % buckets
        self.value = (value / norm[of_row]).astype(np.float32)
        self.statistics = self._structure(texts, words, of, of_row, counts, stated)

    def _structure(self, texts, words, of, of_row, counts, stated) -> np.ndarray:
        n = len(texts)
        kind = _KINDS[np.frombuffer(words.data, np.uint8)]
        size = np.diff(words.text_at) - 1
        row = np.repeat(np.arange(n), size + 1)
        kinds = np.bincount(row * 9 + kind, minlength=9 * n).reshape(n, 9).astype(float)
        kinds[:, 6] -= 1  # the line break that Words adds
        some, n_words = np.maximum(size, 1), np.diff(words.bounds)
        per = np.maximum(n_words, 1)
        length = words.ends - words.starts
        marks = np.concatenate([[0], np.cumsum(kind == 5)])
        odd = (marks[words.ends] - marks[words.starts]) * 2 >= length
        top = np.zeros(n)
        np.maximum.at(top, of_row, counts)
        lines, again, stops = np.ones(n), np.zeros(n), np.zeros(n)
        for i, t in enumerate(texts):
            own = [x for x in t.split(b"\n") if x]
            lines[i] = max(1, len(own))
            again[i] = len(own) - len(set(own))
            stops[i] = sum(x[-1] in b".!?" for x in own)
        by_word = lambda w: np.bincount(of, w, minlength=n) / per
        return np.column_stack([
            np.log1p(size), np.log1p(n_words), by_word(length), by_word(length <= 3), by_word(length >= 12),
            kinds[:, 2] / some, kinds[:, 3] / some, kinds[:, 4] / some, kinds[:, 5] / some, kinds[:, 8] / some,
            lines / per, 1 - np.bincount(of_row, minlength=n) / per, top / per, by_word(odd), again / lines, stops / lines,
            np.log1p(stated)]).astype(np.float32)


class Machine:
    def __init__(self, buckets: int = BUCKETS, rank: int = RANK, seed: int = 7):
        self.buckets, self.size = buckets, buckets + len(STATISTICS)
        rng = np.random.default_rng(seed)
        self.seed = seed
        # Column 0: linear weights; the others: factors; the last row: bias (factors unused).
        self.weights = np.zeros((self.size + 1, rank + 1), np.float32)
        self.weights[:self.size, 1:] = rng.normal(0, 0.05, (self.size, rank))
        self.mean, self.scale = np.zeros(len(STATISTICS), np.float32), np.ones(len(STATISTICS), np.float32)

    def rows(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, feature and value of all entries, in row order."""
        n, k = f.statistics.shape
        scaled = np.clip((f.statistics - self.mean) * self.scale, -4, 4) / 2
        row = np.concatenate([f.rows, np.repeat(np.arange(n, dtype=f.rows.dtype), k)])
        order = np.argsort(row, kind="stable")
        return (row[order], np.concatenate([f.index, np.tile(np.arange(self.buckets, self.size, dtype=f.index.dtype), n)])[order],
                np.concatenate([f.value, scaled.reshape(-1)], dtype=np.float32)[order])

    def _sums(self, n: int, row: np.ndarray, index: np.ndarray, x: np.ndarray):
        """Per row the sum of w x and of v x, and the raw score by the sum-of-squares identity."""
        terms = self.weights[index] * x[:, None]
        begin = np.searchsorted(row, np.arange(n))  # every row has its statistics, so none is empty
        sums = np.add.reduceat(terms, begin, axis=0)
        squares = np.add.reduceat((terms[:, 1:] ** 2).sum(axis=1), begin)
        raw = self.weights[-1, 0] + sums[:, 0] + ((sums[:, 1:] ** 2).sum(axis=1) - squares) / 2
        return sums, raw

    def score(self, f: Features) -> np.ndarray:
        n = len(f.statistics)
        _, raw = self._sums(n, *self.rows(f))
        return 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))

    def fit(self, row: np.ndarray, index: np.ndarray, x: np.ndarray, label: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adam on the log loss."""
        n, rng = len(label), np.random.default_rng(self.seed)
        at = np.searchsorted(row, np.arange(n + 1))
        m, v, t = np.zeros_like(self.weights), np.zeros_like(self.weights), 0
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = rng.permutation(n)
            for i in range(0, n, BATCH):
                some = order[i:i + BATCH]
                size = at[some + 1] - at[some]
                entry = np.repeat(at[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
                own, feature, value = np.repeat(np.arange(len(some)), size), index[entry], x[entry]
                sums, raw = self._sums(len(some), own, feature, value)
                error = ((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[some]) / len(some)).astype(np.float32)
                part = error[own] * value
                step = np.empty((len(entry), self.weights.shape[1]), np.float32)
                step[:, 0] = part
                step[:, 1:] = part[:, None] * (sums[own, 1:] - self.weights[feature, 1:] * value[:, None])
                grad = DECAY * self.weights
                ranked = np.argsort(feature, kind="stable")
                feature = feature[ranked]
                new = np.flatnonzero(np.concatenate([[True], feature[1:] != feature[:-1]]))
                grad[feature[new]] += np.add.reduceat(step[ranked], new, axis=0)
                grad[-1, 0] = error.sum()
                t += 1
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                self.weights -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        self.weights[-1, 1:] = 0


def fold(id_col: "F.Column", folds: int = FOLDS) -> "F.Column":
    """The remainder of the crc32 of the id as text; 0 (held out) for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def _feature_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        f = Features(byte_texts(batch.column("text")), _stated(batch), buckets)
        cut = np.searchsorted(f.rows, np.arange(batch.num_rows + 1))
        for i in range(batch.num_rows):
            own = slice(cut[i], cut[i + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(i, 1), batch.column("label").slice(i, 1),
                 pa.array([f.index[own].astype(np.int32).tobytes()]), pa.array([f.value[own].tobytes()]),
                 pa.array([f.statistics[i].tobytes()])], names=["id", "label", "index", "value", "statistics"])


def _stated(batch: pa.RecordBatch) -> np.ndarray:
    return np.maximum(0, batch.column("n_chars").fill_null(0).to_numpy(zero_copy_only=False)).astype(float)


def _with_length(docs: DataFrame) -> DataFrame:
    """The stated length; without such a column, the text's own."""
    if "n_chars" in docs.columns:
        return docs.withColumn("n_chars", F.col("n_chars").cast("long"))
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
          buckets: int = BUCKETS) -> Machine:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    labelled = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
                .groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
                .where(fold(F.col("id")) != 0).orderBy(F.xxhash64("id"), "id").limit(sample))
    picked = _with_length(docs.select(*(c for c in ("doc_id", "text", "n_chars") if c in docs.columns))).join(
        F.broadcast(labelled), F.col("doc_id") == F.col("id"))  # at most ``sample`` rows of two numbers
    rows = (picked.select("id", "label", "text", "n_chars")
            .mapInArrow(lambda it: _feature_rows(it, buckets), "id long, label int, index binary, value binary, statistics binary")
            .dropDuplicates(["id"]).collect())
    rows.sort(key=lambda r: r["id"])
    machine = Machine(buckets)
    label = np.array([r["label"] for r in rows], np.float32)
    if not 0 < label.sum() < len(label):
        machine.weights[:] = 0
        return machine
    f = Features.__new__(Features)
    f.statistics = np.array([np.frombuffer(r["statistics"], np.float32) for r in rows])
    index = [np.frombuffer(r["index"], np.int32) for r in rows]
    f.rows = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in index])
    f.index = np.concatenate(index)
    f.value = np.concatenate([np.frombuffer(r["value"], np.float32) for r in rows])
    del rows, index
    machine.mean = f.statistics.mean(axis=0)
    machine.scale = 1 / np.maximum(f.statistics.std(axis=0), 1e-3)
    machine.fit(*machine.rows(f), label)
    return machine


def _score_batches(batches: Iterator[pa.RecordBatch], machine: Machine) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        f = Features(byte_texts(batch.column("text")), _stated(batch), machine.buckets)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(machine.score(f))], names=["doc_id", "score"])


def quality_scores(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # buckets * (rank + 1) numbers
    docs = _with_length(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                    *(c for c in ("n_chars",) if c in docs.columns)))
    scored = docs.mapInArrow(lambda it: _score_batches(it, model.value), "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def _good_batches(batches: Iterator[pa.RecordBatch], machine: Machine, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        f = Features(byte_texts(batch.column("text")), _stated(batch), machine.buckets)
        good = batch.filter(pa.array(machine.score(f) >= threshold))
        yield good.select(good.schema.names[:-2])


def good_documents(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns, whatever their names."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    length = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    # Columns go through the workers under plain names.
    plain = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(docs.schema)])
    wide = docs.select(*[c.alias(n) for c, n in zip(every_column(docs), plain.names)],
                       F.col("text").cast("string").alias("text"), length.alias("n_chars"))
    good = wide.mapInArrow(lambda it: _good_batches(it, model.value, threshold), plain)
    return good.select(*[F.col(n).alias(f.name, metadata=f.metadata) for n, f in zip(plain.names, docs.schema)])


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by a machine trained on the other folds."""
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
