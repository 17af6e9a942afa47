"""Operator 7, approximate nearest neighbours by collision-counting hashing.

Vectors get one more component so that the largest inner product becomes the
smallest distance (``sqrt(longest^2 - |x|^2)``, ``longest`` being that of the
block; queries get 0 and are brought to the length ``longest``, which leaves
their order of the vectors). Every block of vectors keeps ``projections``
arrays, each sorted by the projection on one random direction. A query opens a window around its own projection in every
array and widens all of them by virtual rehashing (the half-width grows by a
factor, the arrays stay); a vector collides where it lies in the window. A
vector whose collisions exceed the threshold is verified by its inner product
in double precision. A block is done with a query when at the end of a round a
share of its vectors (``SHARE``, and at least ``VERIFY``) is verified and the
windows are so wide that a vector as near as the last of the nearest found would
exceed the threshold with probability ``RECALL``, or when all are verified. The
second rule holds for any norms. No window, candidate set or partner list is
capped.

Vectors are dealt into blocks by ranges of their norm (the ends of a range are
``RANGE`` apart; ranges of few vectors, which are all verified, share a block),
a range of many vectors further by a hash of the row; the stated queries visit
every block, in batches; each block returns its nearest, and the nearest of all
blocks remain. A block holds at most about ``block_rows`` vectors, so a task's
memory does not grow with the table. Equal rows (id and vector) count once
before they are dealt, and a block's nearest are different ids.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part; vectors of different length are never compared; equal
scores go to the smaller id; null ids take no part; of rows that share an id
the best score counts, none of them is found by their own id's query, and
several queries of one id are answered together; fewer candidates than wanted
are all returned; an empty table gives an empty result; only the two named
columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from landfall.llm.common import materialise, small_table, table

NEAREST = 20
PROJECTIONS = 96
THRESHOLD = 80       # collisions that a vector must exceed
VERIFY, SHARE = 400, 0.12   # vectors of a block verified for a query: at least so many, and this share
RECALL = 0.9         # probability that a vector as near as the last of a block's nearest is verified
RANGE = 1.25         # longest to shortest norm of a range
START, GROWTH = 1.7, 1.06   # first half-width, in units of the projections' spread, and its growth
BLOCK_ROWS = 16384
SEED = 11

_FOUND = "query_id long, vec_id long, score double"


def _reach() -> float:
    """The half-width, per distance, at which a vector exceeds the threshold with probability RECALL."""
    low, high = 0.0, 1.0   # probability of one collision
    for _ in range(60):
        p = (low + high) / 2
        over = sum(math.comb(PROJECTIONS, c) * p ** c * (1 - p) ** (PROJECTIONS - c) for c in range(THRESHOLD + 1, PROJECTIONS + 1))
        low, high = (p, high) if over < RECALL else (low, p)
    return NormalDist().inv_cdf((1 + high) / 2)


REACH = _reach()


def _length(vectors: np.ndarray) -> np.ndarray:
    """Norms of the rows; no square overflows or vanishes."""
    most = np.abs(vectors).max(axis=1)
    return most * np.sqrt(((vectors / most[:, None]) ** 2).sum(axis=1))


class Block:
    """Sorted projection arrays of one block of vectors of one length, in units of its longest vector."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.repeats = len(np.unique(ids)) < len(ids)
        n, dim = vectors.shape
        lengths = _length(vectors)
        self.longest = float(lengths.max())
        if n <= VERIFY:
            return
        lift = np.sqrt(np.maximum(0.0, 1 - (lengths / self.longest) ** 2))
        self.directions = np.random.default_rng(SEED).normal(size=(dim + 1, PROJECTIONS))
        projected = np.column_stack([vectors / self.longest, lift]) @ self.directions
        order = np.argsort(projected, axis=0).T
        self.sorted = np.take_along_axis(projected.T, order, axis=1)
        self.order = order.astype(np.uint16 if n <= 1 << 16 else np.int64)
        self.spread = max(float(projected.std(axis=0).mean()), 1e-12)

    def windows(self, centres: np.ndarray, half: float) -> tuple[list, list]:
        """Per query and array the part of the array inside the window: where it begins, where it ends."""
        low = [a.searchsorted(c - half, "left") for a, c in zip(self.sorted, centres.T)]
        high = [a.searchsorted(c + half, "right") for a, c in zip(self.sorted, centres.T)]
        return np.array(low).T.tolist(), np.array(high).T.tolist()

    def scores(self, query_id: int, query: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vectors ``at`` without the query's own id, and their inner products."""
        at = at[self.ids[at] != query_id]
        return at, np.einsum("ij,j->i", self.vectors[at], query)  # row by row: equal vectors get equal bits, wherever they are

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places in ``at`` of the ``k`` best different ids."""
        near = np.arange(len(at))
        if not self.repeats and len(at) > k:
            near = np.flatnonzero(score >= np.partition(score, -k)[-k])
        near = near[np.lexsort((self.ids[at[near]], -score[near]))]
        if self.repeats:
            near = near[np.sort(np.unique(self.ids[at[near]], return_index=True)[1])]
        return near[:k]

    def candidates(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the verified vectors and their scores: those whose collisions exceed the threshold, once the block is done."""
        n = len(self.ids)
        enough = max(VERIFY, int(SHARE * n))
        if n <= VERIFY:
            yield from (self.scores(i, query, np.arange(n)) for i, query in zip(query_ids, queries))
            return
        lengths = _length(queries)
        centres = np.column_stack([queries / lengths[:, None], np.zeros(len(queries))]) @ self.directions
        rounds = [self.windows(centres, START * self.spread)]
        for q, (query_id, query) in enumerate(zip(query_ids, queries)):
            low, high = rounds[0][0][q], rounds[0][1][q]
            # The first windows are wide: what lies outside them is counted.
            rings = [o[:i] for o, i in zip(self.order, low)] + [o[j:] for o, j in zip(self.order, high)]
            count = PROJECTIONS - np.bincount(np.concatenate(rings, dtype=np.intp), minlength=n)
            found, r = count > THRESHOLD, 0
            at, score = self.scores(query_id, query, np.flatnonzero(found))
            while max(low) > 0 or min(high) < n:
                nearest = self.best(at, score, k) if found.sum() >= enough else ()
                if len(nearest) >= k:
                    last = score[nearest[-1]] / lengths[q] / self.longest
                    if START * GROWTH ** r * self.spread >= REACH * math.sqrt(max(0.0, 2 - 2 * last)):
                        break
                r += 1
                if r == len(rounds):
                    rounds.append(self.windows(centres, START * GROWTH ** r * self.spread))
                wider_low, wider_high = rounds[r][0][q], rounds[r][1][q]
                rings = [o[i:j] for o, i, j in zip(self.order, wider_low, low)]
                rings += [o[i:j] for o, i, j in zip(self.order, high, wider_high)]
                count += np.bincount(np.concatenate(rings, dtype=np.intp), minlength=n)
                low, high = wider_low, wider_high
                fresh = self.scores(query_id, query, np.flatnonzero((count > THRESHOLD) & ~found))
                found = count > THRESHOLD
                at, score = np.concatenate([at, fresh[0]]), np.concatenate([score, fresh[1]])
            yield at, score

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
        for query_id, (at, score) in zip(query_ids.tolist(), self.candidates(query_ids, queries, k)):
            best = self.best(at, score, k)
            yield np.full(len(best), query_id), self.ids[at][best], score[best]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by (dim, block, role): the vectors of a block, then its queries."""
    block, key, held = None, None, []
    for batch in batches:
        keys = list(zip(batch.column("dim").to_pylist(), batch.column("block").to_pylist(), batch.column("role").to_pylist()))
        ids = batch.column("vec_id").to_numpy()
        flat = batch.column("vector")
        out: list = []
        i = 0
        while i < len(keys):
            j = i
            while j < len(keys) and keys[j] == keys[i]:
                j += 1
            own = flat.slice(i, j - i).flatten().to_numpy().reshape(j - i, -1)
            if keys[i][2] == 0:
                if key != keys[i][:2]:
                    key, held, block = keys[i][:2], [], None
                held.append((ids[i:j], own))
            elif key == keys[i][:2]:
                if block is None:
                    block = Block(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                out += block.nearest(ids[i:j], own, k)
            i = j
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                             names=["query_id", "vec_id", "score"])


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles), dim: the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where(F.col("vec_id").isNotNull())
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return rows.withColumn("dim", F.size("vector"))


def _with_range(rows: DataFrame) -> DataFrame:
    """The rows with the range of their norm: its logarithm in units of log(RANGE), rounded."""
    rows = rows.withColumn("squares", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    most = F.array_max(F.transform("vector", F.abs))
    parts = F.aggregate(F.transform("vector", lambda x: x / most), F.lit(0.0), lambda s, x: s + x * x)
    norm = F.when(F.col("squares").between(1e-280, 1e280), F.log("squares") / 2).otherwise(F.log(most) + F.log(parts) / 2)
    return rows.withColumn("norm_range", F.floor(norm / math.log(RANGE) + 0.5).cast("int")).drop("squares")


def _deal(sizes: dict[tuple[int, int], int], block_rows: int) -> list[tuple[int, int, int, int, int]]:
    """dim, norm range, its first block, its number of blocks, the number of blocks of the dim."""
    out, every = [], {}
    shared = {}   # per dim the rows in its last block, if that is one of small ranges
    for (dim, norm_range), n in sorted(sizes.items()):
        if n + shared.get(dim, VERIFY) <= min(VERIFY, block_rows):
            shared[dim] += n
            out.append((dim, norm_range, every[dim] - 1, 1))
            continue
        blocks = -(-n // block_rows)
        out.append((dim, norm_range, every.get(dim, 0), blocks))
        every[dim] = every.get(dim, 0) + blocks
        shared[dim] = n
    return [(*row, every[row[0]]) for row in out]


def nearest_neighbours(embeddings: DataFrame, queries: "F.Column", k: int = NEAREST, id_col: str = "vec_id",
                       vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: of every row that ``queries`` (a condition on vec_id) marks, its ``k`` nearest."""
    spark = embeddings.sparkSession
    rows = usable(embeddings, id_col, vector_col).distinct()  # copies of a row would fill one block, and ask as often
    rows = materialise(_with_range(rows), "vectors")
    sizes = rows.groupBy("dim", "norm_range").count().collect()  # doubles span some 6,400 ranges
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranges = _deal({(r["dim"], r["norm_range"]): r["count"] for r in sizes}, block_rows)
    rows = rows.join(small_table(spark, ranges, "dim int, norm_range int, first int, blocks int, every int"), ["dim", "norm_range"])
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks"))).cast("int")
    columns = ("dim", "block", "role", "vec_id", "vector")
    stored = rows.withColumns({"block": block, "role": F.lit(0)}).select(*columns)
    asked = rows.where(queries).withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("every") - 1)), "role": F.lit(1)})
    found = (stored.unionByName(asked.select(*columns)).repartition("dim", "block")
             .sortWithinPartitions("dim", "block", "role").mapInArrow(lambda it: _search(it, k), _FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
