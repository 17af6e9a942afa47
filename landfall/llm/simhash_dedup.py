"""Operator 5, SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has 64 bits, 8 positional bytes. Fingerprints that differ in at
most ``max_bits`` bits differ in at most so many bytes, so they share at least
``8 - max_bits`` positional bytes: the guaranteed minimum. Postings of single
bytes hold 1/256 of the corpus each, and tallying their pairs would be
quadratic; the index is therefore kept by every set of ``8 - max_bits``
positions with the bytes there (56 sets of five for three bits), in place of a
tally: every pair that meets shares the minimum. It is verified by the bit
distance, and taken up only in the posting of its first five shared positions.

Equal fingerprints are one entry, so a posting holds different fingerprints
only. Inside a posting no more than a spanning forest of its links leaves the
task; a long posting is searched by flipping the bits outside its bytes, which
is linear in its length. Links are contracted to components by randomised
contraction, each round a few aggregations over a written table.

Defined cases: a null or empty text has fingerprint zero, and such texts are
linked like any others; a text of fewer words than a shingle is one shingle; a
null id comes after every id; rows that share an id are ordered by the hash of
their text; an empty table gives an empty result; only the two named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.common import Words, byte_texts, every_column, fresh, from_id_key, id_key, materialise, slices, table

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BATCH_BYTES = 2 << 20
LONG_POSTING = 4096  # from here on a posting is searched by bit flips instead of by pairs


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: A-Z lower-cased, word shingles with repeats, XXH64; a bit is 1 if set in over half."""
    words = Words([b" ".join(t.lower().split()) for t in texts])
    out = np.zeros(len(texts), np.uint64)
    n_words = np.diff(words.bounds)
    n = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    has = np.flatnonzero(n)
    if not len(has):
        return out
    first = np.repeat(words.bounds[:-1], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    last = first + np.repeat(np.minimum(n_words, shingle), n) - 1
    data, digest = words.data, xxhash.xxh64_digest
    hashed = b"".join([digest(data[i:j], SEED) for i, j in zip(words.starts[first].tolist(), words.ends[last].tolist())])
    bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
    ends = np.cumsum(n)
    for t in has.tolist():
        ones = bits[ends[t] - n[t]:ends[t]].sum(axis=0, dtype=np.int64)
        out[t] = np.packbits(2 * ones > n[t]).view(">u8")[0]
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        fp = fingerprints(byte_texts(batch.column("text")), shingle)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(fp.view(np.int64))],
                                         names=["id", "th", "fp"])


def _masks(max_bits: int) -> list[int]:
    """For every set of guaranteed positions the mask of its bytes, as a signed 64-bit number."""
    masks = [sum(0xFF << (8 * p) for p in s) for s in combinations(range(8), 8 - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _first_set(max_bits: int) -> np.ndarray:
    """For every set of shared positions (as 8 bits) the number of the first guaranteed set inside it, else -1."""
    sets = [sum(1 << p for p in s) for s in combinations(range(8), 8 - max_bits)]
    return np.array([next((i for i, s in enumerate(sets) if s & shared == s), -1) for shared in range(256)], np.int16)


def _shared(x: np.ndarray) -> np.ndarray:
    """The positions whose bytes agree, as 8 bits, from the difference of two fingerprints."""
    same = np.ascontiguousarray(x).view(np.uint8).reshape(*x.shape, 8) == 0
    return np.packbits(same, axis=-1, bitorder="little")[..., 0]


def _posting_links(fp: np.ndarray, number: int, mask: int, max_bits: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one posting that agree in the guaranteed positions, met here first, and verify."""
    def keep(i, j):
        x = fp[i] ^ fp[j]
        ok = (first[_shared(x)] == number) & (np.bitwise_count(x) <= max_bits)
        return i[ok], j[ok]

    n = len(fp)
    found = []
    if n <= LONG_POSTING:
        step = max(1, (1 << 20) // n)
        for at in range(0, n, step):
            x = fp[at:at + step, None] ^ fp[None, :]
            i, j = np.nonzero(np.bitwise_count(x) <= max_bits)
            i = i + at
            found.append(keep(i[i < j], j[i < j]))
    else:
        order = np.argsort(fp)
        ranked = fp[order]
        free = [b for b in range(64) if not (mask >> b) & 1]
        for k in range(1, max_bits + 1):
            for flips in combinations(free, k):
                other = fp ^ np.uint64(sum(1 << b for b in flips))
                at = np.minimum(np.searchsorted(ranked, other), n - 1)
                i = np.flatnonzero((ranked[at] == other) & (fp < other))
                if len(i):
                    found.append(keep(i, order[at[i]]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from every index."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside every posting; the rows come ordered by posting, and a posting may span batches."""
    masks = np.array(_masks(max_bits), np.int64).view(np.uint64)
    first = _first_set(max_bits)
    held_set, held_fp = np.zeros(0, np.int16), np.zeros(0, np.uint64)

    def search(sets, fps):
        key = fps & masks[sets]
        new = np.ones(len(fps), bool)
        new[1:] = (sets[1:] != sets[:-1]) | (key[1:] != key[:-1])
        at = np.flatnonzero(new)
        size = np.diff(at, append=len(fps))
        two = at[size == 2]
        x = fps[two] ^ fps[two + 1]
        ok = (first[_shared(x)] == sets[two]) & (np.bitwise_count(x) <= max_bits)
        a, b = [fps[two][ok]], [fps[two + 1][ok]]
        for s, n in zip(at[size > 2].tolist(), size[size > 2].tolist()):
            own = fps[s:s + n]
            i, j = _posting_links(own, int(sets[s]), int(masks[sets[s]]), max_bits, first)
            if len(i):
                root = _forest(n, i, j)
                tied = np.flatnonzero(root != np.arange(n))
                a.append(own[tied])
                b.append(own[root[tied]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        sets = np.concatenate([held_set, batch.column("set").to_numpy().astype(np.int16)])
        fps = np.concatenate([held_fp, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(fps):
            continue
        key = fps & masks[sets]
        other = np.flatnonzero((sets != sets[-1]) | (key != key[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield search(sets[:cut], fps[:cut])
        held_set, held_fp = sets[cut:], fps[cut:]
    if len(held_fp):
        yield search(held_set, held_fp)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all different fingerprints within ``max_bits``; ``prints``: distinct fp."""
    masks = _masks(max_bits)
    posted = prints.select("fp", F.explode(F.array(*[F.lit(i).cast("short") for i in range(len(masks))])).alias("set"))
    mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), F.col("set").cast("int") + 1)
    key = F.col("fp").bitwiseAND(mask)
    return (posted.repartition("set", key).sortWithinPartitions("set", key)
            .select("set", "fp").mapInArrow(lambda it: _links(it, max_bits), "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link, by randomised contraction.

    Each round every node goes to the neighbour (or itself) that comes first in a
    random order drawn for the round; links between the nodes that are left go on.
    """
    edges = materialise(links.where("a <> b").distinct(), "links")
    root, step = None, 0
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.xxhash64("b", F.lit(step))
        best = both.groupBy("a").agg(F.min(F.struct(rank.alias("rank"), F.col("b").alias("b"))).alias("best"))
        own = F.struct(F.xxhash64("a", F.lit(step)).alias("rank"), F.col("a").alias("b"))
        moves = materialise(best.select(F.col("a").alias("node"), F.least(F.col("best"), own)["b"].alias("to")), "moves")
        left = (edges.join(moves.withColumnsRenamed({"node": "a", "to": "x"}), "a")
                .join(moves.withColumnsRenamed({"node": "b", "to": "y"}), "b")
                .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        edges = materialise(left, "links")
        if root is None:
            root = moves.withColumnRenamed("to", "root")
        else:
            root = materialise(root.join(moves.withColumnsRenamed({"node": "root"}), "root", "left")
                               .select(root["node"], F.coalesce("to", root["root"]).alias("root")), "roots")
        step += 1
    return root if root is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id (null last), th (text hash), fp, and the first (id, th) of its component."""
    slim = docs.select(id_key(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    prints = materialise(slim.mapInArrow(lambda it: _fingerprint_batches(it, shingle), "id long, th long, fp long"), "prints")
    nodes = materialise(prints.groupBy("fp").agg(F.min(F.struct("id", "th")).alias("first")), "nodes")
    root = components(near_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(root, nodes["fp"] == root["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    leader = rooted.groupBy("root").agg(F.min("first").alias("lead"))
    of_print = materialise(rooted.join(leader, "root").select("fp", "lead"), "leaders")
    return prints.join(of_print, "fp")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """The first document of every component, with all its columns, whatever their names."""
    own, th = fresh(docs.columns, "own", "th")
    found = simhash_components(docs, id_col, text_col, shingle, max_bits)
    kept = (found.where((F.col("lead.id") == F.col("id")) & (F.col("lead.th") == F.col("th")))
            .select(F.col("id").alias(own), F.col("th").alias(th)).distinct())
    keyed = docs.withColumns({own: id_key(id_col), th: F.xxhash64(text_col)})
    return keyed.join(kept, [own, th]).dropDuplicates([own, th]).select(*every_column(docs))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id of its component."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select(from_id_key("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        from_id_key("lead.id").alias("component_id"))
