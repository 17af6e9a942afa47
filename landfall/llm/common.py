"""Shared pieces of the training-data operators: reading tables, working tables, words in numpy.

A word is a maximal run of bytes that are none of space, \\t, \\n, \\v, \\f, \\r.
UTF-8 never uses those bytes inside a longer sequence, so words can be found on
the encoded text.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.session import hadoop_path, remove_at_exit, scratch_path, shared_dir

# Separator class of the contracts, for regexp functions.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Ids that are null sort after every id.
NULL_ID = (1 << 63) - 1

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, a lost executor costs only a reread.

    The table is removed when the driver ends, or by ``discard``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a working table that ``materialise`` made, once nothing reads it any more."""
    spark = df.sparkSession
    shared = shared_dir(spark)
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        fs, path = hadoop_path(spark, folder)
        if not path.toUri().getPath().startswith(hadoop_path(spark, shared)[1].toUri().getPath() + "/"):
            raise ValueError(f"{folder} is not a working table")
        fs.delete(path, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to differ from every one of ``columns``."""
    taken = {c.lower() for c in columns}  # Spark tells names apart by letters, not by case
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def every_column(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def id_key(col: "str | Column" = "doc_id") -> Column:
    """The id as a non-null long; null ids come last."""
    return F.coalesce(F.col(col).cast("long") if isinstance(col, str) else col, F.lit(NULL_ID))


def from_id_key(col: "str | Column") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NULL_ID, c)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``max_bytes`` of ``column`` (one row may exceed it)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column).cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


BUCKET_BYTES = 16 << 20     # text in one bucket of a chunk table
_CHUNK = "chunk long, measure long, ids array<long>, texts array<binary>"


def _pack_chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int,
                 measure: Callable[[list[bytes]], int]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("chunk", pa.int64()), ("measure", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("texts", pa.list_(pa.binary()))])
    chunk = TaskContext.get().partitionId() << 32
    for batch in slices(batches, "text", chunk_bytes):
        ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy()
        texts = byte_texts(batch.column("text"))
        order = np.argsort(ids, kind="stable")
        texts = [texts[i] for i in order]
        yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([measure(texts)]), pa.array([ids[order].tolist()]),
                                          pa.array([texts], pa.list_(pa.binary()))], schema=schema)
        chunk += 1


def bucket_count(size: int, bucket_bytes: int, most: int) -> int:
    """Buckets for ``size`` bytes: at least 8, and never more than Spark allows (they grow instead)."""
    return min(most, max(8, -(-size // bucket_bytes)))


def chunk_table(docs: DataFrame, chunk_bytes: int, measure: Callable[[list[bytes]], int] = len,
                bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """Texts (doc_id, text) packed into rows of up to ``chunk_bytes``, in the order of their ids; and their bytes.

    Written once to the shared folder, in a table bucketed by chunk: answers are
    joined to it without moving a text. ``measure`` is a number kept for a chunk.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(size, bucket_bytes, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    name = f"llm_chunks_{uuid.uuid4().hex}"
    packed = docs.mapInArrow(lambda it: _pack_chunks(it, chunk_bytes, measure), _CHUNK)
    path = scratch_path(spark, "chunks")
    packed.write.option("path", path).bucketBy(buckets, "chunk").saveAsTable(name)
    remove_at_exit(spark, path)
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the catalog entry; the files stay
    return chunks, size


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def small_table(spark: SparkSession, rows: list, schema: str, broadcast_rows: int = 100_000) -> DataFrame:
    """A driver-side list of tuples as a DataFrame, broadcast in joins up to ``broadcast_rows`` rows.

    Built in the JVM from one JSON literal: no RDD and no Python worker.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    types = ", ".join(f"{field.split()[0]}: {field.split()[1]}" for field in schema.split(", "))
    df = spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{types}>>")))
    return F.broadcast(df) if len(rows) <= broadcast_rows else df


class Words:
    """The words of several texts, found together.

    ``starts``/``ends``: byte positions in ``data`` (the texts, each followed by
    a line break); ``bounds[d]:bounds[d + 1]``: the words of text ``d``.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(self.data, np.uint8)
        space = np.ones(len(buf) + 1, bool)
        space[1:] = _IS_SPACE[buf]
        self.edges = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = self.edges[0::2], self.edges[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_at = np.concatenate([[0], np.cumsum(lengths)])
        self.bounds = np.searchsorted(self.starts, self.text_at)

    def __len__(self) -> int:
        return len(self.starts)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def dictionary(self) -> tuple[np.ndarray, list[bytes]]:
        """For each word its index in the list of different words (which also holds separators)."""
        if not len(self):
            return np.zeros(0, np.int64), []
        values = pa.Array.from_buffers(pa.binary(), len(self.edges) - 1,
                                       [None, pa.py_buffer(self.edges.astype(np.int32)), pa.py_buffer(self.data)])
        coded = values.dictionary_encode()
        return coded.indices.to_numpy()[0::2], coded.dictionary.to_pylist()

    def hashes(self) -> np.ndarray:
        """A 128-bit hash of each word, as two columns of uint64."""
        index, distinct = self.dictionary()
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, distinct)), np.uint64).reshape(-1, 2)[index]


def pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array, planes of equal significance together, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


_shipped: set[str] = set()  # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of an application that was started without it."""
    import os
    import tempfile
    import zipfile

    import landfall

    application = spark.sparkContext.applicationId  # sessions of one application share its files
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(landfall.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="landfall-"), "landfall.zip")  # Spark sends it to the executors
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
