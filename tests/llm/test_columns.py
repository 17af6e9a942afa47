"""Pipeline stages keep every column, whatever its name, and handle empty and edge tables."""

import corpus_pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_cases import EDGES, SF001
from landfall.llm.common import every_column, fresh, table

# Names that stages use or used for their own columns, and names that SQL text would trip over.
NAMES = ["__id", "__sha", "__th", "__hash", "__text", "__n", "__1", "__copies", "__rows", "__source", "__place", "own", "OWN_SOURCE", "sha",
         "th", "text_of", "stated", "text_hash", "rows_of", "place", "copies", "nth", "least_1", "least_3", "_own", "rate", "row_hash",
         "keep", "kept", "n", "id", "a.b", "with `tick`", "two words", "size", "key", "norm", "label_id"]
TYPES = ["string", "int", "array<string>", "struct<x:int>", "date", "boolean"]


def widened(docs):
    """Every further column holds a value that follows from the row's id, in one of several types."""
    own = F.col("doc_id")
    made = {"string": F.concat(F.lit("mine "), own), "int": (own % 1000).cast("int"), "array<string>": F.array(own.cast("string")),
            "struct<x:int>": F.struct((own % 77).cast("int").alias("x")), "date": F.date_add(F.lit("2020-01-01").cast("date"), (own % 99).cast("int")),
            "boolean": own % 2 == 0}
    return docs.select("*", *[made[TYPES[i % len(TYPES)]].alias(n) for i, n in enumerate(NAMES)])


def told(df):
    """Rows by id as text, for comparison."""
    rows = df.select("doc_id", F.to_json(F.struct(*every_column(df))).alias("row")).collect()
    return {r["doc_id"]: r["row"] for r in rows}


def test_every_stage_keeps_every_column(spark):
    docs = widened(table(spark, SF001, "documents")).cache()
    want = told(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema], name
        got = told(out)
        assert got and all(want[d] == row for d, row in got.items()), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert last.count() == docs.count()
    docs.unpersist()


def run_stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        out.append(docs.count())
    return out, docs


def test_pipeline_on_an_empty_table(spark, documents):
    counts, last = run_stages(spark, documents(EDGES).limit(0))
    assert counts == [0] * 5 and last.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_pipeline_on_an_edge_table(spark, documents):
    """Null ids, texts and sources, an empty and a very long text, repeated rows: every stage gives a part of its input."""
    good = [(100 + i, r["text"], "a") for i, r in enumerate(table(spark, SF001, "documents").limit(30).collect())]
    counts, last = run_stages(spark, documents([*EDGES, *good, good[3], good[3], (None, good[4][1], None)]))
    assert 0 < counts[2] <= counts[1] <= counts[0] <= len(EDGES) + 33 and counts[4] == counts[3] > 0
    assert all(len(r["ids"]) == r["n_tokens"] for r in last.collect())


def test_column_named_like_a_table_column(spark):
    """Names are told apart as Spark does it, by letters and not by case."""
    assert fresh(["A", "_a", "b"], "a", "b", "c", "c") == ["__a", "_b", "c", "_c"]
    df = spark.createDataFrame([(1, 2)], T.StructType([T.StructField("a.b", T.IntegerType()), T.StructField("x`y", T.IntegerType())]))
    assert df.select(*every_column(df)).columns == ["a.b", "x`y"]
