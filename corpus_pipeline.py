"""The corpus pipeline: quality, exact copies, near copies, source mix, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads again as the next stage's docs. All but the last return the columns of
``documents``. The stages use trained scores, fingerprints and byte-pair
merges, which SQL cannot express, so ``ORACLE_SQL`` is None.

Defined cases: every stage but the last keeps all columns of its input, whatever
their names and types; a null or empty text is scored, compared, mixed and
encoded as an empty one; null ids come after every id and null sources are a
source; rows that repeat id and text are one document to the two dedup stages;
an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm.byte_bpe import encode_decode
from landfall.llm.common import materialise, ship_package, table
from landfall.llm.exact_dedup import exact_dedup
from landfall.llm.mixing import mixed_documents
from landfall.llm.quality_fm import good_documents, train
from landfall.llm.simhash_dedup import near_dedup

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    return good_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the row with the smallest doc_id stays."""
    ship_package(spark)
    return near_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix and their decoding."""
    import public_tokenizers

    ship_package(spark)
    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("exact dedup", exact_copies), ("near dedup", near_copies), ("source mix", source_mix),
          ("token ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
