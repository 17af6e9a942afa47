"""Operator 2, exact dedup, with DataFrame functions only.

Texts are equal when they are the same after every run of space, \\t, \\n, \\v,
\\f, \\r has become one space. Rows are grouped by a 128-bit hash of that text;
of each group the row with the smallest id stays. The hash groups are checked
byte for byte: the first aggregation groups by hash *and* text (equal texts
meet in the map-side hash table, so a group holding a third of all rows leaves
each task as one row), and a hash with more than one text is resolved by text.

Defined cases: a null text counts as empty; a null id comes after every id;
of rows that share id and text one stays; an empty table gives an empty
result; columns other than the two named ones are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.llm.common import SPACES, every_column, fresh, from_id_key, id_key, materialise, table


def normalised(text: "str | Column") -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), SPACES, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and key, the content hash)."""
    rows = docs.select(id_key(id_col).alias("id"), normalised(text_col).alias("norm"))
    rows = rows.select("id", "norm", content_hash(F.col("norm")).alias("key"))
    texts = rows.groupBy("key", "norm").agg(F.min("id").alias("keep"), F.count("*").alias("n"))
    groups = materialise(
        texts.select("key", "keep", "n").groupBy("key")
        .agg(F.min("keep").alias("keep"), F.sum("n").alias("n"), F.count("*").alias("texts")), "exact-groups")

    def members(of: DataFrame) -> DataFrame:
        """Row counts per group and id: rows that share both come out once, with how many they are."""
        return of.groupBy("key", "id", "sha").agg(F.count("*").alias("rows"))

    slim = rows.select("id", "key", F.sha2("norm", 256).alias("sha"))
    single = groups.where("texts = 1").drop("texts")
    found = members(slim).join(single, "key").select("id", "key", "sha", "rows", "keep", "n")
    if groups.where("texts > 1").limit(1).count():  # two texts with one hash: resolved by the text itself
        clash = groups.where("texts > 1").select("key")
        own = texts.join(clash, "key").withColumn("sha", F.sha2("norm", 256))
        byte_equal = rows.join(own, ["key", "norm"]).select("id", "key", "sha", "keep", "n")
        found = found.unionByName(
            byte_equal.groupBy("id", "key", "sha", "keep", "n").agg(F.count("*").alias("rows"))
            .select("id", "key", "sha", "rows", "keep", "n"))
    # One output row per input row; of rows that share id and text, the first stays.
    copies = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return copies.select(from_id_key("id").alias("doc_id"), from_id_key("keep").alias("keep_id"),
                         F.col("n").alias("group_size"), ((F.col("id") == F.col("keep")) & (F.col("copy") == 1)).alias("kept"),
                         F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names."""
    own, sha = fresh(docs.columns, "own", "sha")
    kept = exact_groups(docs, id_col, text_col).where("kept")
    kept = kept.select(id_key("doc_id").alias(own), F.col("text_sha256").alias(sha))
    keyed = docs.withColumns({own: id_key(id_col), sha: F.sha2(normalised(text_col), 256)})
    # Rows that repeat id and text meet here; the join has already dealt them out by these two columns.
    return keyed.join(kept, [own, sha]).dropDuplicates([own, sha]).select(*every_column(docs))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id that stays for its text."""
    return exact_groups(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
