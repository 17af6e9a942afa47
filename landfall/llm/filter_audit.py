"""Operator 13, filter interaction audit: what each of five filters removes, in every order of them.

A document's verdict is a bit mask, one bit per filter that it fails. Documents
are counted per part and mask; all else follows from those counts. The removal
game of a part gives a coalition S of filters the number of documents that fail
at least one of S. Its Hart-Mas-Colell potential is computed recursively over
the 32 coalitions,

    P(empty) = 0,    P(S) = (v(S) + sum of P(S without i), i in S) / |S|,

and the Shapley value of filter i is P(all) - P(all without i). Steps of an
order are differences of coalitions: after the filters S, filter i removes
v(S with i) - v(S). Potentials are kept times k! (k filters), which makes them
whole numbers: every P(S) is a sum of whole dividends divided by 1..k.

The duplicate filter fails a document whose text also belongs to a smaller id,
anywhere in the table. Texts are told apart by SHA-256; rows are first counted
per text, id, part and label, so a text of a third of all rows is combined
before it is shuffled, and its smallest id is found from those counts.

Defined cases: a null text counts as empty; a null source is the part ''; a
null id comes after every id and has no labels; rows that repeat an id are
counted each (none of them is the other's smaller id); of repeated labels of an
id any 1 counts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.llm.common import WORD, id_key, materialise, table

MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "[#$%&*|]"
MAX_FILTERS = 7  # the audit has k! orders of k steps per part


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of one text."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(words) < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
            "C": 100 * capitals > CAPITAL_PERCENT * F.length(text),
            "D": text.rlike(SYMBOLS)}


def verdict_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source", filters=text_filters) -> tuple[DataFrame, str]:
    """Documents per part and mask of failed filters (n, good, toxic), and the filters' letters in bit order.

    The last letter, E unless ``filters`` uses it, is the duplicate filter.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tests = filters(F.col("t"))
    names = "".join(tests) + chr(ord(max(tests, default="@")) + 1)
    if len(names) > MAX_FILTERS:
        raise ValueError(f"{len(names)} filters: their orders are too many to list")
    mask = sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests.values())), F.lit(0))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        text.alias("t"))
            .select("id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("t", 256)).alias("key")))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.join(known, rows["id"] == known["label_id"], "left").select(
        id_key("id").alias("id"), "part", "mask", "key",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    # Per text, part and label: how many rows, the smallest id, and how many rows have it.
    text_parts = ["key", "mask", "part", "good", "toxic"]
    per_id = rows.groupBy(*text_parts, "id").agg(F.count("*").alias("n"))
    per_part = materialise(per_id.groupBy(*text_parts).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("least")),
                           "audit-texts")
    least = per_part.groupBy("key").agg(F.min("least.id").alias("first_id"))
    owned = F.when(F.col("least.id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    both = per_part.join(least, "key").select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), owned.alias("n")),
            F.struct(F.col("mask").bitwiseOR(1 << len(tests)).alias("mask"), (F.col("n") - owned).alias("n")))).alias("x"))
    counts = both.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic"))
    return counts, names


def _game(count: str, size: int) -> Column:
    """v(S) for every coalition S, as an array: the rows that fail at least one filter of S."""
    failed = lambda s: F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(count)).otherwise(0))
    return F.array(*[failed(s) for s in range(1 << size)])


def potentials(game: Column, size: int) -> Column:
    """size! times the potential of every coalition, as an array; S comes after all its parts."""
    unit = F.lit(factorial(size)).cast("long")

    def next_one(known: Column, s: Column) -> Column:
        inner = sum((F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s.bitwiseAND(~(1 << i)))).otherwise(0) for i in range(size)),
                    F.lit(0).cast("long"))
        total = unit * F.get(game, s) + inner
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s).cast("long"))))  # without remainder

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << size) - 1)), F.array(F.lit(0).cast("long")), next_one)


def orders(letters: str) -> list[dict]:
    """Every step of every order: the filter's bit and the coalition before it."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    return [{"filter_order": "".join(o), "step": k + 1, "own": bit[o[k]], "before": sum(bit[c] for c in o[:k])}
            for o in permutations(letters) for k in range(len(letters))]


def filter_audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from counts per part and mask."""
    size = len(letters)
    every = (1 << size) - 1
    games = counts.groupBy("part").agg(F.sum("n").alias("total"), *[_game(c, size).alias(c) for c in ("n", "good", "toxic")])
    games = games.withColumn("potential", potentials(F.col("n"), size))
    steps = F.from_json(F.lit(json.dumps(orders(letters))), "array<struct<filter_order: string, step: int, own: int, before: int>>")
    each = games.select("*", F.inline(steps))
    after = F.col("before") + F.col("own")
    gained = lambda game: F.get(game, after) - F.get(game, F.col("before"))
    removed = gained("n")
    without = F.lit(every) - F.col("own")
    return each.select(
        "part", "filter_order", "step", (F.col("total") - F.get("n", after)).alias("kept"), removed.alias("removed"),
        (F.get("n", F.col("own")) - removed).alias("redundant"),
        (F.get("n", F.lit(every)) - F.get("n", without)).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(every)) - F.get("potential", without)).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over every document, audited per source in all 120 orders."""
    return filter_audit(*verdict_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
verdicts AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                    concat(CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END,
                           CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END,
                           CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END,
                           CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                           CASE WHEN coalesce(texts.doc_id, 9223372036854775807) > min(texts.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
             FROM texts LEFT JOIN known ON texts.doc_id = known.doc_id),
counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
           FROM verdicts GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM f a, f b, f c, f d, f e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS before
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
done AS (SELECT part, filter_order, step, x,
                sum(n) FILTER (translate(fails, before || x, '') = fails) AS kept,
                sum(n) FILTER (contains(fails, x) AND translate(fails, before, '') = fails) AS removed,
                sum(n) FILTER (contains(fails, x) AND translate(fails, before, '') <> fails) AS redundant,
                sum(n) FILTER (fails = x) AS unique_fails,
                sum(good) FILTER (contains(fails, x) AND translate(fails, before, '') = fails) AS good_lost,
                sum(toxic) FILTER (contains(fails, x) AND translate(fails, before, '') = fails) AS toxic_lost
         FROM counts, steps GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley
FROM done
"""
