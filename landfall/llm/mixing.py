"""Operator 9, mixing sources to target weights by entropy balancing, with DataFrame functions only.

Sources, in code point order with null last, weigh 5, 2, 1, 5, 2, 1 ... and
share all words; a target stops at ``most`` times its source's words and the
excess is shared again by weight until no source is above.

Of all non-negative document rates whose expected words meet the targets, the
mix takes those of least relative entropy to one copy each. They have the form
``min(most, exp(lambda[source] * size))`` (size in units of the source's mean),
and lambda solves a convex dual, one variable per source. A rate depends on
source and size alone, so all documents are first counted per source and size,
in one pass; each Newton step is one aggregation of gradient and curvature per
source over those counts. The sums are decimal, so that no order of tasks
changes lambda; a bracket guards the step.

Rates become whole copies in two steps, both by aggregation: every document
rounds by a hash of its id; a per-source threshold on that hash, found by
zooming into histograms, takes the sum to its target within a document; then
the few documents that best fill what is left, from large size classes down to
small, gain or lose one copy. Only per-source numbers (and a bounded number per
source and bin) reach the driver; the table of them is joined back, broadcast
up to a checked number of sources.

Defined cases: a null text has no words; null is a source of its own, the last;
rows that share an id, source and text are numbered, and round each by itself; sources without words take
nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from landfall.llm.common import WORD, every_column, fresh, from_id_key, id_key, materialise, small_table, table

WEIGHTS = (5, 2, 1)
MOST = 3             # copies of one document, and target over source size
STEPS = 60           # Newton steps at most
CLOSE = 1e-9         # of the target
BINS = 1024          # of one zoom
_ALL = 1e300         # lambda of a source that takes every document as often as it may; minus this: none


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess goes to the others by weight."""
    out, open_ = [0.0] * len(sizes), [i for i in range(len(sizes))]
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in over]
    return out


def _n_words(text) -> "F.Column":
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def _joined(docs: DataFrame, values: dict, schema: str) -> DataFrame:
    """Documents with their source's numbers, one row per source."""
    return docs.join(small_table(docs.sparkSession, [(k, *v) for k, v in sorted(values.items())], f"k int, {schema}"), "k")


def _exact_sum(c: "F.Column") -> "F.Column":
    """A sum of doubles that is the same in any order."""
    return F.sum(c.cast("decimal(38, 12)")).cast("double")


def _balance(counts: DataFrame, goal: dict, mean: dict, most: float) -> dict:
    """lambda per source number: distributed Newton iterations on the dual; ``counts``: k, size, n (documents)."""
    lam = {k: 0.0 for k in goal}
    low, high = {k: -math.inf for k in goal}, {k: math.inf for k in goal}
    open_ = set(goal)
    for _ in range(STEPS):
        if not open_:
            break
        at = _joined(counts, {k: (lam[k], 1.0 / mean[k]) for k in open_}, "lam double, unit double")
        x, words = F.col("size") * F.col("unit"), F.col("size") * F.col("n")
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(math.log(most) + 1)))
        sums = at.groupBy("k").agg(_exact_sum(words * F.least(tilt, F.lit(float(most)))).alias("g"),
                                   _exact_sum(F.when(tilt < most, words * x * tilt).otherwise(0.0)).alias("h"))
        for r in sums.collect():
            k, error = r["k"], r["g"] - goal[r["k"]]
            if abs(error) <= CLOSE * goal[k] + 1e-9:
                open_.discard(k)
                continue
            if error > 0:
                high[k] = lam[k]
            else:
                low[k] = lam[k]
            step = lam[k] - error / r["h"] if r["h"] > 0 else math.inf
            if not low[k] < step < high[k]:
                if math.isinf(low[k]):
                    step = 2 * high[k] - 1
                elif math.isinf(high[k]):
                    step = 2 * low[k] + 1
                else:
                    step = (low[k] + high[k]) / 2
            if step == lam[k] or high[k] - low[k] < 1e-12:
                open_.discard(k)
            lam[k] = step
    return lam


def _zoom(docs: DataFrame, need: dict) -> dict:
    """Per source the threshold on ``p`` under which ``gain`` adds up to at most ``need``, within about a document.

    ``docs``: k, p in [0, 1), gain > 0. Each round cuts the interval of every open
    source into ``BINS`` and keeps the bin in which the sum passes the need.
    """
    at = {k: (0.0, 1.0) for k in need}
    left, open_ = dict(need), set(need)
    for _ in range(5):
        if not open_:
            break
        inside = _joined(docs, {k: at[k] for k in open_}, "lo double, width double")
        inside = inside.where((F.col("p") >= F.col("lo")) & (F.col("p") < F.col("lo") + F.col("width")))
        bin_ = F.least(F.floor((F.col("p") - F.col("lo")) / F.col("width") * BINS), F.lit(BINS - 1)).cast("int")
        found: dict = {}
        for r in (inside.groupBy("k", bin_.alias("bin")).agg(F.sum("gain").alias("gain"), F.count("*").alias("n"))
                  .orderBy("k", "bin").collect()):
            found.setdefault(r["k"], []).append(r)
        for k in list(open_):
            lo, width = at[k]
            passing = None
            for r in found.get(k, ()):
                if r["gain"] > left[k]:
                    passing = r
                    break
                left[k] -= r["gain"]
            if passing is None:
                at[k] = (lo + width, 0.0)
                open_.discard(k)
            else:
                at[k] = (lo + passing["bin"] * width / BINS, width / BINS)
                if passing["n"] == 1:
                    open_.discard(k)
    return {k: lo for k, (lo, _) in at.items()}


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken (copies times size), row_hash."""
    spark = docs.sparkSession
    keys = ("id", "source", "row_hash", "size")
    sized = docs.select(id_key(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                    F.xxhash64(text_col).alias("row_hash"), _n_words(F.col(text_col)).alias("size"))
    # Equal rows are counted first, so that one key's rows are not gathered; nth tells them apart.
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("nth")
    sized = materialise(sized.groupBy(*keys).agg(F.count("*").alias("rows")).select(*keys, nth), "sizes")
    counts = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    per_source = (counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n"))
                  .collect())
    per_source.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))  # code point order
    sizes = [r["size"] for r in per_source]
    share = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], sum(sizes), most)
    numbered = small_table(spark, [(i, r["source"], r["size"], share[i]) for i, r in enumerate(per_source)],
                           "k int, source string, source_size long, target double")

    def by_number(df: DataFrame) -> DataFrame:
        return df.join(numbered, df["source"].eqNullSafe(numbered["source"])).drop(numbered["source"])

    rows = by_number(sized)
    goal = {i: t for i, t in enumerate(share) if sizes[i] and 0 < t < most * sizes[i]}
    mean = {i: sizes[i] / per_source[i]["n"] for i in goal}
    lam = _balance(by_number(counts).select("k", "size", "n"), goal, mean, float(most))
    # lambda and unit of each source; a source at its cap takes every document ``most`` times, one without a target none.
    state = {i: (lam[i], 1.0 / mean[i]) if i in goal else ((_ALL if t else -_ALL), 1.0) for i, t in enumerate(share)}
    rows = _joined(rows, state, "lam double, unit double")
    limit = math.log(most)
    exponent = (F.when(F.col("lam") == _ALL, F.lit(limit)).when(F.col("lam") == -_ALL, F.lit(-1e3))
                .otherwise(F.least(F.col("lam") * F.col("size") * F.col("unit"), F.lit(limit))))
    rate = F.when(exponent >= limit, F.lit(float(most))).otherwise(F.exp(exponent))
    draw = F.xxhash64("id", "source", "row_hash", F.lit("mix"))
    draw = F.when(F.col("nth") == 1, draw).otherwise(F.xxhash64("id", "source", "row_hash", F.lit("mix"), "nth"))
    uniform = F.pmod(draw, F.lit(1 << 52)) / float(1 << 52)
    rows = rows.withColumn("rate", rate).withColumn("sum", F.col("rate") + uniform)
    rows = rows.withColumn("copies", F.least(F.floor("sum"), F.lit(most)).cast("long"))
    rows = materialise(rows.withColumn("frac", F.col("sum") - F.floor("sum"))
                       .select("id", "source", "row_hash", "nth", "size", "k", "source_size", "target", "rate", "copies", "frac"), "rates")

    # First: the threshold. Documents nearest to their next whole copy gain it, or those that just reached theirs lose it.
    def short(of: DataFrame) -> dict:
        return {r["k"]: share[r["k"]] - r["taken"] for r in
                of.groupBy("k").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}

    missing = short(rows)
    need = {k: abs(v) for k, v in missing.items() if abs(v) >= 1}
    if need:
        signed = _joined(rows, {k: (1 if missing[k] > 0 else -1,) for k in need}, "way int")
        way = F.col("way")
        able = (F.col("size") > 0) & F.when(way > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
        near = F.when(way > 0, 1 - F.col("frac")).otherwise(F.col("frac"))
        moved = signed.where(able).select("k", F.least(near, F.lit(1 - 1e-12)).alias("p"), F.col("size").alias("gain"))
        edge = _zoom(moved, need)
        edged = rows.join(small_table(spark, [(k, 1 if missing[k] > 0 else -1, e) for k, e in sorted(edge.items())],
                                      "k int, way int, edge double"), "k", "left")
        shift = F.when(able & (F.least(near, F.lit(1 - 1e-12)) < F.col("edge")), way).otherwise(0)
        rows = edged.withColumn("copies", F.col("copies") + F.coalesce(shift, F.lit(0))).drop("way", "edge")
        rows = materialise(rows, "rounded")
        missing = short(rows)

    # Then: one copy more or less of a few documents fills the rest, largest size class first.
    open_ = {k: v for k, v in missing.items() if abs(v) >= 1}
    if open_:
        signed = _joined(rows, {k: (1 if v > 0 else -1,) for k, v in open_.items()}, "way int")
        able = (F.col("size") > 0) & F.when(F.col("way") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
        few = signed.where(able).withColumn("class", F.floor(F.log2(F.col("size").cast("double"))).cast("int"))
        order = Window.partitionBy("k", "class").orderBy("frac", "id", "row_hash", "nth")
        few = few.withColumn("place", F.row_number().over(order)).where("place <= 4")
        picked = []
        best = few.select("k", "class", "size", "id", "row_hash", "nth").orderBy("k", F.desc("class"), F.desc("size"), "id", "row_hash", "nth").collect()
        for r in best:
            if r["size"] <= abs(open_[r["k"]]):
                way = 1 if open_[r["k"]] > 0 else -1
                open_[r["k"]] -= way * r["size"]
                picked.append((r["k"], r["id"], r["row_hash"], r["nth"], way))
        if picked:  # at most four per source and size class
            picked = sorted(set(picked))
            rows = rows.join(small_table(spark, picked, "k int, id long, row_hash long, nth long, more int"), ["k", "id", "row_hash", "nth"], "left").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0)))
    return rows.select(from_id_key("id").alias("doc_id"), "source", "size", "source_size", "target", "rate",
                       "copies", (F.col("copies") * F.col("size")).alias("taken"), "row_hash")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix, each as many times as it has copies, with all their columns, whatever their names."""
    mixed = mix(docs, id_col, text_col, source_col)
    own, text_hash, source, rows_of, place, copies, nth, *least = fresh(
        docs.columns, "own", "text_hash", "own_source", "rows_of", "place", "copies", "nth",
        *(f"least_{c}" for c in range(1, MOST + 1)))
    # Per key its rows, and how many of them have at least 1, 2, ... copies.
    take = (mixed.groupBy(id_key("doc_id").alias(own), F.col("source").alias(source), F.col("row_hash").alias(text_hash))
            .agg(F.count("*").alias(rows_of), *(F.count_if(F.col("copies") >= c).alias(n) for c, n in enumerate(least, 1))))
    take = materialise(take.where(F.col(least[0]) > 0), "copies")
    alike = F.lit(True)
    for n in least:
        alike = alike & F.col(n).isin(0, F.col(rows_of))
    keyed = docs.withColumns({own: id_key(id_col), text_hash: F.xxhash64(text_col)})

    def taken(keys: DataFrame, number: "F.Column | None") -> DataFrame:
        same = ((keyed[own] == keys[own]) & (keyed[text_hash] == keys[text_hash])
                & keyed[source_col].cast("string").eqNullSafe(keys[source]))
        rows = keyed.join(keys, same).drop(keys[own], keys[text_hash])
        rows = rows.withColumn(place, F.lit(1) if number is None else number)
        times = sum((F.when(F.col(place) <= F.col(n), 1).otherwise(0) for n in least), F.lit(0))
        return (rows.withColumn(copies, times).where(F.col(copies) > 0)
                .withColumn(nth, F.explode(F.sequence(F.lit(1), copies))).select(*every_column(docs)))

    out = taken(take.where(alike), None)
    if take.where(~alike).isEmpty():
        return out
    # Only keys whose rows differ in copies need numbers: by a hash of all columns.
    everything = F.xxhash64(F.to_json(F.struct(*every_column(docs))))
    order = Window.partitionBy(own, source, text_hash).orderBy(everything)
    return out.unionByName(taken(take.where(~alike), F.row_number().over(order)))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
