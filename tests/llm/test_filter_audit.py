"""Operator 13 against a brute force that applies the filters one after another."""

import re
from collections import Counter
from itertools import permutations

import pytest

from llm_cases import EDGES, SF001
from landfall.llm.common import table
from landfall.llm.filter_audit import filter_audit, text_filters, verdict_counts


def brute(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    rank = lambda d: float("inf") if d is None else d
    docs = []
    for d, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": any((u or "") == t and rank(i) < rank(d) for i, u, _ in rows)}
        docs.append((s or "", {k for k, v in fails.items() if v}, d in good and d is not None, d in toxic and d is not None))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            own = list(left)
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                fails = sum(x in d[1] for d in own)
                shapley[part, x] += len(gone)
                out[part, "".join(order), step] = (len(left), len(gone), fails - len(gone), sum(d[1] == {x} for d in own),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audited(docs, labels):
    rows = filter_audit(*verdict_counts(docs, labels)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}
    assert len(found) == len(rows)
    return found


def test_edges(spark, documents):
    rows = [*EDGES, (20, "Same# " * 60, "b"), (21, "Same# " * 60, "a"), (None, "Same# " * 60, "a"), (None, "same " * 100, ""),
            (22, "A $", "a"), (23, "\x0b" + " ".join(f"é{i}" for i in range(49)), "c"), (24, "b " * 49 + "UPPER", None)]
    labels = [(1, 1, 0), (1, 0, 1), (5, 1, None), (8, None, None), (21, 0, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(documents(rows), frame) == brute(rows, labels)


def test_repeated_ids_and_empty_tables(spark, documents):
    rows = [(1, "x y", "a"), (1, "x y", "a"), (1, "x y", "b"), (2, "x y", "a"), (2, "x y", "a")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(documents(rows), none) == brute(rows, [])
    assert audited(documents(rows).limit(0), none) == {}


def test_given_table(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert audited(docs, labels) == brute(rows, [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])


def test_other_filters(spark, documents):
    """Two of the text filters and the duplicate filter: three letters, six orders."""
    rows = [(1, "a b", "s"), (2, "a b", "s"), (3, "#", "s")]
    counts, letters = verdict_counts(documents(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                                     filters=lambda t: {"A": text_filters(t)["D"], "B": t == "a b"})
    out = filter_audit(counts, letters).collect()
    assert letters == "ABC" and len(out) == 18
    assert {r["shapley"] for r in out if r["filter_order"][r["step"] - 1] == "C"} == {3}  # id 2 fails B and C, half of 6 orders
    with pytest.raises(ValueError):
        verdict_counts(documents(rows), None, filters=lambda t: {chr(65 + i): t == "" for i in range(7)})
