"""Operator 12 against a brute force: every edit sequence by exhaustive search, on small conversations."""

import binascii
import hashlib
import random
import re
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from llm_cases import SF001
from landfall.llm import conversation_repair as R
from landfall.llm.common import table

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = binascii.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def repair(rows, found):
    """The least (cost, audit) with its turns over all edit sequences, by trying them all from each point on.

    Written as a search over (rows used, initials so far as a residue of the regular
    expression), without stacks: 0 nothing, 1 s, 2 u expected an a, 3 complete pairs.
    """
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, at, inserted):
        options = []
        if i == len(rows) and at in (0, 3):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                to = step.get((at, role[0]))
                if to is not None:
                    c, a, t = best(i, to, inserted + 1)
                    options.append((5 + c, "I" + a, ((role, ""),) + t))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, t = best(i + 1, at, 0)
            options.append((2 + c, "D" + a, t))
            if found[i] not in ("blank", "duplicate"):
                extra = 5 if found[i] else 0
                for edit, cost, new in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    to = step.get((at, new[:1]))
                    if to is not None:
                        c, a, t = best(i + 1, to, 0)
                        options.append((cost + extra + c, edit + a, ((new, text),) + t))
        return min(options) if options else (10 ** 9, "", ())

    return best(0, 0, 0)


def expected(rows):
    per = defaultdict(list)
    for row in rows:
        per[row[0]]
    for row in damage(rows):
        per[row[0]].append(row)
    out = {}
    for conv, own in per.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        cost, audit, lines = repair(own, found)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, digest)
    return out


def repaired(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


EDGE_ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"),
    (2, 0, "user", None), (2, None, "user", "Why?"), (2, 5, None, "So."), (2, 5, "assistant", "\t\n"), (2, 9, "assistant", "Cut off"),
    (None, 0, "user", "A?"), (None, 0, "user", "A?"), (None, None, "assistant", "B."),
    (3, 1, "", "Empty role."), (3, 2, "Tool", "Other."), (3, 3, "assistant", "End. \x0b"), (3, 3, "assistant", "End. \x0b"),
    (4, 7, "assistant", "x" * 300_000 + "."), (4, 8, "superuser", "Ünï 中!"), (4, 8, "user", "one\x1f"),
    (5, None, "user", None), (5, None, "system", "only."),
]
EXTRA = "conv_id long, turn long, role string, text string, gone_by string, fault int, copy int, kind string"


def test_edges(spark):
    frame = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in EDGE_ROWS], EXTRA).repartition(3)
    assert repaired(R.repair_summary(R.damaged(frame))) == expected(EDGE_ROWS)
    assert repaired(R.repair_summary(R.damaged(frame.limit(0)))) == {}


def test_random_conversations(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why?", "cut", "", " ", "a.", "b", "c"]
    rows = [(conv, rng.choice([None, *range(40)]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None]),
             rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}" + rng.choice(["", ".", "."]))
            for conv in range(400) for _ in range(rng.randrange(1, 14))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert repaired(R.repair_summary(R.damaged(frame))) == expected(rows)


def test_given_table(spark):
    frame = table(spark, SF001, "conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert repaired(R.repair_summary(R.damaged(frame))) == expected(rows)


def test_turns_of_a_clean_conversation(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Still here?"), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "No.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = [tuple(r) for r in R.repaired_turns(frame).orderBy("conv_id", "position").collect()]
    assert turns == [(1, 0, "user", "Still here?"), (1, 1, "assistant", "Yes.")]  # deleting costs 2, an insertion 5
    assert R.repair_summary(frame).where("conv_id = 2").first()["audit"] == "D"


@pytest.mark.parametrize("pattern", ["ua", "u", "uua", "a"])
def test_long_conversation_is_decided_as_it_goes(spark, pattern):
    """20,000 rows: the repair equals the one found with everything held, and decided tops are let go."""
    roles = {"u": "user", "a": "assistant"}
    rows = [(roles[pattern[i % len(pattern)]], f"{i}.", None if i % 7 else R.CUT) for i in range(20_000)]

    def run(look_at):
        told = []
        parser = R.Parser(lambda edits, turns: told.append((edits, turns)))
        most = 0
        for row in rows:
            parser.look_at = look_at or parser.look_at
            parser.row(*row)
            most = max(most, parser.undecided)
        return parser.end(), "".join(e for e, _ in told), [t for _, ts in told for t in ts], most

    cost, audit, turns, most = run(None)
    assert (cost, audit, turns) == run(10 ** 9)[:3]
    assert len(audit.replace("I", "")) == len(rows)
    if len(pattern) > 1:  # two readings of a run of one role cost alike to its end
        assert most <= 256
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns))


def test_automaton():
    automaton = R.Automaton(R.GRAMMAR)
    assert sum(automaton.accepts) == 2  # the empty conversation, and after a whole pair
    assert all(len(rules) <= 1 and not (rules and go) for rules, go in zip(automaton.complete, automaton.go))


def test_faults_column(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "a."), (1, 2, "user", " \x0c"), (1, 3, "user", "b")]
    out = R.faulty(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("turn")
    assert [r["fault"] for r in out.select(F.col("fault")).collect()] == [None, "duplicate", "blank", "truncated"]
