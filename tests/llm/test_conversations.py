"""op13 against brute force: every edit string of short conversations, a plain dynamic program for long ones."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, conversations

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(table):
    out = []
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        out += [(conv, turn, "user" if rule == 4 else role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = BLANK.findall(text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def replay(rows, found, audit):
    """Cost and repaired rows of an edit string, None where it is not allowed."""
    cost, at, out = 0, 0, []
    for edit in audit:
        last = out[-1][0][:1] if out else ""
        wanted = "assistant" if last == "u" else "user"
        if edit == "I":
            cost, out = cost + 2, [*out, (wanted, "")]
            continue
        fault, (_, role, text) = found[at], rows[at]
        at += 1
        if edit == "D":
            cost += 3
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += (2 if edit == "R" else 0) + (fault == "truncated")
        out.append((role if edit == "K" else wanted, text))
    if not re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
        return None
    return cost, out


def every(rows, found):
    """Cheapest by trying all edit strings with up to two inserted rows at each place."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + x for n, x in zip(gaps, (*letters, "")))
            done = replay(rows, found, audit)
            if done and (best is None or (done[0], audit) < best[:2]):
                best = (done[0], audit)
    return best


def plain(rows, found):
    """Cheapest by a table over states of (cost, edits); the strings meet at the same row and end with its edit."""
    table = {"": (0, "")}
    steps = {"": {"u": 1, "a": 2}, "s": {"u": 1, "a": 2}, "u": {"a": 1}, "a": {"u": 1}}
    for fault, (_, role, _) in zip(found, rows):
        new = {}
        for state, (cost, audit) in table.items():
            for mid, n in [(state, 0), *steps[state].items()]:
                into = "a" if mid == "u" else "u"
                ways = [(mid, 3, "D")]
                if fault not in ("blank", "duplicate"):
                    late = fault == "truncated"
                    ways.append((into, 2 + late, "R"))
                    if role[:1] == into or (role[:1] == "s" and mid == ""):
                        ways.append((role[:1], late, "K"))
                for to, more, edit in ways:
                    offer = (cost + 2 * n + more, audit + "I" * n + edit)
                    new[to] = min(new.get(to, offer), offer)
        table = new
    ends = [(c + 2 * n, a + "I" * n) for s, (c, a) in table.items() for n in [{"": 0, "a": 0, "u": 1, "s": 2}[s]]]
    return min(ends)


def expected(table, solver):
    by_conv: dict = {r[0]: [] for r in table}
    for conv, turn, role, text in damaged(table):
        by_conv[conv].append((turn, role, text))
    out = {}
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found = faults(rows)
        turns = {t for t, _, _ in rows if t is not None}
        roles = [r[:1] for _, r, _ in rows]
        cost, audit = solver(rows, found)
        _, repaired = replay(rows, found, audit)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def found_by(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r[n] for n in names) for r in df.collect()}


def write(spark, folder, table):
    frame = spark.createDataFrame(table, SCHEMA).withColumn("cost", F.lit("a clashing name"))
    frame.repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def dirty(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \t", None, "a\x1c.", "\x1c", "end!  \n", "Ende. ", "x" * 5000 + "."]
    table = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            table.append((conv if conv % 7 else -conv, turn * rng.choice([1, 1, 1, 2]), role, rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    table += [(None, 3, "user", "hi"), (None, None, "system", "be kind."), (None, None, "user", "Good."), (9_007_199_254_740_993, 9_007_199_254_740_995, "user", "q?")]
    return table + table[:9]


def test_all_edit_strings(spark, tmp_path):
    table = [r for r in dirty(1, 90, 3) if r[0] is not None]
    sizes = pd.Series([r[0] for r in damaged(table)]).value_counts()
    table = [r for r in table if sizes.get(r[0], 0) <= 4]
    assert found_by(catalog.op13_conversation_repair(spark, write(spark, tmp_path / "t", table))) == expected(table, every)


def test_long_and_dirty_conversations(spark, tmp_path):
    table = dirty(2, 60, 40)
    assert found_by(catalog.op13_conversation_repair(spark, write(spark, tmp_path / "t", table))) == expected(table, plain)


@pytest.mark.parametrize(("limit", "fan"), [(1, 2), (3, 2), (5, 3)])
def test_conversations_cut_into_fragments(spark, limit, fan):
    """A third of all rows are one row of one conversation, and fragments are small."""
    table = dirty(3, 20, 30)
    table += [(1, 500, "user", "again.")] * (len(table) // 2)
    rows = conversations.damage(spark.createDataFrame(table, SCHEMA).repartition(4))
    cut, found = conversations.repair(rows, limit, fan)
    out = conversations.digest(cut, found).withColumn("conv_id", F.col("conv").cast("long"))
    assert found_by(out) == expected(table, plain)


def test_supplied_table(spark):
    folder = "/root/testdata/sf0.01"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found_by(catalog.op13_conversation_repair(spark, folder)) == expected(table, plain)


def test_repaired_rows(spark):
    table = [(1, 0, "system", "s."), (1, 1, "assistant", "Hello."), (1, 2, "user", "q"), (2, 0, "user", "")]
    cut, found = conversations.repair(spark.createDataFrame(table, SCHEMA))
    out = sorted(map(tuple, conversations.repaired_rows(cut, found).collect()))
    assert out == [("1", 0, "0", "system", "s.", "K"), ("1", 1, None, "user", "", "I"), ("1", 2, "1", "assistant", "Hello.", "K")]
    assert {r.conv: r.audit for r in found.collect()}["2"] == "D"


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    out = catalog.op13_conversation_repair(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[0] == "conv_id"


def test_ranks_follow_the_edit_strings():
    """Entries of rules against strings compared in full."""
    rng = random.Random(4)
    rules = ["sU", "ua", "ad", "\ue000\ue001", "x\ue002", "\ue003\ue004"]
    g = conversations.Grammar(rules)
    for _ in range(200):
        word = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(1, 6)))
        m = g.whole(word)
        for p in conversations.STATES:
            some = [(g.audit(word, p, q), m.rank[p][q]) for q in conversations.STATES if m.cost[p][q] < conversations.NONE]
            assert [s for s, _ in sorted(some)] == [s for s, _ in sorted(some, key=lambda x: x[1])]
