"""Repair of conversations by a grammar over row symbols and min-plus transfer matrices.

A repaired conversation is empty, or one optional system row and then pairs of user and assistant
rows. Each row becomes a symbol of its role and its fault. Re-Pair rules name the frequent pairs of
symbols over all conversations; a rule has one min-plus matrix over the states of the repaired
form, made from the matrices of its two halves, so what conversations have in common is worked out
once. Costs come with the order of their edit strings: an entry of a rule holds the state between
its halves, and the edit string is a rope that is only unrolled for the chosen entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NONE = 1 << 40  # cost of what cannot be
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: White space of the blank check; and the ends of a whole text.
SPACE, STOPS = " \t\n\x0b\x0c\r", ".!?"
#: Rows and characters of a fragment; children of a node above fragments.
ROWS, CHARS, FAN = 1024, 4 << 20, 512
#: Rounds of pair naming and rules of a round: a grammar has at most ROUNDS * RULES rules.
ROUNDS, RULES = 6, 64
_FIRST_RULE = 0xE000  # private characters name rules
_INSERTS = {(p, p): 0 for p in STATES} | {(START, USER): 1, (START, ASSISTANT): 2, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2, (USER, ASSISTANT): 1, (ASSISTANT, USER): 1}
_STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
_ROLE = {START: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}  # of an inserted or changed row, by the state before


class Matrix(NamedTuple):
    """Least cost from state to state, and the place of its edit string among those from the same state.

    Every edit string from a state ends with the edit of the last row and names the states on its
    way, so two strings that end in different states differ, and neither starts with the other.
    Hence their order stays the same whatever follows, and ranks are all that a product needs.
    """

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]


def _terminal(symbol: str) -> tuple[Matrix, list[list[str]]]:
    """Matrix and edit strings of one row: inserted rows before it, then its own edit."""
    late = TRUNCATED if symbol.isupper() else 0
    edits: list[tuple[int, int, int, str]] = [(p, p, DELETE, "D") for p in STATES]
    if symbol != "d":
        edits += [(p, q, late, "K") for p, q in _STEP[symbol.lower()].items()]
        edits += [(p, ASSISTANT if p == USER else USER, REROLE + late, "R") for p in STATES]
    best = [[(NONE, "")] * 4 for _ in STATES]
    for (p, k), n in _INSERTS.items():
        for at, q, cost, letter in edits:
            if at == k:
                best[p][q] = min(best[p][q], (INSERT * n + cost, "I" * n + letter))
    rank = []
    for row in best:
        order = sorted(STATES, key=lambda q: (row[q][0] >= NONE, row[q][1]))
        rank.append(tuple(order.index(q) for q in STATES))
    return Matrix(tuple(tuple(c for c, _ in row) for row in best), tuple(rank)), [[s for _, s in row] for row in best]


def product(a: Matrix, b: Matrix) -> tuple[Matrix, tuple[tuple[int, ...], ...]]:
    """The matrix of `a` followed by `b`, and the state between them for each entry."""
    cost, rank, via = [], [], []
    for p in STATES:
        ways = [min((a.cost[p][k] + b.cost[k][q], a.rank[p][k], k) for k in STATES) for q in STATES]
        middle = tuple(k for _, _, k in ways)
        order = sorted(STATES, key=lambda q: (ways[q][0] >= NONE, a.rank[p][middle[q]], b.rank[middle[q]][q]))
        cost.append(tuple(min(c, NONE) for c, _, _ in ways))
        rank.append(tuple(order.index(q) for q in STATES))
        via.append(middle)
    return Matrix(tuple(cost), tuple(rank)), tuple(via)


class Grammar:
    """Terminals and rules with their matrices, evaluated from the shortest rules up."""

    def __init__(self, rules: list[str]):
        self.matrix: dict[str, Matrix] = {}
        self.audits: dict[str, list[list[str]]] = {}
        self.halves: dict[str, tuple[str, str, tuple]] = {}
        for symbol in "suaxSUAXd":
            self.matrix[symbol], self.audits[symbol] = _terminal(symbol)
        for n, pair in enumerate(rules):
            symbol = chr(_FIRST_RULE + n)
            self.matrix[symbol], via = product(self.matrix[pair[0]], self.matrix[pair[1]])
            self.halves[symbol] = (pair[0], pair[1], via)

    def rope(self, symbol: str, p: int, q: int) -> str:
        """The edit string of an entry."""
        if symbol in self.audits:
            return self.audits[symbol][p][q]
        left, right, via = self.halves[symbol]
        return self.rope(left, p, via[p][q]) + self.rope(right, via[p][q], q)

    def whole(self, symbols: str) -> Matrix:
        """The matrix of one symbol or more."""
        out = self.matrix[symbols[0]]
        for symbol in symbols[1:]:
            out, _ = product(out, self.matrix[symbol])
        return out

    def audit(self, symbols: str, p: int, q: int) -> str:
        return "".join(self.rope(s, a, b) for s, (a, b) in zip(symbols, path([self.matrix[s] for s in symbols], p, q)))


def path(matrices: list[Matrix], p: int, q: int) -> list[tuple[int, int]]:
    """The states before and after each matrix on the best way from p to q."""
    reach, backs = {p: (0, 0)}, []
    for m in matrices:
        ways = {to: min((c + m.cost[k][to], r, m.rank[k][to], k) for k, (c, r) in reach.items()) for to in STATES}
        ways = {to: w for to, w in ways.items() if w[0] < NONE}
        order = sorted(ways, key=lambda to: (ways[to][1], ways[to][2]))
        backs.append({to: w[3] for to, w in ways.items()})
        reach = {to: (ways[to][0], n) for n, to in enumerate(order)}
    out = []
    for back in reversed(backs):
        out.append((back[q], q))
        q = back[q]
    return out[::-1]


def ending(m: Matrix) -> tuple[int, int, int]:
    """Cost, last state and inserted rows at the end of the best repair."""
    ends = []
    for q in STATES:
        n = min(_INSERTS.get((q, end), NONE) for end in (START, ASSISTANT))
        ends.append((m.cost[START][q] + INSERT * n, m.rank[START][q], q, n))
    cost, _, q, n = min(ends)
    return cost, q, n


def _packed(m: Matrix) -> bytes:
    return np.array([*m.cost, *m.rank], np.int64).tobytes()


def _unpacked(data: bytes) -> Matrix:
    grid = np.frombuffer(data, np.int64).reshape(8, 4).tolist()
    return Matrix(tuple(map(tuple, grid[:4])), tuple(map(tuple, grid[4:])))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by rule, with `present` false for those dropped.

    The rule is the CRC-32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its text, 2
    removes its stops, 3 repeats it, 4 makes it a user's. A null counts as one space, in the key
    and as role or text.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rule = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(F.col("_rule") == 1, "").when(F.col("_rule") == 2, F.translate(plain("text"), STOPS, "")).otherwise(plain("text"))
    ruled = rows.select("conv_id", "turn", "role", "text", rule.alias("_rule"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_rule") == 3, 2).otherwise(1)))
    return ruled.select(
        "conv_id", "turn", F.when(F.col("_rule") == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        (F.col("_rule") != 0).alias("present"), copies.alias("_copy"),
    ).drop("_copy")


def _symbol(role: str, text: str) -> Column:
    """Role initial, or x; in capitals when the text does not end with a stop; d for a blank text."""
    shown = F.rtrim(F.col(text), F.lit(SPACE))
    initial = F.left(F.col(role), F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    cut = ~F.right(shown, F.lit(1)).isin(*STOPS)
    return F.when(shown == "", "d").when(cut, F.upper(letter)).otherwise(letter)


def fragments(rows: DataFrame, limit: int = ROWS) -> DataFrame:
    """Each conversation in order, in fragments of at most `limit` rows; a written table.

    Rows are dealt to tasks by ranges of conversation, turn, role and text, and equal rows by their
    place in the input, so a conversation of any size, or one row repeated any number of times, is
    spread. `(part, frag)` orders the fragments; `whole` tells that a conversation has no other.
    Rows with equal turns are ordered by role and by text (its first 64 characters, then a hash).
    """
    keyed = rows.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn"), F.col("role"), F.col("text"), F.col("present"),
        _symbol("role", "text").alias("symbol"), F.substring("text", 1, 64).alias("head"), F.xxhash64("text").alias("hash"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("hash")]
    spread = keyed.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order, F.asc("salt"))
    ordered = spread.sortWithinPartitions(*order).select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "present", "symbol")
    schema = "conv string, part int, frag int, whole boolean, turns array<string>, roles array<string>, texts array<string>, symbols string"

    def run(batches):
        part, frag = TaskContext.get().partitionId(), 0
        conv, held, size, seen, split, first = None, [], 0, set(), False, True

        def close(whole: bool):
            nonlocal frag, held, size, seen
            kept = [r for r in held if r[3]]
            symbols = "".join("d" if r[5] else r[4] for r in kept)
            out = (conv, part, frag, whole, [r[0] for r in kept], [r[1] for r in kept], [r[2] for r in kept], symbols)
            frag, held, size, seen = frag + 1, [], 0, set()
            return out

        for batch in batches:
            done = []
            for own, *row in zip(*(batch[c].tolist() for c in ("conv", "turn", "role", "text", "present", "symbol"))):
                if held and own != conv:
                    done.append(close(not split and not first))
                    first, split = False, False
                elif held and (len(held) >= limit or size >= CHARS):
                    split = True
                    done.append(close(False))
                conv = own
                content = (row[1], row[2])
                held.append((*row, row[3] and content in seen))
                if row[3]:
                    seen.add(content)
                    size += len(row[2])
            yield pd.DataFrame(done, columns=[c.split()[0] for c in schema.split(", ")])
        if held:
            yield pd.DataFrame([close(False)], columns=[c.split()[0] for c in schema.split(", ")])

    return stage(ordered.mapInPandas(run, schema), "fragments")


def _sequences(cut: DataFrame) -> DataFrame:
    """(conv, part, frag, symbols, several): symbols with rows seen in an earlier fragment as d."""
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    loose = cut.where("not whole")
    several = loose.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("conv_of"))
    split = stage(loose.join(several, same("conv", "conv_of"), "left_semi").select("conv", "part", "frag", "roles", "texts", "symbols"), "split")
    places = split.select("part", "frag")
    one = cut.join(places, ["part", "frag"], "left_anti").select("conv", "part", "frag", "symbols", F.lit(False).alias("several"))
    if split.isEmpty():
        return one
    spot = F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row")
    rows = split.select("conv", "part", "frag", "symbols", spot).where("substring(symbols, pos + 1, 1) <> 'd'")
    content = F.sha2(F.concat(F.length("row.roles").cast("string"), F.lit(":"), "row.roles", "row.texts"), 256)
    rows = rows.select("conv", content.alias("content"), F.struct("part", "frag", "pos").alias("place"))
    firsts = rows.groupBy(F.col("conv").alias("conv_of"), F.col("content").alias("content_of")).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = rows.join(firsts, same("conv", "conv_of") & same("content", "content_of")).where("place <> first")
    marks = later.groupBy("place.part", "place.frag").agg(F.collect_list("place.pos").alias("marks"))
    marked = F.aggregate(F.coalesce("marks", F.array().cast("array<int>")), F.col("symbols"), lambda s, at: F.overlay(s, F.lit("d"), at + 1, F.lit(1)))
    many = split.join(marks, ["part", "frag"], "left").select("conv", "part", "frag", marked.alias("symbols"), F.lit(True).alias("several"))
    return one.unionByName(many)


def grammar(sequences: DataFrame, rounds: int = ROUNDS, per_round: int = RULES) -> tuple[Grammar, DataFrame]:
    """Rules for the most frequent pairs over all sequences (symbols, n), and each sequence packed by them.

    A round counts neighbouring symbols in Spark, names the most frequent pairs and replaces them
    from left to right. Only the pairs of a round reach the driver. What no rule covers stays.
    """
    packed = sequences.select("symbols", "n", F.col("symbols").alias("packed"))
    rules: list[str] = []
    for _ in range(rounds):
        letters = packed.where(F.length("packed") > 1).select("n", F.split("packed", "").alias("l"))
        pair = F.explode(F.transform(F.sequence(F.lit(0), F.size("l") - 2), lambda i: F.concat(F.get("l", i), F.get("l", i + 1))))
        counts = letters.select("n", pair.alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        named = [r.pair for r in counts.orderBy(F.desc("n"), "pair").limit(per_round).collect()]
        if not named:
            break
        column = F.col("packed")
        for pair in named:
            column = F.replace(column, F.lit(pair), F.lit(chr(_FIRST_RULE + len(rules))))
            rules.append(pair)
        packed = stage(packed.select("symbols", "n", column.alias("packed")), "packed")
    return Grammar(rules), packed


def edits(cut: DataFrame, fan: int = FAN) -> DataFrame:
    """(conv, part, frag, symbols, cost, audit): the cheapest edits of each fragment's rows.

    The cost of a conversation stands at its first fragment, 0 at the others.
    """
    sequences = stage(_sequences(cut), "sequences")
    rules, packed = grammar(sequences.where("symbols <> ''").groupBy("symbols").agg(F.count("*").alias("n")))

    def solve(batches):
        for batch in batches:
            out = []
            for symbols, short in zip(batch["symbols"], batch["packed"]):
                m = rules.whole(short)
                cost, q, n = ending(m)
                out.append((symbols, short, cost, rules.audit(short, START, q) + "I" * n, _packed(m)))
            yield pd.DataFrame(out, columns=["sequence", "packed", "cost", "audit", "matrix"])

    solved = stage(packed.mapInPandas(solve, "sequence string, packed string, cost long, audit string, matrix binary"), "solved")
    known = sequences.where("not several").join(solved, F.col("symbols") == F.col("sequence"), "left")
    one = known.select("conv", "part", "frag", "symbols", F.coalesce("cost", F.lit(0)).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"))
    if sequences.where("several").isEmpty():
        return one
    return one.unionByName(_long(sequences.where("several"), solved, rules, fan))


def _long(sequences: DataFrame, solved: DataFrame, rules: Grammar, fan: int) -> DataFrame:
    """Edits of conversations of several fragments: matrices are multiplied up a tree, states handed down.

    A node has at most `fan` children, so no task holds a conversation, only nodes.
    """
    rank = "row_number() over (partition by conv order by part, frag) - 1"
    filled = sequences.where("symbols <> ''").withColumn("k", F.expr(rank).cast("long"))
    leaves = stage(filled.join(solved.select("sequence", "packed", "matrix"), F.col("symbols") == F.col("sequence")).drop("sequence"), "leaves")
    levels = [leaves.select("conv", "k", "matrix")]

    def up(frame):
        frame = frame.sort_values("k")
        m = None
        for data in frame["matrix"]:
            m = _unpacked(data) if m is None else product(m, _unpacked(data))[0]
        return pd.DataFrame({"conv": [frame["conv"].iloc[0]], "k": [int(frame["k"].iloc[0]) // fan], "matrix": [_packed(m)]})

    while not levels[-1].where("k > 0").isEmpty():
        levels.append(stage(levels[-1].groupBy("conv", F.floor(F.col("k") / fan)).applyInPandas(up, "conv string, k long, matrix binary"), "nodes"))

    def top(batches):
        for batch in batches:
            ends = [ending(_unpacked(m)) for m in batch["matrix"]]
            yield pd.DataFrame({"conv": batch["conv"], "k": batch["k"], "p": START, "q": [q for _, q, _ in ends], "cost": [c for c, _, _ in ends], "tail": [n for _, _, n in ends]})

    schema = "conv string, k long, p int, q int, cost long, tail int"
    states = levels[-1].mapInPandas(top, schema)

    def down(children, parent):
        if not len(children) or not len(parent):
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        children, own = children.sort_values("k"), parent.iloc[0]
        way = path([_unpacked(m) for m in children["matrix"]], int(own["p"]), int(own["q"]))
        cost, tail = np.zeros(len(way), np.int64), np.zeros(len(way), np.int32)
        cost[0], tail[-1] = own["cost"], own["tail"]
        return pd.DataFrame({"conv": children["conv"], "k": children["k"], "p": [p for p, _ in way], "q": [q for _, q in way], "cost": cost, "tail": tail})

    for level in reversed(levels[:-1]):
        states = stage(level.groupBy("conv", F.floor(F.col("k") / fan)).cogroup(states.groupBy("conv", "k")).applyInPandas(down, schema), "states")

    def unroll(batches):
        for batch in batches:
            audits = [rules.audit(s, p, q) + "I" * n for s, p, q, n in zip(batch["packed"], batch["p"], batch["q"], batch["tail"])]
            yield pd.DataFrame({**{c: batch[c] for c in ("conv", "part", "frag", "symbols", "cost")}, "audit": audits})

    place = states.select(F.col("conv").alias("conv_of"), F.col("k").alias("k_of"), "p", "q", "cost", "tail")
    met = leaves.join(place, F.col("conv").eqNullSafe(F.col("conv_of")) & (F.col("k") == F.col("k_of")))
    out = met.select("conv", "part", "frag", "symbols", "packed", "p", "q", "cost", "tail").mapInPandas(unroll, "conv string, part int, frag int, symbols string, cost long, audit string")
    empty = sequences.where("symbols = ''").select("conv", "part", "frag", "symbols", F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
    return out.unionByName(empty)


class _Conversation:
    """What is known of a conversation while its rows go by."""

    def __init__(self, conv):
        self.conv, self.state, self.place, self.last_turn, self.initial = conv, START, 0, None, None
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def faults(self, turns, roles, texts, symbols) -> None:
        for turn, role, text, symbol in zip(turns, roles, texts, symbols):
            if turn is not None and turn != self.last_turn:
                self.turns, self.last_turn, self.high = self.turns + 1, turn, int(turn)
                self.low = self.high if self.low is None else self.low
            blank = not text.strip(SPACE)
            self.blank += blank
            self.duplicate += symbol == "d" and not blank
            self.truncated += symbol.isupper()
            if self.initial is not None:
                self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
            self.initial = role[:1]

    def repaired(self, turns, roles, texts, audit) -> Iterator[tuple]:
        """(turn, role, text, edit) of the rows that the edits leave."""
        at = 0
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            role = roles[at] if edit == "K" else _ROLE[self.state]
            self.state = SYSTEM if role[:1] == "s" else USER if role[:1] == "u" else ASSISTANT
            turn, text = (None, "") if edit == "I" else (turns[at], texts[at])
            at += edit != "I"
            yield turn, role, text, edit

    def summary(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _replayed(cut: DataFrame, found: DataFrame) -> DataFrame:
    """Edits and fragments of a conversation side by side and in order: one shuffle of the texts."""
    lists = [F.lit(None).cast("array<string>").alias(c) for c in ("turns", "roles", "texts")]
    marks = found.select("conv", "part", "frag", F.lit(0).alias("kind"), "cost", "audit", "symbols", *lists)
    rows = cut.select("conv", "part", "frag", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"), F.lit("").alias("symbols"), "turns", "roles", "texts")
    return marks.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "part", "frag", "kind")


def _walk(batches):
    """(conversation, fragment's turns, roles, texts, audit, whether it is the first) in order."""
    now, marks = None, None
    for batch in batches:
        for conv, kind, cost, audit, symbols, turns, roles, texts in zip(*(batch[c].tolist() for c in ("conv", "kind", "cost", "audit", "symbols", "turns", "roles", "texts"))):
            if kind == 0:
                marks = (cost, audit, symbols)
                continue
            before = now
            if now is None or now.conv != conv:
                now = _Conversation(conv)
            now.cost += marks[0]
            now.audit.append(marks[1])
            now.faults(turns, roles, texts, marks[2])
            yield (before if before is not now else None), now, (turns, roles, texts, marks[1])
    if now is not None:
        yield now, None, None


def repair(rows: DataFrame, limit: int = ROWS, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """The fragments of all conversations, and their cheapest edits; for `repaired_rows` and `digest`.

    `rows` has conv_id, turn, role, text and optionally `present`; a row that is not present only
    keeps its conversation in the results. Null ids are one conversation, null turns come first,
    a null role or text is one space. Repeated rows are duplicates. No rows give no rows. Other columns are not used.
    """
    if "present" not in rows.columns:
        rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(True).alias("present"))
    cut = fragments(rows, limit)
    return cut, stage(edits(cut, fan), "edits")


def repaired_rows(cut: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, place, turn, role, text, edit) of the rows that remain; inserted rows have no turn and no text."""

    def run(batches):
        for _, now, fragment in _walk(batches):
            if now is None:
                continue
            out = [(now.conv, now.place + i, *row) for i, row in enumerate(now.repaired(*fragment))]
            now.place += len(out)
            yield pd.DataFrame(out, columns=["conv", "place", "turn", "role", "text", "edit"])

    return _replayed(cut, found).mapInPandas(run, "conv string, place long, turn string, role string, text string, edit string")


def digest(cut: DataFrame, found: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, edits and a hash of the repaired rows.

    A hash goes over the rows in order, so the rows of one conversation pass through one task; they
    are sorted by Spark and read as a stream, none but the current fragment is held.
    """
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def run(batches):
        done = []
        for before, now, fragment in _walk(batches):
            if before is not None:
                done.append(before.summary())
            if now is not None:
                for _, role, text, _ in now.repaired(*fragment):
                    now.hash.update(f"{chr(10) if now.lines else ''}{role}:{text}".encode())
                    now.lines += 1
            if len(done) >= 5_000:
                yield pd.DataFrame(done, columns=[c.split()[0] for c in schema.split(", ")])
                done = []
        yield pd.DataFrame(done, columns=[c.split()[0] for c in schema.split(", ")])

    return _replayed(cut, found).mapInPandas(run, schema)
