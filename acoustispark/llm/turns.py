"""Conversations repaired by generalised LR parsing of their roles.

The grammar of a sound conversation is ``Talk -> (nothing) | Turns``, ``Turns -> u a | s u a | Turns u a`` over the
initials of the roles. Its LR automaton runs over the rows with weighted actions: keep, give another role, delete, insert.
All stacks that are still possible form a graph: stacks share what lies below their tops, and equal ones are merged by the
smallest (cost, audit). What all of them agree on is settled and leaves memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs of the actions and the roles that can be given.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
GIVEN = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

#: The automaton: shifts by (state, initial); how many symbols a state's production has; where ``Turns`` leads; the ends.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 3, (2, "a"): 4, (3, "a"): 5, (6, "u"): 7, (7, "a"): 8}
REDUCE = {4: 2, 5: 3, 8: 3}
TURNS, ACCEPT = {0: 6}, {0, 6}
START = (0, None)
#: Steering one stack to where another is costs two inserted turns, or one and a deleted system row, at most: a stack
#: behind the best by more can never come first again.
BEHIND = 2 * INSERT
SEEN = re.compile(r"[^\x20\x09-\x0D]")


@lru_cache(maxsize=4096)
def pushed(stack: tuple, symbol: str) -> tuple | None:
    """The stack after a shift and the reductions that follow it; None where the symbol does not fit."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        for _ in range(REDUCE[stack[0]]):
            stack = stack[1]
        stack = (TURNS[stack[0]], stack)
    return stack


@lru_cache(maxsize=4096)
def inserted(stack: tuple) -> tuple:
    """(stack, initials inserted on the way) with up to two turns inserted."""
    out, last = [(stack, "")], [(stack, "")]
    for _ in range(2):
        last = [(s, put + c) for held, put in last for c in GIVEN if (s := pushed(held, c)) is not None]
        out += last
    return tuple(out)


@lru_cache(maxsize=65536)
def moves(stack: tuple, initial: str, must_go: bool, cut: bool) -> tuple:
    """(stack, cost, letters, initials put out) of every action on one row."""
    out = [(stack, DELETE, "D", "")]
    if not must_go:
        for held, put in inserted(stack):
            base, letters = INSERT * len(put) + (TRUNCATED if cut else 0), "I" * len(put)
            for c, cost, letter in ((initial, 0, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
                if (s := pushed(held, c)) is not None:
                    out.append((s, base + cost, letters + letter, put + c))
    return tuple(out)


class Parse:
    """The rows of one conversation, one after the other. A stack's way back is a linked list with one link a row; the
    order of the audits is kept as ranks, so no audit is ever copied or compared as a whole: every link ends with the
    letter of its row, so no audit begins with another."""

    def __init__(self):
        self.tops = {START: (0, 0, None)}  # stack -> (cost, rank of its audit, last link)
        self.settled, self.open, self.wait = 0, 0, 64

    def row(self, initial: str, must_go: bool, cut: bool) -> None:
        found: dict = {}
        for stack, (cost, rank, link) in self.tops.items():
            for s, more, letters, put in moves(stack, initial, must_go, cut):
                key = (cost + more, rank, letters)
                if s not in found or key < found[s][0]:
                    found[s] = (key, (link, letters, put))
        best = min(k[0] for k, _ in found.values())
        found = {s: v for s, v in found.items() if v[0][0] <= best + BEHIND}
        ranks = {a: i for i, a in enumerate(sorted({k[1:] for k, _ in found.values()}))}
        self.tops = {s: (k[0], ranks[k[1:]], link) for s, (k, link) in found.items()}
        self.open += 1

    def agreed(self) -> list[tuple[str, str]]:
        """(letters, initials) of the rows that all stacks agree on and that were not handed over before."""
        if self.open < self.wait:
            return []
        ways, depth = [t[2] for t in self.tops.values()], 0
        while depth < self.open and any(w is not ways[0] for w in ways):
            ways, depth = [w[0] for w in ways], depth + 1
        out, link = [], ways[0]
        for _ in range(self.open - depth):
            out.append(link[1:])
            link = link[0]
        if out:
            self._cut(depth)
        self.wait = max(64, 2 * depth)
        return out[::-1]

    def _cut(self, depth: int) -> None:
        """Forget what lies behind the settled rows."""
        made: dict = {}

        def copy(link):
            chain, n = [], depth
            while n and id(link) not in made:
                chain.append(link)
                link, n = link[0], n - 1
            end = made[id(link)] if n else None
            for x in reversed(chain):
                end = made[id(x)] = (end, *x[1:])
            return end

        self.tops = {s: (c, r, copy(link)) for s, (c, r, link) in self.tops.items()}
        self.open = depth

    def end(self) -> tuple[int, list[tuple[str, str]]]:
        """The least cost, and (letters, initials) of the rows still open, with what is inserted after them."""
        key, put, link = min(((cost + INSERT * len(put), rank, "I" * len(put)), put, link) for (cost, rank, link), put in (
            (t, put) for s, t in self.tops.items() for held, put in inserted(s) if held[0] in ACCEPT))
        out = [(key[2], put)] if put else []
        while link is not None:
            out.append(link[1:])
            link = link[0]
        return key[0], out[::-1]


class Talk:
    """Counts, audit and digest of one conversation from its rows in order."""

    def __init__(self):
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None
        self.parse, self.held, self.audit, self.sha, self.any = Parse(), [], [], hashlib.sha256(), False
        self.rows: list[tuple] = []

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None and (self.last is None or turn != self.last):
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        marks = SEEN.search(text)
        tail = text.rstrip("\x20\x09\x0A\x0B\x0C\x0D")[-1:]
        blank, seen = marks is None, marks is not None and seen
        cut = not blank and not seen and tail not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + seen, self.truncated + cut
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        self.parse.row(initial, blank or seen, cut)
        self.held.append((role, text))
        self.put(self.parse.agreed())

    def put(self, links: list[tuple[str, str]]) -> None:
        done = 0
        for letters, initials in links:
            self.audit.append(letters)
            own = letters[-1] != "I"  # only what is inserted at the very end has no row
            role, text = self.held[done] if own else ("", "")
            done += own
            for i, c in enumerate(initials):
                mine = own and i == len(initials) - 1
                self.line(role if mine and letters[-1] == "K" else GIVEN[c], text if mine else "")
        del self.held[:done]

    def line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.any = True
        if self.keep_rows:
            self.rows.append((role, text))

    keep_rows = False

    def result(self) -> tuple:
        cost, links = self.parse.end()
        self.put(links)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.audit), self.sha.hexdigest()


RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) after the contract's damage by the crc32 of ``conv:turn``. Null roles and texts are one
    space, as are null ids and turns inside the crc32; a null turn stays null. A dropped row stays as a mark of its
    conversation (``gone``), without content."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said(conv), F.lit(":"), said(turn))) % 20
    r = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), said(role).alias("role"), said(text).alias("text"), kind.alias("kind"))
    r = r.withColumns({"text": F.when(F.col("kind") == 0, "").when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
                       "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "gone": F.col("kind") == 0})
    again = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return r.withColumn("again", again).select("conv", "turn", "role", "text", "gone")


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with ``seen`` (role and text stood earlier), each conversation in one piece and in order: turn with nulls first,
    then role and text. One exchange by conversation serves the window and the order."""
    w = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    kept = rows.repartition("conv").withColumn("nth", F.row_number().over(w))
    return kept.sortWithinPartitions("conv", "gone", F.col("turn").asc_nulls_first(), "role", "text", "nth").select(
        "conv", "turn", "role", "text", (F.col("nth") > 1).alias("seen"), "gone")


def _walk(batches: Iterator[pa.RecordBatch], keep_rows: bool) -> Iterator[tuple]:
    talk, of = None, None
    for b in batches:
        for conv, turn, role, text, seen, gone in zip(*[b.column(i).to_pylist() for i in range(6)]):
            if talk is None or conv != of:
                if talk is not None:
                    yield of, talk
                talk, of = Talk(), conv
                talk.keep_rows = keep_rows
            if not gone:
                talk.add(turn, role, text, seen)
    if talk is not None:
        yield of, talk


def repair(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``rows`` (conv, turn, role, text, gone): its faults, the cheapest edits and the digest of the
    repaired conversation.

    Rows of one turn are taken by role and text; equal rows stand together, the second a duplicate. Null ids are one
    conversation. A conversation of which nothing is left has zeros, an empty audit and the digest of nothing. An empty
    table gives an empty result. As the digest runs over a whole conversation, one task reads a conversation, sorted, as
    a stream: it holds the rows that are not settled, and one audit letter a row.
    """
    conv = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for of, talk in _walk(batches, False):
            out.append((of, *talk.result()))
            if len(out) >= 512:
                yield pack(out)
                out = []
        yield pack(out)

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], f"conv {conv}, {RESULT}").schema)

    def pack(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    return _in_order(rows).mapInArrow(run, f"conv {conv}, {RESULT}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv, place, role, text): the rows of every repaired conversation, places from 0. Holds one conversation a task."""
    conv = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, talk in _walk(batches, True):
            talk.result()
            n = len(talk.rows)
            yield pa.RecordBatch.from_pydict({"conv": pa.array([of] * n, kind), "place": pa.array(range(n), pa.int64()),
                                              "role": pa.array([r for r, _ in talk.rows], pa.string()), "text": pa.array([t for _, t in talk.rows], pa.string())})

    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(rows.schema["conv"].dataType)
    return _in_order(rows).mapInArrow(run, f"conv {conv}, place bigint, role string, text string")
