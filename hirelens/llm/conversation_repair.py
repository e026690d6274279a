"""Conversation structure repair by iterative-deepening A*.

A conversation is repaired by the cheapest edits after which its role initials
read ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (3), Delete (4; the
only edit of a blank or duplicate row) and Insert an empty user or assistant
turn (3). A truncated row that isn't deleted costs 3 more. Of equally cheap
repairs, the one whose edit initials come first in ASCII order is taken.

Search. A state is (row, what the roles so far allow next). Depth-first search
tries the edits in ASCII order (D, I, K, R) under a cost bound; the bound starts
at the sum of each remaining row's least cost and rises to the least cost that
was cut off. A transposition table keeps, for each state that failed, the cost
that it needs at least, so a state is searched again only with more to spend.
The first accepting path is the answer.

Long conversations are cut into blocks of ``BLOCK`` rows. A block is searched
for each state that it can be entered and left in, ending with its last row
consumed; the entries of up to ``BLOCK`` neighbouring blocks combine into one
of a larger block, level by level, until a conversation is one block, and the
choices are handed down again. Paths of one block from one state differ in an
edit before either ends, so the least cost with the ASCII-least path is the
same as that of one search over all rows, and no task holds more than a block.

Rows are in order of turn (null first), then role and text. The first fault of
a row counts: blank (no character but white space), duplicate (role and text
stood earlier), truncated (the last character that is no white space is none of
``.!?``). The role's first character is its initial; an empty role has a space.

Defined results: a null role or text is one space; a null conversation id is a
conversation; texts of any length are carried whole; an empty table gives no
edits. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch, ordinals
from hirelens.operators.dedupe import digest

BLOCK = 32
WHITE = " \t\n\v\f\r"
INK = r"[^\x20\x09-\x0D]"
#: What an initial leads to: 0 nothing yet, 1 after s, 2 after u, 3 after a.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
DUE = {0: "u", 1: "u", 2: "a", 3: "u"}
END = 4  # left by the end of the conversation, in state 0 or 3
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED = 3


def _moves(code: str | None, state: int) -> list[tuple[str, int, int, int]]:
    """(edit with its role, cost, rows consumed, next state) in ASCII order of
    the edits; ``code`` is the row's initial, in upper case if it is
    truncated, 'd' if it must go, None behind the last row."""
    due = DUE[state]
    insert = ("I" + due, COST["I"], 0, NEXT[state, due])
    if code is None:
        return [insert]
    out = [("D-", COST["D"], 1, state), insert]
    if code != "d":
        more = TRUNCATED * code.isupper()
        kept = NEXT.get((state, code.lower()))
        if kept is not None:
            out.append(("K-", COST["K"] + more, 1, kept))
        out.append(("R" + due, COST["R"] + more, 1, NEXT[state, due]))
    return out


def _least(code: str) -> int:
    if code == "d":
        return COST["D"]
    return min(COST["D"], TRUNCATED * code.isupper() + COST["R"] * (code in "xX"))


def search(codes: str, state: int, goal: int) -> tuple[int, str] | None:
    """The least cost and the ASCII-least of the cheapest edits (two characters
    each: the edit and the role it sets) from ``state`` before the rows to
    ``goal`` behind them; None if no edits lead there."""
    n = len(codes)
    reached = {0: goal in (0, 2, 3) or goal == 1 and "s" in codes.lower(), 1: goal > 0}.get(state, goal > 1)
    if not (reached or goal == END):
        return None
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + _least(codes[i])
    need: dict[tuple[int, int], float] = {}  # cost from here at least, learnt from failures

    def visit(i: int, q: int, left: float) -> str | None:
        if i == n and (q == goal if goal != END else q in (0, 3)):
            return ""
        least = math.inf
        if i < n or goal == END:
            for edit, cost, rows, to in _moves(codes[i] if i < n else None, q):
                known = need.get((i + rows, to), ahead[i + rows])
                if cost + known <= left:
                    path = visit(i + rows, to, left - cost)
                    if path is not None:
                        return edit + path
                    known = need[i + rows, to]
                least = min(least, cost + known)
        need[i, q] = least
        return None

    bound: float = ahead[0]
    while bound < math.inf:
        path = visit(0, state, bound)
        if path is not None:
            return int(bound), path
        bound = need[0, state]
    return None


@functools.lru_cache(maxsize=1 << 16)
def entries(codes: str, first: bool, last: bool) -> str:
    """All ways through a block as ``in,out,cost,edits`` joined by ``;``, those
    of one entry state in ASCII order of their edits."""
    out = []
    for q in (0,) if first else (0, 1, 2, 3):
        found = [(path, goal, cost) for goal in ((END,) if last else (0, 1, 2, 3))
                 for cost, path in [search(codes, q, goal) or (0, None)] if path is not None]
        out += [f"{q},{goal},{cost},{path}" for path, goal, cost in sorted(found)]
    return ";".join(out)


def combine(blocks: list[str]) -> str:
    """The entries of neighbouring blocks as those of one block, whose edits
    are the states between its parts."""
    parsed = []
    for text in blocks:
        ways: dict[int, list[tuple[int, int]]] = {}
        for entry in text.split(";"):
            a, b, cost, _ = entry.split(",", 3)
            ways.setdefault(int(a), []).append((int(b), int(cost)))
        parsed.append(ways)
    out = []
    for start in parsed[0]:
        best: dict[int, tuple[int, list[int], str]] = {start: (0, [], "")}
        for ways in parsed:
            after: dict[int, tuple[int, list[int], str]] = {}
            for q, (cost, ranks, states) in best.items():
                for rank, (to, more) in enumerate(ways.get(q, ())):
                    way = (cost + more, [*ranks, rank], states + str(to))
                    if to not in after or way[:2] < after[to][:2]:
                        after[to] = way
            best = after
        found = sorted((ranks, to, cost, states) for to, (cost, ranks, states) in best.items())
        out += [f"{start},{to},{cost},{states}" for _, to, cost, states in found]
    return ";".join(out)


def _entries(codes: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([entries(c, bool(a), bool(z)) for c, a, z in zip(codes, first, last)], dtype=object)


def _combined(blocks: pd.Series) -> pd.Series:
    return pd.Series([combine(list(x)) for x in blocks], dtype=object)


def _entry(paths: str, a: str, b: str, field: int):
    """A field of the entry from state ``a`` to state ``b``."""
    return F.expr(f"split(filter(split({paths}, ';'), x -> startswith(x, concat({a}, ',', {b}, ',')))[0], ',')[{field}]")


def _chosen(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, block, edits) of the cheapest repairs, from (conv, block, last,
    paths) of all blocks."""
    joined = F.pandas_udf(_combined, "string")
    levels = [blocks]
    while levels[-1].where("block > 0").limit(1).count():
        up = levels[-1].select("conv", (F.expr(f"block div {BLOCK}")).alias("over"), F.struct("block", "paths").alias("x"))
        up = up.groupBy("conv", "over").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # BLOCK of them at most
        levels.append(scratch.save(up.select("conv", F.col("over").alias("block"), joined("xs.paths").alias("paths")),
                                   f"level-{len(levels)}"))
    pick = levels[-1].select("conv", "block", F.lit("0").alias("a"), F.lit(str(END)).alias("b"))
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k].select(F.col("conv").alias("c"), F.col("block").alias("n"), "paths")
        pick = pick.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("n")))
        pick = pick.select("conv", "block", "a", _entry("paths", "a", "b", 3).alias("path"))
        if k:
            states = pick.withColumn("i", F.explode(F.expr("sequence(0, length(path) - 1)")))
            pick = states.select("conv", (F.col("block") * BLOCK + F.col("i")).alias("block"),
                                 F.expr("CASE WHEN i = 0 THEN a ELSE substring(path, i, 1) END").alias("a"),
                                 F.expr("substring(path, i + 1, 1)").alias("b"))
    return pick.select("conv", "block", F.col("path").alias("edits"))


def repair(rows: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The edits of every conversation in order, one row each: conv, place (of
    the row, or of the next one for an insert), step, edit (D, I, K, R), role
    and text (what stands there afterwards; of a deleted row, what stood
    there), and of the row itself turn, initial and fault."""
    at = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    at = ordinals(at, "conv", [F.col("turn"), F.col("role"), F.col("text")],
                  [F.col("turn"), F.left("role", F.lit(16)), F.left("text", F.lit(32))], scratch, "rows")
    at = at.withColumn("what", digest("role", "text"))
    again = (at.groupBy("conv", "what").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("conv").alias("c"), F.col("what").alias("w"), "first"))
    at = at.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("what") == F.col("w")), "left")
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(INK), "blank").when(F.col("place") > F.col("first"), "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated"))
    initial = F.when(F.col("role") == "", F.lit(" ")).otherwise(F.left("role", F.lit(1)))
    at = scratch.save(at.select("conv", "place", "held", "turn", "role", "text", initial.alias("initial"), fault.alias("fault")), "faults")

    mine = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(mine)).otherwise(mine))
    blocks = (at.select("conv", F.expr(f"place div {BLOCK}").alias("block"), "held", F.struct("place", code.alias("code")).alias("x"))
              .groupBy("conv", "block").agg(F.max("held").alias("held"), F.sort_array(F.collect_list("x")).alias("xs")))  # BLOCK of them at most
    through = F.pandas_udf(_entries, "string")
    blocks = scratch.save(blocks.select("conv", "block", through(
        F.array_join("xs.code", ""), F.col("block") == 0, (F.col("block") + 1) * BLOCK >= F.col("held")).alias("paths")), "level-0")

    pieces = _chosen(blocks, scratch).select(
        "conv", "block", F.posexplode(F.expr(r"regexp_extract_all(edits, '((?:I.)*[DKR].|(?:I.)+$)', 1)")).alias("i", "piece"))
    pieces = pieces.select("conv", (F.col("block") * BLOCK + F.col("i")).alias("place"), "piece")
    own = at.select(F.col("conv").alias("c"), F.col("place").alias("p"), "turn", "role", "text", "initial", "fault")
    steps = pieces.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("place") == F.col("p")), "left")
    steps = steps.withColumn("step", F.explode(F.expr("sequence(0, length(piece) div 2 - 1)")))
    edit, due = F.expr("substring(piece, 2 * step + 1, 1)"), F.expr("substring(piece, 2 * step + 2, 1)")
    named = F.when(due == "u", "user").when(due == "a", "assistant").otherwise(F.col("role"))
    of_row = lambda c: F.when(edit != "I", F.col(c)).alias(c)
    return steps.select("conv", "place", "step", edit.alias("edit"), named.alias("role"),
                        F.when(edit == "I", F.lit("")).otherwise(F.col("text")).alias("text"), of_row("turn"), of_row("initial"), of_row("fault"))


LEGAL = {"su", "ua", "au"}
REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Report:
    """The figures of one conversation while its edits pass by in order."""

    def __init__(self, conv):
        self.conv, self.low, self.high, self.turns, self.turn = conv, None, None, 0, None
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.initial, self.cost, self.audit = 0, None, 0, []
        self.sha, self.any = hashlib.sha256(), False

    def add(self, edit, role, text, turn, initial, fault):
        self.audit.append(edit)
        self.cost += COST[edit] + TRUNCATED * (fault == "truncated" and edit != "D")
        if edit != "I":
            if turn is not None and turn != self.turn:
                self.turns, self.turn, self.high = self.turns + 1, turn, int(turn)
                self.low = int(turn) if self.low is None else self.low
            if fault is not None:
                self.faults[fault] += 1
            self.illegal += self.initial is not None and self.initial + initial not in LEGAL
            self.initial = initial
        if edit != "D":
            self.sha.update((("\n" if self.any else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
            self.any = True

    def row(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in REPORT.split(", ")]
    now, done = None, []
    for pdf in batches:
        clean = pdf.astype(object).where(pdf.notna(), None)
        for conv, *edit in clean[["conv", "edit", "role", "text", "turn", "initial", "fault"]].itertuples(index=False, name=None):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Report(conv)
            now.add(*edit)
        if done:
            yield pd.DataFrame(done, columns=names)
            done = []
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


def report(edits: DataFrame) -> DataFrame:
    """One row for each conversation with edits: gaps in its turns, faults,
    adjacent roles that may not follow each other, cost, the edits' initials and
    the SHA-256 of the repaired ``role:text`` lines.

    The hash of a conversation is of one sequence, so its rows pass through one
    task; they pass one by one in sorted order, and only the audit, which is
    the result, grows with them."""
    rows = edits.select(F.col("conv").cast("string").alias("conv"), "place", "step", "edit", "role", "text",
                        F.col("turn").cast("string").alias("turn"), "initial", "fault")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "place", "step").drop("place", "step")
    return rows.mapInPandas(_reports, REPORT).withColumn("conv", F.col("conv").cast(edits.schema["conv"].dataType))
