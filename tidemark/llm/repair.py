"""Cheapest repair of a conversation's structure, streamed in turn order.

A conversation is well formed if its roles read ``(s?(ua)+)?`` by their initials: a system
turn at most, then user and assistant in pairs. Edits are Keep (0), Rerole to user or
assistant (2), Delete (3; blank and repeated turns must go) and Insert an empty user or
assistant turn (2); a turn that breaks off costs 1 if it stays.

Equal rows are counted before anything moves. Turns are dealt out by conversation and
sorted within, and ``mapInPandas`` carries the state of a dynamic program from Arrow batch
to Arrow batch: for each of the four places in the pattern the least cost, how the best
edit strings to them compare, and a running digest of the repaired lines. Costs are held
relative to the least, so only few different states exist and a row's step is looked up by
(state, kind of row); two bytes a row name the step and serve as back pointers. A task
never holds a conversation's texts. After ``SPILL`` rows the pointers are resolved for all
four places and leave the task as a row of their own; such rows are put together per
conversation at the end, so a giant conversation takes two bytes for each of at most
``SPILL`` rows in its task. Whether a turn repeats an earlier one is decided before, by the
least turn per (conversation, digest of role and text), joined on (conversation, turn,
digest): no key of that join has more than one row on either side.

Nulls: a null role or text counts as one space; null turns come first and count as no
number for gaps; rows without conv_id form one conversation of their own. Rows of equal
turn are taken by role, then text; fully equal rows one after another. An empty role
matches nothing. Very long texts are streamed. Empty tables give empty results. Only the
four columns are read; other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

#: Rows after which a conversation's back pointers leave the task.
SPILL = 1 << 16

#: Costs: keep 0, rerole, delete, insert, and for a kept turn that breaks off.
REROLE, DELETE, INSERT, BREAK = 2, 3, 2, 1

SPACE = " \t\n\x0b\x0c\r"
FAR = 1 << 30

#: Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The place an inserted or reroled turn leads to, and the role it gets.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("", "system", "user", "assistant")
#: Where a kept turn of an initial leads, by place; absent where it may not stand.
KEPT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: Inserts that end the pattern, by place.
TAIL = ("", "II", "I", "")

#: Faults of a row.
NO_FAULT, TRUNCATED, MUST_GO = range(3)

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` as conv_id, turn, role, text, copies, with faults put in.

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops the row, 1 empties its text, 2
    takes out its ``.!?``, 3 repeats it, 4 makes it a user's. A dropped row stays with
    0 copies, so that its conversation is still known.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"))
    fate = F.crc32(F.encode(F.concat_ws(":", shown("conv_id"), shown("turn")), "utf-8")) % 20
    return rows.withColumn("_fate", fate).select(
        "conv_id",
        "turn",
        F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fate") == 1, "")
        .when(F.col("_fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("_fate") == 0, 0).when(F.col("_fate") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def counted(turns: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and ``first``: no earlier turn has the same role and text."""
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1).cast("long")
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.alias("copies"),
    )
    there = F.col("copies") > 0
    # a row without copies only tells that its conversation exists
    rows = rows.withColumns({c: F.when(there, F.col(c)).otherwise("") for c in ("role", "text")})
    rows = rows.withColumn("digest", _digest(F.col("role"), F.col("text")))
    keys = ["conv_id", "turn", "digest"]
    distinct = rows.groupBy(*keys).agg(
        F.sum("copies").alias("copies"), F.any_value("role").alias("role"), F.any_value("text").alias("text")
    )
    firsts = rows.where(there).groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("least"))
    firsts = firsts.select(
        F.col("conv_id").alias("_c"), F.col("least.turn").alias("_t"), F.col("digest").alias("_d"), F.lit(True).alias("first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
    joined = distinct.join(firsts, same & (F.col("digest") == F.col("_d")), "left")
    return joined.select(
        "conv_id", "turn", "role", "text", "copies", F.coalesce("first", F.lit(False)).alias("first")
    )


def _digest(role: Column, text: Column) -> Column:
    # the role's length keeps (role, text) apart from other cuts of the same characters
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


class Steps:
    """The dynamic program's steps, each computed once and then looked up.

    A state has for each place (cost over the least one, rank of its edit string), or None.
    A step is (state it leads to, what the least cost grows by, for each place the place
    it came from and the edits).
    """

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.found: dict[tuple[int, str, int], int] = {}
        self.steps: list[tuple[int, int, tuple]] = []
        self.start = self.state(((0, 0), None, None, None))

    def state(self, state: tuple) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
        return self.number[state]

    def step(self, at: int, initial: str, fault: int) -> int:
        key = (at, initial, fault)
        if key not in self.found:
            self.found[key] = len(self.steps)
            self.steps.append(self._step(self.states[at], initial, fault))
        return self.found[key]

    def _step(self, state: tuple, initial: str, fault: int) -> tuple[int, int, tuple]:
        best: list[tuple | None] = [None] * 4
        for place, known in enumerate(state):
            if known is None:
                continue
            cost, rank = known
            options = [(cost + DELETE, place, "D")]
            at, added = place, ""
            # more than three inserts before one turn only go round in the pattern
            while fault != MUST_GO and len(added) <= 3:
                spent = cost + INSERT * len(added) + (BREAK if fault == TRUNCATED else 0)
                if at in KEPT.get(initial, {}):
                    options.append((spent, KEPT[initial][at], added + "K"))
                options.append((spent + REROLE, NEXT[at], added + "R"))
                at, added = NEXT[at], added + "I"
            for spent, to, edits in options:
                if best[to] is None or (spent, rank, edits) < best[to][:3]:
                    best[to] = (spent, rank, edits, place)
        least = min(b[0] for b in best if b)
        order = {b[1:3]: i for i, b in enumerate(sorted((b for b in best if b), key=lambda b: b[1:3]))}
        to = tuple(None if b is None else (b[0] - least, order[b[1:3]]) for b in best)
        return self.state(to), least, tuple(None if b is None else (b[3], b[2]) for b in best)

    def end(self, at: int) -> tuple[int, int]:
        """(place, cost over the least) of the cheapest way to end; ties go to the least edit string."""
        ways = [
            (known[0] + INSERT * len(TAIL[place]), known[1], TAIL[place], place)
            for place, known in enumerate(self.states[at])
            if known is not None
        ]
        cost, _, _, place = min(ways)
        return place, cost

    def resolve(self, steps: array, place: int) -> tuple[int, str]:
        """The place at the start and the edits that lead from there to ``place``."""
        pieces = []
        for step in reversed(steps):
            place, edits = self.steps[step][2][place]
            pieces.append(edits)
        return place, "".join(reversed(pieces))


class Lines:
    """Digests of the repaired lines on the best way to each place."""

    def __init__(self):
        self.hash = [hashlib.sha256(), None, None, None]

    def advance(self, step: tuple, role: str, text: str) -> None:
        new: list = [None] * 4
        for to, back in enumerate(step[2]):
            if back is None:
                continue
            place, edits = back
            if edits == "D":
                new[to] = self.hash[place]  # shared, never changed: every other way copies first
                continue
            new[to] = self.hash[place].copy()
            at = place
            for edit in edits:
                line = "" if at == START else "\n"
                if edit == "I":
                    at = NEXT[at]
                    line += ROLE[at] + ":"
                elif edit == "R":
                    at = NEXT[at]
                    line += f"{ROLE[at]}:{text}"
                else:
                    at = to
                    line += f"{role}:{text}"
                new[to].update(line.encode())
        self.hash = new

    def end(self, place: int) -> str:
        digest = self.hash[place]
        if TAIL[place]:
            digest = digest.copy()
            at = place
            for _ in TAIL[place]:
                at = NEXT[at]
                digest.update(f"\n{ROLE[at]}:".encode())
        return digest.hexdigest()


def fault_of(text: str, first: bool) -> tuple[str | None, int]:
    """What a row's first fault counts as, and how the program must treat the row."""
    last = text.rstrip(SPACE)[-1:]
    if not last:
        return "blank", MUST_GO
    if not first:
        return "duplicate", MUST_GO
    return ("truncated", TRUNCATED) if last not in ".!?" else (None, NO_FAULT)


class Conversation:
    """The program over one conversation's turns, in order."""

    def __init__(self, conv_id, steps: Steps):
        self.conv_id, self.steps = conv_id, steps
        self.at, self.cost, self.lines, self.back = steps.start, 0, Lines(), array("H")
        self.chunks, self.counts = 0, dict.fromkeys(COUNTS, 0)
        self.least = self.most = self.turn = None
        self.turns, self.before = 0, None

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most, self.turn, self.turns = turn, turn, self.turns + 1
        what, fault = fault_of(text, first)
        if what:
            self.counts[what] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.before = initial
        number = self.steps.step(self.at, initial if initial in KEPT else "", fault)
        step = self.steps.steps[number]
        self.back.append(number)
        self.at, self.cost = step[0], self.cost + step[1]
        self.lines.advance(step, role, text)

    def spill(self) -> dict:
        """The back pointers so far as a row: for each place where they begin and the edits."""
        ways = [
            (-1, "") if known is None else self.steps.resolve(self.back, place)
            for place, known in enumerate(self.steps.states[self.at])
        ]
        row = dict.fromkeys(["audit", "place", "repaired_sha256", *COUNTS])
        row |= {"conv_id": self.conv_id, "chunk": self.chunks, "starts": [w[0] for w in ways], "pieces": [w[1] for w in ways]}
        self.chunks += 1
        del self.back[:]
        return row

    def end(self) -> dict:
        place, more = self.steps.end(self.at)
        self.counts["cost"] = self.cost + more
        if self.turns:
            self.counts["gaps"] = self.most - self.least + 1 - self.turns
        start, edits = self.steps.resolve(self.back, place)
        return {
            "conv_id": self.conv_id, "chunk": None, "starts": None, "pieces": None,
            "audit": edits + TAIL[place], "place": start, "repaired_sha256": self.lines.end(place), **self.counts,
        }


def stream(frames: Iterator[pd.DataFrame], spill: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn to one row for each conversation, and one for each spill."""
    steps, held = Steps(), None
    for frame in frames:
        out = []
        for conv_id, has_id, turn, has_turn, role, text, copies, first in zip(
            *(frame[c].tolist() for c in ["conv_id", "has_id", "turn", "has_turn", "role", "text", "copies", "first"]),
            strict=True,
        ):
            conv_id = conv_id if has_id else None
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    out.append(held.end())
                held = Conversation(conv_id, steps)
            for _ in range(copies):
                held.add(turn if has_turn else None, role, text, first)
                first = False
                if len(held.back) >= spill:
                    out.append(held.spill())
        if out:
            yield _frame(out)
    if held is not None:
        yield _frame([held.end()])


def _frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows)
    for c in ("conv_id", "chunk", "place", *COUNTS):
        frame[c] = pd.Series([row[c] for row in rows], dtype=object)
    return frame


def repair(turns: DataFrame, spill: int = SPILL) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit and digest of the repaired lines.

    ``turns`` has conv_id, turn, role, text and, if rows stand for several equal ones, copies.
    """
    small_batches(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType.simpleString()
    blank = F.lit("") if kind == "string" else F.lit(0).cast(kind)
    rows = (
        counted(turns)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
        .select(
            # without nulls, so that pandas keeps whole numbers whole
            F.coalesce("conv_id", blank).alias("conv_id"),
            F.col("conv_id").isNotNull().alias("has_id"),
            F.coalesce("turn", F.lit(0)).alias("turn"),
            F.col("turn").isNotNull().alias("has_turn"),
            "role", "text", "copies", "first",
        )
    )
    numbers = ", ".join(f"{c} long" for c in COUNTS)
    schema = (
        f"conv_id {kind}, chunk long, starts array<int>, pieces array<string>, audit string, place int,"
        f" repaired_sha256 string, {numbers}"
    )
    parts = rows.mapInPandas(lambda frames: stream(frames, spill), schema)
    whole = F.col("chunk").isNull()
    told = ["audit", "place", "repaired_sha256", *COUNTS]
    chunk = F.when(~whole, F.struct("chunk", "starts", "pieces"))
    joined = parts.groupBy("conv_id").agg(
        *[F.max(F.when(whole, F.col(c))).alias(c) for c in told], F.array_sort(F.collect_list(chunk)).alias("chunks")
    )
    # from the last spill back to the first: the place decides which edits count
    back = F.aggregate(
        F.reverse("chunks"),
        F.struct(F.col("place").alias("place"), F.array("audit").alias("pieces")),
        lambda acc, c: F.struct(
            F.element_at(c["starts"], acc["place"] + 1).alias("place"),
            F.concat(acc["pieces"], F.array(F.element_at(c["pieces"], acc["place"] + 1))).alias("pieces"),
        ),
        lambda acc: F.array_join(F.reverse(acc["pieces"]), ""),
    )
    audit = F.when(F.size("chunks") == 0, F.col("audit")).otherwise(back)
    return joined.select("conv_id", *COUNTS, audit.alias("audit"), "repaired_sha256")


def repaired_turns(turns: DataFrame, spill: int = SPILL) -> DataFrame:
    """conv_id, place, role, text of every conversation after its cheapest repair.

    The audit goes before its conversation's turns in the same sorted stream.
    """
    rows = counted(turns)
    audits = repair(turns, spill).select("conv_id", "audit")
    empty = {"turn": F.lit(None).cast("long"), "role": F.lit(""), "text": F.lit(""), "copies": F.lit(0).cast("long")}
    both = audits.withColumns(empty).unionByName(rows.drop("first").withColumn("audit", F.lit(None).cast("string")))
    kind = turns.schema["conv_id"].dataType.simpleString()
    blank = F.lit("") if kind == "string" else F.lit(0).cast(kind)
    ordered = both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text"
    )
    ordered = ordered.select(
        F.coalesce("conv_id", blank).alias("conv_id"), F.col("conv_id").isNotNull().alias("has_id"),
        "audit", "role", "text", "copies",
    )

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, done, place, held = "", START, 0, 0, None
        for frame in frames:
            out: list[tuple] = []
            names = ["conv_id", "has_id", "audit", "role", "text", "copies"]
            for conv_id, has_id, told, role, text, copies in zip(*(frame[c].tolist() for c in names), strict=True):
                conv_id = conv_id if has_id else None
                if isinstance(told, str):
                    for _ in audit[done:]:  # inserts at the end of the one before
                        at = NEXT[at]
                        out.append((held, place, ROLE[at], ""))
                        place += 1
                    audit, at, done, place, held = told, START, 0, 0, conv_id
                    continue
                for _ in range(copies):
                    while audit[done] == "I":
                        at, done = NEXT[at], done + 1
                        out.append((held, place, ROLE[at], ""))
                        place += 1
                    edit, done = audit[done], done + 1
                    if edit != "D":
                        at = NEXT[at] if edit == "R" else KEPT[role[0]][at]
                        out.append((held, place, ROLE[at] if edit == "R" else role, text))
                        place += 1
            if out:
                yield _turns(out)
        if tail := [*audit[done:]]:
            out = []
            for _ in tail:
                at = NEXT[at]
                out.append((held, place, ROLE[at], ""))
                place += 1
            yield _turns(out)

    return ordered.mapInPandas(apply, f"conv_id {kind}, place long, role string, text string")


def _turns(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["conv_id", "place", "role", "text"])
    frame["conv_id"] = pd.Series([row[0] for row in rows], dtype=object)
    return frame
