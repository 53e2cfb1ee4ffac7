"""Repair of the turn structure of conversations, by Hirschberg's divide and conquer.

A conversation should read `(s?(ua)+)?` by the initials of its roles. Each of its rows is kept
(cost 0), given the role user or assistant (1) or deleted (2); rows without text may be inserted
(5 each). Blank rows and repeats must be deleted; a truncated row that stays costs 5 more. What
has been read so far leaves one of four states: nothing, a system row, a user row, an assistant
row. The costs of reaching each state from the front and of ending well from each state at
the back meet in the middle; the crossing of least cost, and among equals the one whose edits
come first in ASCII order, splits the task into two halves that share nothing. Only four costs
and four ranks are carried along, so space grows with the rows alone. The ranks order the best edits of the four
states: none of them is the beginning of another, as each ends in an edit of the same row.

A conversation of ordinary size is handled in one piece. One with more than PART_ROWS rows or
PART_CHARS characters is cut into parts, in parallel: each part gives the costs and ranks
between all states at its ends; four numbers a part decide the states where parts meet, and
then each part is repaired by itself. No task holds such a conversation.

Defined results. Rows are read by turn (NULLs first), then role, the first characters of the
text, and a hash of it, so rows alike in all of that are adjacent. NULL role or text counts as one blank; a
role that is empty or begins with another letter than s, u, a can only be changed or deleted.
NULL is a conversation of its own. A conversation all of whose rows are dropped has no gaps,
faults, edits or turns. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from riskweave.llm.common import small_batches
from riskweave.operators.skew import MAX_SLICES, same_keys
from riskweave.session import written

PART_ROWS = 5_000
PART_CHARS = 8_000_000
BLANKS = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 50
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAULTS = ("blank", "duplicate", "truncated")
# What a row is to the search: one byte.
GONE = 0  # blank or repeated
INITIALS = {"s": 1, "u": 2, "a": 3}
OTHER, CUT = 4, 4  # 1 to 4 by initial, plus CUT where the text is truncated


def _next_turn(state: int) -> int:
    """The state behind a row that continues the alternation of user and assistant."""
    return ASSISTANT if state == USER else USER


def _inserts(state: int) -> list[tuple[int, int]]:
    """States reached by inserted rows, with their number; longer runs only come back."""
    out = [(state, 0), (_next_turn(state), 1)]
    return out + [(ASSISTANT, 2)] if state in (NOTHING, SYSTEM) else out


@lru_cache(None)
def moves(symbol: int) -> tuple[tuple[tuple[int, str], ...], ...]:
    """By state before and behind a row: the least cost, and the edits at that cost that come
    first in ASCII order, inserts in front of the row included."""
    best = [[(FAR, "")] * 4 for _ in STATES]
    cut = TRUNCATED if symbol > CUT else 0
    initial = symbol - CUT if symbol > CUT else symbol
    for start in STATES:
        for state, inserted in _inserts(start):
            found = [(state, DELETE, "D")]
            if symbol != GONE:
                found.append((_next_turn(state), RELABEL + cut, "R"))
                if initial == SYSTEM and state == NOTHING:
                    found.append((SYSTEM, cut, "K"))
                elif initial in (USER, ASSISTANT) and initial == _next_turn(state):
                    found.append((initial, cut, "K"))
            for end, cost, edit in found:
                whole = (INSERT * inserted + cost, "I" * inserted + edit)
                best[start][end] = min(best[start][end], whole)
    return tuple(map(tuple, best))


# Costs and edits behind the last row, by the state it leaves.
ENDING = tuple(
    min((INSERT * n, "I" * n) for end, n in _inserts(state) if end in (NOTHING, ASSISTANT))
    for state in STATES
)


@lru_cache(1 << 16)
def _forward(costs: tuple, ranks: tuple, symbol: int) -> tuple[int, tuple, tuple]:
    """One row further: how much all costs grow, the costs above that, and the ranks."""
    step = moves(symbol)
    found = []
    for end in STATES:
        found.append(
            min(
                ((costs[s] + step[s][end][0], ranks[s], step[s][end][1]) for s in STATES),
                key=lambda m: (min(m[0], FAR), m[1:]),
            )
        )
    least = min(m[0] for m in found)
    order = sorted(STATES, key=lambda e: (found[e][0] >= FAR, found[e][1:]))
    ranked = tuple(order.index(e) for e in STATES)
    return least, tuple(min(m[0] - least, FAR) if m[0] < FAR else FAR for m in found), ranked


@lru_cache(1 << 16)
def _backward(costs: tuple, symbol: int) -> tuple[int, tuple]:
    step = moves(symbol)
    found = [min(step[s][e][0] + costs[e] for e in STATES) for s in STATES]
    least = min(found)
    return least, tuple(c - least if c < FAR else FAR for c in found)


def _at(state: int) -> tuple:
    return tuple(0 if s == state else FAR for s in STATES)


def forward(symbols: bytes, start: int) -> tuple[list[int], tuple]:
    """Least costs of all states behind the rows, and the order of the edits that give them."""
    total, costs, ranks = 0, _at(start), (0, 0, 0, 0)
    for symbol in symbols:
        more, costs, ranks = _forward(costs, ranks, symbol)
        total += more
    return [total + c if c < FAR else FAR for c in costs], ranks


def backward(symbols: bytes, costs: tuple) -> tuple[int, tuple]:
    """Least costs to go in front of the rows, as a sum and what each state has above it."""
    total = 0
    for symbol in reversed(symbols):
        more, costs = _backward(costs, symbol)
        total += more
    return total, costs


def crossing(costs: list[int], ranks: tuple, ahead) -> int:
    """The state of least cost in both directions; among equals that of the first edits."""
    return min(STATES, key=lambda s: (min(costs[s] + ahead[s], FAR), ranks[s]))


def edits(symbols: bytes, start: int, end: int) -> list[str]:
    """For each row its edit, after the inserts in front of it: the cheapest from one state to
    the other, and of these the first in ASCII order."""
    out = []
    todo = [(0, len(symbols), start, end)]
    while todo:
        low, high, first, last = todo.pop()
        if high - low == 1:
            out.append(moves(symbols[low])[first][last][1])
        elif high > low:
            mid = (low + high) // 2
            costs, ranks = forward(symbols[low:mid], first)
            _, ahead = backward(symbols[mid:high], _at(last))
            cross = crossing(costs, ranks, ahead)
            todo += [(mid, high, cross, last), (low, mid, first, cross)]
    return out


def last_state(symbols: bytes, start: int = NOTHING) -> tuple[int, int]:
    """The state behind the last row of the best whole repair, and the cost of that repair."""
    costs, ranks = forward(symbols, start)
    state = crossing(costs, ranks, [c for c, _ in ENDING])
    return state, costs[state] + ENDING[state][0]


def repaired_turns(rows: list[dict], edited: list[str], state: int) -> tuple[list[dict], int]:
    """The rows (role, text) that the edits leave, and the state behind them."""
    names = {USER: "user", ASSISTANT: "assistant"}
    out = []

    def insert(n: int) -> None:
        nonlocal state
        for _ in range(n):
            state = _next_turn(state)
            out.append({"role": names[state], "text": ""})

    for row, edit in zip(rows, edited):
        insert(len(edit) - 1)
        if edit[-1] == "K":
            state = INITIALS[row["role"][0]]
            out.append(row)
        elif edit[-1] == "R":
            state = _next_turn(state)
            out.append({"role": names[state], "text": row["text"]})
    return out, state


def symbol_of(role: str, text: str, repeated: bool) -> tuple[int, str | None]:
    """What a row is to the search, and its first fault."""
    said = text.rstrip(BLANKS)
    if not said:
        return GONE, "blank"
    if repeated:
        return GONE, "duplicate"
    known = INITIALS.get(role[:1], OTHER)
    return (known + CUT, "truncated") if said[-1] not in ".!?" else (known, None)


class _Part:
    """Consecutive rows of one conversation, as they come."""

    def __init__(self, key, slice_no: int):
        self.key, self.slice_no = key, slice_no
        self.rows, self.symbols = [], bytearray()
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal, self.seen = 0, set()
        self.turns, self.chars = set(), 0
        self.first = self.last = None

    def add(self, turn, role: str, text: str, repeated: bool | None) -> None:
        if repeated is None:  # the whole conversation is in this part
            repeated = (role, text) in self.seen
            self.seen.add((role, text))
        symbol, fault = symbol_of(role, text, repeated)
        if fault:
            self.faults[fault] += 1
        if self.rows:
            self.illegal += self.last + role[:1] not in LEGAL
        else:
            self.first = role[:1]
        self.last = role[:1]
        self.symbols.append(symbol)
        self.rows.append({"role": role, "text": text})
        self.chars += len(text)
        if turn is not None:
            self.turns.add(turn)


LEGAL = ("su", "ua", "au")
COUNTS = ["gaps", *FAULTS, "illegal", "cost"]
TURNS = "turns array<struct<role string, text string>>"
_REPAIRED = f"part int, parts int, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string, {TURNS}"
_FAULTY = f"gaps bigint, {', '.join(f'{c} bigint' for c in FAULTS)}, illegal bigint"


def _schema(rows: DataFrame, columns: str) -> tuple[str, pa.Schema]:
    """`columns` behind conv_id, for Spark and for Arrow."""
    text = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {columns}"
    return text, to_arrow_schema(rows.sparkSession.createDataFrame([], text).schema)


def _gaps(turns: set) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


def _prepared(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(dropped, F.lit(False)).alias("dropped"),
        F.coalesce(F.col("role"), blank).alias("role"),
        F.coalesce(F.col("text"), blank).alias("text"),
    ).withColumns({"_front": F.substring("text", 1, 64), "_hash": F.xxhash64("text")})


ORDER = ["turn", "role", "_front", "_hash"]


def _finished(rows: list[dict], symbols: bytes, start: int, end: int, last: bool) -> dict:
    """Audit and turns of consecutive rows between two states."""
    done = edits(symbols, start, end)
    turns, state = repaired_turns(rows, done, start)
    if last:
        tail = ENDING[end][1]
        done.append(tail)
        turns += repaired_turns([{}], [tail + "D"], state)[0]
    return {"audit": "".join(done), "turns": turns}


def _parts_of(
    rows: DataFrame, schema: tuple[str, pa.Schema], done, full, whole: bool, part_chars: int
) -> DataFrame:
    """Sorted rows as parts, one row each, made by `done` (part, slice, chunk). A part ends where
    its conversation ends or where it is `full`."""
    names = ["conv_id", "slice", "turn", "role", "text", "dropped", "_repeated"]

    def run(batches):
        part, chunk, out, size = None, 0, [], 0
        for batch in batches:
            for key, slice_no, turn, role, text, dropped, repeated in zip(
                *[c.to_pylist() for c in batch.columns]
            ):
                if part is None or part.key != key or full(part):
                    if part is not None:
                        out.append({"conv_id": part.key} | done(part, part.slice_no, chunk))
                        size += part.chars
                        chunk += 1
                        if size > part_chars or len(out) >= 1_000:
                            yield pa.RecordBatch.from_pylist(out, schema=schema[1])
                            out, size = [], 0
                    part = _Part(key, slice_no)
                if not dropped:
                    part.add(turn, role, text, None if whole else repeated)
        if part is not None:
            out.append({"conv_id": part.key} | done(part, part.slice_no, chunk))
        yield pa.RecordBatch.from_pylist(out, schema=schema[1])

    return rows.select(*names).mapInArrow(run, schema[0])


def _ordinary(rows: DataFrame, part_chars: int) -> DataFrame:
    """Conversations within the limits, one row each."""

    def done(part: _Part, slice_no: int, chunk: int) -> dict:
        symbols = bytes(part.symbols)
        end, cost = last_state(symbols)
        found = {"part": 0, "parts": 1, "gaps": _gaps(part.turns), "cost": cost}
        found |= part.faults | {"illegal": part.illegal}
        return found | _finished(part.rows, symbols, NOTHING, end, True)

    sorted_rows = (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", *ORDER)
        .withColumns({"slice": F.lit(0), "_repeated": F.lit(None).cast("boolean")})
    )
    return _parts_of(
        sorted_rows, _schema(rows, _REPAIRED), done, lambda part: False, True, part_chars
    )


def _meeting_states(parts: DataFrame) -> DataFrame:
    """For each part of the long conversations the states at its ends, and its cost.

    A part gives 16 costs and ranks. One task walks along those of a conversation, back to
    front for the costs to go and then forward: 32 numbers a part, and no text.
    """
    place = "slice int, chunk int"
    summed, summed_arrow = _schema(
        parts, f"{place}, first string, last string, costs array<bigint>, ranks array<int>"
    )
    walked, walked_arrow = _schema(
        parts, f"{place}, part int, parts int, start int, end int, cost bigint, joint bigint"
    )

    def between(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                symbols = row.pop("symbols")
                found = [forward(symbols, s) for s in STATES]
                row["costs"] = [c for costs, _ in found for c in costs]
                row["ranks"] = [r for _, ranks in found for r in ranks]
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=summed_arrow)

    def walk(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["slice"], r["chunk"]))
        ahead = [[c for c, _ in ENDING]]
        for row in reversed(rows):
            at = [row["costs"][4 * s : 4 * s + 4] for s in STATES]
            ahead.append([min(FAR, *(at[s][e] + ahead[-1][e] for e in STATES)) for s in STATES])
        ahead.reverse()
        state, out = NOTHING, []
        for i, row in enumerate(rows):
            costs = row["costs"][4 * state : 4 * state + 4]
            end = crossing(costs, row["ranks"][4 * state : 4 * state + 4], ahead[i + 1])
            last = i == len(rows) - 1
            out.append(
                {k: row[k] for k in ("conv_id", "slice", "chunk")}
                | {"part": i, "parts": len(rows), "start": state, "end": end}
                | {"cost": costs[end] + (ENDING[end][0] if last else 0)}
                | {"joint": int(i > 0 and rows[i - 1]["last"] + row["first"] not in LEGAL)}
            )
            state = end
        return pa.Table.from_pylist(out, schema=walked_arrow)

    return (
        parts.select("conv_id", "slice", "chunk", "first", "last", "symbols")
        .mapInArrow(between, summed)
        .groupBy("conv_id")
        .applyInArrow(walk, walked)
    )


def _repeats(rows: DataFrame) -> DataFrame:
    """Marks the rows whose role and text an earlier row of the conversation has."""
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("timed"), "turn", "_id")
    firsts = rows.groupBy(F.col("conv_id").alias("_conv"), said.alias("_said")).agg(
        F.min(place)["_id"].alias("_first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (said == F.col("_said"))
    return rows.join(firsts, same).select(
        *rows.columns, (F.col("_id") != F.col("_first")).alias("_repeated")
    )


def _large(rows: DataFrame, n: int, part_rows: int, part_chars: int) -> DataFrame:
    """Parts of the conversations beyond the limits, repaired, as a written table."""
    kept = written(
        rows.filter(~F.col("dropped")).withColumn("_id", F.monotonically_increasing_id()),
        "long-conversations",
    )
    slices = min(math.ceil(n / part_rows) + 1, MAX_SLICES)
    order = ["conv_id", *ORDER, "_id"]
    sliced = _repeats(kept).repartitionByRange(slices, *order).sortWithinPartitions(*order)
    kind = f"slice int, chunk int, {_FAULTY}, first string, last string, symbols binary, {TURNS}"

    def packed(part: _Part, slice_no: int, chunk: int) -> dict:
        found = {"slice": slice_no, "chunk": chunk, "gaps": 0, "illegal": part.illegal}
        found |= part.faults | {"first": part.first, "last": part.last}
        return found | {"symbols": bytes(part.symbols), "turns": part.rows}

    def full(part: _Part) -> bool:
        return len(part.rows) >= part_rows or part.chars >= part_chars

    parts = written(
        _parts_of(
            sliced.withColumn("slice", F.spark_partition_id()),
            _schema(kept, kind),
            packed,
            full,
            False,
            part_chars,
        ),
        "conversation-parts",
    )
    # Gaps need the turns of all parts; they stand with the first one.
    turn = F.col("turn")
    gaps = kept.groupBy("conv_id", turn).agg(F.count(F.lit(1)).alias("_n")).groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps")
    )
    states = _meeting_states(parts)
    at_first = states["conv_id"].eqNullSafe(gaps["conv_id"]) & (states["part"] == 0)
    states = states.join(gaps, at_first, "left").select(
        *[states[c] for c in states.columns], F.coalesce(gaps["gaps"], F.lit(0)).alias("gaps")
    )
    schema = _schema(kept, _REPAIRED)

    def finish(part: pa.Table, state: pa.Table) -> pa.Table:
        [row], [at] = part.to_pylist(), state.to_pylist()
        found = {k: at[k] for k in ("conv_id", "part", "parts", "gaps", "cost")}
        found |= {k: row[k] for k in FAULTS} | {"illegal": row["illegal"] + at["joint"]}
        last = at["part"] == at["parts"] - 1
        found |= _finished(row["turns"], row["symbols"], at["start"], at["end"], last)
        return pa.Table.from_pylist([found], schema=schema[1])

    place = ["conv_id", "slice", "chunk"]
    done = parts.groupBy(*place).cogroup(written(states, "conversation-states").groupBy(*place))
    return written(done.applyInArrow(finish, schema[0]), "long-repaired")


def _repaired(
    rows: DataFrame, part_rows: int, part_chars: int
) -> tuple[DataFrame, DataFrame | None]:
    """Conversations within the limits, and the parts of the others if there are any."""
    small_batches(rows.sparkSession)
    rows = _prepared(rows)
    there = ~F.col("dropped")
    sizes = rows.groupBy("conv_id").agg(
        F.count_if(there).alias("_rows"),
        F.sum(F.when(there, F.length("text")).otherwise(0)).alias("_chars"),
    )
    beyond = (F.col("_rows") > part_rows) | (F.col("_chars") > part_chars)
    long = written(sizes.filter(beyond), "long")
    n, total, chars = long.agg(F.count(F.lit(1)), F.sum("_rows"), F.sum("_chars")).first()
    if not n:
        return _ordinary(rows, part_chars), None
    same = same_keys(rows, long, ["conv_id"])
    total = max(total, math.ceil(chars / part_chars) * part_rows)
    return (
        _ordinary(rows.join(long, same, "left_anti"), part_chars),
        _large(rows.join(long, same, "left_semi"), total, part_rows, part_chars),
    )


def repair(
    rows: DataFrame, part_rows: int = PART_ROWS, part_chars: int = PART_CHARS
) -> DataFrame:
    """Conversations repaired: conv_id, part, parts, gaps, blank, duplicate, truncated, illegal,
    cost, audit, turns (an array of role and text).

    `rows` have conv_id, turn, role, text and may mark rows as `dropped`: they count for
    nothing but the existence of their conversation. A conversation within the limits is one
    row; a longer one has several, whose numbers add up and whose audits and turns follow
    each other by `part`.
    """
    ordinary, large = _repaired(rows, part_rows, part_chars)
    return ordinary if large is None else ordinary.unionByName(large)


def report(
    rows: DataFrame, part_rows: int = PART_ROWS, part_chars: int = PART_CHARS
) -> DataFrame:
    """One row per conversation: conv_id, its counts, cost, audit, and the SHA-256 of its
    repaired lines `role:text` (repaired_sha256)."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    text = F.array_join(lines, "\n")
    ordinary, large = _repaired(rows, part_rows, part_chars)
    one = ordinary.select(
        "conv_id", *COUNTS, "audit", F.sha2(text, 256).alias("repaired_sha256")
    )
    if large is None:
        return one
    audits = F.array_sort(F.collect_list(F.struct("part", "audit")))
    sums = large.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.array_join(F.transform(audits, lambda a: a["audit"]), "").alias("audit"),
    )
    digests = _streamed_digest(
        large.select("conv_id", "part", F.when(F.size("turns") > 0, text).alias("lines"))
    ).withColumnRenamed("conv_id", "_conv")
    many = sums.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return one.unionByName(many)


def _streamed_digest(parts: DataFrame) -> DataFrame:
    """SHA-256 of long conversations, part by part. A digest reads its text in order, so that of
    one conversation is one task's work, but the task holds a few parts at a time."""
    schema, arrow = _schema(parts, "repaired_sha256 string")

    def run(batches):
        key, hashed, empty = None, None, True

        def made():
            row = {"conv_id": key, "repaired_sha256": hashed.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for conv, part, lines in zip(*batch.columns):
                if part.as_py() == 0:
                    if hashed is not None:
                        yield made()
                    key, hashed, empty = conv.as_py(), hashlib.sha256(), True
                if lines.is_valid:
                    hashed.update((b"" if empty else b"\n") + lines.as_py().encode())
                    empty = False
        if hashed is not None:
            yield made()

    return (
        parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with known faults, by crc32 of `conv_id:turn` modulo 20: 0 drops a row
    (`dropped`), 1 empties its text, 2 takes its stops away, 3 repeats it, 4 makes it the
    user's. NULLs count as one blank."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (
        F.when(F.col("_kind") == 1, F.lit(""))
        .when(F.col("_kind") == 2, F.regexp_replace(plain("text"), "[.!?]", ""))
        .otherwise(plain("text"))
    )
    return (
        rows.select("conv_id", "turn", "role", "text", kind.alias("_kind"))
        .withColumn("_time", F.explode(times))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, F.lit("user")).otherwise(plain("role")).alias("role"),
            text.alias("text"),
            (F.col("_kind") == 0).alias("dropped"),
        )
    )
