"""Repair of conversations by iterative-deepening A*.

A conversation must read as `(s?(ua)+)?` in the initials of its roles. Each row is kept (0), given
the role user or assistant (1) or deleted (2; blank and repeated rows must be); rows with the role
that is missing are inserted anywhere (5, empty text); a row without an end of sentence costs 5
unless it is deleted. The cheapest edits are searched depth first in ASCII order of their initials
(Delete, Insert, Keep, Rerole) under a bound that rises to the least estimate beyond it. A state is a
place and what was said last; a table remembers for each state the largest rest of the bound
that failed. The first path that is accepted is the cheapest and of these the least in ASCII order.

Long conversations are searched in segments of SEGMENT rows, for each state in front of and behind
one. Inserts belong to the row after them, so no path of a segment is the beginning of another, and
the least path of the whole consists of the least ones between its states. So the time grows with the rows. Rows
pass in order through tasks that keep a byte for each row of one conversation, never its texts.

Defined cases: a null role or text is one space, so its row is blank or has no usable role; an
empty role has none either. Null conv_ids are one conversation. Rows stand in the order of turn (nulls
first), then role, then text. Conversations without rows left keep a report. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that are searched at once.
SEGMENT = 16
KEEP, REROLE, DELETE, INSERT, UNENDED = 0, 1, 2, 5, 5

_BLANKS = " \t\n\x0b\x0c\r"
#: Faults, the rest of a row's code is its role: system, user, assistant, other.
_SOUND, _CUT, _BLANK, _REPEAT, _GONE = range(5)
#: What was said last: nothing, system, user, assistant. Who may speak next is fixed but for the start.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_AFTER = {(_NONE, 0): _SYSTEM, (_NONE, 1): _USER, (_SYSTEM, 1): _USER, (_USER, 2): _ASSISTANT, (_ASSISTANT, 1): _USER}
_END = 4

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_FOUND = f"conv_id long, place long, edit string, role string, text string, {REPORT}"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) after faults that a hash of conv_id and turn chooses."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    named = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1)))
    return named.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("h") == 0).alias("gone"), times.alias("_")).drop("_")


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations, in order within each partition: a report, then the rows that stay.

    Takes (conv_id, turn, role, text) and perhaps a boolean gone: such a row does not count, but its
    conversation is reported. Gives (conv_id, place, edit, role, text, and REPORT): the report has no place, edit,
    role and text, the rows have no report. Inserted rows have the edit I.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    space = F.lit(" ")
    known = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), gone.alias("gone"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    known = known.withColumn("same", F.when(~F.col("gone"), same))
    earlier = F.row_number().over(Window.partitionBy("conv_id", "same").orderBy(F.col("turn").asc_nulls_first())) > 1
    ended = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = (
        F.when(F.col("gone"), _GONE).when(ended == "", _BLANK).when(earlier, _REPEAT)
        .when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), _CUT).otherwise(_SOUND)
    )
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    coded = known.withColumn("code", (role * 8 + fault).cast("int")).drop("same", "gone")
    ordered = coded.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "code")
    placed = ordered.mapInArrow(_with_reports, f"{_FOUND}, code int")
    return placed.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place").mapInArrow(_applied, _FOUND)


def digest(found: DataFrame) -> DataFrame:
    """A report for each conversation with the hash of its repaired rows."""
    return found.mapInArrow(_hashed, f"conv_id long, {REPORT}, repaired_sha256 string")


# The search.


@lru_cache(1 << 16)
def _least(codes: bytes) -> tuple[int, ...]:
    """For each place, what the rows from there on cost at least.

    A faulty row costs a deletion. Two sound rows that come to stand side by side, but may not, cost one
    edit of them, a row between them or an undeleted faulty one; pairs that share no row add up.
    """
    faulty, alone = 0, [0, 0]  # alone: edits from the sound row found last on, and from the one behind it
    out, role = [0], -1
    for code in reversed(codes):
        own = code >> 3
        if code & 7 != _SOUND:
            faulty += min(DELETE, UNENDED)
        elif own == 3:
            alone, role = [alone[0] + 1, alone[0]], -1
        else:
            pair = role >= 0 and (own, role) not in ((0, 1), (1, 2), (2, 1))
            alone, role = [max(alone[0], alone[1] + pair), alone[0]], own
        out.append(faulty + alone[0])
    return tuple(reversed(out))


def search(codes: bytes, entry: int, goal: int) -> tuple[int, str] | None:
    """Cost and edits of the cheapest way from a state to a goal (_END: any that may end, with inserts)."""
    least, n, ends = _least(codes), len(codes), goal == _END
    if goal == _NONE or (goal == _SYSTEM and entry == _SYSTEM):
        return (DELETE * n, "D" * n) if entry == goal else None
    if goal == _SYSTEM and (entry != _NONE or not any(code in (_SOUND, _CUT) for code in codes)):
        return None
    failed: dict[tuple[int, int], int] = {}
    most = (n + 2) * (REROLE + UNENDED + 2 * INSERT)
    bound = least[0]
    while bound <= most:
        # Each level: place, state, rest of the bound, and the edit to try next.
        path, stack = [], [[0, entry, bound, 0]]
        while stack:
            top = stack[-1]
            at, state, rest, edit = top
            if edit == 0:
                done = at == n and (state in (_NONE, _ASSISTANT) if ends else state == goal)
                if done:
                    return bound, "".join(path)
                if failed.get((at, state), -1) >= rest:
                    edit = 4
            top[3] = edit + 1
            step = None
            if edit == 0 and at < n:
                step = "D", at + 1, state, DELETE
            elif edit == 1 and (at < n or ends):
                step = "I", at, _NEXT[state], INSERT
            elif edit == 2 and at < n and (after := _AFTER.get((state, codes[at] >> 3))) and codes[at] & 7 in (_SOUND, _CUT):
                step = "K", at + 1, after, KEEP + UNENDED * (codes[at] & 7 == _CUT)
            elif edit == 3 and at < n and codes[at] & 7 in (_SOUND, _CUT):
                step = "R", at + 1, _NEXT[state], REROLE + UNENDED * (codes[at] & 7 == _CUT)
            elif edit >= 4:
                failed[at, state] = max(rest, failed.get((at, state), -1))
                stack.pop()
                if path:
                    path.pop()
                continue
            if step:
                name, place, after, cost = step
                if cost + least[place] <= rest:
                    path.append(name)
                    stack.append([place, after, rest - cost, 0])
        bound += 1  # a state that had failed before may hide the least estimate beyond the bound
    return None


_known = lru_cache(1 << 14)(search)


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and edits of a conversation, given its rows' codes."""
    if len(codes) <= SEGMENT:
        return _known(codes, _NONE, _END)
    parts = [codes[at : at + SEGMENT] for at in range(0, len(codes), SEGMENT)]
    # From the back: what it costs from each state in front of a part to the end.
    rest = [np.full(4, 1 << 62, np.int64) for _ in parts]
    rest[-1][:] = [_known(parts[-1], state, _END)[0] for state in range(4)]
    for k in range(len(parts) - 2, -1, -1):
        for state in range(4):
            ways = [way[0] + int(rest[k + 1][to]) for to in range(4) if (way := _known(parts[k], state, to))]
            rest[k][state] = min(ways)
    state, edits = _NONE, []
    for k, part in enumerate(parts[:-1]):
        ways = [(way[1], to) for to in range(4) if (way := _known(part, state, to)) and way[0] + rest[k + 1][to] == rest[k][state]]
        text, state = min(ways)
        edits.append(text)
    edits.append(_known(parts[-1], state, _END)[1])
    return int(rest[0][_NONE]), "".join(edits)


# Rows of conversations, streamed in order.


class _Conversation:
    """What is kept of the rows of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.turns, self.first, self.last = conv_id, bytearray(), 0, None, None

    def add(self, turn, code: int) -> int:
        """The place of a row."""
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.codes.append(code)
        return len(self.codes) - 1

    def report(self) -> dict:
        data = np.frombuffer(bytes(self.codes), np.uint8)
        faults, roles = data & 7, data >> 3
        pairs = roles[:-1] * 4 + roles[1:]
        cost, audit = cheapest(bytes(self.codes))
        return {
            "conv_id": self.conv_id, "place": -1, "gaps": self.last - self.first + 1 - self.turns if self.turns else 0,
            "blank": int((faults == _BLANK).sum()), "duplicate": int((faults == _REPEAT).sum()), "truncated": int((faults == _CUT).sum()),
            "illegal": int((~np.isin(pairs, (1, 6, 9))).sum()), "cost": cost, "audit": audit,
        }


_FOUND_TYPES = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
_CODED_TYPES = _FOUND_TYPES.append(pa.field("code", pa.int32()))


def _batch(rows: list[dict], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, types)


def _with_reports(batches):
    """The rows with their places, and each conversation's report, which can only follow them."""
    current = None
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            out = []
            for row in whole.slice(at, 1024).to_pylist():
                if current is None or row["conv_id"] != current.conv_id:
                    if current is not None:
                        out.append(current.report())
                    current = _Conversation(row["conv_id"])
                if row["code"] & 7 != _GONE:
                    row["place"] = current.add(row["turn"], row["code"])
                    out.append(row)
            yield _batch(out, _CODED_TYPES)
    if current is not None:
        yield _batch([current.report()], _CODED_TYPES)


def _applied(batches):
    """Reports without a place, each followed by the rows that its edits leave."""
    audit, at, state, conv_id, place = "", 0, _NONE, None, 0

    def said(edit, role, text):
        nonlocal place
        place += 1
        return {"conv_id": conv_id, "place": place - 1, "edit": edit, "role": role, "text": text}

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _NEXT[state]
            yield said("I", _NAMES[state], "")

    for whole in batches:
        for begin in range(0, whole.num_rows, 1024):
            out = []
            for row in whole.slice(begin, 1024).to_pylist():
                if row["place"] < 0:
                    out += inserts()
                    audit, at, state, conv_id, place = row["audit"], 0, _NONE, row["conv_id"], 0
                    out.append({**row, "place": None})
                    continue
                out += inserts()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = _AFTER[state, row["code"] >> 3]
                    out.append(said("K", row["role"], row["text"]))
                elif edit == "R":
                    state = _NEXT[state]
                    out.append(said("R", _NAMES[state], row["text"]))
            yield _batch(out, _FOUND_TYPES)
    yield _batch(list(inserts()), _FOUND_TYPES)


_REPORT_TYPES = pa.schema([_FOUND_TYPES.field("conv_id"), *list(_FOUND_TYPES)[5:], pa.field("repaired_sha256", pa.string())])


def _hashed(batches):
    report, hashed = None, None
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            out = []
            for row in whole.slice(at, 1024).to_pylist():
                if row["place"] is None:
                    if report:
                        out.append({**report, "repaired_sha256": hashed.hexdigest()})
                    report, hashed = row, hashlib.sha256()
                    continue
                if row["place"]:
                    hashed.update(b"\n")
                hashed.update(f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass"))
            yield _batch(out, _REPORT_TYPES)
    if report:
        yield _batch([{**report, "repaired_sha256": hashed.hexdigest()}], _REPORT_TYPES)
