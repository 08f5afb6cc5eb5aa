"""Cheapest repair of conversations by lightest derivations.

A repaired conversation has the role initials ``(s?(ua)+)?``. An item ``(i, state)``
stands for the best edits of the rows from ``i`` on, begun in a state of the automaton
of that pattern. Its deductions put one edit in front of a finished item: keep, give
another role, delete or insert. An agenda pops items in the order of their weight
(cost, rows used, audit) and the first pop of an item is final (Knuth's generalisation
of shortest paths). The weights need that number of rows: keeping costs nothing, and
an audit with a letter put in front may come before the audit without it, so cost and
audit alone would not be superior. With the rows between them every deduction makes
its conclusion heavier, and putting the same letter in front of two audits keeps their
order. Audits are never built while searching: within one cost and number of rows an
audit compares as its first letter and the rank at which the rest was popped.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..shipping import ship_package
from ..sources.staged import shared_folder, stage
from .words import SPACE_CHARS, SPACES

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# States: before anything, after s, after u, after a. The pattern may end in ACCEPT.
MOVES = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
ACCEPT = (0, 3)
STATES = 4
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
# What precedes a state under an initial.
_BEFORE = {
    (r, q): [p for p in range(STATES) if MOVES.get((r, p)) == q]
    for r in "sua" for q in range(STATES)
}
SOUND, BLANK, TRUNC, DUPLICATE = 0, 1, 2, 3

PLAN = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string"
)
PLAN_COLUMNS = [c.split()[0] for c in PLAN.split(", ")]


def lightest(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Least cost of a repair and the ASCII-least audit of that cost.

    ``initials`` are first characters of the roles ('' fits everywhere), ``faults``
    one of the codes above per row.
    """
    n = len(initials)
    letter = [bytearray(n + 1) for _ in range(STATES)]
    then = [bytearray(n + 1) for _ in range(STATES)]
    ranks = [array("q", [-1]) * (n + 1) for _ in range(STATES)]
    agenda = [(0, 0, "", 0, q, q) for q in ACCEPT]
    heapq.heapify(agenda)
    push, rank, last = partial(heapq.heappush, agenda), 0, None
    while True:
        cost, used, edit, below, state, next_state = heapq.heappop(agenda)
        i = n - used
        if ranks[state][i] >= 0:
            continue
        if (cost, used, edit, below) != last:
            rank, last = rank + 1, (cost, used, edit, below)
        ranks[state][i] = rank
        letter[state][i] = ord(edit) if edit else 0
        then[state][i] = next_state
        if i == 0 and state == 0:
            break
        for r in "ua":
            for p in _BEFORE[r, state]:
                if ranks[p][i] < 0:
                    push((cost + INSERT, used, "I", rank, p, state))
        if not i:
            continue
        fault, initial, one = faults[i - 1], initials[i - 1], used + 1
        push((cost + DELETE, one, "D", rank, state, state))
        if fault in (BLANK, DUPLICATE):
            continue
        more = cost + (TRUNCATED if fault == TRUNC else 0)
        for p in (state,) if not initial else _BEFORE.get((initial, state), ()):
            push((more + KEEP, one, "K", rank, p, state))
        for r in "ua":
            for p in _BEFORE[r, state]:
                push((more + REROLE, one, "R", rank, p, state))
    audit, i, state = bytearray(), 0, 0
    while letter[state][i]:
        edit, state_after = letter[state][i], then[state][i]
        audit.append(edit)
        i += edit != ord("I")
        state = state_after
    return cost, audit.decode()


def apply_audit(audit: str) -> Iterator[list[str]]:
    """For every row and once for the end: the edits up to and with that row's own."""
    part: list[str] = []
    for edit in audit:
        part.append(edit)
        if edit != "I":
            yield part
            part = []
    yield part


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with planted faults, and which of the rows are left.

    The fault depends on crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user. NULLs count
    as one space. Dropped rows stay in the frame, as they name a conversation.
    """
    space = F.lit(" ")
    name = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    code = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    found = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), code.alias("code"),
        F.when(code == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
    )
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return found.withColumn("copy", F.explode(copies)).drop("copy"), F.col("code") != 0


def _rows(rows: DataFrame, left: Column) -> DataFrame:
    """Rows with what their order and their faults depend on."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    end = F.substring(F.rtrim(text, F.lit(SPACE_CHARS)), -1, 1)
    blank = ~text.rlike(f"[^{SPACES}]")
    return rows.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        text.alias("text"), F.coalesce(left, F.lit(False)).alias("left"),
        F.when(blank, BLANK).when(~end.isin(".", "!", "?"), TRUNC).otherwise(SOUND)
        .alias("fault"),
        F.xxhash64(role, text).alias("hash"), F.xxhash64(text, F.lit(1), role).alias("hash2"),
    )


ORDER = ["turn", "role", "hash", "hash2"]


def _plan(turns, initials, faults) -> tuple:
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = zip(initials, initials[1:])
    cost, audit = lightest(initials, faults)
    return (
        gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNC),
        sum(x + y not in LEGAL for x, y in pairs), cost, audit,
    )


def _plans(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Plans from rows in order; a conversation may go over many batches."""
    done: list[tuple] = []
    none = object()
    conv, turns, initials, faults, seen = none, [], [], [], set()

    def close() -> None:
        if conv is not none:
            done.append((conv, *_plan(turns, initials, faults)))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "left", "fault", "hash", "hash2")]
        for c, turn, initial, left, fault, *mark in zip(*columns):
            if conv is none or c != conv:
                close()
                conv, turns, initials, faults, seen = c, [], [], [], set()
            if not left:
                continue
            turns.append(turn)
            initials.append(initial)
            mark = tuple(mark)
            faults.append(DUPLICATE if fault != BLANK and mark in seen else fault)
            seen.add(mark)
        if len(done) > 10_000:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema
            )
            done.clear()
    close()
    if done:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema
        )


def plan_repairs(rows: DataFrame, left: Column | None = None) -> DataFrame:
    """Faults of every conversation and its cheapest repair, one row each.

    Takes ``conv_id``, ``turn``, ``role`` and ``text``. Rows for which ``left`` is not
    true only name their conversation; one without other rows has zeros and an empty
    audit. Result: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` and ``audit`` (initials of Keep, Rerole, Delete, Insert).

    * NULL roles and texts are one space, so such a text is blank and such a role is
      never kept; NULL turns come first and count for no gap; NULL ``conv_id`` is a
      conversation of its own.
    * Rows of one turn are ordered by role and hash of role and text; repeated rows
      are duplicates. An empty role has no initial and may be kept anywhere.
    * A conversation is read in order by one task, as its repair depends on all its
      rows; of each a turn, an initial, a fault and two hashes are held, some hundred
      bytes, and never its text, however long. An empty table gives none.
    * Columns of other names are not looked at.
    """
    ship_package(rows.sparkSession)
    compact = _rows(rows, F.lit(True) if left is None else left).withColumn(
        "role_order", F.col("role")
    ).select(
        "conv_id", "turn", "role_order", F.substring("role", 1, 1).alias("role"), "left",
        "fault", "hash", "hash2",
    )
    ordered = compact.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role_order", "hash", "hash2"
    )
    schema = _schema(rows, PLAN)
    return ordered.drop("role_order").mapInArrow(
        partial(_plans, schema=to_arrow_schema(schema)), schema
    )


def _schema(rows: DataFrame, others: str) -> T.StructType:
    kind = rows.schema["conv_id"].dataType
    return T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(others)])


def _repaired(
    batches: Iterator[pa.RecordBatch], schema: pa.Schema, digest: bool
) -> Iterator[pa.RecordBatch]:
    """Repaired rows, or a digest of them; a plan comes before its rows."""
    out: list[tuple] = []
    plan: tuple | None = None
    edits: Iterator[list[str]] = iter(())
    state, place, sha, first = 0, 0, hashlib.sha256(), True

    def put(role: str, text: str, edit: str) -> None:
        nonlocal place, first
        if digest:
            sha.update((("" if first else "\n") + f"{role}:{text}").encode())
        else:
            out.append((plan[0], place, edit, role, text))
        place, first = place + 1, False

    def step(part: list[str], role: str, text: str) -> None:
        nonlocal state
        for edit in part:
            if edit == "K":
                put(role, text, edit)
                state = MOVES.get((role[:1], state), state)
            elif edit != "D":
                initial = "a" if state == 2 else "u"
                put(ROLES[initial], "" if edit == "I" else text, edit)
                state = MOVES[initial, state]

    def close() -> None:
        if plan is not None:
            step(next(edits), "", "")
            if digest:
                out.append((*plan, sha.hexdigest()))

    names = ["conv_id", "is_row", "role", "text", *PLAN_COLUMNS]
    for batch in batches:
        for conv, is_row, role, text, *found in zip(*[batch.column(c).to_pylist() for c in names]):
            if is_row:
                step(next(edits), role, text)
            else:
                close()
                plan, edits = (conv, *found), apply_audit(found[-1])
                state, place, sha, first = 0, 0, hashlib.sha256(), True
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema
            )
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema
        )


def _streamed(
    rows: DataFrame, plans: DataFrame, left: Column | None, digest: bool, schema: str
) -> DataFrame:
    texts = _rows(rows, F.lit(True) if left is None else left).filter("left").select(
        "conv_id", F.lit(True).alias("is_row"), "turn", "role", "hash", "hash2", "text"
    )
    heads = plans.select("conv_id", F.lit(False).alias("is_row"), *PLAN_COLUMNS)
    both = heads.unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *ORDER)
    result = _schema(rows, schema)
    return ordered.mapInArrow(
        partial(_repaired, schema=to_arrow_schema(result), digest=digest), result
    )


def repaired_rows(rows: DataFrame, plans: DataFrame, left: Column | None = None) -> DataFrame:
    """Rows of the repaired conversations: ``conv_id``, ``place``, ``edit``, ``role``, ``text``.

    ``plans`` come from :func:`plan_repairs` for the same rows. Rows are read in order
    beside the plan, so no conversation is held as a whole.
    """
    return _streamed(rows, plans, left, False, "place long, edit string, role string, text string")


def repair_digests(rows: DataFrame, plans: DataFrame, left: Column | None = None) -> DataFrame:
    """The plans with ``repaired_sha256`` of the repaired ``role:text`` lines."""
    return _streamed(rows, plans, left, True, f"{PLAN}, repaired_sha256 string")


def repair_conversations(rows: DataFrame, left: Column | None = None) -> DataFrame:
    """Plan of every conversation and the digest of what the plan makes of it."""
    folder = shared_folder(rows.sparkSession, "repair")
    plans = stage(plan_repairs(rows, left), f"{folder}/plans")
    return repair_digests(rows, plans, left)
