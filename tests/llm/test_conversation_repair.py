"""Repairs against every sequence of edits, and the query against a plain reading."""

import hashlib
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tamiz.llm.conversation_repair import (
    BLANK, DUPLICATE, SOUND, TRUNC, damage, lightest, plan_repairs, repair_conversations,
    repaired_rows,
)

PATTERN = re.compile(r"(s?(ua)+)?")
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


def every_repair(initials, faults, bound):
    """(cost, audit, roles) of all repairs up to a cost, without a search order."""

    def go(i, cost, audit, roles):
        if cost > bound:
            return
        if i == len(initials):
            if PATTERN.fullmatch("".join(roles)):
                yield cost, audit, roles
        else:
            more = 3 if faults[i] == TRUNC else 0
            yield from go(i + 1, cost + 4, audit + "D", roles)
            if faults[i] not in (BLANK, DUPLICATE):
                yield from go(i + 1, cost + more, audit + "K", [*roles, initials[i]])
                for r in "ua":
                    yield from go(i + 1, cost + more + 3, audit + "R", [*roles, r])
        for r in "ua":
            yield from go(i, cost + 3, audit + "I", [*roles, r])

    return go(0, 0, "", [])


def brute(initials, faults):
    return min((c, a, r) for c, a, r in every_repair(initials, faults, lightest(initials, faults)[0]))


@pytest.mark.parametrize("n", range(0, 5))
def test_lightest_equals_enumeration(n):
    kinds = [("u", SOUND), ("a", SOUND), ("s", SOUND), ("a", TRUNC), ("u", BLANK)]
    for rows in product(kinds, repeat=n) if n < 4 else list(product(kinds, repeat=n))[::7]:
        initials, faults = [k for k, _ in rows], [f for _, f in rows]
        cost, audit, _ = brute(initials, faults)
        assert lightest(initials, faults) == (cost, audit), rows


def test_odd_roles():
    for initials in (["", "u", "a"], ["u", "", "a"], [" ", "a"], ["x", "y", "s", "s"], ["s"]):
        faults = [SOUND] * len(initials)
        assert lightest(initials, faults) == brute(initials, faults)[:2]


def test_a_long_conversation_is_repaired():
    n = 20_000
    cost, audit = lightest(["u"] * n, [SOUND] * n)
    assert cost == 3 * n // 2 and len(audit.replace("I", "")) == n


def plain(rows):
    """The contract, row by row; repairs by enumeration."""
    convs = {}
    for conv, turn, role, text in rows:
        keep = convs.setdefault(conv, [])
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        code = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        keep += [(turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), []
        for _, role, text in kept:
            last = re.findall("[^\x20\x09-\x0d]", text)[-1:]
            if not last:
                faults.append(BLANK)
            elif (role, text) in seen:
                faults.append(DUPLICATE)
            else:
                faults.append(SOUND if last[0] in ".!?" else TRUNC)
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        cost, audit, roles = brute(initials, faults)
        texts, names, i = [], [], 0
        for edit in audit:
            if edit == "I":
                texts.append(""), names.append(None)
                continue
            if edit != "D":
                texts.append(kept[i][2])
                names.append(kept[i][1] if edit == "K" else None)
            i += 1
        full = {"u": "user", "a": "assistant"}
        lines = [f"{n if n is not None else full[r]}:{t}" for n, r, t in zip(names, roles, texts)]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        yield (conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNC),
               illegal, cost, audit, digest)


def test_query_equals_plain_reading(spark):
    from tamiz.llm.queries import QUERIES

    path = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{path}/conversations.parquet")
    found = {tuple(r) for r in QUERIES["op12_conversation_repair"](spark, path).collect()}
    short = {r[0] for r in source.groupBy("conv_id").count().filter("count <= 6").collect()}
    rows = [tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()]
    expected = set(plain([r for r in rows if r[0] in short]))
    assert {r for r in found if r[0] in short} == expected and len(expected) > 20
    assert {r[0] for r in found} == {r[0] for r in rows}


ODD = [
    (1, 0, None, None), (1, 1, "user", "Is it?"), (1, 2, "assistant", "No."), (1, 2, "assistant", "No."),
    (2, None, "system", "Be kind."), (2, None, "user", "Go on\n"), (2, 5, "assistant", "x" * 200_000 + "!"),
    (None, 0, "user", "Hello."), (None, 1, "assistant", ""), (None, None, None, "Eh?"),
    (3, 0, "", "Empty role."), (3, 1, "user", "Ünïcode 日本 🙂."), (4, 7, "user", "a\x00b."),
    (5, 1, "agent", "A role that begins alike!"), (6, 0, "User", "Upper case."),
]


def test_odd_rows(spark):
    rows = [(c, t, r, x, f"n{k}", k) for k, (c, t, r, x) in enumerate(ODD)]
    frame = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, audit string, left int"
    ).repartition(3)
    damaged, left = damage(frame)
    found = {tuple(r) for r in repair_conversations(damaged, left).collect()}
    assert found == set(plain(ODD))
    plans = plan_repairs(frame)
    repaired = repaired_rows(frame, plans)
    pattern = repaired.orderBy("conv_id", "place").groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "role"))),
                                 lambda r: F.substring(r["role"], 1, 1)), "").alias("p"))
    assert all(PATTERN.fullmatch(r["p"]) for r in pattern.collect())


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    damaged, left = damage(none)
    result = repair_conversations(damaged, left)
    assert result.count() == 0 and result.columns[0] == "conv_id"


def test_a_conversation_without_rows_has_zeros(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (only,) = repair_conversations(rows, F.lit(False)).collect()
    assert tuple(only) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
