import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from recurra.llm import conversations as c
from recurra.llm.common import read
from recurra.llm.lightest import lightest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile("(s?(ua)+)?")


def damaged(rows):
    """The damage by its definition; rows of (conv, turn, role, text)."""
    out, convs = [], {r[0] for r in rows}
    for conv, turn, role, text in rows:
        named = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(named).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out, convs


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def exhaustive(rows, faults):
    """Cheapest edits: every way to insert (up to two turns anywhere) and to edit each row."""
    best = None
    options = []
    for (_, _, role, text), fault in zip(rows, faults):
        extra = int(fault == "truncated")
        ways = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            ways.append((extra, "K", (role, text)))
            ways += [(2 + extra, "R", (new, text)) for new in ("user", "assistant")]
        options.append(ways)
    gaps = [()] + [(r,) for r in ("user", "assistant")] + [("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*options):
        for places in itertools.product(gaps, repeat=len(rows) + 1):
            turns, audit, cost = [], "", 0
            for i, place in enumerate(places):
                for role in place:
                    turns.append((role, ""))
                    audit, cost = audit + "I", cost + 2
                if i < len(edits):
                    cost, audit = cost + edits[i][0], audit + edits[i][1]
                    turns += [edits[i][2]] if edits[i][2] else []
            if best and (cost, audit) >= best[:2]:
                continue
            if all(r for r, _ in turns) and GOOD.fullmatch("".join(r[0] for r, _ in turns)):
                best = (cost, audit, turns)
    return best


def by_states(rows, faults):
    """Cheapest edits by a table over rows and last initials, for longer conversations."""
    now = {"": (0, "", [])}

    def inserted(now):
        for _ in range(3):
            for state, (cost, audit, turns) in list(now.items()):
                for role in ("user", "assistant"):
                    if role[0] in ("a" if state == "u" else "u"):
                        new = (cost + 2, audit + "I", turns + [(role, "")])
                        if role[0] not in now or new[:2] < now[role[0]][:2]:
                            now[role[0]] = new
        return now

    def fits(state, initial):
        return initial and state + initial in ("s", "u", "su", "ua", "au")

    for (_, _, role, text), fault in zip(rows, faults):
        now, later = inserted(now), {}
        for state, (cost, audit, turns) in now.items():
            extra = int(fault == "truncated")
            ways = [(state, cost + 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                if fits(state, role[:1]):
                    ways.append((role[0], cost + extra, "K", [(role, text)]))
                for new in ("user", "assistant"):
                    if fits(state, new[0]):
                        ways.append((new[0], cost + 2 + extra, "R", [(new, text)]))
            for to, total, letter, more in ways:
                made = (total, audit + letter, turns + more)
                if to not in later or made[:2] < later[to][:2]:
                    later[to] = made
        now = later
    return min((v for s, v in inserted(now).items() if s in ("", "a")), key=lambda v: v[:2])


def plain(rows, convs, solve=by_states):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = []
    for conv in convs:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = faults_of(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit, left = solve(own, faults)
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out.append((
            conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    (1, 1, "system", "Be kind."), (1, 2, "user", "Hello?"), (1, 4, "assistant", "Yes."),
    (1, 4, "assistant", "Yes."), (2, None, "assistant", "first"), (2, 1, "", "No role."),
    (2, None, None, None), (2, 2, "tool", "Result!"), (None, 1, "user", "Alone."),
    (None, None, "assistant", "\t\n"), (3, 1, "user", ""), (4, 9, "user", "é 日本。"),
    (4, 9, "assistant", "Tie one."), (4, 9, "assistant", "Tie two."), (5, 1, "user", "long. " * 20000),
    (6, 1, "user", "A."), (6, 1, "user", "A."), (6, 3, "system", "Late."),
]


def long_ones():
    roles = ["user", "assistant", "assistant", "system", "user", "tool"]
    rows = [(7, i if i % 11 else None, roles[i * i % 6], f"text {i % 40}{'.' if i % 5 else ''}")
            for i in range(300)]
    rows += [(8, 0, "user", "same.")] * 60
    return rows + [(9, i, "user" if i % 2 else "assistant", f"{i}!") for i in range(150)]


def test_damage_is_the_stated_one(spark):
    rows = ODD + [(i, j, "assistant", "a. b!") for i in range(20, 40) for j in range(8)]
    made = c.damage(spark.createDataFrame(rows, SCHEMA)).collect()
    kept = [tuple(r)[:4] for r in made for _ in range(r.copies)]
    assert sorted(kept, key=repr) == sorted(damaged(rows)[0], key=repr)


@pytest.mark.parametrize("segment", [c.SEGMENT_ROWS, 50])
def test_summaries_of_odd_rows(spark, segment):
    rows = ODD + long_ones()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", cost string")
    undamaged = [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows]
    made = c.repair_summaries(df, segment_rows=segment)
    assert found(made) == plain(undamaged, {r[0] for r in rows})
    assert found(c.repair_summaries(c.damage(df), segment_rows=segment)) == plain(*damaged(rows))
    assert c.repair_summaries(df.limit(0)).collect() == []


def test_summaries_of_the_small_conversations(spark):
    df = read(spark, SMALL, "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(c.repair_summaries(c.damage(df))) == plain(*damaged(rows))


@pytest.mark.parametrize("segment", [c.SEGMENT_ROWS, 50])
def test_repaired_turns(spark, segment):
    df = spark.createDataFrame(ODD + long_ones(), SCHEMA)
    turns = defaultdict(list)
    for r in sorted(c.repair(df, segment_rows=segment).collect(),
                    key=lambda r: (r.conv_id or 0, r.segment, r.turn)):
        turns[r.conv_id].append(r)
    for conv, *_, audit, sha in found(c.repair_summaries(df)):
        lines = "\n".join(f"{r.role}:{r.text}" for r in turns[conv])
        assert hashlib.sha256(lines.encode()).hexdigest() == sha
        assert "".join(r.edit for r in turns[conv]) == audit.replace("D", "")
        assert GOOD.fullmatch("".join(r.role[0] for r in turns[conv]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "tool", ""]),
    st.sampled_from(["Yes.", "No", "", "Why?"]),
), max_size=3))
def test_agenda_against_all_edits(turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    unit = c.Turns()
    for _, turn, role, text in rows:
        unit.add(turn, role, text, 1, None)
    cost, audit = c._lightest_whole(unit)
    best = exhaustive(rows, faults_of(rows))
    assert (cost, audit) == best[:2] == by_states(rows, faults_of(rows))[:2]
    assert [(r, t) for _, r, t in unit.repaired(audit, c.NOTHING)] == best[2]


def test_lightest_takes_ties_by_the_audit():
    steps = [[(0, 1, 1, "b"), (0, 2, 1, "a")], [(1, 3, 0, "x"), (2, 3, 0, "y")]]
    assert lightest(steps) == {3: (1, "ay")}
    assert lightest(steps, goal=(4,)) == {}
    assert lightest([]) == {0: (0, "")}
