import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from timewise.llm import conversation_repair as cr

from .helpers import same_as_duckdb

SPACE = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """(counts, cost, audit, digest) of one conversation's (turn, role, text)
    rows, by a plain search over (cost, audit, lines) of every state."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        ink = text.strip(SPACE)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(3):
            for q, (c, t, x) in list(states.items()):
                for i, to in step[q].items():
                    if i in name:
                        new = (c + 2, t + "I", x + [name[i] + ":"])
                        states[to] = min(states.get(to, new), new)
        return states

    states = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for q, (c, t, x) in states.items():
            options = [(q, (c + 3, t + "D", x))]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                for i, to in step[q].items():
                    if role[:1] == i:
                        options.append((to, (c + more, t + "K", x + [f"{role}:{text}"])))
                    if i in name:
                        options.append((to, (c + more + 2, t + "R", x + [f"{name[i]}:{text}"])))
            for to, v in options:
                new[to] = min(new.get(to, v), v)
        states = inserted(new)
    cost, audit, lines = min(states[q] for q in ("", "a") if q in states)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h:
            row = (turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            mine += [row] * (2 if h == 3 else 1)
    return out


def frame(spark, rows):
    """Rows with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, 1, "x", True, "y") for r in rows], "conv_id long, turn long, role string, text string, pos long, key string, blank boolean, h string")


def random_rows(seed, conversations, rows):
    r = random.Random(seed)
    texts = ["Yes.", "no", "", " \t", "What?", "What? ", "go on!", "ü", "a\nb.", "漢字。"]
    out = []
    for c in range(conversations):
        for t in range(r.randint(1, rows)):
            role = r.choice(["user", "assistant"] * 5 + ["system", "tool", "", None, "User", "assist"])
            out.append((c if c else None, r.choice([t, t, t, t + 3, None]), role, r.choice(texts + [None, f"text {c} {t}.", f"text {c} {t}"])))
    return out


def same(spark, rows, **kw):
    want = {c: brute_repair(x) for c, x in brute_damage(rows).items()}
    got = cr.repair(cr.damage(frame(spark, rows)), **kw).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id
    return got


@pytest.mark.parametrize("seed,conversations,rows,segment", [(1, 60, 9, cr.SEGMENT), (2, 25, 40, 4), (3, 3, 300, 16), (4, 1, 500, 1), (5, 30, 30, cr.SEGMENT)])
def test_against_brute_force(spark, seed, conversations, rows, segment):
    same(spark, random_rows(seed, conversations, rows), segment=segment)


def test_edges(spark):
    assert same(spark, []) == []
    lost = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = same(spark, lost)
    assert len(got) == len(lost) > 5 and all(r.audit == "" and r.cost == 0 and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    same(spark, [(1, None, None, None)] * 5 + [(1, 3, "user", "long " * 20000 + ".")] * 3 + [(None, None, "assistant", "x")])
    same(spark, [(7, 5, "user", "same.")] * 200 + [(7, 6, "assistant", "same.")] * 200, segment=32)


def test_all_dropped_among_long(spark):
    """A long conversation of which every row was dropped keeps its row."""
    rows = spark.createDataFrame([(1, t, "user", "x.", True) for t in range(20)] + [(2, t, "user", f"x{t}.", t % 2 == 0) for t in range(20)],
                                 "conv_id long, turn long, role string, text string, gone boolean")
    got = {r.conv_id: r for r in cr.repair(rows, segment=4).collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert tuple(got[2])[1:] == brute_repair([(t, "user", f"x{t}.") for t in range(1, 20, 2)])


def test_repaired_turns(spark):
    rows = random_rows(9, 20, 25)
    damaged = cr.damage(frame(spark, rows))
    want = {r.conv_id: r for r in cr.repair(damaged).collect()}
    lines = {}
    for r in cr.repaired_turns(damaged, segment=8).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(r)
    for c, r in want.items():
        mine = lines.get(c, [])
        assert [m.place for m in mine] == list(range(len(mine)))
        assert "".join(m.edit for m in mine) == r.audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(m.role[0] for m in mine))
        assert hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in mine).encode()).hexdigest() == r.repaired_sha256


def test_ranks_agree_with_the_audits():
    """Node ranks order the least audits of all nodes as strings."""
    r = np.random.default_rng(0)
    n = 30
    p = cr.Paths(r.integers(0, 4, n), r.random(n) < 0.2, r.random(n) < 0.3, np.array([0, 12, 12, n]), np.tile(cr.CLOSED, (3, 1)), True)
    for q in range(4):
        codes, offs = p.audits(q)
        for c in range(3):
            assert len(cr.spelled(codes[offs[c]:offs[c + 1]])) == p.length[p.start[c] * 4 + q]


def test_same_as_duckdb(spark, sf):
    same_as_duckdb(spark, sf, "op11_path_repair")
