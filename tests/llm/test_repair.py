"""Conversation repair against a chart of all spans and cuts, plain enumeration, and a plain parser of whole tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def symbol(kind, state="clean"):
    return repair.SYMBOLS[repair.KINDS.index(kind) * 4 + repair.STATES.index(state)]


def whole_chart(symbols):
    """CYK with every span and every cut."""
    n = len(symbols)
    cells = {(i, i + 1): repair.terminal(s) for i, s in enumerate(symbols)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best = {}
            for cut in range(i + 1, i + length):
                for key, found in repair.combined(cells[i, cut], cells[cut, i + length]).items():
                    best[key] = min(found, best.get(key, found))
            cells[i, i + length] = best
    return cells[0, n]


def enumerated(turns):
    """The least (cost, audit) over all edits of (kind, state) turns, with up to two insertions in each gap."""
    choices = []
    for kind, state in turns:
        own = [("D", "", 4)]
        if state in ("clean", "truncated"):
            extra = 3 * (state == "truncated")
            own += [("K", kind, extra)] * (kind != "-") + [("R", "u", 3 + extra), ("R", "a", 3 + extra)]
        choices.append(own)
    gap = [("I" * n, "".join(x), 3 * n) for n in range(3) for x in itertools.product("ua", repeat=n)]
    best = None
    for picked in itertools.product(*choices):
        for gaps in itertools.product(gap, repeat=len(turns) + 1):
            parts = [gaps[0], *itertools.chain(*zip(picked, gaps[1:]))]
            cost = sum(p[2] for p in parts)
            if best and cost > best[0]:
                continue
            if GOOD.fullmatch("".join(p[1] for p in parts)):
                found = (cost, "".join(p[0] for p in parts))
                best = min(best or found, found)
    return best


def plain(rows):
    """Everything about one conversation's rows (turn, role, text) after damage, by a forward search."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        solid = re.sub("[ \t-\r]+", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        marked.append((role, text, fault))
    states = {"": (0, "", ())}

    def better(into, state, found):
        if state not in into or found[:2] < into[state][:2]:
            into[state] = found

    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit, kept) in list(out.items()):
                better(out, follow[state], (cost + 3, audit + "I", (*kept, f"{names[follow[state]]}:")))
        return out

    states = inserted(states)
    for role, text, fault in marked:
        out = {}
        for state, (cost, audit, kept) in states.items():
            better(out, state, (cost + 4, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            extra, to, first = 3 * (fault == "truncated"), follow[state], role[:1]
            better(out, to, (cost + 3 + extra, audit + "R", (*kept, f"{names[to]}:{text}")))
            if first == to or (first == "s" and state == ""):
                better(out, first, (cost + extra, audit + "K", (*kept, f"{role}:{text}")))
        states = inserted(out)
    cost, audit, kept = min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha, kept


def plain_damage(conv, turn, role, text):
    name = ":".join(" " if x is None else str(x) for x in (conv, turn))
    role, text, n = " " if role is None else role, " " if text is None else text, zlib.crc32(name.encode()) % 20
    if n == 0:
        return []
    text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
    return [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)


def grouped(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def test_doubling_spans_equal_the_whole_chart():
    rng = random.Random(3)
    for _ in range(200):
        symbols = "".join(rng.choice(repair.SYMBOLS) for _ in range(rng.randint(1, 23)))
        assert repair.span(symbols) == whole_chart(symbols)


def test_least_edits_of_all():
    every = [(k, s) for k in "sua-" for s in ("clean", "truncated")] + [("u", "blank")]
    for turns in [(t,) for t in every] + [tuple(random.Random(i).choices(every, k=3)) for i in range(25)]:
        assert repair.cheapest([repair.span("".join(symbol(*t) for t in turns))]) == enumerated(turns)


def test_cells_survive_packing():
    cell = repair.span("".join(random.Random(0).choices(repair.SYMBOLS, k=40)))
    assert repair.unpacked(repair.packed(cell)) == cell


def random_rows(rng, convs):
    rows = []
    for conv in convs:
        for _ in range(rng.randint(0, 9)):
            rows.append(
                (
                    conv,
                    rng.choice([None, 0, 1, 2, 3, 4, 5, 9]),
                    rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "umpire", "User", None]),
                    rng.choice(["Hello.", "Hi there", "What?", "", " \n\t", "Done! ", "a.b", "é.", "x" * 5_000 + ".", None]),
                )
            )
    return rows


def as_tuple(row):
    return tuple(row[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))


def test_tables_match_a_plain_parser(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 3)  # conversations of several blocks
    rng = random.Random(5)
    data = random_rows(rng, [None, *range(60)])
    data += data[:40] + [(1_000, i, "user", f"No {i}") for i in range(60)]
    frame = spark.createDataFrame(data, SCHEMA).withColumns({"conv": F.lit("x"), "row": F.lit(1), "symbol": F.lit("?"), "audit": F.lit(2)})
    rows, audits = repair.repaired(frame)
    expected = {conv: plain(own) for conv, own in grouped(data).items()}
    assert {r["conv"]: as_tuple(r) for r in audits.collect()} == {conv: e[:7] for conv, e in expected.items()}
    assert {r["conv"]: r["repaired_sha256"] for r in repair.digests(rows, audits).collect()} == {c: e[7] for c, e in expected.items()}
    turns = {}
    for r in repair.repaired_turns(rows, audits).orderBy("conv", "place").collect():
        assert r["place"] == len(turns.setdefault(r["conv"], []))
        turns[r["conv"]].append(f"{r['role']}:{r['text']}")
    assert {c: tuple(t) for c, t in turns.items()} == {c: e[8] for c, e in expected.items() if e[8]}


def test_query_matches_a_plain_parser(spark, tmp_path):
    data = random_rows(random.Random(8), range(150)) + [(500 + i, None, "user", "Only one.") for i in range(40)]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    after = {conv: [] for conv, *_ in data}
    for row in data:
        after[row[0]] += plain_damage(*row)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected = {conv: plain(own)[:8] if own else nothing for conv, own in after.items()}
    found = queries.op11_repair(spark, str(tmp_path)).collect()
    assert len(found) == len(expected)
    assert {r["conv_id"]: (*as_tuple(r), r["repaired_sha256"]) for r in found} == expected


def test_a_long_conversation_is_streamed(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(9_000) if i % 100]
    kept, audits = repair.repaired(spark.createDataFrame(rows, SCHEMA))
    row = audits.first()
    assert (row["gaps"], row["duplicate"], row["truncated"]) == (89, 0, 0)
    assert as_tuple(row) == plain([r[1:] for r in rows])[:7]
    assert repair.digests(kept, audits).first()["repaired_sha256"] == plain([r[1:] for r in rows])[7]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows, audits = repair.repaired(empty)
    assert audits.count() == repair.digests(rows, audits).count() == repair.repaired_turns(rows, audits).count() == 0


@pytest.mark.parametrize("text", ["", " ", "\t\n\x0b\x0c\r"])
def test_blank_turns_go(spark, text):
    rows, audits = repair.repaired(spark.createDataFrame([(1, 0, "user", text), (1, 1, "user", "Hi.")], SCHEMA))
    assert (audits.first()["audit"], audits.first()["blank"], audits.first()["cost"]) == ("DKI", 1, 7)
