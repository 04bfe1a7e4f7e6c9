import hashlib
import re
import zlib
from heapq import heappop, heappush
from itertools import product

import pytest

from conftest import SF01
from panelforge.llm import conversations as C

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows, bad):
    """Dijkstra over (cost, audit), so the least audit of the cheapest comes out first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (i, last) in done:
            continue
        done.add((i, last))
        for role, c in (("user", "u"), ("assistant", "a")):
            if (last, c) in STEP:
                heappush(heap, (cost + 5, audit + "I", i, c, (*out, (role, ""))))
        if i < len(rows):
            role, text = rows[i]
            heappush(heap, (cost + 2, audit + "D", i + 1, last, out))
            if bad[i] != "gone":
                more = 5 if bad[i] == "short" else 0
                if (last, role[:1]) in STEP:
                    heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, (role, text))))
                for other, c in (("user", "u"), ("assistant", "a")):
                    if (last, c) in STEP:
                        heappush(heap, (cost + more + 1, audit + "R", i + 1, c, (*out, (other, text))))


def brute(table):
    """The contract, row by row: {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}."""
    convs = {}
    for conv, turn, role, text in table:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, bad, n = set(), [], [0, 0, 0]
        for _, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            bad.append(None if fault is None else ("gone", "gone", "short")[fault])
            if fault is not None:
                n[fault] += 1
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit, fixed = cheapest([r[1:] for r in rows], bad)
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha)
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [(1, 0, "system", "S."), (1, 1, "user", "A?"), (1, 2, "assistant", "B!"), (1, 2, "assistant", "B!"), (1, 9, "user", "cut"), (2, 0, None, None), (2, None, "user", "x."),
       (None, 3, "user", "q."), (None, None, "assistant", "w. \x0b"), (3, 5, "", "t."), (3, 6, "tool", "t."), (3, 6, "assistant", "ü。"), (4, 0, "assistant", "only."),
       (5, 0, "user", "a."), (5, 1, "user", "b."), (5, 2, "user", "c."), (6, -3, "system", "a."), (6, 3, "system", "b."), (6, 3, "supervisor", "x" * 100000 + ".")]


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries

    table = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries()["op12_conversation_repair"](spark, SF01)) == brute(table)


@pytest.mark.parametrize("bounds", [{}, {"whole_rows": 3, "chunk_bits": 1}, {"whole_rows": 0, "chunk_bits": 0}])
def test_odd_rows_whole_and_in_chunks(spark, bounds):
    many = [(k % 40, (k * 7) % 23, ("user", "assistant", "system", "user", "tool")[k * k % 5], ("ok.", "well", "", "fine!", f"n{k}.")[k % 5]) for k in range(900)]
    hot = [(7777, 1, "user", "same.")] * 60 + [(7777, t, "assistant" if t % 2 else "user", f"t{t}.") for t in range(80)]
    table = ODD + many + hot
    df = spark.createDataFrame([(*r, 1, "x") for r in table], SCHEMA + ", conv int, there string").repartition(5)
    assert found(C.digest(df, **bounds)) == brute(table)


@pytest.mark.parametrize("bounds", [{}, {"whole_rows": 2, "chunk_bits": 1}])
def test_repaired_turns(spark, bounds):
    df = spark.createDataFrame(ODD, SCHEMA)
    by_conv = {}
    for r in sorted(C.repair(df, **bounds).collect(), key=lambda r: (str(r.conv_id), r.chunk)):
        by_conv.setdefault(r.conv_id, ["", []])
        by_conv[r.conv_id][0] += r.audit
        by_conv[r.conv_id][1] += [(t.role, t.text) for t in r.turns]
    for audit, turns in by_conv.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in turns)) and len(turns) == sum(c != "D" for c in audit)
    assert by_conv[5] == ["KRD", [("user", "a."), ("assistant", "b.")]] or by_conv[5][0] in ("DKR", "KRD")


def test_empty_table_and_whole_loss(spark):
    assert C.digest(spark.createDataFrame([], SCHEMA)).collect() == [] and C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = found(C.digest(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA)))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_all_short_conversations():
    import numpy as np

    words = [w for n in range(1, 5) for w in product("suax", repeat=n)]
    for n in range(1, 5):
        own = [w for w in words if len(w) == n]
        for faults in product((0, 1, 2), repeat=n) if n < 4 else [(0, 1, 2, 0), (2, 0, 0, 2), (0,) * 4]:
            initial = np.array([["sua".find(c) % 4 if c != "x" else 3 for c in w] for w in own])
            cost, letter, _, _ = C.least_paths(initial, np.tile(faults, (len(own), 1)), np.full(len(own), n), np.zeros(len(own), int), C.END, True)
            for w, c, a in zip(own, cost, letter):
                want = cheapest([(r, "") for r in w], [(None, "gone", "short")[f] for f in faults])
                assert (c, "".join("DIKR"[k] for k in a if k >= 0)) == want[:2]
