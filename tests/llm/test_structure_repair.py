"""Conversation repair against exhaustive search and plain Python."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from rivulet.llm import structure_repair as sr

SPACES = " \t\n\v\f\r"


def brute_edits(rows):
    """Uniform-cost search over (cost, audit) strings; rows: (initial, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        # The pattern's state: which roles came last, and whether any came.
        state = (i, roles[-1:])
        if (state, "x") in done:
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out
        if state in done:
            continue
        done.add(state)
        moves = [("I", 0, r, 3, ("I", r)) for r in "ua"]
        if i < len(rows):
            initial, fault = rows[i]
            moves.append(("D", 1, "", 4, ()))
            if fault != 1:
                extra = 3 if fault == 2 else 0
                moves.append(("K", 1, initial, extra, ("K", i)))
                moves += [("R", 1, r, 3 + extra, ("R", r, i)) for r in "ua"]
        for name, taken, role, price, step in moves:
            new = roles + role
            if role == "-" or not re.fullmatch("s?(ua)*u?", new):
                continue
            heapq.heappush(heap, (cost + price, audit + name, i + taken, new, (*out, step) if step else out))
    raise AssertionError


def test_all_short_conversations():
    kinds = [(c, f) for c in "sua-" for f in range(3)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            got = sr.cheapest_edits(bytes(sr.symbol(*r) for r in rows), window=2)
            assert got == brute_edits(rows)[:2], rows


@pytest.mark.parametrize("window", [1, 3, 32, 1000])
def test_longer_conversations(window):
    rng = random.Random(7)
    for n in (8, 20, 60, 150):
        for _ in range(6):
            rows = [("ua"[k % 2], 0) if rng.random() < 0.6 else
                    (rng.choice("sua-"), rng.randrange(3)) for k in range(n)]
            got = sr.cheapest_edits(bytes(sr.symbol(*r) for r in rows), window)
            assert got == brute_edits(rows)[:2], rows


def test_estimates_never_exceed_the_cost():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice("sua-"), rng.randrange(3)) for _ in range(9)]
        symbols = bytes(sr.symbol(*r) for r in rows)
        assert sr.estimates(symbols, 4)[0] <= sr.cheapest_edits(symbols)[0]
        assert sr.estimates(symbols, 100)[0] == sr.cheapest_edits(symbols)[0]


def test_a_long_conversation_is_searched_in_bounded_time():
    rng = random.Random(1)
    rows = [("ua"[k % 2] if rng.random() > 0.03 else "u", rng.choice([0] * 18 + [1, 2]))
            for k in range(5000) if rng.random() > 0.05]
    cost, audit = sr.cheapest_edits(bytes(sr.symbol(*r) for r in rows))
    assert sum(c != "I" for c in audit) == len(rows) and cost > 1000


def plain(rows):
    """The contract in plain Python."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        out = convs[conv]
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out.extend([(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1))
    result = {}
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                hashlib.md5(r[2].encode()).hexdigest()))
        turns = [r[0] for r in out if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, seen, symbols = [0, 0, 0], set(), []
        for _, role, text in out:
            fault = 0
            body = text.strip(SPACES)
            if not body:
                counts[0] += 1
                fault = 1
            elif (role, text) in seen:
                counts[1] += 1
                fault = 1
            elif body[-1] not in ".!?":
                counts[2] += 1
                fault = 2
            seen.add((role, text))
            symbols.append((role[:1] if role[:1] and role[:1] in "sua" else "-", fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(out))
        cost, audit, steps = brute_edits(symbols)
        lines = []
        for step in steps:
            name = {"u": "user", "a": "assistant"}
            if step[0] == "I":
                lines.append(name[step[1]] + ":")
            elif step[0] == "K":
                lines.append(out[step[1]][1] + ":" + out[step[1]][2])
            else:
                lines.append(name[step[1]] + ":" + out[step[2]][2])
        result[conv] = (gaps, *counts, illegal, cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, True) for r in rows],
                                 "conv_id long, turn long, role string, text string, audit string, "
                                 "kind int, copy boolean")


def test_summary_matches_plain_python(spark):
    rng = random.Random(11)
    texts = ["Yes.", "no", "  \t", "", None, "What?! ", "ends ", "é. \n", "..", "a.b"]
    rows = []
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool"]
    for conv in range(80):
        for turn in range(rng.randrange(1, 9) if conv else 90):
            role = rng.choice(roles) if conv % 3 == 0 else ("user", "assistant")[turn % 2]
            text = f"text {turn}" + rng.choice([".", "", "?"])
            if not conv % 5 or rng.random() < 0.2:
                text = rng.choice(texts)
            rows.append((conv, turn + rng.randrange(2) * (conv % 7 == 0) * 3, role, text))
    rows += [(None, 1, "user", "hi."), (None, None, "assistant", "x."), (None, None, "assistant", "x."),
             (901, None, "user", "only"), (901, None, None, None)] + [rows[0], rows[95]] * 2
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone"))
    got = {r["conv_id"]: tuple(r)[1:] for r in
           sr.repair_summary(sr.damage(frame(spark, rows).repartition(5))).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if v != want[k]} == {}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_repaired_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (1, 2, "assistant", " "), (2, 0, "assistant", "A."),
         (3, 0, "tool", "x.")], "conv_id long, turn long, role string, text string")
    found = sr.diagnose(rows)
    assert {r["conv_id"]: r["audit"] for r in found.collect()} == {1: "KRD", 2: "IK", 3: "D"}
    got = sorted(map(tuple, sr.repair(rows, found).collect()))
    assert got == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Hello."),
                   (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "A.")]


def test_empty_table(spark):
    assert sr.repair_summary(sr.damage(frame(spark, []))).count() == 0
