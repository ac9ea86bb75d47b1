r"""Repair of damaged conversations by the cheapest edits.

A conversation's roles must read ``(s?(ua)+)?``: an optional system turn, then user
and assistant in turn. Edits, left to right: Keep costs 0, Rerole (to user or
assistant) 3, Delete 4, Insert (an empty user or assistant turn) 3; a blank row or
a copy of an earlier one must go; a truncated row that stays costs 3 more. Of all
cheapest edit sequences the one with the least string of initials is taken.

The search is iterative-deepening A*. Its depth-first passes try the edits of a
state (row, place in the grammar) in ASCII order - D, I, K, R - and give up where
cost so far plus the estimate of the rest exceeds the bound; a pass that fails
raises the bound to the least cost it gave up at. The first path that is accepted
is therefore the least of the cheapest. States that failed are kept in a
transposition table with the remaining cost that is now known to be needed, so
they are left at once when they are met with no more to spend, in this pass or a
later one. The first estimates relax the problem: the rest of the conversation is
cut into windows of rows, each charged its cheapest edits from any place in the
grammar to any other.

Rows are shuffled by conversation and sorted, never collected: the first pass over
them keeps a byte and a digest per row of one conversation, the second streams.

Nulls: null roles and texts are one space, rows with a null ``conv_id`` are one
conversation, null turns come first. Rows of equal turn go by role and the
digest of their text. An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
WINDOW = 32
# ASCII white space as SQL: the characters of [\x20\x09-\x0D].
_SPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

# Places in the grammar: nothing yet, after system, after user, after assistant.
_ACCEPT = (True, False, False, True)
_EXPECTED = ("user", "user", "assistant", "user")
_AFTER = (2, 2, 3, 2)  # the place behind the expected role
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_NONE, _MUST_GO, _CUT = range(3)  # what a row's fault means for the search
_INITIALS = "sua-"  # "-" any other


def _edits(initial: str, fault: int) -> tuple:
    """Per place the edits of a row: ``(name, rows taken, place, cost)``, ASCII order."""
    out = []
    for place in range(4):
        moves = [("D", 1, place, DELETE), ("I", 0, _AFTER[place], INSERT)]
        if fault != _MUST_GO:
            extra = TRUNCATED if fault == _CUT else 0
            if (initial, place) in _KEPT:
                moves.append(("K", 1, _KEPT[initial, place], KEEP + extra))
            moves.append(("R", 1, _AFTER[place], REROLE + extra))
        out.append(tuple(moves))
    return tuple(out)


# A row is a symbol: its initial and what its fault means.
_EDITS = [_edits(i, f) for i in _INITIALS for f in range(3)]
_AT_END = tuple((("I", 0, _AFTER[p], INSERT),) for p in range(4))
_REST = (0, 2 * INSERT, INSERT, 0)  # behind the last row


def symbol(initial: str, fault: int) -> int:
    return 3 * (_INITIALS.index(initial) if initial in ("s", "u", "a") else 3) + fault


def estimates(symbols: bytes, window: int = WINDOW) -> list[int]:
    """A cost that the rest needs at least, for every state ``4 * row + place``."""
    n = len(symbols)
    out = [0] * (4 * n + 4)
    out[4 * n:] = behind = list(_REST)
    later = 0
    for row in range(n - 1, -1, -1):
        if row != n - 1 and (row + 1) % window == 0:
            # Window boundary: any place may follow.
            later += min(behind)
            behind = [0, 0, 0, 0]
        here = [min(cost + behind[place] for _, taken, place, cost in moves if taken)
                for moves in _EDITS[symbols[row]]]
        for _ in range(2):
            here = [min(c, INSERT + here[_AFTER[p]]) for p, c in enumerate(here)]
        out[4 * row:4 * row + 4] = [later + c for c in here]
        behind = here
    return out


def cheapest_edits(symbols: bytes, window: int = WINDOW) -> tuple[int, str]:
    """Cost and initials of the least of the cheapest edit sequences (IDA*)."""
    n = len(symbols)
    need = estimates(symbols, window)  # estimates, then what failed states proved
    bound = need[0]
    while True:
        states, spent, names = [0], [0], []
        tried, least = [0], [1 << 60]
        while states:
            state, cost = states[-1], spent[-1]
            row, place = state >> 2, state & 3
            if row == n and _ACCEPT[place]:
                return cost, "".join(names)
            moves = _EDITS[symbols[row]][place] if row < n else _AT_END[place]
            k, low = tried[-1], least[-1]
            while k < len(moves):
                name, taken, to, price = moves[k]
                child = 4 * (row + taken) + to
                total = price + need[child]
                if cost + total <= bound:
                    break
                k += 1
                low = min(low, total)
            tried[-1], least[-1] = k, low
            if k < len(moves):
                states.append(child)
                spent.append(cost + price)
                names.append(name)
                tried.append(0)
                least.append(1 << 60)
                continue
            # Failed: remember what the state is now known to need. The edit that led
            # here is tried again against that, and given up.
            need[state] = max(need[state], low)
            for pile in (states, spent, tried, least):
                pile.pop()
            if names:
                names.pop()
        bound = need[0]


_known: dict[bytes, tuple[int, str]] = {}


def _solve(symbols: bytes) -> tuple[int, str]:
    """``cheapest_edits``; answers for short conversations are kept."""
    if len(symbols) > 16:
        return cheapest_edits(symbols)
    if symbols not in _known:
        if len(_known) >= 1 << 16:
            _known.clear()
        _known[symbols] = cheapest_edits(symbols)
    return _known[symbols]


def damage(conversations: DataFrame) -> DataFrame:
    """Test damage by crc32(``conv_id:turn``) mod 20: 0 drops the row, 1 empties its
    text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes the role user. Dropped rows
    stay as rows with ``dropped`` so that their conversation is still known."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                 text("role").alias("role"), text("text").alias("text"),
                                 kind.alias("kind"))
            .select("conv_id", "turn",
                    F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "")
                    .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    (F.col("kind") == 0).alias("dropped"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2)))
                              .otherwise(F.array(F.lit(1)))).alias("copy"))
            .drop("copy"))


def _rows(conversations: DataFrame) -> DataFrame:
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        filled("role").alias("role"), filled("text").alias("text"),
        F.coalesce(dropped, F.lit(False)).alias("dropped"))


_DIAGNOSED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, "
              "illegal long, cost long, audit string")


def diagnose(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps in the turn numbers, rows by their first fault, illegal
    neighbours, and cost and initials (``audit``) of the cheapest edits."""
    end = F.expr(f"right(trim(TRAILING {_SPACE} FROM text), 1)")
    slim = _rows(conversations).select(
        "conv_id", "dropped", "turn", "role", F.md5("text").alias("text_key"),
        F.when(end == "", 1).when(~end.isin(".", "!", "?"), 2).otherwise(0).alias("fault"))
    ordered = slim.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text_key")

    def finish(conv):
        low, high, turns = conv["turns"]
        cost, audit = _solve(bytes(conv["symbols"]))
        return (conv["id"], 0 if low is None else high - low + 1 - turns, conv["blank"],
                conv["duplicate"], conv["truncated"], conv["illegal"], cost, audit)

    def run(batches):
        names = [f.split()[0] for f in _DIAGNOSED.split(", ")]
        conv = None
        for batch in batches:
            done = []
            for conv_id, dropped, turn, role, key, fault in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if conv is None or conv["id"] != conv_id:
                    if conv is not None:
                        done.append(finish(conv))
                    conv = {"id": conv_id, "turns": (None, None, 0), "blank": 0, "duplicate": 0,
                            "truncated": 0, "illegal": 0, "symbols": bytearray(), "seen": set(),
                            "last": None}
                if dropped:
                    continue
                low, high, turns = conv["turns"]
                if turn is not None and turn != high:  # turns come in order
                    conv["turns"] = (turn if low is None else low, turn, turns + 1)
                row = hashlib.blake2b(f"{role}\0{key}".encode(), digest_size=16).digest()
                copy = row in conv["seen"]
                conv["seen"].add(row)
                initial = role[:1]
                if fault == 1:
                    conv["blank"] += 1
                elif copy:
                    conv["duplicate"] += 1
                elif fault == 2:
                    conv["truncated"] += 1
                last, conv["last"] = conv["last"], initial
                if last is not None and last + initial not in ("su", "ua", "au"):
                    conv["illegal"] += 1
                conv["symbols"].append(symbol(
                    initial, _MUST_GO if fault == 1 or copy else _CUT if fault == 2 else _NONE))
            if done:
                yield _batch(done, names)
        if conv is not None:
            yield _batch([finish(conv)], names)

    return ordered.mapInArrow(run, _DIAGNOSED)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = {"audit": pa.string(), "edit": pa.string(), "role": pa.string(), "text": pa.string(),
             "repaired_sha256": pa.string()}
    return pa.record_batch([pa.array(c, types.get(n, pa.int64()))
                            for c, n in zip(zip(*rows, strict=True), names, strict=True)], names)


_REPAIRED = "conv_id long, position long, edit string, role string, text string"


class _Editor:
    """Applies an audit to the rows of its conversation as they come by."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.at, self.place, self.position = conv_id, audit, 0, 0, 0

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.position += 1
        return self.conv_id, self.position - 1, edit, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            role, self.place = _EXPECTED[self.place], _AFTER[self.place]
            self.at += 1
            yield self._out("I", role, "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.place = _KEPT[role[:1], self.place]
            yield self._out("K", role, text)
        elif edit == "R":
            role, self.place = _EXPECTED[self.place], _AFTER[self.place]
            yield self._out("R", role, text)


def repair(conversations: DataFrame, diagnosed: DataFrame) -> DataFrame:
    """The repaired rows: ``position`` in the conversation, the ``edit`` that made the
    row (K, R or I), ``role`` and ``text``. A conversation's rows come out together
    and in order. Its audit travels as its first row."""
    rows = (_rows(conversations).where("NOT dropped")
            .select("conv_id", F.lit(1).alias("kind"), "turn", "role",
                    F.md5("text").alias("text_key"), "text", F.lit(None).cast("string").alias("audit")))
    heads = diagnosed.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        *(F.lit(None).cast("string").alias(c) for c in ("role", "text_key", "text")), "audit")
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", F.asc_nulls_first("turn"), "role", "text_key").select(
        "conv_id", "kind", "role", "text", "audit")

    def run(batches):
        names = [f.split()[0] for f in _REPAIRED.split(", ")]
        editor = None
        for batch in batches:
            out = []
            for conv_id, kind, role, text, audit in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if editor is not None:
                        out.extend(editor.inserted())
                    editor = _Editor(conv_id, audit)
                else:
                    out.extend(editor.row(role, text))
            if out:
                yield _batch(out, names)
        if editor is not None and (out := list(editor.inserted())):
            yield _batch(out, names)

    return ordered.mapInArrow(run, _REPAIRED)


def _digests(repaired: DataFrame) -> DataFrame:
    """sha256 of every conversation's ``role:text`` lines, as its rows come by."""

    def run(batches):
        names, missing = ["conv_id", "repaired_sha256"], object()
        current, digest = missing, None
        for batch in batches:
            out = []
            for conv_id, position, role, text in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if position == 0:
                    if current is not missing:
                        out.append((current, digest.hexdigest()))
                    current, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield _batch(out, names)
        if current is not missing:
            yield _batch([(current, digest.hexdigest())], names)

    return repaired.select("conv_id", "position", "role", "text").mapInArrow(
        run, "conv_id long, repaired_sha256 string")


def repair_summary(conversations: DataFrame) -> DataFrame:
    """``diagnose`` with the digest of the repaired conversation."""
    found = stored(diagnose(conversations), "repair-audits")
    digests = _digests(repair(conversations, found)).withColumnRenamed("conv_id", "repaired_id")
    empty = hashlib.sha256().hexdigest()
    return (found.join(digests, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left")
            .select(*found.columns, F.coalesce("repaired_sha256", F.lit(empty))
                    .alias("repaired_sha256")))
