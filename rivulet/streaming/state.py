"""Keyed state of the streaming jobs, as ``transformWithState`` processors.

Each processor keeps one small value per key in the state store - a count, the
open slots of a window, the pending sides of a join, a bounded list - and emits
what a micro-batch changed. What a key costs is bounded: rows are reduced per
task before they are shuffled to their key (:func:`partial_counts`,
:func:`partial_lowest`, :func:`partial_highest`), lists have at most ``n`` entries, and
slots and pending sides are dropped by event-time timers. Each state key costs calls and a
batch of its own, so many keys share a value: where time bounds the state, all keys of a
bucket (:class:`Bucketed`), and counts in pages of a bucket (:class:`KeyedCounts`).

Times are epoch milliseconds. Processors are pickled by value: executors need
not have the package installed.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _types(df: DataFrame, cols) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


# Rows, and bytes of them, that a task holds to reduce them together before it sends them on.
PENDING, PENDING_BYTES = 1 << 19, 64 << 20


def _much(held: list, share: int = 1) -> bool:
    """Are ``held``, Arrow tables or batches, more than a ``share``-th of what a task holds?"""
    return (share * sum(t.num_rows for t in held) > PENDING
            or share * sum(t.nbytes for t in held) > PENDING_BYTES)


def partial_counts(df: DataFrame, keys: list[str], weight: str | None = None,
                   name: str = "n") -> DataFrame:
    """Rows (or the sum of ``weight``) per ``keys``, before any shuffle: a task counts
    its Arrow batches together, up to ``PENDING`` groups at a time."""
    def grouped(t: pa.Table, how: tuple) -> pa.Table:
        out = f"{how[0]}_{how[1]}" if how[0] else how[1]
        t = t.group_by(keys).aggregate([how])
        return (t.select([*keys, out]).rename_columns([*keys, name])
                .set_column(len(keys), name, pc.cast(t[out], pa.int64())))

    def run(batches) -> Iterator[pa.RecordBatch]:
        how = (weight, "sum") if weight else ([], "count_all")
        held: list[pa.Table] = []
        for batch in batches:
            held.append(grouped(pa.Table.from_batches([batch]), how))
            if _much(held):
                held = [grouped(pa.concat_tables(held), (name, "sum"))]
                if _much(held, 2):
                    yield from held.pop().to_batches()
        if held:
            yield from grouped(pa.concat_tables(held), (name, "sum")).to_batches()

    cols = [*keys, weight] if weight else keys
    return df.select(*cols).mapInArrow(run, f"{_types(df, keys)}, {name} bigint")


def packed(df: DataFrame, bucket: str) -> DataFrame:
    """``df`` with a row per ``bucket`` of up to ``PENDING`` rows of a task: the other columns
    are arrays, as long as each other. A row costs a stateful step more than its cells."""
    cols = [c for c in df.columns if c != bucket]

    def pack(held: list) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).sort_by(bucket).combine_chunks()
        sizes = t.group_by(bucket, use_threads=False).aggregate([([], "count_all")])
        ends = pa.array([0, *pc.cumulative_sum(sizes["count_all"]).to_pylist()], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, t[c].combine_chunks()) for c in cols]
        return pa.record_batch([sizes[bucket].combine_chunks(), *lists], names=[bucket, *cols])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if _much(held):
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    types = ", ".join(f"`{c}` array<{df.schema[c].dataType.simpleString()}>" for c in cols)
    return df.select(bucket, *cols).mapInArrow(run, f"{_types(df, [bucket])}, {types}")


def partial_lowest(df: DataFrame, group: str, link: str, number: str, n: int,
                   carry=()) -> DataFrame:
    """The ``n`` lowest entries per group of every Arrow batch, one per link."""
    cols = [group, number, link, *carry]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict = {}
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                entries = best.setdefault(row[0], {})
                if row[2] not in entries or _lower(row, entries[row[2]]):
                    entries[row[2]] = row
            rows = [r for e in best.values() for r in sorted(e.values(), key=_lowest)[:n]]
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(
                    zip(*rows, strict=True), batch.schema, strict=True)], schema=batch.schema)

    return df.select(*cols).where(f"`{number}` IS NOT NULL").mapInArrow(run, _types(df, cols))


def partial_highest(df: DataFrame, by: list[str], obj: str, n: int) -> DataFrame:
    """The rows of the ``n`` objects with the highest ``count`` per ``by`` group of every
    Arrow batch; ties to the lesser object."""
    cols = [*by, obj, "count"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict = {}
            for *group, o, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = groups.setdefault(tuple(group), {})
                counts[o] = max(count, counts.get(o, 0))
            rows = [(*g, o, c) for g, counts in groups.items() for o, c in _highest(counts, n)]
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(
                    zip(*rows, strict=True), batch.schema, strict=True)], schema=batch.schema)

    return df.select(*cols).mapInArrow(run, _types(df, cols))


def _highest(counts: dict, n: int) -> list[tuple]:
    return sorted(counts.items(), key=lambda e: (-e[1], e[0] is not None, e[0]))[:n]


def _lowest(row: tuple):
    return row[1], row[2] is not None, row[2]


def _lower(row: tuple, other: tuple) -> bool:
    key = lambda r: (r[1], *((c is not None, c) for c in r[3:]))
    return key(row) < key(other)


class _Processor(StatefulProcessor):
    state_type = ""

    def init(self, handle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", self.state_type)

    def current(self):
        """The key's state, None where it has none."""
        return self.value.get() if self.value.exists() else None

    def close(self) -> None:
        pass


# Keys that a page of counts holds on average, at most.
PAGE = 256


class KeyedCounts(StatefulProcessor):
    """Counts of the keys of a bucket. Packed partial counts ``(bucket, hash, keys..., n)``
    in; packed ``(keys..., count, prev_count)`` out, once per key and micro-batch.
    ``prev_count`` is null on first sight.

    The counts lie in pages by the key's hash. Their number doubles as keys come, so a
    page stays small however many keys a bucket has, and a micro-batch reads and writes
    the pages of its own keys. ``step``: the hashes of a bucket are this far apart."""

    def __init__(self, keys: list[str], step: int):
        self.keys, self.step, self.page = keys, step, PAGE

    def init(self, handle) -> None:
        self.size = handle.getValueState("size", "pages bigint, held bigint")
        self.counts = handle.getMapState("counts", "page bigint", "cells binary")

    def _cells(self, page: int) -> dict:
        """``{name: (key, hash, count)}`` of a page."""
        found = self.counts.getValue((page,)) if self.counts.containsKey((page,)) else None
        return {_same(c[0]): c for c in pickle.loads(found[0])} if found is not None else {}

    def _by_page(self, cells, pages: int) -> dict:
        out: dict = {}
        for name, cell in cells:
            out.setdefault(cell[1] // self.step % pages, {})[name] = cell
        return out

    def handleInputRows(self, key, rows, timerValues):
        fresh: dict = {}
        for r in rows:
            for k, h, n in zip(zip(*(r[c] for c in self.keys), strict=True), r["_hash"], r["n"],
                               strict=True):
                name = _same(k)
                cell = fresh.get(name)
                fresh[name] = (k, h, n) if cell is None else (cell[0], h, cell[2] + n)
        pages, held = self.size.get() if self.size.exists() else (1, 0)
        before = held, pages
        touched = {}
        for page, news in self._by_page(fresh.items(), pages).items():
            cells = touched[page] = self._cells(page)
            held -= len(cells)
            prev = [cells[name][2] if name in cells else None for name in news]
            count = [(p or 0) + c[2] for p, c in zip(prev, news.values(), strict=True)]
            cells.update((name, (*c[:2], n)) for (name, c), n in zip(news.items(), count, strict=True))
            held += len(cells)
            yield Row(**dict(zip(self.keys, map(list, zip(*(c[0] for c in news.values()), strict=True)),
                                 strict=True)), count=count, prev_count=prev)
        if held > pages * self.page:
            for page in range(pages):
                if page not in touched:
                    touched[page] = self._cells(page)
            while held > pages * self.page:
                pages *= 2
            touched = self._by_page((e for cells in touched.values() for e in cells.items()), pages)
        for page, cells in touched.items():
            self.counts.updateValue((page,), (pickle.dumps(list(cells.values()), 5),))
        if (held, pages) != before:
            self.size.update((pages, held))

    def close(self) -> None:
        pass


class Folded(_Processor):
    """A user's fold as keyed state: ``step(old, row) -> new`` over value tuples
    (``old`` is None at first). Emits ``(keys..., value columns)`` when it changed."""

    def __init__(self, keys: list[str], columns: list[str], value_type: str, step):
        self.keys, self.columns, self.state_type, self.step = keys, columns, value_type, step

    def handleInputRows(self, key, rows, timerValues):
        old = self.current()
        new = old = None if old is None else tuple(old)
        for row in rows:
            new = self.step(new, row)
        if new is not None and new != old:
            self.value.update(new)
            yield Row(**dict(zip(self.keys, key, strict=True)),
                      **dict(zip(self.columns, new, strict=True)))


class LowestN(_Processor):
    """The ``n`` lowest entries of a group, one per link (its smallest number; ties to
    the earlier link). Emits the entries that entered the list in this micro-batch."""

    def __init__(self, group: str, columns: list[str], n: int, entry_type: str):
        self.group, self.columns, self.n = group, columns, n
        self.state_type = f"entries array<struct<{entry_type}>>"

    def handleInputRows(self, key, rows, timerValues):
        old = self.current()
        held = {e[1]: (None, *e) for e in (old[0] if old is not None else ())}
        best = dict(held)
        for r in rows:
            row = (None, *(r[c] for c in self.columns))
            if row[2] not in best or _lower(row, best[row[2]]):
                best[row[2]] = row
        lowest = sorted(best.values(), key=_lowest)[:self.n]
        entered = [r for r in lowest if r[2] not in held or held[r[2]][1] != r[1]]
        if lowest != list(held.values()):
            self.value.update(([r[1:] for r in lowest],))
        for r in entered:
            yield Row(**{self.group: key[0]}, **dict(zip(self.columns, r[1:], strict=True)))


class RankList(_Processor):
    """The ``n`` objects of a group with the highest counts. Counts only grow, and
    every change of a count comes in, so an object outside the list has a count not
    above the list's least until it is seen again.

    Emits the entries that are new or have a new count (``whole`` False, for the next
    ranking), or the whole ranked list when it changed (``whole`` True). With
    ``end``, the position of the window's end (milliseconds) in the key, the list is
    dropped when the watermark passes it."""

    def __init__(self, by: list[str], obj: str, n: int, obj_type: str, whole: bool,
                 end: int | None = None):
        self.by, self.obj, self.n, self.whole, self.end = by, obj, n, whole, end
        self.state_type = f"entries array<struct<count:bigint,obj:{obj_type}>>"

    def handleInputRows(self, key, rows, timerValues):
        old = self.current()
        held = {e[1]: e[0] for e in (old[0] if old is not None else ())}
        counts = dict(held)
        for r in rows:
            counts[r[self.obj]] = max(r["count"], counts.get(r[self.obj], 0))
            if len(counts) > 1000 * self.n:
                counts = dict(_highest(counts, self.n))
        ranked = _highest(counts, self.n)
        if ranked == list(held.items()):
            return
        self.value.update(([(c, o) for o, c in ranked],))
        if self.end is not None and old is None:
            self.handle.registerTimer(key[self.end])
        group = dict(zip(self.by, key, strict=True))
        for rank, (obj, count) in enumerate(ranked, 1):
            if self.whole:
                yield Row(**group, rank=rank, **{self.obj: obj}, count=count)
            elif held.get(obj) != count:
                yield Row(**group, **{self.obj: obj}, count=count)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.value.clear()
        return iter(())


class WindowCounts(_Processor):
    """Counts of sliding windows with bounded lateness.

    Rows are ``(keys..., slot, n)``: ``n`` rows of the slot that starts at ``slot``. A
    row whose slot has ended by the watermark is late: it is handed on as ``late``
    and counted nowhere. Open slots are the only state.

    ``updates``: every micro-batch emits the present count of each window that it
    touched (``update``). Otherwise a timer per key emits at every tick the count of
    the window that ends there (``count``), and one ``zero`` at the tick after the
    last window with a row."""

    state_type = "slots array<struct<slot:bigint,n:bigint>>, tick bigint"

    def __init__(self, keys: list[str], width_ms: int, emit_ms: int, updates: bool = False):
        self.keys, self.width, self.emit, self.updates = keys, width_ms, emit_ms, updates

    def _row(self, key, kind: str, end: int, count: int) -> Row:
        return Row(kind=kind, **dict(zip(self.keys, key, strict=True)), end_ms=end, count=count)

    def _window(self, slots: dict, end: int) -> int:
        return sum(slots.get(s, 0) for s in range(end - self.width, end, self.emit))

    def _keep(self, slots: dict, tick: int | None) -> None:
        if slots or tick is not None:
            self.value.update((sorted(slots.items()), tick))
        else:
            self.value.clear()

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        state = self.current()
        slots, tick = ({}, None) if state is None else ({s: n for s, n in state[0]}, state[1])
        fresh = set()
        for r in rows:
            if not r.n:
                continue  # a heartbeat only moves the time on
            if r.slot + self.emit <= watermark:
                yield self._row(key, "late", r.slot + self.emit, r.n)
            else:
                slots[r.slot] = slots.get(r.slot, 0) + r.n
                fresh.add(r.slot)
        if not fresh:
            return
        if self.updates:
            ends = {s + k for s in fresh for k in range(self.emit, self.width + 1, self.emit)}
            for end in sorted(ends):
                yield self._row(key, "update", end, self._window(slots, end))
            # A slot is needed until it is closed for late rows and out of all windows.
            wake = min(slots) + self.width
        else:
            wake = min(fresh) + self.emit
        if tick is None or wake < tick:
            if tick is not None:
                self.handle.deleteTimer(tick)
            self.handle.registerTimer(wake)
            tick = wake
        self._keep(slots, tick)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        state = self.current()
        if state is None:
            return
        slots, tick = {s: n for s, n in state[0]}, state[1]
        while tick is not None and tick <= watermark:
            if self.updates:
                slots = {s: n for s, n in slots.items() if s + self.width > tick}
                tick = min(slots) + self.width if slots else None
                continue
            count = self._window(slots, tick)
            yield self._row(key, "count" if count else "zero", tick, count)
            slots = {s: n for s, n in slots.items() if s >= tick + self.emit - self.width}
            tick = (tick + self.emit if count else min(slots) + self.emit if slots else None)
        if tick is not None:
            self.handle.registerTimer(tick)
        self._keep(slots, tick)


class NaturalJoin(_Processor):
    """Inner join of N streams on their common key: a slot per side, emitted as
    ``joined`` when all sides have come. A second row for a pending side is an error.

    With ``within_ms`` the rows of a result lie at most that far apart; pending sides
    that can no longer be completed are emitted as ``expired``, by a timer when the
    watermark passes, or at once when a row shows it. Rows are ``(keys..., side, at,
    fields...)``; a field that several sides have is the first side's."""

    def __init__(self, keys: list[str], fields: list[str], sides: int, within_ms: int | None,
                 field_type: str, owners: dict[str, int]):
        self.keys, self.fields, self.full = keys, fields, (1 << sides) - 1
        self.within, self.owners = within_ms, owners
        self.state_type = "sides int, first bigint, last bigint" + (
            f", {field_type}" if field_type else "")

    def _row(self, key, kind: str, state: tuple) -> Row:
        return Row(kind=kind, sides=state[0], **dict(zip(self.keys, key, strict=True)),
                   **dict(zip(self.fields, state[3:], strict=True)))

    def handleInputRows(self, key, rows, timerValues):
        held = self.current()
        held = before = None if held is None else tuple(held)
        watermark = timerValues.getCurrentWatermarkInMs() if self.within is not None else 0
        for r in sorted(rows, key=lambda r: (r.at or 0, r.side)):
            if r.side < 0:
                continue  # a heartbeat only moves the time on
            alone = (1 << r.side, r.at, r.at, *(
                r[f] if self.owners.get(f) == r.side else None for f in self.fields))
            if self.within is not None:
                if r.at + self.within < watermark or (
                        held is not None and r.at < held[2] - self.within):
                    yield self._row(key, "expired", alone)
                    continue
                if held is not None and r.at > held[1] + self.within:
                    yield self._row(key, "expired", held)
                    held = None
            if held is None:
                held = alone
            elif held[0] & alone[0]:
                raise ValueError(f"second row of side {r.side} for pending key {key}")
            else:
                times = [t for t in (held[1], held[2], r.at) if t is not None]
                held = (held[0] | alone[0], min(times, default=None), max(times, default=None),
                        *(a if b is None else b for a, b in zip(held[3:], alone[3:], strict=True)))
            if held[0] == self.full:
                yield self._row(key, "joined", held)
                held = None
        if held == before:
            return
        if before is not None and self.within is not None and (
                held is None or held[1] != before[1]):
            self.handle.deleteTimer(before[1] + self.within + 1)
        if held is None:
            self.value.clear()
            return
        self.value.update(held)
        if self.within is not None and (before is None or held[1] != before[1]):
            self.handle.registerTimer(held[1] + self.within + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.current()
        if held is not None:
            self.value.clear()
            yield self._row(key, "expired", tuple(held))


_NAN = ("NaN",)


class _Cell:
    """A key of a bucket to its processor: value state and timers, held in memory."""

    key = state = timer = None
    changed = False

    def take(self, key, state=None, timer=None) -> None:
        self.key, self.state, self.timer = key, state, timer

    def exists(self) -> bool:
        return self.state is not None

    def get(self):
        return self.state

    def update(self, state: tuple) -> None:
        self.state, self.changed = state, True

    def clear(self) -> None:
        self.state, self.changed = None, True

    def registerTimer(self, at: int) -> None:
        self.timer, self.changed = at, True

    def deleteTimer(self, at: int) -> None:
        if self.timer == at:
            self.timer, self.changed = None, True


def _same(value):
    """A dictionary key that is equal for values that Spark groups together."""
    if isinstance(value, (list, tuple)):
        return tuple(_same(v) for v in value)
    if isinstance(value, bytearray):
        return bytes(value)
    return _NAN if isinstance(value, float) and value != value else value


class Bucketed(StatefulProcessor):
    """``processor`` (with at most one timer per key) over the keys of a bucket, the only
    grouping key. A bucket's keys are one value and one timer, the earliest of theirs, so a
    micro-batch costs the calls of its buckets, not of its keys. A touched bucket is written
    whole: for state that time bounds."""

    def __init__(self, keys: list[str], processor: _Processor):
        self.keys, self.processor = keys, processor

    def init(self, handle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", "cells binary, wake bigint")
        self.cell = self.processor.value = self.processor.handle = _Cell()

    def _load(self):
        state = self.value.get() if self.value.exists() else None
        held = pickle.loads(state[0]) if state is not None else ()
        self.cell.changed = False
        return {_same(c[0]): c for c in held}, None if state is None else state[1]

    def _run(self, cells: dict, name, cell: tuple, call):
        self.cell.take(*cell)
        yield from call()
        if self.cell.state is None and self.cell.timer is None:
            cells.pop(name, None)
        else:
            cells[name] = (self.cell.key, self.cell.state, self.cell.timer)

    def _store(self, cells: dict, wake: int | None, fired: bool = False) -> None:
        if not self.cell.changed:
            return
        first = min((c[2] for c in cells.values() if c[2] is not None), default=None)
        if first != wake:
            if wake is not None and not fired:
                self.handle.deleteTimer(wake)
            if first is not None:
                self.handle.registerTimer(first)
        if cells:
            self.value.update((pickle.dumps(list(cells.values()), 5), first))
        else:
            self.value.clear()

    def handleInputRows(self, key, rows, timerValues):
        groups: dict = {}
        at = None
        for r in rows:
            if at is None:
                at = [r.__fields__.index(k) for k in self.keys]
            k = tuple(r[i] for i in at)
            groups.setdefault(_same(k), (k, []))[1].append(r)
        cells, wake = self._load()
        for name, (k, group) in groups.items():
            yield from self._run(cells, name, cells.get(name, (k,)), lambda k=k, group=group:
                                 self.processor.handleInputRows(k, iter(group), timerValues))
        self._store(cells, wake)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        cells, wake = self._load()
        for name, (k, state, timer) in list(cells.items()):
            if timer is not None and timer <= now:
                self.cell.changed = True
                yield from self._run(cells, name, (k, state), lambda k=k, timer=timer:
                                     self.processor.handleExpiredTimer(
                                         k, timerValues, ExpiredTimerInfo(timer)))
        self._store(cells, wake, True)

    def close(self) -> None:
        pass
