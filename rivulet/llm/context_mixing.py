"""Language-model scoring by logistic context mixing.

A text is its token sequence (words ``[^\\x20\\x09-\\x0D]+`` with A-Z folded, one space
between words) as bytes and an end symbol. Every symbol is a path of
binary decisions in the Huffman tree of its predecessor (trees of the training
pair counts), so a byte costs about three decisions instead of eight.

* Predictors: for each decision, ``CONTEXTS`` (the last three, six and nine bytes,
  the word begun) hash with the tree node into a table of ``SLOTS`` zero/one
  counters each. The counters are summed over all training texts: every task
  counts its own texts, Spark adds the exact counts block by block, and only the
  sums are scaled to bytes, so the table does not depend on the partitions.
* Mixing: a counter is one of ``STATES`` states. All decisions of all training
  texts are counted by the states of their contexts (:func:`_learn`; the counts of a
  decision leave out the decision itself). From these exact sums come the
  log odds of every state and, by Newton steps, the weights with which a gate, the
  contexts' levels of evidence, adds them up; the outcomes of each combination of
  states correct its mix. Neither the counters nor the weights depend on how the input is split.
* Refinement: while a text is scored, offsets per log-odds range are adapted to
  it after each block of ``BLOCK`` symbols, starting from zero.

The sum of the decisions' log probabilities is the text's; the total in bits
over the bytes of the token sequence is ``bits_per_byte``. All texts of a chunk advance
together, block by block, in slices of ``SLICE`` symbols. The counter tables have a fixed size (the broadcast is
``CONTEXTS * SLOTS * 2`` bytes, 32 MB, at any input size); what is counted and
merged grows with the corpus.

Base: token counts are exact. Tokens that hold at least 1/2**20 of all (at most
1,048,576) are broadcast; every other (text, token) pair is joined on the
token's 64-bit hash with its count.

Defined cases: null text is empty and scored (its end symbol); rows with a null
doc_id are held out; repeated rows are scored and learned from each; without
training rows all probabilities are those of the empty model; an empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored
from rivulet.llm.textcore import (
    _BASE, _BYTE, _INV, _M1, LOWER, SPACE, Words, chunks, powers, text_bytes,
)

ORDERS, SLOT_BITS = (3, 6, 9), 22
CONTEXTS, SLOTS, PART = len(ORDERS) + 1, 1 << SLOT_BITS, 1 << 13
BLOCK, STATES, LEVELS, RANGES = 192, 32, 7, 12
GATES, CELLS = LEVELS ** CONTEXTS, STATES ** CONTEXTS
SLICE, CHUNK, OWN = 1 << 16, 1 << 18, 30.0
COMMON = 1 << 20
END = 256
END_TOKEN = np.uint64(0x5851F42D4C957F2D)
_FIRST = 256  # "predecessor" of a text's first symbol


# --- binary decisions -------------------------------------------------------

def huffman(counts: np.ndarray):
    """Trees of all predecessors from pair counts (257, 257).

    Returns ``(length, offset, path)``: ``path[offset[pair] + j]`` is
    ``2 * node + bit`` of the pair's j-th decision.
    """
    length = np.zeros(257 * 257, np.int64)
    offset = np.zeros(257 * 257, np.int64)
    path: list[int] = []
    for prev in range(257):
        heap = [(int(c) * 4096 + 1, s, s) for s, c in enumerate(counts[prev])]
        heapq.heapify(heap)
        up: dict[int, tuple[int, int]] = {}
        for k in range(257, 513):
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            up[a[2]], up[b[2]] = (k, 0), (k, 1)
            heapq.heappush(heap, (a[0] + b[0], k, k))
        for s in range(257):
            steps, k = [], s
            while k in up:
                k, bit = up[k]
                steps.append(2 * (k - 257) + bit)
            offset[prev * 257 + s], length[prev * 257 + s] = len(path), len(steps)
            path += reversed(steps)
    return length.astype(np.int32), offset.astype(np.int32), np.array(path, np.int16)


def canonical(data: np.ndarray, off: np.ndarray, words: Words):
    """The token sequence as bytes: folded words with one space between them."""
    keep = ~SPACE[data]
    between = words.end[:-1][words.doc[1:] == words.doc[:-1]]
    keep[between] = True
    data = LOWER[data]
    data[between] = 32
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[off]


def pair_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(predecessor, symbol) counts of a chunk, flat."""
    symbol, prev, *_ = symbols(data, off)
    return np.bincount(prev * np.int32(257) + symbol, minlength=257 * 257)


def symbols(data: np.ndarray, off: np.ndarray):
    """``symbol, prev, row, place`` of all texts, each closed by END."""
    rows = len(off) - 1
    size = np.diff(off) + 1
    start = np.concatenate(([0], np.cumsum(size)))
    row = np.repeat(np.arange(rows, dtype=np.int32), size)
    symbol = np.full(start[-1], END, np.int32)
    last = np.zeros(start[-1], bool)
    last[start[1:] - 1] = True
    symbol[~last] = data
    prev = np.empty_like(symbol)
    prev[1:] = symbol[:-1]
    prev[start[:-1]] = _FIRST
    place = np.arange(len(symbol), dtype=np.int32) - start.astype(np.int32)[:-1][row]
    return symbol, prev, row, place


def word_begun(symbol: np.ndarray, place: np.ndarray):
    """Sums of hashed bytes, and at each symbol where its word began (the white space
    before it)."""
    n = len(symbol)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[symbol] * powers(_BASE, n), out=total[1:])
    at = np.arange(n, dtype=np.int32)
    begun = np.zeros(n, np.int32)
    np.maximum.accumulate(np.where(_GAP[symbol[:-1]], at[1:], 0), out=begun[1:])
    return total, np.maximum(begun, at - place)


def contexts(prev: np.ndarray, place: np.ndarray, word, order: np.ndarray) -> list[np.ndarray]:
    """32-bit hashes of the contexts at the symbols ``order``: the last bytes, and
    the word begun."""
    out, hashed = [], prev[order].astype(np.uint32) * np.uint32(0x2C1B3C6D)
    depth = place[order]
    for back in range(2, max(ORDERS) + 1):
        older = prev[np.maximum(order - (back - 1), 0)].astype(np.uint32)
        older[depth < back - 1] = _FIRST
        hashed = (hashed ^ older) * np.uint32(0x297A2D39 + 2 * back)
        hashed ^= hashed >> np.uint32(15)
        if back in ORDERS:
            out.append(hashed)
    total, begun = word[0], word[1][order]
    h = (total[order] - total[begun]) * powers(_INV, len(prev))[begun] * _M1
    return [*out, (h >> np.uint64(32)).astype(np.uint32)]


_GAP = np.concatenate((SPACE, [True]))
_VALUE = np.concatenate((_BYTE, [np.uint64(1)]))


def decisions(code, data: np.ndarray, off: np.ndarray):
    """All decisions of a chunk, ordered by block and row, in slices.

    Yields ``(slots, bit, row, step)``: per context the slot of each decision,
    its outcome, the row, and the indexes at which blocks begin, and the end.
    """
    length, offset, path = code
    symbol, prev, row, place = symbols(data, off)
    if not len(symbol):
        return
    word = word_begun(symbol, place)
    block = place // np.int32(BLOCK)
    # int16 is sorted by radix.
    order = np.argsort(block.astype(np.int16) if block.max() < 32768 else block, kind="stable")
    block, row = block[order], row[order]
    fresh = np.flatnonzero(np.concatenate(
        ([True], (block[1:] != block[:-1]) | (row[1:] != row[:-1]), [True])))
    # A block of a text is never cut.
    cuts = np.unique(fresh[np.searchsorted(fresh, np.arange(0, len(order) + SLICE, SLICE))
                           .clip(max=len(fresh) - 1)])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        at = order[lo:hi]
        pair = prev[at] * np.int32(257) + symbol[at]
        size = length.take(pair)
        first = np.cumsum(size, dtype=np.int32) - size
        step = np.repeat(offset.take(pair) - first, size)
        step += np.arange(len(step), dtype=np.int32)
        node = path.take(step)
        salt = (node >> 1).astype(np.uint32)
        salt *= np.uint32(0x9E3779B1)
        slots = []
        for h in contexts(prev, place, word, at):
            x = np.repeat(h, size)
            x ^= salt
            x *= np.uint32(0x85EBCA6B)
            x >>= np.uint32(32 - SLOT_BITS)
            slots.append(x)
        blocks = block[lo:hi]
        edge = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
        yield (slots, (node & 1).astype(bool), np.repeat(row[lo:hi], size),
               np.append(first[edge], len(node)))


# --- counters ----------------------------------------------------------------

def _pack(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Counts as two bytes; larger ones are scaled down together."""
    scale = 255 / np.maximum(np.maximum(zero, one), 255)
    low = np.where(zero > 0, np.maximum(1, np.rint(zero * scale)), 0)
    high = np.where(one > 0, np.maximum(1, np.rint(one * scale)), 0)
    return (low + 256 * high).astype(np.uint16)


def _squeeze(counts: np.ndarray) -> bytes:
    """Exact counts, compressed: a byte each, then those that do not fit."""
    return zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes()
                         + counts[counts >= 255].astype(np.uint64).tobytes(), 1)


def _unsqueeze(packed: bytes) -> np.ndarray:
    data = zlib.decompress(packed)
    counts = np.frombuffer(data, np.uint8, PART * 2).astype(np.uint64)
    counts[counts == 255] = np.frombuffer(data, np.uint64, offset=PART * 2)
    return counts


def states(skip: int | None = None) -> np.ndarray:
    """State of each packed count; ``skip``: without one observation of that outcome."""
    zero, one = np.arange(65536) & 255, np.arange(65536) >> 8
    if skip == 0:
        zero = np.maximum(zero - 1, 0)
    if skip == 1:
        one = np.maximum(one - 1, 0)
    n, less = zero + one, np.minimum(zero, one)
    sure = 1 + 2 * np.searchsorted([2, 3, 5, 15], n, "right") + (one > 0)
    odds = np.log((one + 0.4) / (zero + 0.4))
    mixed = np.select(  # 5, 7 and 9 ranges of the odds
        [n < 8, n < 41], [13 + np.rint(odds / 0.6).clip(-2, 2), 19 + np.rint(odds / 0.8).clip(-3, 3)],
        27 + np.rint(odds).clip(-4, 4))
    return np.where(n == 0, 0, np.where(less == 0, sure, mixed)).astype(np.uint8)


def _level(state: np.ndarray) -> np.ndarray:
    """Level of evidence of a state: none, once, two to four times or more and all alike
    (1 to 3), mixed (4 to 6)."""
    return np.array([0, 1, 1, *[2] * 4, *[3] * 4, *[4] * 5, *[5] * 7, *[6] * 9])[state]


def _count(code):
    """Per task, its counters in parts of ``PART`` slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((CONTEXTS, SLOTS * 2), np.uint32)
        some = False
        for b in chunks(batches, "text", CHUNK):
            data, off = text_bytes(b.column("text"))
            some = some or b.num_rows > 0
            for slots, bit, _, _ in decisions(code.value,
                                              *canonical(data, off, Words(data, off))):
                for k in range(CONTEXTS):
                    np.add.at(table[k], (slots[k].astype(np.int64) << 1) + bit, np.uint32(1))
        if not some:
            return
        for k in range(CONTEXTS):
            for part in range(SLOTS // PART):
                t = table[k, part * PART * 2:(part + 1) * PART * 2]
                if t.any():
                    yield pa.RecordBatch.from_pydict({
                        "part": [k * (SLOTS // PART) + part],
                        "counts": [_squeeze(t)]})
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the rows of each part; they arrive sorted by part."""
    part, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"part": [part], "counts": [_pack(total[::2], total[1::2]).tobytes()]})

    for b in batches:
        for k in range(b.num_rows):
            p, c = b.column("part")[k].as_py(), _unsqueeze(b.column("counts")[k].as_py())
            if p != part:
                if part is not None:
                    yield row()
                part, total = p, np.zeros(PART * 2, np.uint64)
            total += c
    if part is not None:
        yield row()


# --- mixing ------------------------------------------------------------------

def _cell(state: list[np.ndarray]) -> np.ndarray:
    cell = state[0].astype(np.int64)
    for s in state[1:]:
        cell *= STATES
        cell += s
    return cell


def _learn(code, table):
    """Decisions of the task's texts by the states of their contexts: ``cell, zero, one``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without = np.concatenate((states(0), states(1)))
        seen = np.zeros(2 * CELLS, np.int64)
        for b in chunks(batches, "text", CHUNK):
            data, off = text_bytes(b.column("text"))
            for slots, bit, _, _ in decisions(code.value,
                                              *canonical(data, off, Words(data, off))):
                high = bit.astype(np.int32) << 16
                cell = _cell([without.take(table.value[k].take(slots[k]) | high)
                              for k in range(CONTEXTS)])
                cell *= 2
                cell += bit
                np.add.at(seen, cell, 1)
        pair = seen.reshape(CELLS, 2)
        at = np.flatnonzero(pair.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(pair[at, 0]), pa.array(pair[at, 1])], ["cell", "zero", "one"])
    return run


def fit(zero: np.ndarray, one: np.ndarray, steps: int = 12) -> np.ndarray:
    """Log odds of every cell from the decisions seen in each (``CELLS`` numbers): the mix
    of its states, and ``OWN`` decisions of it weigh as much as the cell's own."""
    rest, state = np.arange(CELLS), []
    for _ in range(CONTEXTS):
        rest, s = np.divmod(rest, STATES)
        state.insert(0, s)
    gate, x = np.zeros(CELLS, np.int64), []
    for s in state:
        gate = gate * LEVELS + _level(s)
        odds = np.log((np.bincount(s, one, STATES) + 0.4) / (np.bincount(s, zero, STATES) + 0.4))
        x.append(odds[s])
    x = np.stack([*x, np.ones(CELLS)], 1)
    n, wide, prior = zero + one, CONTEXTS + 1, 2.0
    start = np.array([0.4] * CONTEXTS + [0.0])
    w = np.tile(start, (GATES, 1))
    used = n > 0
    g, xu, nu, ou = gate[used], x[used], n[used], one[used]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip((w[g] * xu).sum(1), -15, 15)))
        slope = np.stack([np.bincount(g, (ou - nu * p) * xu[:, k], GATES)
                          for k in range(wide)], 1) - prior * (w - start)
        bend = np.stack([np.stack([np.bincount(g, nu * p * (1 - p) * xu[:, j] * xu[:, k], GATES)
                                   for j in range(wide)], 1)
                         for k in range(wide)], 1) + prior * np.eye(wide)
        move = np.linalg.solve(bend, slope[..., None])[..., 0]
        w += move / np.maximum(1, np.abs(move).max(1, keepdims=True))
    p = 1 / (1 + np.exp(-np.clip((w[gate] * x).sum(1), -15, 15)))
    odds = np.log(one + OWN * p) - np.log(zero + OWN * (1 - p))
    return np.clip(odds, -12, 12).astype(np.float32)


def log10_probabilities(model, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """log10 probability of each text of a chunk, refined while it is read."""
    code, table, odds = model
    rows = len(off) - 1
    total = np.zeros(rows)
    shift = np.zeros(rows * RANGES, np.float32)
    seen = np.full(rows * RANGES, 20.0, np.float32)
    for slots, bit, row, step in decisions(code, data, off):
        z = odds.take(_cell([table[k].take(slots[k]) for k in range(CONTEXTS)]))
        key = row * np.int64(RANGES) + RANGES // 2
        key += np.floor(z).clip(-RANGES // 2, RANGES // 2 - 1).astype(np.int64)
        sign = 1 - 2 * bit.astype(np.float32)
        z *= sign
        for a, b in zip(step[:-1], step[1:], strict=True):
            k, s, x = key[a:b], sign[a:b], z[a:b]
            x += shift.take(k) * s
            np.exp(x, out=x)  # odds of the other outcome
            x += 1
            lo, hi = int(k.min()), int(k.max()) + 1
            err = s / x - s  # outcome less its probability
            k = k - lo
            seen[lo:hi] += np.bincount(k, minlength=hi - lo)
            shift[lo:hi] += 2 * np.bincount(k, err, hi - lo).astype(np.float32) / seen[lo:hi]
        total -= np.bincount(row, np.log(z), rows)
    return total / np.log(10)


# --- training and scoring ---------------------------------------------------------

def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts (kind 0) and symbol pair counts (kind 1) of the task's texts."""
    held, times, size, pairs, texts = [], [], 0, np.zeros(257 * 257, np.int64), 0

    def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n)],
            ["kind", "key", "n"])

    def merged():
        token, inverse = np.unique(np.concatenate(held), return_inverse=True)
        return token, np.bincount(inverse, np.concatenate(times)).astype(np.int64)

    for b in chunks(batches, "text"):
        data, off = text_bytes(b.column("text"))
        texts += b.num_rows
        words = Words(data, off)
        pairs += pair_counts(*canonical(data, off, words))
        token, n = np.unique(words.hash, return_counts=True)
        held.append(token)
        times.append(n)
        size += len(token)
        if size > 1 << 21:
            token, n = merged()
            if len(token) > 1 << 20:
                yield rows(0, token.view(np.int64), n)
                token, n = token[:0], n[:0]
            held, times, size = [token], [n], len(token)
    if texts:
        held.append(np.array([END_TOKEN]))
        times.append(np.array([texts]))
        token, n = merged()
        yield rows(0, token.view(np.int64), n)
        at = np.flatnonzero(pairs)
        yield rows(1, at, pairs[at])


class Model:
    """Trained state: ``code``, the states ``table``, the cells' ``odds``, and the token
    counts ``(token, n)``."""

    def __init__(self, code, table, odds, counts: DataFrame, tokens: int, distinct: int):
        self.code, self.table, self.odds = code, table, odds
        self.counts, self.tokens, self.distinct = counts, tokens, distinct


def train(docs: DataFrame) -> Model:
    """Model of the whole texts of ``docs(text)``."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select("text")
    tally = stored(texts.mapInArrow(_tally, "kind int, key bigint, n bigint"), "lm-tally")
    counts = stored(tally.where("kind = 0").groupBy(F.col("key").alias("token"))
                    .agg(F.sum("n").alias("n")), "lm-tokens")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    pairs = tally.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    grid = np.zeros(257 * 257, np.int64)
    grid[np.asarray(pairs["key"])] = np.asarray(pairs["n"])
    code = huffman(grid.reshape(257, 257))
    shared = sc.broadcast(code)
    parts = (texts.mapInArrow(_count(shared), "part bigint, counts binary")
             .repartition("part").sortWithinPartitions("part")
             .mapInArrow(_merge, "part bigint, counts binary"))
    table = np.zeros((CONTEXTS * (SLOTS // PART), PART), np.uint16)
    for r in stored(parts, "lm-counters").toLocalIterator():  # CONTEXTS * SLOTS * 2 bytes in all
        table[r["part"]] = np.frombuffer(r["counts"], np.uint16)
    table = table.reshape(CONTEXTS, SLOTS)
    counters = sc.broadcast(table)
    cells = stored(texts.mapInArrow(_learn(shared, counters),
                                    "cell bigint, zero bigint, one bigint")
                   .groupBy("cell").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")),
                   "lm-cells").toArrow()  # at most CELLS rows
    counters.destroy()
    shared.destroy()
    zero, one = np.zeros(CELLS), np.zeros(CELLS)
    at = np.asarray(cells["cell"])
    zero[at], one[at] = np.asarray(cells["zero"]), np.asarray(cells["one"])
    return Model(code, states().take(table), fit(zero, one), counts, tokens, distinct)


def _score(model, common, total: float):
    """Kind 0: ``row, doc_id`` and all sums of a text; kind 1: a token that is not
    common, ``row, token, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, count = common.value
        task = TaskContext.get().partitionId() << 33
        done = 0
        names = ["row", "doc_id", "token", "n", "known", "base", "score", "bytes"]
        for b in chunks(batches, "text", CHUNK):
            data, off = text_bytes(b.column("text"))
            rows = b.num_rows
            key = task + done + np.arange(rows)
            done += rows
            w = Words(data, off)
            h = np.concatenate((w.hash, np.full(rows, END_TOKEN)))
            doc = np.concatenate((w.doc, np.arange(rows)))
            if len(token):
                at = np.minimum(np.searchsorted(token, h), len(token) - 1)
                hit = token[at] == h
            else:
                at, hit = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
            base = np.bincount(doc[hit], np.log10((count[at[hit]] + 1) / total), rows)
            known = np.bincount(doc[hit], minlength=rows)
            data, off = canonical(data, off, w)
            score = log10_probabilities(model.value, data, off)
            none = pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), b.column("doc_id"), none, pa.array(w.count + 1), pa.array(known),
                 pa.array(base.astype(float)), pa.array(score), pa.array(np.diff(off))], names)
            h, doc = h[~hit], doc[~hit]
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            if not len(h):
                continue
            first = np.flatnonzero(np.concatenate(
                ([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))))
            n = np.diff(np.append(first, len(h)))
            none, real = pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[doc[first]]), none, pa.array(h[first].view(np.int64)), pa.array(n),
                 none, real, real, none], names)
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte``."""
    sc = docs.sparkSession.sparkContext
    total = float(model.tokens + model.distinct + 1)
    least = -(-model.tokens // COMMON)
    often = model.counts.where(F.col("n") >= least).toArrow()  # at most COMMON rows
    token = np.asarray(often["token"].combine_chunks(), np.int64).view(np.uint64)
    order = np.argsort(token)
    common = sc.broadcast((token[order], np.asarray(often["n"].combine_chunks())[order]))
    shared = sc.broadcast((model.code, model.table, model.odds))
    rows = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _score(shared, common, total),
        "row bigint, doc_id bigint, token bigint, n bigint, known bigint, base double, "
        "score double, bytes bigint"), "lm-scores")
    shared.destroy()
    common.destroy()
    texts = rows.where("score IS NOT NULL").drop("token")
    rest = (rows.where("score IS NULL").select("row", "token", "n")
            .join(model.counts.where(F.col("n") < least)
                  .select("token", F.col("n").alias("c")), "token", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"),
                F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(total)))
                .alias("tail")))
    return texts.join(rest, "row", "left").select(
        "doc_id", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail", F.lit(0.0))).alias("base_score"), "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.greatest("bytes", F.lit(1)))
        .alias("bits_per_byte"))


def _held_out() -> Column:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return F.coalesce(remainder == 2, F.lit(True))


def op4_scores(docs: DataFrame) -> DataFrame:
    """The digest columns over all ``docs``, learned from rows that are not held out."""
    model = train(docs.where(~_held_out()))
    return score(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "bits_per_byte")
