"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are counts and ratios of the bytes, words and lines of the whole text,
computed for many documents at once (``features``). The trees are fitted with
logistic loss on binned features: each level sums gradients and Hessians per
(node, feature, bin) and takes the split with the largest gain. They are then
flattened into arrays (feature, threshold, children, value), and scoring walks
all trees for all documents of a chunk as one index array.

The model is fitted on a bounded sample of labelled rows (``max_rows``, those with
the smallest hash of doc_id; a documented bound), whose features only (26 numbers
a row) reach the driver. Scoring is one map over all documents; nothing is
shuffled but the labels.

Defined cases: null text counts as empty, and empty texts get the score of
their features; null labels and null doc_ids are not learned from; repeated
label or document rows each count; with no labelled row, or one class only, the
score is constant; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.textcore import SPACE, Words, chunks, mix, row_sums, text_bytes

MAX_ROWS, WIDTH = 20_000, 26
SHAPE = {"trees": 80, "depth": 4, "bins": 64, "rate": 0.15, "l2": 1.0, "least": 8}

_KIND = np.zeros((256, 6), bool)  # upper, lower, digit, sentence end, symbol, not ASCII
_KIND[65:91, 0] = _KIND[97:123, 1] = _KIND[48:58, 2] = _KIND[128:, 5] = True
_KIND[[33, 46, 63], 3] = True
_KIND[33:128, 4] = ~_KIND[33:128, :4].any(1)
_KIND[[39, 44, 45], 4] = False  # apostrophe, comma, hyphen belong to prose
_KIND_CODE = np.where(_KIND.any(1), _KIND.argmax(1), np.where(SPACE, 6, 7)).astype(np.uint8)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Statistics of each text, float64 (rows, 26)."""
    rows = len(off) - 1
    size = np.diff(off).astype(np.float64)
    at = np.repeat(np.arange(rows), np.diff(off))
    w = Words(data, off)
    n = w.count.astype(np.float64)
    some, chars = np.maximum(n, 1), np.maximum(size, 1)
    kinds = np.bincount(at * 8 + _KIND_CODE[data], minlength=rows * 8).reshape(rows, 8)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 5], 1)
    out = [np.log1p(size), np.log1p(n), kinds[:, 0] / letters]
    out += [kinds[:, k] / chars for k in (2, 3, 4, 5, 6)]

    length = (w.end - w.start).astype(np.float64)
    mean = row_sums(length, w.doc, rows) / some
    square = row_sums(length * length, w.doc, rows) / some
    out += [mean, np.sqrt(np.maximum(square - mean * mean, 0))]
    last = _KIND_CODE[data[w.end - 1]] if len(length) else np.empty(0, np.uint8)
    first = _KIND_CODE[data[w.start]] if len(length) else np.empty(0, np.uint8)
    for flag in (last == 4, first == 4, last == 3, first == 0, first == 2, length == 1,
                 (first == 0) & (length > 1) & (last == 3)):
        out.append(row_sums(flag.astype(np.float64), w.doc, rows) / some)
    same = np.zeros(len(length), bool)
    if len(length):
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    out.append(row_sums(same.astype(np.float64), w.doc, rows) / some)

    def variety(hashes, doc, count):
        """Distinct share, largest share and normalised entropy of each row's items."""
        order = np.lexsort((hashes, doc))
        h, d = hashes[order], doc[order]
        if not len(h):
            return [np.zeros(rows), np.zeros(rows), np.ones(rows)]
        begin = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))))
        times = np.diff(np.append(begin, len(h))).astype(np.float64)
        d = d[begin]
        total = np.maximum(count, 1)
        top = np.zeros(rows)
        rows_at = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        top[d[rows_at]] = np.maximum.reduceat(times, rows_at)
        bits = row_sums(times * np.log(times), d, rows)
        return [np.bincount(d, minlength=rows) / total, top / total,
                1 - bits / (total * np.log(total + 1))]

    out += variety(w.hash, w.doc, n)
    # Lines: a sum over their words' hashes (with the place in the line).
    newline = np.flatnonzero(data == 10)
    line = np.searchsorted(newline, w.start) + w.doc  # grows with both
    begin = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) \
        if len(line) else np.empty(0, np.int64)
    place = np.arange(len(line)) - np.repeat(begin, np.diff(np.append(begin, len(line))))
    value = np.add.reduceat(w.hash * mix(place.astype(np.uint64) + np.uint64(1)), begin) \
        if len(begin) else np.empty(0, np.uint64)
    lines = np.bincount(w.doc[begin], minlength=rows).astype(np.float64) \
        if len(begin) else np.zeros(rows)
    out += [np.log1p(lines), n / np.maximum(lines, 1)]
    out += variety(value, w.doc[begin] if len(begin) else begin, lines)
    return np.stack(out, 1)


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 64,
        rate: float = 0.15, l2: float = 1.0, least: int = 8) -> dict:
    """Boosted trees as flat arrays; ``y`` is 0 or 1."""
    rows, width = x.shape
    share = (y.sum() + 1.0) / (rows + 2.0)
    base = float(np.log(share / (1 - share)))
    model = {"base": base, "depth": depth, "feature": [], "threshold": [], "left": [],
             "right": [], "value": [], "root": []}
    if rows and 0 < y.sum() < rows:
        marks = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
                 for f in range(width)]
        code = np.stack([np.searchsorted(m, x[:, f]) for f, m in enumerate(marks)], 1)
        score = np.full(rows, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            score += _grow(model, code, marks, p - y, p * (1 - p), depth, bins, rate, l2, least)
    out = {k: np.array(v) for k, v in model.items() if isinstance(v, list)}
    return out | {"base": base, "depth": depth}


def _grow(model, code, marks, grad, hess, depth, bins, rate, l2, least) -> np.ndarray:
    """Adds one tree; returns its values for the training rows."""
    rows, width = code.shape

    def leaf(g: float, h: float) -> int:
        model["feature"].append(0)
        model["threshold"].append(np.inf)
        model["value"].append(-rate * g / (h + l2))
        model["left"].append(len(model["left"]))  # a leaf leads to itself
        model["right"].append(len(model["right"]))
        return len(model["left"]) - 1

    root = leaf(grad.sum(), hess.sum())
    model["root"].append(root)
    node, open_nodes = np.full(rows, root), [root]
    for _ in range(depth):
        if not open_nodes:
            break
        slot = {k: i for i, k in enumerate(open_nodes)}
        place = np.array([slot.get(k, -1) for k in range(root, len(model["left"]))])[node - root]
        live = place >= 0
        key = place[live] * bins
        best = [(1e-9, -1, -1)] * len(open_nodes)
        for f in range(width):
            k = key + code[live, f]
            size = len(open_nodes) * bins
            g, h, c = (np.bincount(k, v, size).reshape(-1, bins).cumsum(1)
                       for v in (grad[live], hess[live], None))
            total_g, total_h, total_c = g[:, -1:], h[:, -1:], c[:, -1:]
            gain = (g * g / (h + l2) + (total_g - g) ** 2 / (total_h - h + l2)
                    - total_g ** 2 / (total_h + l2))
            gain[(c < least) | (total_c - c < least)] = -1
            gain = gain[:, :len(marks[f])]
            if not gain.shape[1]:
                continue
            top = gain.argmax(1)
            for i, b in enumerate(top):
                if gain[i, b] > best[i][0]:
                    best[i] = (gain[i, b], f, int(b))
        following = []
        for k, (_, f, b) in zip(open_nodes, best, strict=True):
            if f < 0:
                continue
            mine = node == k
            low = mine & (code[:, f] <= b)
            high = mine & ~low
            model["feature"][k], model["threshold"][k] = f, marks[f][b]
            model["left"][k] = leaf(grad[low].sum(), hess[low].sum())
            model["right"][k] = leaf(grad[high].sum(), hess[high].sum())
            node[low], node[high] = model["left"][k], model["right"][k]
            following += [model["left"][k], model["right"][k]]
        open_nodes = following
    return np.array(model["value"][root:])[node - root]


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1: all trees are walked for all rows at once."""
    score = np.full(len(x), model["base"])
    if len(model["root"]):
        node = np.broadcast_to(model["root"], (len(x), len(model["root"])))
        row = np.arange(len(x))[:, None]
        for _ in range(model["depth"]):
            low = x[row, model["feature"][node]] <= model["threshold"][node]
            node = np.where(low, model["left"][node], model["right"][node])
        score = score + model["value"][node].sum(1)
    return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches, "text"):
        x = features(*text_bytes(b.column("text")))
        off = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("y"), pa.ListArray.from_arrays(off, pa.array(x.ravel()))],
            ["doc_id", "y", "x"])


def _scores(model, names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text):
            score = predict(model.value, features(*text_bytes(b.column(text))))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(score)], [*names, "score"])
    return run


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
          max_rows: int = MAX_ROWS) -> dict:
    """Model of ``labels.quality`` from the texts of labelled ``docs``; ``usable`` is a
    condition on doc_id for rows that may be learned from."""
    sample = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    if usable is not None:
        sample = sample.where(usable)
    sample = (sample.select("doc_id", F.col("quality").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows))
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .join(F.broadcast(sample), "doc_id")  # max_rows rows
            .select("doc_id", "y", "text")
            .mapInArrow(_features, "doc_id bigint, y int, x array<double>")
            # A labelled doc_id may stand on many rows: the bound holds for those, too.
            .orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(max_rows)
            .select("y", "x").toArrow())
    y = np.asarray(rows["y"].combine_chunks(), np.float64)
    x = np.asarray(rows["x"].combine_chunks().flatten(), np.float64).reshape(len(y), WIDTH)
    order = np.lexsort((*x.T, y))  # the model does not depend on the order of arrival
    return fit(x[order], y[order], **SHAPE)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with a column ``quality_score`` in [0, 1]."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"k{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    plain = docs.toDF(*names)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}"
                       for n, f in zip(names, docs.schema.fields, strict=True))
    out = plain.mapInArrow(_scores(shared, names, text), f"{schema}, score double")
    return out.toDF(*docs.columns, "quality_score")


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op3_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; rows with a null doc_id are held out."""
    model = train(docs, labels, remainder(5) != 0)
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out"),
                      F.col("quality_score").alias("score"),
                      (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))
