"""Benchmark decontamination by latent semantic retrieval.

The benchmark's items are cut into passages of at most three blocks of ``BLOCK`` words.
They are a stated query set, taken in blocks of about ``PASSAGES`` passages (all of
an item in one), one after another; for each, every window of every document is
searched:

1. Statistics: over all documents, cut into blocks of ``BLOCK`` words, the number of
   blocks that hold each word of the passages gives inverse block frequencies.
2. Latent spaces: the passages are TF-IDF rows, in spaces of about ``SPACE`` passages.
   A randomised SVD gives a space's ``RANK`` leading directions: tasks multiply their
   passages with the current basis, Spark sums the products per word, and the driver
   only orthonormalises the basis. As rank and space go together, a space keeps
   nearly all of each of its passages, however many passages there are.
3. Candidate search: a window is two neighbouring blocks of a document, folded into
   the space. The projection of the window on a passage, divided by what the space
   keeps of the passage itself, estimates the share of the passage that the window
   holds - it is the cosine against the one that a window with the whole passage
   would have. From ``NEAR`` on the passage is a candidate there. As a second, exact
   way, word-for-word copies are found in place at each occurrence of the passage's
   heaviest word; passages of fewer than ``SHORT`` words have no other way.
4. Checks on the candidate's surroundings, in the same task: the longest common
   subsequence with the passage, weighted by inverse frequency, is a copy from
   ``COPY`` of the passage's weight on. From ``PARAPHRASE`` on it is a paraphrase
   if the passage's answer, its rarest third of words, is there as well
   (``ANSWER`` of its weight). Passages of fewer than ``SHORT`` words must be
   there word for word.

A document is a hit for an item if any of the item's passages is found, so only
counters and basis products are shuffled, and no group of equal documents or
frequent passage meets in a task. What a block sends to the tasks is bounded by its
passages, and freed before the next block.

Words are runs without ASCII white space and punctuation, in lower case. Defined cases:
null and empty documents and items match nothing; a null item_id or doc_id is carried
as null; repeated items give one hit per item_id, repeated documents one hit each; an
empty table on either side gives no hits; very long texts are read whole, their
windows in turns. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored
from rivulet.llm.textcore import NOT_WORD, Words, chunks, text_bytes

BLOCK, PASSAGES, SPACE, RANK, NEAR = 24, 2048, 256, 256, 0.3
COPY, PARAPHRASE, ANSWER, SHORT = 0.65, 0.55, 0.55, 8
_OVER, _STEPS = 16, 2
# Blocks whose latent vectors are held at a time.
TURN = 4096


def _words(texts: pa.Array) -> Words:
    return Words(*text_bytes(texts), NOT_WORD)


def _blocks(w: Words):
    """Block of each word (blocks do not cross rows) and the row of each block."""
    first = np.concatenate(([0], np.cumsum(w.count)))
    per_row = -(-w.count // BLOCK)
    start = np.concatenate(([0], np.cumsum(per_row)))
    place = np.arange(len(w.doc)) - first[w.doc]
    return start[w.doc] + place // BLOCK, np.repeat(np.arange(len(w.count)), per_row)


def _known(vocab: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted vocabulary, -1 where it is not there."""
    if not len(vocab):
        return np.full(len(hashes), -1)
    at = np.searchsorted(vocab, hashes)
    at[at == len(vocab)] = 0
    return np.where(vocab[at] == hashes, at, -1)


def _once(block: np.ndarray, at: np.ndarray, size: int):
    """Distinct ``(block, word)`` of the known words, sorted by both."""
    key = np.sort(block * size + at)
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return np.divmod(key, max(size, 1))


def weights(docs: DataFrame, vocab: np.ndarray) -> np.ndarray:
    """Inverse block frequency of each word of ``vocab`` over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total, blocks = np.zeros(len(known) + 1, np.int64), 0
        for b in chunks(batches, "text"):
            w = _words(b.column("text"))
            block, rows = _blocks(w)
            at = _known(known, w.hash)
            here = at >= 0
            total[:-1] += np.bincount(_once(block[here], at[here], len(known))[1],
                                      minlength=len(known))
            blocks += len(rows)
        total[-1] = blocks
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    counts = (docs.select("text").mapInArrow(run, "word bigint, n bigint")
              .groupBy("word").agg(F.sum("n").alias("n")).toArrow())
    shared.destroy()
    n = np.zeros(len(vocab) + 1, np.float64)
    n[np.asarray(counts["word"], np.int64)] = np.asarray(counts["n"], np.float64)
    return np.maximum(np.log1p(n[-1] / np.maximum(n[:-1], 1)), 1e-6)


def passages(texts: pa.Array) -> list[tuple[int, np.ndarray]]:
    """``(row, word hashes)``: each text as equal runs of at most three blocks."""
    w = _words(texts)
    first = np.concatenate(([0], np.cumsum(w.count)))
    out = []
    for row, n in enumerate(w.count):
        if n:
            cuts = np.linspace(0, n, -(-int(n) // (3 * BLOCK)) + 1).astype(int)
            out += [(row, w.hash[first[row] + a:first[row] + b])
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = passages(b.column("text"))
        ids = b.column("item_id").take(pa.array([r for r, _ in found], pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([h.view(np.int64) for _, h in found], pa.list_(pa.int64()))],
            ["item_id", "words"])


def _row(words: np.ndarray, vocab: np.ndarray, idf: np.ndarray):
    """Columns and TF-IDF values of a passage, and their length."""
    at, times = np.unique(_known(vocab, words), return_counts=True)
    value = idf[at] * np.sqrt(times)
    return at, value, max(float(np.sqrt((value * value).sum())), 1e-30)


def latent_space(rows: DataFrame, vocab: np.ndarray, idf: np.ndarray, n: int,
                 rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (word, direction) of the unit TF-IDF rows of
    ``rows.words``, ``n`` passages over ``vocab``, by randomised subspace iteration:
    each step is one distributed product of the rows with the basis."""
    sc = rows.sparkSession.sparkContext
    width = max(1, min(rank + _OVER, n, len(vocab)))
    schema = "word bigint, " + ", ".join(f"d{k} double" for k in range(width))

    def product(v: np.ndarray) -> np.ndarray:
        shared = sc.broadcast((vocab, idf, v))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, weight, basis = shared.value
            out = np.zeros(basis.shape)
            for b in batches:
                for passage in b.column("words"):
                    h = passage.values.to_numpy(zero_copy_only=False).view(np.uint64)
                    at, value, length = _row(h, words, weight)
                    value = value / length
                    out[at] += np.outer(value, value @ basis[at])
            at = np.flatnonzero(np.abs(out).sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), *(pa.array(out[at, k]) for k in range(width))],
                ["word", *(f"d{k}" for k in range(width))])

        sums = (rows.select("words").mapInArrow(run, schema).groupBy("word")
                .agg(*(F.sum(f"d{k}").alias(f"d{k}") for k in range(width))).toArrow())
        shared.destroy()
        out = np.zeros(v.shape)
        out[np.asarray(sums["word"], np.int64)] = np.stack(
            [np.asarray(sums[f"d{k}"]) for k in range(width)], 1)
        return out

    basis = np.random.default_rng(8).standard_normal((len(vocab), width))
    for _ in range(_STEPS):
        basis = np.linalg.qr(product(basis))[0]
    small = basis.T @ product(basis)
    value, turn = np.linalg.eigh((small + small.T) / 2)
    lead = np.argsort(-value)[:rank]
    return (basis @ turn[:, lead]).astype(np.float32)


class Space:
    """A latent space and its passages. ``place``: row of ``vectors`` of each word of
    the block's vocabulary (-1: none); ``members``: the passages; ``unit``: their latent
    vectors scaled so that the product with a window's vector estimates the share of the
    passage in it; ``length``: what that is to be multiplied by for the product with the
    latent unit vector."""

    def __init__(self, vocab, idf, own, vectors, members, queries):
        self.place = np.full(len(vocab), -1, np.int32)
        self.place[np.searchsorted(vocab, own)] = np.arange(len(own))
        self.vectors, self.members = vectors, np.array(members)
        unit, length = [], []
        for q in members:
            at, value, size = _row(queries[q], vocab, idf)
            z = (value / size) @ vectors[self.place[at]]
            kept = float(z @ z)
            unit.append(z / (kept * size) if kept > 1e-6 else z * 0)
            length.append(np.sqrt(kept) * size)
        self.unit = np.array(unit, np.float32).T.copy()
        self.length = np.array(length)

    def candidates(self, block, at, value, row, lo: int, hi: int, extra: dict) -> list:
        """``(window, passage, cosine)`` of the windows that start at blocks ``lo`` to
        ``hi``; ``block``, ``at`` and ``value`` are their known words. Windows in
        ``extra`` (passage -> windows) are candidates in any case."""
        here = self.place[at]
        inside = here >= 0
        here, slot, v = here[inside], block[inside] - lo, value[inside].astype(np.float32)
        sums = np.zeros((hi - lo + 1, self.vectors.shape[1]), np.float32)
        for k in range(0, len(here), 1 << 13):
            part = self.vectors[here[k:k + (1 << 13)]] * v[k:k + (1 << 13), None]
            into = slot[k:k + (1 << 13)]
            begin = np.flatnonzero(np.concatenate(([True], into[1:] != into[:-1])))
            sums[into[begin]] += np.add.reduceat(part, begin, axis=0)
        follows = np.zeros(hi - lo, np.float32)
        last = min(hi, len(row) - 1)
        follows[:last - lo] = row[lo + 1:last + 1] == row[lo:last]
        window = sums[:-1] + sums[1:] * follows[:, None]
        share = window @ self.unit
        near = share >= NEAR
        for p, windows in extra.items():
            near[windows - lo, p] = True
        w, p = np.nonzero(near)
        square = np.bincount(block - lo, value * value, hi - lo + 1)
        norm = np.sqrt(np.maximum(square[:-1] + square[1:] * follows, 1e-30))
        cosine = share[w, p] * self.length[p] / norm[w]
        return list(zip((w + lo).tolist(), self.members[p].tolist(), cosine.tolist(), strict=True))


def common_weight(words: np.ndarray, weight: np.ndarray, region: np.ndarray):
    """Weight of the heaviest common subsequence, and the end of its match."""
    best = np.zeros(len(region) + 1)
    for h, v in zip(words, weight, strict=True):
        best[1:] = np.maximum(best[1:], best[:-1] + np.where(region == h, v, 0))
        np.maximum.accumulate(best, out=best)
    return best[-1], int(np.searchsorted(best, best[-1] - 1e-9))


def check(words: np.ndarray, weight: np.ndarray, region: np.ndarray):
    """``(kind, share, answer share, end)`` of a passage in a region, kind None if
    it is not there."""
    n = len(words)
    if n < SHORT:
        spans = np.lib.stride_tricks.sliding_window_view(region, n) \
            if len(region) >= n else np.empty((0, n), np.uint64)
        at = np.flatnonzero((spans == words).all(1))
        return ("copy", 1.0, 1.0, int(at[0]) + n) if len(at) else (None, 0.0, 0.0, 0)
    total = weight.sum()
    if weight[(words[:, None] == region).any(1)].sum() < PARAPHRASE * total * (1 - 1e-9):
        return None, 0.0, 0.0, 0  # in any order
    best, end = common_weight(words, weight, region)
    share = best / total
    rare = np.argsort(-weight, kind="stable")[:-(-n // 3)]
    there = np.isin(words[rare], region)
    answer = (weight[rare] * there).sum() / weight[rare].sum()
    kind = "copy" if share >= COPY else (
        "paraphrase" if share >= PARAPHRASE and answer >= ANSWER else None)
    return kind, float(share), float(answer), end


class Copies:
    """Passages by their heaviest word, to find word-for-word copies in place."""

    def __init__(self, queries: list[np.ndarray], vocab: np.ndarray, idf: np.ndarray):
        self.size = np.array([len(q) for q in queries], np.int64)
        self.padded = np.zeros((len(queries), self.size.max(initial=1)), np.uint64)
        anchor, self.offset = np.empty((2, len(queries)), np.int64)
        for k, q in enumerate(queries):
            self.padded[k, :len(q)] = q
            at = _known(vocab, q)
            self.offset[k] = int(np.argmax(idf[at]))
            anchor[k] = at[self.offset[k]]
        self.passage = np.argsort(anchor, kind="stable")
        self.start = np.searchsorted(anchor[self.passage], np.arange(len(vocab) + 1))

    def find(self, w: Words, at: np.ndarray):
        """``(first word, passage)`` of each copy; ``at``: vocabulary place of each word."""
        word = np.flatnonzero(at >= 0)
        n = self.start[at[word] + 1] - self.start[at[word]]
        word, n = word[n > 0], n[n > 0]
        post = np.arange(n.sum()) + np.repeat(self.start[at[word]] - (np.cumsum(n) - n), n)
        q = self.passage[post]
        s = np.repeat(word, n) - self.offset[q]
        first = np.concatenate(([0], np.cumsum(w.count)))
        row = np.repeat(w.doc[word], n)
        ok = (s >= first[row]) & (s + self.size[q] <= first[row + 1])
        s, q = s[ok], q[ok]
        for j in range(self.padded.shape[1]):
            if not len(s):
                break
            ok = (j >= self.size[q]) | (
                w.hash[np.minimum(s + j, len(w.hash) - 1)] == self.padded[q, j])
            s, q = s[ok], q[ok]
        return s, q


def _search(model, key: pa.DataType):
    schema = pa.schema([("key", key), ("item_id", pa.int64()), ("kind", pa.string()),
                        ("cosine", pa.float64()), ("lcs", pa.float64()),
                        ("answer", pa.float64()), ("end_word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, idf, queries, ids, spaces, copies = model.value
        item_weights = [idf[_known(vocab, q)] for q in queries]
        space_of = {int(q): (s, p) for s, space in enumerate(spaces)
                    for p, q in enumerate(space.members)}
        for b in chunks(batches, "text"):
            w = _words(b.column("text"))
            if not len(w.doc):
                continue
            word_block, row = _blocks(w)
            place = _known(vocab, w.hash)
            start, copied = copies.find(w, place)
            here = place >= 0
            block, at = _once(word_block[here], place[here], len(vocab))
            value = idf[at]
            sure: list[dict] = [{} for _ in spaces]
            found_at = []
            for k, q in zip(word_block[start].tolist(), copied.tolist(), strict=True):
                if q in space_of:
                    s, p = space_of[q]
                    sure[s].setdefault(p, []).append(k)
                else:
                    found_at.append((k, q, 0.0))
            for lo in range(0, len(row), TURN):
                hi = min(lo + TURN, len(row))
                i, j = np.searchsorted(block, (lo, hi + 1))
                for s, space in enumerate(spaces):
                    extra = {p: k for p, windows in sure[s].items()
                             if len(k := np.array([x for x in windows if lo <= x < hi]))}
                    found_at += space.candidates(block[i:j], at[i:j], value[i:j], row, lo, hi, extra)
            first = np.concatenate(([0], np.cumsum(w.count)))
            opens = np.searchsorted(word_block, np.arange(len(row)))
            found: dict[tuple[int, int], tuple] = {}
            for k, q, cosine in found_at:
                words, d = queries[q], int(row[k])
                a = max(first[d], opens[k] - len(words))
                z = min(first[d + 1], opens[k] + 2 * BLOCK + len(words))
                kind, share, answer, end = check(words, item_weights[q], w.hash[a:z])
                pair = (d, ids[q])
                hit = (share, answer, cosine, int(a + end - first[d]), kind)
                if kind and (pair not in found or hit > found[pair]):
                    found[pair] = hit
            if found:
                keys = b.column("key").to_pylist()
                yield pa.RecordBatch.from_pylist(
                    [{"key": keys[d], "item_id": i, "kind": kind, "cosine": cosine, "lcs": share,
                      "answer": answer, "end_word": end}
                     for (d, i), (share, answer, cosine, end, kind) in sorted(
                         found.items(), key=lambda x: (x[0][0], str(x[0][1])))], schema=schema)
    return run


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits of ``docs(key, text)``, one row per document and item. Blocks of
    passages are searched and stored one after another."""
    spark = docs.sparkSession
    kind = docs.schema["key"].dataType.simpleString()
    hit = (f"key {kind}, item_id bigint, kind string, cosine double, lcs double, answer double, "
           "end_word bigint")
    docs = docs.select("key", F.lower("text").alias("text"))
    items = benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.lower("text").alias("text"))
    cut = stored(items.mapInArrow(_cut, "item_id bigint, words array<bigint>"), "passages")
    parts = max(1, -(-cut.count() // PASSAGES))
    out = spark.createDataFrame([], hit)
    for part in range(parts):
        mine = cut.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        table = mine.toArrow()
        if not len(table):
            continue
        ids = table["item_id"].to_pylist()
        queries = [np.array(q, np.int64).view(np.uint64) for q in table["words"].to_pylist()]
        vocab = np.unique(np.concatenate(queries))
        idf = weights(docs, vocab)
        long = mine.where(F.size("words") >= SHORT)
        n_spaces = max(1, -(-sum(len(q) >= SHORT for q in queries) // SPACE))
        # The space of a passage is a hash of its words, here and in the tasks.
        chosen = long.select("words", F.pmod(F.xxhash64("words"), F.lit(n_spaces)).alias("space"))
        spaces = []
        space_of = {q: s for q, s in ((tuple(r["words"]), r["space"]) for r in
                                      chosen.toArrow().to_pylist())}
        for s in range(n_spaces):
            members = [k for k, q in enumerate(queries) if len(q) >= SHORT
                       and space_of[tuple(q.view(np.int64).tolist())] == s]
            if not members:
                continue
            own = np.unique(np.concatenate([queries[k] for k in members]))
            vectors = latent_space(chosen.where(F.col("space") == s), own,
                                   idf[np.searchsorted(vocab, own)], len(members))
            spaces.append(Space(vocab, idf, own, vectors, members, queries))
        model = spark.sparkContext.broadcast(
            (vocab, idf, queries, ids, spaces, Copies(queries, vocab, idf)))
        arrow = pa.string() if kind == "string" else pa.int64()
        out = out.unionByName(stored(docs.mapInArrow(_search(model, arrow), hit), "hits"))
        model.destroy()
    return out


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, kind`` (copy or
    paraphrase), ``cosine`` in the latent space (0 for short passages, which have
    none), ``lcs`` and ``answer`` (shares of weight) and ``end_word``."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("key"), "text")
    return _found(keyed, benchmark).withColumnRenamed("key", "doc_id")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in whose text an item was found; all columns kept.
    Rows go by their text (its digest), so rows that share a doc_id, or have none, are
    judged apart."""
    digest = F.sha2(F.col("text"), 256)
    found = _found(docs.select(digest.alias("key"), "text"), benchmark)
    leaked = found.select(F.col("key").alias("_leaked")).distinct()
    return docs.join(leaked, digest == F.col("_leaked"), "left_anti")
