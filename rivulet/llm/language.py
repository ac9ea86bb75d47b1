"""Language identification by multilingual mixture inference.

Learning counts hashed three-byte grams of letters (ASCII case folded, with word
edges) per language over all usable documents: every task sums its own counts,
Spark sums them per (language, gram). The table has at most ``GRAMS`` entries per
language, whatever the input size.

A document is a mixture: each word was written in one of the languages, with
the document's proportions. A word's likelihood under a language is the
product of its grams' probabilities (tempered by the gram length, as each byte
is in three grams). Expectation-maximisation estimates the proportions, for
sets of languages of growing size: the best single language first, then the
set grown by the language with the largest estimated share, as long as the
likelihood penalised by ``PENALTY * languages * log(1 + words)`` rises. The
prediction is the language with the largest share in the selected set; the
score is its share when all learned languages may take part.

All documents of a chunk are iterated together. Scoring is one map; only
gram counts are shuffled.

Defined cases: null text and text without a letter are ``und`` with score 0;
so is every text when no language was learned; letters in no learned gram
give the language that the smoothed tables favour; repeated rows each count; null
languages and null doc_ids are not learned from; an empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.quality import remainder
from rivulet.llm.textcore import LOWER, chunks, row_sums, text_bytes

GRAMS, ROUNDS, PENALTY = 1 << 16, 8, 1.5
NOT_LETTER = 32

# Bytes as letters: ASCII letters folded, other ASCII an edge, the rest as they are.
_LETTER = np.full(256, NOT_LETTER, np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_LETTER = _LETTER[LOWER]


def grams(data: np.ndarray, off: np.ndarray):
    """Hashed grams and the word each lies in: ``gram, word, doc`` (doc per word).

    The bytes are cut into runs of letters; a run of k letters has k grams,
    each centred on a letter, edges included.
    """
    n = len(data)
    code = np.full(n + 2, NOT_LETTER, np.uint32)
    code[1:-1] = _LETTER[data]
    letter = code[1:-1] != NOT_LETTER
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    left, right = code[:-2].copy(), code[2:].copy()
    left[edge[:n]] = NOT_LETTER
    right[edge[1:]] = NOT_LETTER
    at = np.flatnonzero(letter)
    key = (left[at] << np.uint32(16)) | (code[1:-1][at] << np.uint32(8)) | right[at]
    gram = (key * np.uint32(2654435761)) >> np.uint32(16)
    begin = left[at] == NOT_LETTER
    word = np.cumsum(begin) - 1
    doc = np.searchsorted(off, at[begin], "right") - 1
    return gram, word, doc


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for b in chunks(batches, "text"):
        gram, word, doc = grams(*text_bytes(b.column("text")))
        lang = b.column("lang").dictionary_encode()
        code = np.asarray(lang.indices)[doc[word]] if len(word) else np.empty(0, np.int64)
        size = len(lang.dictionary)
        counts = np.bincount(code.astype(np.int64) * GRAMS + gram, minlength=size * GRAMS)
        for name, c in zip(lang.dictionary.to_pylist(), counts.reshape(size, GRAMS), strict=True):
            sums[name] = sums.get(name, 0) + c
    for name, c in sums.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(c[at])],
            ["lang", "gram", "n"])


def train(docs: DataFrame, usable: Column | None = None) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and log probabilities (GRAMS, languages)."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    if usable is not None:
        rows = rows.where(usable)
    counts = (rows.select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(counts["lang"].to_pylist()))
    table = np.full((GRAMS, len(names)), 0.5)
    place = {name: k for k, name in enumerate(names)}
    column = np.array([place[x] for x in counts["lang"].to_pylist()], np.int64)
    table[np.asarray(counts["gram"]), column] += np.asarray(counts["n"])
    return names, np.log(table / table.sum(0)).astype(np.float32)


def _em(like: np.ndarray, doc: np.ndarray, words: np.ndarray, member: np.ndarray):
    """Shares (rows, languages) and log likelihood of the mixture of the languages in
    ``member`` (rows, languages); ``like`` are log likelihoods per word."""
    rows = len(words)
    share = member / member.sum(1, keepdims=True)
    peak = np.where(member[doc], like, -np.inf).max(1)
    with np.errstate(under="ignore"):
        odds = np.where(member[doc], np.exp(like - peak[:, None]), 0)
    for _ in range(ROUNDS):
        part = odds * share[doc]
        part /= part.sum(1, keepdims=True)
        share = row_sums(part, doc, rows) / np.maximum(words, 1)[:, None]
        share = np.where(member, np.maximum(share, 1e-9), 0)
        share /= share.sum(1, keepdims=True)
    total = row_sums(np.log((odds * share[doc]).sum(1)) + peak, doc, rows)
    return share, total


def infer(model, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Main language (index), its share among all languages, and all shares of the
    selected set, per row."""
    table = model[1]
    gram, word, doc = grams(data, off)
    rows, langs = len(off) - 1, table.shape[1]
    like = row_sums(table[gram].astype(np.float64), word, len(doc)) / 3
    words = np.bincount(doc, minlength=rows).astype(np.float64)
    everything = np.ones((rows, langs), bool)
    full, _ = _em(like, doc, words, everything)
    single = row_sums(like, doc, rows)
    first = single.argmax(1)
    member = np.zeros((rows, langs), bool)
    member[np.arange(rows), first] = True
    best = single.max(1) - PENALTY * np.log1p(words)
    share = member.astype(np.float64)
    rank = np.argsort(-np.where(member, np.inf, full), 1, kind="stable")
    growing = words > 1
    for size in range(2, langs + 1):
        todo = np.flatnonzero(growing)
        if not len(todo):
            break
        bigger = member[todo].copy()
        bigger[np.arange(len(todo)), rank[todo, size - 1]] = True
        place = np.full(rows, -1)
        place[todo] = np.arange(len(todo))
        mine = place[doc] >= 0
        s, total = _em(like[mine], place[doc[mine]], words[todo], bigger)
        value = total - PENALTY * size * np.log1p(words[todo])
        better = value > best[todo]
        growing[todo[~better]] = False
        todo = todo[better]
        member[todo], share[todo], best[todo] = bigger[better], s[better], value[better]
    main = share.argmax(1)
    return main, full[np.arange(rows), main], share


def _predict(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = model.value[0]
        for b in chunks(batches, "text"):
            known = np.asarray(b.column("lettered")).astype(bool)
            if langs:
                main, score, _ = infer(model.value, *text_bytes(b.column("text")))
                pred = np.where(known, np.array(langs, object)[main], "und")
                score = np.where(known, np.clip(score, 0, 1), 0.0)
            else:
                pred, score = np.full(b.num_rows, "und", object), np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(pred, pa.string()), pa.array(score)],
                [*names, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model, key: str = "doc_id") -> DataFrame:
    """``key, lang_pred, score`` per row of ``docs(key, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, "text", lettered.alias("lettered")).mapInArrow(
        _predict(shared, [key]), f"{key} {kind}, lang_pred string, score double")


def op5_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows with a null doc_id are held out."""
    model = train(docs, remainder(4) != 2)
    return predict(docs, model).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(True)).alias("held_out"),
        "lang_pred", "score")
