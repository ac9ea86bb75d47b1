"""Quality classifier, language identification, language model, decontamination."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import context_mixing, decontaminate, language, quality
from rivulet.llm.textcore import Words
from tests.conftest import SF_MID

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def flat(texts):
    raw = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(raw), np.uint8),
            np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))


def documents(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet")


# --- quality ---------------------------------------------------------------------

def test_features_do_not_depend_on_the_chunk():
    texts = ["", "One two two.\nOne two two.\n", "A | b | c", "x" * 5000, " \n ", "é É 12 ##"]
    whole = quality.features(*flat(texts))
    assert whole.shape == (len(texts), 26) and np.isfinite(whole).all()
    for k, t in enumerate(texts):
        assert np.allclose(quality.features(*flat([t]))[0], whole[k])


def test_flattened_trees_match_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x, y, trees=12, depth=3)

    def walk(row):
        total = m["base"]
        for node in m["root"]:
            while m["left"][node] != node:
                low = row[m["feature"][node]] <= m["threshold"][node]
                node = m["left"][node] if low else m["right"][node]
            total += m["value"][node]
        return 1 / (1 + math.exp(-total))

    p = quality.predict(m, x)
    assert np.allclose(p[:60], [walk(r) for r in x[:60]])
    assert ((p > 0.5) == y).mean() > 0.95


def test_quality_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = quality.op3_scores(documents(spark), labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93


def test_quality_edge_cases(spark):
    schema = "text string, doc_id long, y int, x string, k0 int, quality string"
    rows = [(None, 1), ("", 2), ("a", None), ("word " * 60000, 3), ("a", 4), ("a", 4)]
    docs = spark.createDataFrame([(*r, 1, "x", 2, "q") for r in rows], schema)
    labels = spark.createDataFrame([(1, 0), (2, 1), (4, 1), (4, None), (None, 1)],
                                   "doc_id long, quality int")
    got = quality.op3_scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.op3_scores(docs, labels.limit(0)).count() == 6
    assert quality.op3_scores(docs.limit(0), labels).count() == 0
    scored = quality.score(docs, quality.train(docs, labels))
    assert scored.columns == [*docs.columns, "quality_score"]


# --- language ------------------------------------------------------------------

def test_language_on_held_out_documents(spark):
    docs = documents(spark)
    rows = language.op5_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where(
        "held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_mixture_proportions(spark):
    docs = documents(spark)
    model = language.train(docs)
    texts = {r["lang"]: r["t"] for r in docs.groupBy("lang").agg(
        F.max_by("text", F.length("text")).alias("t")).collect()}
    a, b = "de", "fr"
    cut = [" ".join(texts[x].split()[:n]) for x, n in ((a, 300), (b, 100))]
    main, score, share = language.infer(model, *flat([" ".join(cut), cut[0]]))
    names = model[0]
    assert names[main[0]] == names[main[1]] == a
    assert share[0][names.index(a)] == pytest.approx(0.75, abs=0.08)
    assert share[0][names.index(b)] == pytest.approx(0.25, abs=0.08)
    assert share[1][names.index(a)] == 1.0  # one language explains the second text
    assert score[0] < score[1]


def test_language_edge_cases(spark):
    schema = "text string, doc_id long, lang string, score int, lettered string"
    rows = [(None, 1, "en"), ("", 2, "en"), ("12 !!", 3, None), ("the of and", 4, "en"),
            ("the of and", 4, "en"), ("é", None, "fr"), ("漢字", 6, None), ("of " * 90000, 7, "en")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], schema)
    got = {(r["doc_id"], r["lang_pred"]) for r in language.op5_languages(docs).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= got
    assert all(p == "en" for i, p in got if i in (4, 6, 7, None))
    assert language.op5_languages(docs.limit(0)).count() == 0
    nothing = language.op5_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(nothing) == 8 and {r["lang_pred"] for r in nothing} == {"und"}


# --- language model --------------------------------------------------------------------

def test_trees_code_every_symbol():
    """Kraft sums of one and distinct paths: the decisions define probabilities."""
    counts = np.random.default_rng(2).poisson(0.2, (257, 257))
    length, offset, path = context_mixing.huffman(counts)
    for prev in (0, 97, 256):
        n = length[prev * 257:(prev + 1) * 257]
        assert sum(2.0 ** -k for k in n.tolist()) == pytest.approx(1.0)
        codes = {tuple(path[offset[prev * 257 + s]:offset[prev * 257 + s] + n[s]])
                 for s in range(257)}
        assert len(codes) == 257


TEXTS = ["", "a", "the cat sat on the mat " * 40, "zzz \x00 é  Sat\tON", "x" * 1500, "   "]


def a_model(texts):
    """Trees of the texts, with invented states and odds."""
    data, off = flat(texts)
    data, off = context_mixing.canonical(data, off, Words(data, off))
    rng = np.random.default_rng(3)
    return (context_mixing.huffman(context_mixing.pair_counts(data, off).reshape(257, 257)),
            rng.integers(0, context_mixing.STATES,
                         (context_mixing.CONTEXTS, context_mixing.SLOTS), np.uint8),
            rng.normal(0, 3, context_mixing.CELLS).astype(np.float32)), data, off


def test_scores_do_not_depend_on_chunks_and_slices(monkeypatch):
    model, data, off = a_model(TEXTS)
    whole = context_mixing.log10_probabilities(model, data, off)
    for k in range(len(TEXTS)):
        one = context_mixing.log10_probabilities(model, data[off[k]:off[k + 1]],
                                                 np.array([0, off[k + 1] - off[k]]))
        assert one[0] == pytest.approx(whole[k], rel=1e-5)
    monkeypatch.setattr(context_mixing, "SLICE", 50)
    assert context_mixing.log10_probabilities(model, data, off) == pytest.approx(whole, rel=1e-5)
    assert (whole < 0).all()


def plain_score(model, text):
    """The model's log10 probability of one text, decision by decision."""
    (length, offset, path), table, odds = model
    word, half = (1 << 64) - 1, (1 << 32) - 1
    gap = {0x20, 9, 10, 11, 12, 13}
    symbols = [*b" ".join(x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", text.encode())), 256]
    value = [int(v) for v in context_mixing._VALUE]
    total, shift, seen, pending = 0.0, Counter(), Counter(), []
    for i, symbol in enumerate(symbols):
        if i and i % context_mixing.BLOCK == 0:
            err = Counter()
            for span, e in pending:
                seen[span] += 1
                err[span] += e
            for span, e in err.items():
                shift[span] += 2 * e / (20 + seen[span])
            pending.clear()
        last = [symbols[i - b] if i >= b else 256 for b in range(1, 10)]
        hashed, own = last[0] * 0x2C1B3C6D & half, []
        for b, older in enumerate(last[1:], 2):
            hashed = (hashed ^ older) * (0x297A2D39 + 2 * b) & half
            hashed ^= hashed >> 15
            own += [hashed] if b in context_mixing.ORDERS else []
        begun = max([j + 1 for j in range(i) if symbols[j] in gap] + [0])
        spelt = sum(value[s] * pow(context_mixing._BASE, j, 1 << 64)
                    for j, s in enumerate(symbols[begun:i])) & word
        own.append((spelt * int(context_mixing._M1) & word) >> 32)
        pair = last[0] * 257 + symbol
        for x in path[offset[pair]:offset[pair] + length[pair]].tolist():
            cell = 0
            for j, c in enumerate(own):
                salted = (c ^ (x >> 1) * 0x9E3779B1 & half) * 0x85EBCA6B & half
                cell = cell * context_mixing.STATES + int(
                    table[j, salted >> (32 - context_mixing.SLOT_BITS)])
            z = float(odds[cell])
            span = min(max(math.floor(z), -6), 5)
            p = 1 / (1 + math.exp(-(z + shift[span])))
            total += math.log10(p if x & 1 else 1 - p)
            pending.append((span, (x & 1) - p))
    return total


def test_scores_are_those_of_a_plain_coder():
    model, data, off = a_model(TEXTS)
    assert context_mixing.log10_probabilities(model, data, off) == pytest.approx(
        [plain_score(model, x) for x in TEXTS], rel=1e-4)


def test_weights_are_fitted_to_the_decisions_seen():
    """Two contexts agree with the outcome, one is noise, one empty: the odds come out near the shares."""
    rng = np.random.default_rng(5)
    n, size = 200000, context_mixing.STATES
    bit = rng.random(n) < 0.5
    good = [np.where(rng.random(n) < p, np.where(bit, 30, 24), np.where(bit, 24, 30)) for p in (0.9, 0.8)]
    cell = ((good[0] * size + good[1]) * size + rng.integers(23, 32, n)) * size
    one = np.bincount(cell[bit], minlength=context_mixing.CELLS).astype(float)
    zero = np.bincount(cell[~bit], minlength=context_mixing.CELLS).astype(float)
    odds = context_mixing.fit(zero, one)
    loss = np.log1p(np.exp(np.where(bit, -odds[cell], odds[cell]))).mean()
    best = []
    for a, b in ((30, 30), (30, 24), (24, 30), (24, 24)):
        at = (good[0] == a) & (good[1] == b)
        p = bit[at].mean()
        best.append(-at.mean() * (p * math.log(p) + (1 - p) * math.log(1 - p)))
    assert sum(best) - 1e-3 < loss < sum(best) + 2e-3


def test_language_model_base_is_exact_and_the_model_beats_it(spark):
    docs = documents(spark).select("doc_id", "text", F.lit("x").alias("token"),
                                   F.lit(1).alias("n"), F.lit(2).alias("row"))
    odd = [(None, "The of", "x", 1, 2), (10**7, None, "x", 1, 2), (10**7 + 1, "", "x", 1, 2),
           (10**7 + 1, "", "x", 1, 2), (10**7 + 2, "qqq  ZZZ\n", "x", 1, 2)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = [(r["doc_id"], WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), r["text"] or ""))
             + ["\0end"]) for r in docs.collect()]

    def out(i):
        return i is None or zlib.crc32(str(i).encode()) % 7 == 2

    c = Counter(w for i, ws in rows if not out(i) for w in ws)
    total, distinct = sum(c.values()), len(c)
    want = Counter((i, out(i), len(ws), sum(c[w] > 0 for w in ws), total, round(sum(
        math.log10((c[w] + 1) / (total + distinct + 1)) for w in ws), 5)) for i, ws in rows)
    got = context_mixing.op4_scores(docs).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                    round(r["base_score"], 5)) for r in got) == want
    held = [r for r in got if r["held_out"]]
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_the_model_does_not_depend_on_the_partitions(spark):
    """One outcome holds nearly all, in a few texts; the others are spread."""
    rnd = random.Random(3)
    texts = ["ab " * 4000] * 3 + ["".join(rnd.choices("abc ", k=60)) for _ in range(397)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    models = [context_mixing.train(docs.repartition(n)) for n in (1, 60)]
    assert models[0].table.any() and (models[0].table == models[1].table).all()
    assert (models[0].odds == models[1].odds).all()
    got = [{r["doc_id"]: r["score"] for r in context_mixing.score(docs.repartition(n), m).collect()}
           for n, m in ((60, models[0]), (1, models[1]))]
    assert got[0] == pytest.approx(got[1], rel=1e-5)


def test_the_bound_holds_for_repeated_documents(spark):
    """One labelled doc_id on many rows: no more than the bound reach the driver."""
    docs = spark.range(3000).select(F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("word "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    taken = []

    def watch(x, y, **shape):
        taken.append(len(x))
        return plain(x, y, trees=2, depth=2)

    plain, quality.fit = quality.fit, watch
    try:
        quality.train(docs, labels, max_rows=200)
        quality.train(docs.limit(0), labels, max_rows=200)
    finally:
        quality.fit = plain
    assert taken == [200, 0]


# --- decontamination -----------------------------------------------------------------

def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(4)
    words = [a + b + c for a in ("ka", "lo", "mi", "ru", "te", "so") for b in ("na", "pe", "gi", "vo")
             for c in ("", "x", "nt", "sh", "ld")]

    def prose(n):
        return [rng.choice(("the", "of", "and")) if rng.random() < 0.4 else rng.choice(words) + str(
            rng.randrange(4)) for _ in range(n)]

    items = [(k, " ".join(prose(rng.randrange(18, 60)))) for k in range(30)]
    items += [(100, "alpha beta gamma"), (101, None), (102, ""), (3, items[3][1]), (None, None)]
    rows, want = [], set()
    for k in range(300):
        host = prose(rng.choice([5, 60, 400]))
        if k % 3 == 0:
            i, text = items[rng.randrange(30)]
            t = text.split()
            if k % 2:
                t = [w if rng.random() > 0.12 else rng.choice(words) for w in t]
                t = [w.upper() + "!!" for w in t]
            at = rng.randrange(len(host) + 1)
            host[at:at] = t
            want.add((k, i))
        rows.append((k, " ".join(host)))
    rows += [(500, "so alpha beta gamma it is"), (501, "alpha gamma beta"), (502, None), (503, "")]
    want.add((500, 100))
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = decontaminate.hits(docs, bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found) == len(got)
    assert len(want & found) >= 0.97 * len(want)
    assert {d for d, _ in found} <= {d for d, _ in want}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in found}
    assert decontaminate.hits(docs.limit(0), bench).count() == 0
    assert decontaminate.hits(docs, bench.limit(0)).count() == 0


def test_common_weight_is_the_heaviest_common_subsequence():
    rng = random.Random(6)
    for _ in range(50):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(6) for _ in range(rng.randrange(1, 12))]
        v = [rng.random() for _ in a]
        table = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j],
                                          table[i][j] + (v[i] if a[i] == b[j] else 0))
        got, _ = decontaminate.common_weight(np.array(a), np.array(v), np.array(b))
        assert got == pytest.approx(table[-1][-1])


def _every_window(docs, bench, idf_of):
    """Brute force: the checks of every passage at every window."""
    want, block = {}, decontaminate.BLOCK
    cut = decontaminate.passages(pa.array([" ".join(w) for _, w in bench]))
    for key, text in docs:
        w = decontaminate._words(pa.array([text])).hash
        for q, p in cut:
            v = idf_of(p)
            for a in range(0, len(w), block):
                region = w[max(0, a - len(p)):a + 2 * block + len(p)]
                kind = decontaminate.check(p, v, region)[0]
                if kind:
                    want[key, bench[q][0]] = kind
    return want


@pytest.mark.parametrize("items", [200, 2000, pytest.param(20_000, marks=pytest.mark.skipif(
    "RIVULET_LONG_TESTS" not in os.environ, reason="four minutes"))])
def test_recall_against_every_window_with_many_items(spark, monkeypatch, items):
    """Copies and paraphrases (words dropped, replaced, moved) of items of 3 to 60 words.
    Word-for-word copies are all found; of all that a check of every window finds,
    at least nine in ten."""
    if items == 20_000:
        monkeypatch.setattr(decontaminate, "PASSAGES", 1 << 15)  # one pass over the documents
    rnd = random.Random(items)
    zipf = [1 / (k + 3) for k in range(20_000)]

    def words(n):
        return [f"w{k}" for k in rnd.choices(range(20_000), zipf, k=n)]

    bench = [(k, words(3 + k % 58)) for k in range(items)]
    docs, copies, tried = [], set(), []
    for n, (k, item) in enumerate(bench[::items // 100]):
        put = list(item)
        if n % 4:
            lost = (0.1, 0.2, 0.3)[n % 3]
            put = [w if rnd.random() > 0.08 else f"w{rnd.randrange(20_000)}"
                   for w in item if rnd.random() > lost]
            if len(put) > 8:
                at = rnd.randrange(len(put) - 5)
                put[at:at + 3] = reversed(put[at:at + 3])
        else:
            copies.add((k, k))
        text = words(rnd.randrange(40, 200))
        at = rnd.randrange(len(text))
        docs.append((k, " ".join(text[:at] + put + text[at:])))
        tried.append((k, item))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.hits(
        frame, spark.createDataFrame([(k, " ".join(w)) for k, w in bench],
                                     "item_id bigint, text string")).collect()}
    assert {c for c in copies if got.get(c) == "copy"} == copies
    runs = np.concatenate([h for _, h in decontaminate.passages(
        pa.array([" ".join(w) for _, w in bench]))])
    vocab = np.unique(runs)
    idf = decontaminate.weights(frame.select("text"), vocab)
    want = _every_window(docs, tried, lambda p: idf[decontaminate._known(vocab, p)])
    paraphrases = {c for c in want if c not in copies}
    assert len(paraphrases) > 25
    assert len(paraphrases & set(got)) >= 0.9 * len(paraphrases)
    assert {c for c in got if c in {(k, i) for k, _ in docs for i, _ in tried}} <= set(want)


def test_hits_stand_the_checks_and_come_from_the_latent_space(spark, monkeypatch):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    zipf = [1 / (k + 3) for k in range(3000)]
    bench = [(k, rnd.choices(words, zipf, k=rnd.randrange(3, 100))) for k in range(150)]
    docs = []
    for k in range(24):
        text = rnd.choices(words, zipf, k=rnd.randrange(10, 150))
        item = [w for w in bench[5 * k][1] if rnd.random() < (1, 0.75, 0.62)[k % 3]]
        docs.append((k, " ".join(text[:30] + item + text[30:])))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in bench], "item_id bigint, text string")
    vocab = np.unique(np.concatenate([h for _, h in decontaminate.passages(
        pa.array([" ".join(w) for _, w in bench]))]))
    idf = decontaminate.weights(frame.select("text"), vocab)
    want = set(_every_window(docs, bench, lambda p: idf[decontaminate._known(vocab, p)]))

    def found():
        return {(r["doc_id"], r["item_id"]) for r in decontaminate.hits(frame, items).collect()}

    got = found()
    assert got <= want and len(got) >= 0.9 * len(want)
    # Several blocks of passages, and windows taken in turns, change nothing.
    monkeypatch.setattr(decontaminate, "PASSAGES", 60)
    monkeypatch.setattr(decontaminate, "TURN", 3)
    assert len(found() ^ got) <= 0.05 * len(got)
    # Without the latent space only what stands word for word is left.
    monkeypatch.setattr(decontaminate, "latent_space",
                        lambda rows, own, *a: np.zeros((len(own), 4), np.float32))
    exact = {(k, i) for k, t in docs for i, w in bench if f" {' '.join(w)} " in f" {t} "}
    alone = found()
    assert exact <= alone < got


def test_rows_are_cleaned_by_their_text(spark):
    """Rows without an id, or with one id, are judged apart."""
    item = "seven quiet herons cross the frozen estuary before the early tide returns"
    rows = [(None, f"so {item} it is"), (None, "a clean row"), (4, f"x {item}"), (4, "another clean row"),
            (4, "another clean row"), (5, None), (6, "")]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, _leaked string")
    kept = decontaminate.clean(docs.drop("_leaked").withColumn("key", F.lit(1)),
                               spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [r for r in rows if item not in (r[1] or "")], key=str)
