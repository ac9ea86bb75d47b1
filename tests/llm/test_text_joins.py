"""N-gram join, components and embeddings against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from rivulet.llm import embedding_join, ngram_join
from rivulet.llm.common import connected_components
from rivulet.llm.textcore import Words, mix, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingle_set(text, size):
    w = WORD.findall(fold(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(rows, size, num, den):
    sets = {i: shingle_set(t, size) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return sorted((i, len(sets[i]), comp[i]) for i in sets)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()),
                  key=str)


def test_words_and_shingles_match_plain_python():
    texts = ["", "one", "Ab  aB\tc\nab ab c", " é É ", "x y", "\x0b\x0c \r\n", "a b c d a b c"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    w = Words(data, off)
    assert w.count.tolist() == [len(WORD.findall(t)) for t in texts]
    names = {}
    for h, word in zip(w.hash, [x for t in texts for x in WORD.findall(fold(t))], strict=True):
        assert names.setdefault(int(h), word) == word
    assert len(set(names.values())) == len(names)
    for size in (1, 3, 5):
        doc, _ = shingles(w, size)
        assert np.bincount(doc, minlength=len(texts)).tolist() == [
            len(shingle_set(t, size)) for t in texts]


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100)])
def test_linked_sets_share_enough_signatures(num, den):
    """The index's guarantee, for random sets and any choice of frequent tokens."""
    rng = np.random.default_rng(5)
    universe = mix(np.arange(1, 4000, dtype=np.uint64))
    tried = 0
    for trial in range(400):
        n = int(rng.integers(2, 12) if trial % 2 else rng.integers(12, 700))
        base = rng.choice(universe, n, replace=False)
        cut = int(rng.integers(0, max(1, n // 6) + 1))
        other = np.concatenate([base[cut:], rng.choice(universe, int(rng.integers(0, cut + 1)))])
        pair = [np.unique(base), np.unique(other)]
        both = len(np.intersect1d(*pair))
        if den * both < num * (len(pair[0]) + len(pair[1]) - both) or both == len(pair[0]) == len(
                pair[1]):
            continue
        tried += 1
        doc = np.repeat([0, 1], [len(x) for x in pair])
        s = np.concatenate(pair)
        share = rng.choice([0.0, 0.5, 1.0])
        level = np.where(mix(s) % np.uint64(100) < share * 100, 1 + mix(s) % np.uint64(3),
                         0).astype(np.int64)
        row, sig, bucket = ngram_join.signatures(
            doc, s, np.array([len(x) for x in pair]), level, num, den)
        common = defaultdict(int)
        mine = [{(x, b) for x, b in zip(sig[row == k].tolist(), bucket[row == k].tolist(),
                                        strict=True)} for k in (0, 1)]
        for _, b in mine[0] & mine[1]:
            common[b] += 1
        assert any(c >= ngram_join.least_shared(np.int64(b)) for b, c in common.items())
    assert tried > 60


def make_documents(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    passage = " ".join(rng.choices(words, k=25))
    rows, i = [], 0
    for _ in range(n):
        text = rng.choices(words, k=rng.choice([1, 2, 3, 8, 40, 120]))
        if rng.random() < 0.4:
            text[rng.randrange(len(text)):0] = passage.split()
        copies = rng.choice([1, 1, 1, 2, 5, 12])
        for _ in range(copies):
            t = list(text)
            for _ in range(rng.choice([0, 0, 1, 2])):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i * 7 + 1, " ".join(t).upper() if rng.random() < 0.1 else " ".join(t)))
            i += 1
    return rows


@pytest.mark.parametrize(("size", "num", "small"), [(3, 90, 32), (5, 80, 1)])
def test_join_matches_brute_force(spark, monkeypatch, size, num, small):
    rows = make_documents(size)
    monkeypatch.setattr(ngram_join, "SMALL", small)  # 1: blocks for every signature
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 1 << 9)  # many frequent tokens
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(ngram_join.similar_documents(df, size, num, 100)) == sorted(
        brute(rows, size, num, 100), key=str)


def test_star_rounds_on_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"v{k}" for k in range(200)]
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(rng.randrange(5)):
            t[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert result(ngram_join.similar_documents(df, 3, 90, 100)) == sorted(
        brute(rows, 3, 90, 100), key=str)


def test_join_edge_cases(spark):
    schema = "text string, doc_id long, n long, node string, component_id int"
    rows = [(None, 1), ("", 2), (" \n", 3), ("a", 4), ("A", 5), ("a b", 6), ("a  b", 6),
            ("q r s t", None), ("q r s t", 9), ("q r s t", 8), ("q r s t", 8),
            ("z " * 30000, 11), ("Z\n" * 29000, 10)]
    df = spark.createDataFrame([(*r, 5, "x", 7) for r in rows], schema)
    got = result(ngram_join.similar_documents(df, 3, 90, 100))
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6),
                          (6, 1, 6), (None, 2, None), (9, 2, 8), (8, 2, 8), (8, 2, 8),
                          (11, 1, 10), (10, 1, 10)], key=str)
    kept = ngram_join.first_of_each(df, 3, 90, 100)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == sorted(
        ["1", "2", "3", "4", "6", "None", "8", "10"])
    assert ngram_join.similar_documents(df.limit(0), 3, 90, 100).count() == 0


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000, k) for k in range(1001, 1100)] + [(k, k + 1) for k in range(2000, 2060)]
    links += [(5, 5), (7000, 7000)]
    got = {r["id"]: r["root"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == components(nodes, [(a, b) for a, b in links if a != b])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows, least):
    good = {}
    for k, (_, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = np.array(v, float)
        if v.any():
            good[k] = (label, v / np.linalg.norm(v))
    links = [(a, b) for a in good for b in good if a < b and good[a][0] == good[b][0]
             and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= least]
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    roots = components(range(len(rows)), links)
    low = defaultdict(list)
    for k, r in roots.items():
        if rows[k][0] is not None:
            low[r].append(rows[k][0])
    return sorted(((i, n[k], min(low[roots[k]]) if i is not None else None,
                    i is not None and i == min(low[roots[k]]))
                   for k, (i, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [32, 1024])
def test_embeddings_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    monkeypatch.setattr(embedding_join, "LEAF", 8)
    rng = np.random.default_rng(4)
    rows = []
    for k in range(12):
        centre = rng.normal(size=8)
        for _ in range(18):
            v = centre + rng.normal(size=8) * rng.choice([0.0, 0.05, 0.15])
            rows.append([len(rows), (v * rng.choice([0.5, 1, 3])).astype(np.float32).tolist(),
                         int(k % 3) if rng.random() < 0.95 else None])
    rows += [[900, None, 1], [901, [0.0] * 8, 1], [902, [float("nan")] + [1.0] * 7, 1],
             [903, [None] + [1.0] * 7, 1], [904, [float("inf")] + [1.0] * 7, 1], [905, [], 1],
             [906, [1.0, 2.0], 1], [907, [1.0, 2.0], 1], [None, [1.0, 2.0], 1],
             [908, [1.0, 2.0], 2], [3, rows[3][1], rows[3][2]]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, id string, n int")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"])
                  for r in embedding_join.near_embeddings(df, 0.98).collect()), key=str)
    assert got == brute_vectors(rows, 0.98)
    assert embedding_join.near_embeddings(df.limit(0)).count() == 0


def test_rows_that_share_a_doc_id_are_told_apart(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    near_a = a + " tail"
    rows = [(1, a), (1, b), (1, b), (1, near_a), (2, a), (3, "c d e f g h"), (3, b), (0, "c d e f g h"),
            (None, a), (None, a), (4, None), (4, ""), (4, "z")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, node int")
    kept = sorted(((r["doc_id"], r["text"]) for r in ngram_join.first_of_each(df, 3, 80, 100).collect()),
                  key=str)
    as_a = [(1, a)] if (1, a) in kept else [(1, near_a)]   # either stands for their component
    empty = [r for r in kept if r[0] == 4 and not r[1]]
    assert len(empty) == 1
    assert kept == sorted([*as_a, (1, b), (0, "c d e f g h"), (None, a), (None, a), (4, "z"), *empty],
                          key=str)


@pytest.mark.parametrize("num", [50, 65, 80, 95])
def test_links_match_brute_force_at_every_threshold(spark, num):
    rng = random.Random(num)
    texts = []
    for k in range(60):
        words = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(3, 40))]
        texts.append(" ".join(words))
        cut = rng.randrange(1, len(words) + 1)
        texts.append(" ".join(words[:cut] + [f"x{k}"] * rng.randrange(3)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(ngram_join.similar_documents(df, 1, num, 100)) == sorted(
        brute(list(enumerate(texts)), 1, num, 100), key=str)


def test_rounds_leave_out_what_is_settled(spark, monkeypatch):
    """Signatures of few classes are all tried in the first step: later ones read none."""
    whole, read = ngram_join.stored, []

    def counted(df, name):
        table = whole(df, name)
        if name == "ngram-members":
            read.append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "stored", counted)
    words = [f"w{k}" for k in range(12)]
    df = spark.createDataFrame([(k, " ".join(words[:12 - k % 3] + [f"own{k}"])) for k in range(9)],
                               "doc_id long, text string")
    assert result(ngram_join.similar_documents(df, 1, 70, 100)) == sorted(
        (k, 13 - k % 3, 0) for k in range(9))
    assert read[0] > 0 and read[1:] == [0]


def test_signatures_of_many_classes_begin_with_a_star(spark, monkeypatch):
    """However few pairs there are: the steps depend on group sizes, not on the input's.
    Signatures of few classes wait and are tried once."""
    whole, read = ngram_join.stored, []

    def counted(df, name):
        table = whole(df, name)
        if name.endswith("members"):
            read.append((name, table.count()))
        return table

    monkeypatch.setattr(ngram_join, "stored", counted)
    monkeypatch.setattr(ngram_join, "SMALL", 4)
    texts = [" ".join([f"w{n}" for n in range(40)] + [f"own{k}"]) for k in range(9)]
    texts += [" ".join([f"v{k // 2}x{n}" for n in range(40)] + [f"end{k}"]) for k in range(30)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(ngram_join.similar_documents(df, 3, 90, 100)) == sorted(
        brute(rows, 3, 90, 100), key=str)
    names = [name for name, _ in read]
    assert names.count("ngram-few-members") == 1
    assert names.index("ngram-few-members") > names.index("ngram-open-members")
    later = [n for name, n in read if name == "ngram-members"][1:]
    assert later and max(later) < read[0][1]


def test_few_rows_take_few_tasks(spark, tmp_dir, monkeypatch):
    """A cluster's number of partitions is not the number of tasks of a table of a few rows."""
    import os

    from rivulet.llm import common
    files = {}

    def counted(df, name):
        table = whole(df, name)
        path = table._stored_at.replace("file:", "")
        files.setdefault(name, []).append(sum(f.endswith(".parquet") for f in os.listdir(path)))
        return table

    whole = common.stored
    monkeypatch.setattr(common, "stored", counted)
    monkeypatch.setattr(ngram_join, "stored", counted)
    options = {"spark.sql.shuffle.partitions": "40",
               "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        rows = [(k, " ".join([f"v{k // 3}x{n}" for n in range(40)] + [f"end{k}"]))
                for k in range(90)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert result(ngram_join.similar_documents(df, 3, 90, 100)) == sorted(
            brute(rows, 3, 90, 100), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    few = {"cc-edges", "cc-low", "cc-large", "ngram-classes", "ngram-post", "ngram-open",
           "ngram-pairs", "ngram-links", "ngram-named"}
    assert few <= set(files) and max(max(files[name]) for name in few) <= 4


def test_tables_nothing_reads_are_removed(spark, tmp_dir, monkeypatch):
    import os

    from rivulet.llm import common
    monkeypatch.setattr(common, "scratch_path", lambda spark, name: os.path.join(
        tmp_dir, f"{name}-{len(os.listdir(tmp_dir))}-{os.urandom(4).hex()}"))
    rng = random.Random(3)
    texts = [" ".join(f"w{(k // 4) * 50 + n + (n == rng.randrange(50))}" for n in range(50))
             for k in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.similar_documents(df, 1, 80, 100)
    left = {n.rsplit("-", 2)[0] for n in os.listdir(tmp_dir)}
    assert "ngram-named" in left and "ngram-links" in left
    assert not left & {"ngram-index", "ngram-post", "ngram-sets", "ngram-members", "ngram-pairs",
                       "ngram-near", "cc-low", "cc-large"}
    assert result(got) == sorted(brute(list(enumerate(texts)), 1, 80, 100), key=str)


def test_thresholds_below_one_half_are_refused(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for num, den in ((20, 100), (49, 100), (101, 100), (0, 100)):
        with pytest.raises(ValueError):
            ngram_join.similar_documents(df, 3, num, den)
